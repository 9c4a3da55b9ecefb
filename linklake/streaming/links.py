"""Incremental runs over folders that keep filling up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linklake import schemas, storage
from linklake.operators.anchors import page_anchors, page_links
from linklake.operators.sites import site_counts
from linklake.sources.archives import ARCHIVE_GLOB, STRETCH_BYTES, cut_archives, read_records, stretches_of, task_count

# Fixed value: how often collected links are written out.
FLUSH_INTERVAL = "10 seconds"
UNIT_BYTES = 64 << 30  # archive bytes that are committed together
JOB_BYTES = 64 << 30  # archive bytes of the units that one job writes, unless a single unit has more
COMPACT_EVERY = 20  # batches of changes between two compactions
SITE_COUNT = "primary_link string, frequency bigint"


@dataclass(frozen=True)
class Flush:
    """When a batch is written out: after ``interval``, and with no more input than
    ``max_files`` or ``max_bytes`` (one of the two; at least one file is taken)."""

    interval: str = FLUSH_INTERVAL
    max_files: int | None = None
    max_bytes: int | None = None

    def admitting(self, reader):
        if self.max_files is not None and self.max_bytes is not None:
            raise ValueError("bound a batch by files or by bytes, not by both")
        if self.max_files is not None:
            return reader.option("maxFilesPerTrigger", self.max_files)
        return reader if self.max_bytes is None else reader.option("maxBytesPerTrigger", self.max_bytes)

    def triggered(self, writer, available_now: bool):
        return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=self.interval)


def new_archives(spark: SparkSession, folder: str, glob: str = ARCHIVE_GLOB, flush: Flush = Flush()) -> DataFrame:
    """A stream of the paths and sizes of archives as they arrive; no content is read."""
    stream = spark.readStream.format("binaryFile").schema(schemas.BINARY_FILE)
    stream = flush.admitting(stream.option("pathGlobFilter", glob)).load(folder)
    return stream.select(F.col("path").alias("warc_file"), F.col("length").alias("file_bytes"))


def write_new_links(
    paths: DataFrame,
    output: str,
    checkpoint: str,
    available_now: bool = False,
    stretch_bytes: int = STRETCH_BYTES,
    unit_bytes: int = UNIT_BYTES,
    flush: Flush = Flush(),
) -> StreamingQuery:
    """Extract the links of arriving archives into Parquet, each link once.

    A batch's archives are cut into byte stretches, so one big archive is read by many
    tasks. The stretches are dealt over units of about ``unit_bytes``, and the plan is
    stored with the checkpoint. A unit is written as a whole to a folder of its own,
    ``batch_id=N/unit=K``. A batch that runs again keeps to the stored plan, passes over units
    that are whole and writes those that were broken off anew.

    One job writes several small units: as many as this run has written before it, so a break
    loses no more than is kept, and no more than ``JOB_BYTES``.
    """
    done = 0

    def store(batch: DataFrame, number: int) -> None:
        nonlocal done
        spark, plan = batch.sparkSession, f"{checkpoint}/stretches/batch_id={number}"
        if not storage.is_whole(spark, plan):
            cut = stretches_of(batch, stretch_bytes)
            units = max(1, -(-cut.count() * stretch_bytes // unit_bytes))
            dealt = cut.withColumn("unit", _unit_of(F.col("stretch"), units)).withColumn("units", F.lit(units))
            dealt.write.mode("overwrite").parquet(plan)
        planned = spark.read.parquet(plan)
        sizes = {r["unit"]: r["count"] for r in planned.groupBy("unit").count().collect()}  # one row a unit
        # A plan of an earlier version does not say over how many units it is dealt.
        dealt_over = planned.first()["units"] if sizes and "units" in planned.columns else None
        place = f"{output}/batch_id={number}"
        whole = set(storage.numbered(spark, place, "unit"))
        left = [unit for unit in sorted(sizes) if unit not in whole]
        while left:
            most = min(max(1, done), max(1, JOB_BYTES // unit_bytes)) if dealt_over else 1
            units, left = left[:most], left[most:]
            own = planned.where(F.col("unit").isin(units)).select("warc_file", "stretch", "start", "end")
            stretches = sum(sizes[unit] for unit in units)
            tasks = stretches if len(units) == 1 else task_count(stretches, stretch_bytes)
            spread = own.repartition(tasks, "warc_file", "stretch")
            links = page_links(page_anchors(read_records(spread, rec_types=("response",))))
            if len(units) == 1:
                links.write.mode("overwrite").parquet(f"{place}/unit={units[0]}")
            else:
                _write_units(links, place, units, dealt_over)
            done += len(units)

    writer = paths.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return flush.triggered(writer, available_now).start()


def _unit_of(stretch: Column, units: int) -> Column:
    """Which unit a stretch of ``warc_file`` belongs to."""
    return F.pmod(F.xxhash64("warc_file", stretch), F.lit(units))


def _write_units(links: DataFrame, place: str, units: list[int], dealt_over: int) -> None:
    """Links of several units, by one job, each in a folder of its own, which is marked as whole
    once its files are in it."""
    stretch = F.shiftright("record_pos", 32).cast("int")  # a record's position begins with it
    writer = links.withColumn("unit", _unit_of(stretch, dealt_over)).write.partitionBy("unit").mode("overwrite")
    # Only folders of units that are written are replaced, and the batch's folder gets no mark.
    writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(place)
    storage.mark_whole(links.sparkSession, place, [f"unit={unit}" for unit in units])


def running_site_counts(links: DataFrame) -> DataFrame:
    """Links per site over a stream of links.

    State is one count a site and never expires, as links carry no event time:
    run it with the RocksDB state store. Subsections are left to the batch job.
    """
    return site_counts(links)


def write_site_counts(
    links: DataFrame,
    output: str,
    checkpoint: str,
    available_now: bool = False,
    compact_every: int = COMPACT_EVERY,
    flush: Flush = Flush(),
) -> StreamingQuery:
    """Keep changed site counts under ``output``, one folder a batch, compacted from time to time.

    A batch that runs again after a failure overwrites its own folder, so every
    link counts once.
    """

    def store(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/changes/batch_id={batch}")
        if (batch + 1) % compact_every == 0:
            compact_site_counts(changed.sparkSession, output)

    writer = running_site_counts(links).writeStream.outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(store)
    return flush.triggered(writer, available_now).start()


def _reached(spark: SparkSession, output: str) -> tuple[DataFrame, int]:
    """The count each site has reached, and the last batch that is in it (-1: none).

    Read are the newest base, whose version is the last batch in it, and the changes after.
    """
    known = storage.versions(spark, f"{output}/base")
    mark = known[-1] if known else -1
    later = [b for b in storage.numbered(spark, f"{output}/changes", "batch_id") if b > mark]
    rows = spark.createDataFrame([], f"{SITE_COUNT}, batch_id bigint")
    if known:
        base = storage.read_version(spark, f"{output}/base", mark, SITE_COUNT)
        rows = base.withColumn("batch_id", F.lit(mark).cast("bigint"))
    if later:
        folders = [f"{output}/changes/batch_id={b}" for b in later]
        reader = spark.read.schema(f"{SITE_COUNT}, batch_id bigint").option("basePath", f"{output}/changes")
        rows = rows.unionByName(reader.parquet(*folders))
    counts = rows.groupBy("primary_link").agg(F.max_by("frequency", "batch_id").alias("frequency"))
    return counts, max([mark, *later])


def compact_site_counts(spark: SparkSession, output: str) -> None:
    """Fold the changes so far into a new base, marked with the last batch in it.

    Changes that the base before holds too are deleted with the bases older than that, so
    what a reader has to open does not grow with the number of batches.
    """
    counts, mark = _reached(spark, output)
    if mark < 0:
        return
    kept = storage.write_version(counts, f"{output}/base", mark)
    for batch in storage.numbered(spark, f"{output}/changes", "batch_id"):
        if len(kept) > 1 and batch <= kept[0]:
            storage.delete(spark, f"{output}/changes/batch_id={batch}")


def latest_site_counts(spark: SparkSession, output: str) -> DataFrame:
    """The count each site has reached."""
    return _reached(spark, output)[0]
