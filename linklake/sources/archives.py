"""Crawl archives as record DataFrames.

Listing, spreading and everything after the split is Spark's. The only Python
stage is the splitter, fed with paths or coordinates (never with file content)
and handing back Arrow batches bounded by bytes.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linklake import schemas
from linklake.session import bound_batches
from linklake.sources.archive_bytes import failure, joined_ranges, open_at, read_range, size_of, split_records, split_stretch
from linklake.storage import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARCHIVE_GLOB = "*.warc.gz"
HAS_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:/"
BATCH_BYTES = 16 << 20
STRETCH_BYTES = 256 << 20
# Small stretches share tasks once there are many: a task has at least so many bytes then.
TASK_BYTES = 4 << 20
LEAST_TASKS = 32
BATCH_ROWS = 2000

_HEADER_MAP = pa.map_(pa.string(), pa.string())
_RECORD_ARROW = [
    ("record_pos", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
    ("rec_type", pa.string()), ("content_type", pa.string()), ("target_uri", pa.string()),
    ("warc_headers", _HEADER_MAP), ("http_headers", _HEADER_MAP),
    ("payload", pa.binary()), ("error", pa.string()),
]


def resolve_path(path: Column, base_uri: str | None = None, local_base: str | None = None) -> Column:
    """Put the base before paths that have no scheme; with no base, relative
    local paths start at ``local_base``."""
    if base_uri:
        return F.when(path.rlike(HAS_SCHEME), path).otherwise(F.concat(F.lit(base_uri), path))
    if local_base:
        relative = ~path.rlike(HAS_SCHEME) & ~path.startswith("/")
        return F.when(relative, F.concat(F.lit(local_base.rstrip("/") + "/"), path)).otherwise(path)
    return path


def list_archives(spark: SparkSession, folder: str, glob: str = ARCHIVE_GLOB) -> DataFrame:
    """Paths and sizes under a folder; no content is read. Spark packs files into
    tasks by size, so a big archive has a task of its own."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return listing.select(F.col("path").alias("warc_file"), F.col("length").alias("file_bytes"))


def with_sizes(paths: DataFrame, tasks: int | None = None) -> DataFrame:
    """Sizes of listed archives, asked for by tasks and stored once; null where an archive
    cannot be found. Its one stretch then gives the row with the error."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0)
            sizes = pa.array([size_of(name) for name in names.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([names, sizes], names=["warc_file", "file_bytes"])

    tasks = tasks or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = paths.select("warc_file").repartition(tasks)
    return written(spread.mapInArrow(probe, "warc_file string, file_bytes bigint"), "archive-sizes")


def stretches_of(paths: DataFrame, stretch_bytes: int = STRETCH_BYTES) -> DataFrame:
    """Archives of known size as byte stretches; one of unknown size is a single stretch."""
    last = F.coalesce(F.floor((F.col("file_bytes") - 1) / stretch_bytes), F.lit(0)).cast("int")
    number = F.col("stretch").cast("bigint")
    cut = paths.where("file_bytes is null or file_bytes > 0").select(
        "warc_file", "file_bytes", F.explode(F.sequence(F.lit(0), last)).alias("stretch")
    )
    end = F.when(F.col("file_bytes").isNull(), F.lit((1 << 63) - 1)).otherwise((number + 1) * stretch_bytes)
    return cut.select("warc_file", "stretch", (number * stretch_bytes).alias("start"), end.alias("end"))


def task_count(stretches: int, stretch_bytes: int, unsized: int = 0) -> int:
    """Tasks for a number of stretches and of archives of unknown size, which may be long."""
    shared = -(-stretches * min(stretch_bytes, TASK_BYTES) // TASK_BYTES)
    return max(1, min(stretches + unsized, max(LEAST_TASKS, shared + unsized)))


def cut_archives(paths: DataFrame, stretch_bytes: int = STRETCH_BYTES, tasks: int | None = None) -> DataFrame:
    """Archives of known size cut into byte stretches and spread over tasks.

    However much of the data one file holds, a task reads stretches of about
    ``stretch_bytes``, one after the other where stretches are small and many. The task
    count follows from the sizes: two numbers, summed from metadata alone.
    """
    if tasks is None:
        stretches = F.sum(F.ceil(F.col("file_bytes") / stretch_bytes))
        sized, unsized = paths.agg(stretches, F.count_if(F.col("file_bytes").isNull())).first()
        tasks = task_count(int(sized or 0), stretch_bytes, unsized)
    return stretches_of(paths, stretch_bytes).repartition(tasks, "warc_file", "stretch")


def archive_paths(
    spark: SparkSession, list_file: str, base_uri: str | None = None, local_base: str | None = None
) -> DataFrame:
    """Paths named in a text file, one a line."""
    lines = spark.read.text(list_file).where(F.length(F.trim("value")) > 0)
    return lines.select(resolve_path(F.trim("value"), base_uri, local_base).alias("warc_file"))


def _batch(carried: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    fields = carried + _RECORD_ARROW
    columns = []
    for (_, kind), values in zip(fields, zip(*rows)):
        if pa.types.is_map(kind):
            values = [None if v is None else list(v.items()) for v in values]
        columns.append(pa.array(values, type=kind))
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _packed(carried, tuples: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches bounded in rows and in payload bytes."""
    rows, size = [], 0
    for row in tuples:
        rows.append(row)
        size += len(row[-2] or b"")
        if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
            yield _batch(carried, rows)
            rows, size = [], 0
    if rows:
        yield _batch(carried, rows)


def read_records(
    paths: DataFrame,
    rec_types: Sequence[str] | None = None,
    parse_http: bool = True,
    with_payload: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Records of the archives named in ``warc_file``.

    Record types are an argument because a filter above a Python stage cannot
    be pushed into it. An archive that cannot be opened or read on gives one row
    with ``error`` set; records before the damage are kept. Paths from
    ``cut_archives`` are read a stretch at a time.
    """
    kinds = None if rec_types is None else tuple(rec_types)
    is_cut = "stretch" in paths.columns

    def records_of(place: dict) -> Iterator[tuple]:
        if is_cut:
            path, number, start, end = (place[k] for k in ("warc_file", "stretch", "start", "end"))
            yield from split_stretch(path, number, start, end, parse_http, kinds)
        else:
            with open_at(place["warc_file"]) as stream:
                yield from split_records(stream, parse_http, kinds)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for place in batch.to_pylist():
                    path = place["warc_file"]
                    try:
                        for record in records_of(place):
                            if not with_payload:
                                record = (*record[:-2], None, record[-1])
                            yield (path, *record)
                    except OSError as problem:
                        yield (path, *failure(problem))

        yield from _packed([("warc_file", pa.string())], rows())

    named = paths.select("warc_file", *(["stretch", "start", "end"] if is_cut else []))
    if partitions:
        named = named.repartition(partitions)
    schema = schemas.columns("warc_file string")
    return named.mapInArrow(split, StructType(schema.fields + schemas.RECORD.fields))


def coordinate_columns(table: DataFrame) -> list[str]:
    """The coordinate columns of a table, with the charset if it has one."""
    extra = [schemas.CHARSET_COLUMN] if schemas.CHARSET_COLUMN in table.columns else []
    return schemas.COORDINATES + extra


def fetch_records(
    coordinates: DataFrame,
    base_uri: str | None = None,
    local_base: str | None = None,
    parse_http: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Records found by file name, offset and length.

    Rows are spread by stretches of a file and sorted inside a task: reads run
    forward, neighbouring ranges are read by one request, and a file that holds much
    of the rows is shared out by its stretches.
    The partition count is set, as the rows are tiny next to the work they stand
    for and would else be merged into few tasks. A declared charset travels as a
    column and in the record's headers.
    """
    columns = coordinate_columns(coordinates)
    charset_column = schemas.CHARSET_COLUMN
    has_charset = charset_column in columns
    wanted = coordinates.select(
        F.col("url"),
        F.col("warc_filename"),
        F.col("warc_record_offset").cast("bigint").alias("warc_record_offset"),
        F.col("warc_record_length").cast("bigint").alias("warc_record_length"),
        *([charset_column] if has_charset else []),
        resolve_path(F.col("warc_filename"), base_uri, local_base).alias("warc_file"),
    )
    bound_batches(coordinates.sparkSession)
    tasks = partitions or int(coordinates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = F.floor(F.col("warc_record_offset") / STRETCH_BYTES)
    spread = wanted.repartition(tasks, "warc_file", stretch)
    carried = [
        ("url", pa.string()), ("warc_filename", pa.string()),
        ("warc_record_offset", pa.int64()), ("warc_record_length", pa.int64()),
        *([(charset_column, pa.string())] if has_charset else []),
        ("warc_file", pa.string()),
    ]

    def opened(path: str, start: int, length: int, places: list[tuple[int, int]]) -> Iterator:
        """A stream a place, all cut from one request; a file that is read whole has one place."""
        if start < 0:
            with open_at(path) as stream:
                yield stream
            return
        content = memoryview(read_range(path, start, length))
        for offset, size in places:
            yield io.BytesIO(content[offset - start : offset - start + size])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wanted_places():
            for batch in batches:
                for row in batch.to_pylist():
                    offset, length = row["warc_record_offset"], row["warc_record_length"]
                    yield row["warc_file"], -1 if offset is None else offset, -1 if length is None else length, row

        def rows():
            for path, start, total, group in joined_ranges(wanted_places()):
                done = 0
                try:
                    for stream in opened(path, start, total, [place for place, _ in group]):
                        (offset, length), row = group[done]
                        kept = tuple(row[name] for name, _ in carried)
                        for record in split_records(stream, parse_http):
                            record = list(record)
                            if record[-1] is None:
                                record[1:3] = [offset, length] if length > 0 else record[1:3]
                                if has_charset and row[charset_column]:
                                    record[6] = {
                                        **record[6],
                                        "warc-identified-content-charset": row[charset_column],
                                    }
                            yield (*kept, *record)
                        done += 1
                except OSError as problem:
                    for _, row in group[done:]:
                        yield (*(row[name] for name, _ in carried), *failure(problem))

        yield from _packed(carried, rows())

    kinds = {"warc_record_offset": "long", "warc_record_length": "long"}
    kept = schemas.columns(", ".join(f"{name} {kinds.get(name, 'string')}" for name, _ in carried))
    schema = StructType(kept.fields + schemas.RECORD.fields)
    return spread.sortWithinPartitions("warc_file", "warc_record_offset").mapInArrow(fetch, schema)


def count_inputs(paths: DataFrame, counter: Observation) -> DataFrame:
    """Count the archives a job takes in, as a by-product of its one run."""
    return paths.observe(counter, F.count(F.lit(1)).alias("inputs"))


def count_records(records: DataFrame, counter: Observation) -> DataFrame:
    """Count records read and inputs failed, as a by-product of the job's run."""
    return records.observe(
        counter,
        F.count_if(F.col("error").isNull()).alias("records"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )
