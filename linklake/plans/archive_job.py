"""Jobs over whole archives or over records picked through a URL index."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from linklake import schemas
from linklake.operators.key_values import Hook, apply_hook, reduce_by_key
from linklake.sinks.tables import save_table
from linklake.sources import archives, tables

# Fixed value: default spread of picked records.
INPUT_PARTITIONS = 400


@dataclass
class Output:
    """Where and how a job saves its table."""

    table: str
    table_format: str = "parquet"
    compression: str = "gzip"
    options: Iterable[str] = ()
    files: int | None = None
    mode: str = "errorifexists"

    def save(self, rows: DataFrame) -> None:
        save_table(
            rows, self.table, self.table_format, self.compression, self.options, self.files, mode=self.mode
        )


@dataclass
class Counters:
    """Inputs, records and failures of one run, known once it has run."""

    _inputs: Observation = field(default_factory=Observation)
    _records: Observation = field(default_factory=Observation)

    def watch_inputs(self, paths: DataFrame) -> DataFrame:
        return archives.count_inputs(paths, self._inputs)

    def watch_records(self, records: DataFrame) -> DataFrame:
        return archives.count_records(records, self._records)

    def values(self) -> dict[str, int]:
        return {**self._inputs.get, **self._records.get}


def run_archive_job(
    spark: SparkSession,
    path_list: str,
    output: Output,
    hook: Hook,
    base_uri: str | None = None,
    local_base: str | None = None,
    schema: StructType = schemas.KEY_VALUE,
    reducer: Column | None = None,
    parse_http: bool = True,
    partitions: int | None = None,
    stretch_bytes: int = archives.STRETCH_BYTES,
) -> dict[str, int]:
    """Records of all archives in a list, through the hook, reduced by key, saved.

    Tasks ask for the sizes of the listed archives first; these are then cut into byte
    stretches, one task each unless ``partitions`` says how many. Unreadable archives are
    counted and passed over; a damaged one counts once for each stretch it breaks.
    """
    counters = Counters()
    paths = counters.watch_inputs(archives.archive_paths(spark, path_list, base_uri, local_base))
    cut = archives.cut_archives(archives.with_sizes(paths), stretch_bytes, partitions)
    records = archives.read_records(cut, parse_http=parse_http)
    pairs = apply_hook(counters.watch_records(records), hook, schema)
    output.save(reduce_by_key(pairs, reducer))
    return counters.values()


def select_rows(spark: SparkSession, query: str, explain: bool = False) -> DataFrame:
    """Rows of the index by a SQL query over its view."""
    rows = spark.sql(query)
    if explain:
        rows.explain("formatted")
    return rows


def count_rows(rows: DataFrame) -> int:
    """Size of a selection. Persist it first if it is used again, and unpersist
    it after."""
    return rows.count()


def run_index_job(
    spark: SparkSession,
    index_path: str,
    query: str,
    output: Output,
    view: str = tables.INDEX_VIEW,
    schema_file: str | None = None,
    explain: bool = False,
) -> int:
    """Save the rows a query selects from the index; returns how many.

    They are counted as they are written, so nothing is persisted.
    """
    tables.load_index(spark, index_path, view, schema_file)
    counter = Observation()
    rows = select_rows(spark, query, explain)
    output.save(archives.count_inputs(rows, counter))
    return counter.get["inputs"]


def run_index_record_job(
    spark: SparkSession,
    coordinates: DataFrame,
    output: Output,
    hook: Hook,
    base_uri: str | None = None,
    local_base: str | None = None,
    schema: StructType = schemas.KEY_VALUE,
    reducer: Column | None = None,
    parse_http: bool = True,
    partitions: int | None = INPUT_PARTITIONS,
) -> dict[str, int]:
    """Records at the given coordinates, through the hook, reduced by key, saved.

    Coordinates come from ``select_rows`` over an index, ``read_coordinates_csv``
    or ``read_coordinates``.
    """
    counters = Counters()
    records = archives.fetch_records(
        counters.watch_inputs(coordinates), base_uri, local_base, parse_http, partitions
    )
    pairs = apply_hook(counters.watch_records(records), hook, schema)
    output.save(reduce_by_key(pairs, reducer))
    return counters.values()
