"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster run should start from. Nothing here depends on data size:
# partition counts are left to adaptive execution.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, under ``spark.checkpoint.dir``.

    Executors must all see it, so a machine-local folder is made only for a
    local session that names none.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="linklake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Rows and bytes at most that are handed to Python at a time where rows carry payloads.
# Workers keep the room that their largest batch took.
BATCH_ROWS, BATCH_BYTES = 1_000, "8m"


def bound_batches(spark: SparkSession, most: int = BATCH_ROWS) -> None:
    """Lower the session's batches to Python where they are larger."""
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= most:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


@contextmanager
def persisted(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep rows that several jobs read, and let go of them after."""
    rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()
