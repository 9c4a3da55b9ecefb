"""The training-data pipeline: five stages over ``documents``.

Each stage works on all rows its predecessor kept and is written as Parquet before the next
one reads it. Rows keep the columns of documents up to the last stage, which packs them.
Very long texts are read whole by every stage, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake.llm import jaccard, packing, quality, substrings, toxicity
from linklake.llm.queries import WORD_BPE
from linklake.llm.tables import ship, stored, table

# Rows and bytes at most that are handed to Python at a time, and rows that are read from Parquet
# at a time. Workers serve one stage after the other and keep the room that their largest batch
# took; so does the heap of an executor, where the texts read at a time are one array.
BATCH_ROWS, BATCH_BYTES = 2_000, "2m"
READ_ROWS = 256

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _ready(spark: SparkSession) -> None:
    """Ship the package, and bound the session's batches where they are larger."""
    ship(spark)
    if int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) > READ_ROWS:
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules' posterior finds good. Null, empty and short texts fail the base test
    and go; equal rows are kept or go together; ids and other columns play no part."""
    _ready(spark)
    return quality.good_rows(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that do not score as toxic. Null and empty texts have the score of the bias; equal
    texts score alike; a row without an id is scored like others but never trained on."""
    _ready(spark)
    return toxicity.clean_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id, a null before all others.
    Rows are known by their id and text, so rows that share an id are told apart; of rows that
    are equal in both, one is kept."""
    _ready(spark)
    rows = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    groups = jaccard.components(rows, "row_key").select("row_key", "component_id").distinct()
    own = rows.select("row_key", "doc_id").distinct().join(groups, "row_key")
    kept = own.groupBy("component_id").agg(F.min(F.struct("doc_id", "row_key"))["row_key"].alias("row_key")).select("row_key")
    return rows.join(kept.hint("shuffle_hash"), "row_key", "left_semi").dropDuplicates(["row_key"]).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that repeat; ``n_chars`` follows the text. No row goes: a text that
    repeats from end to end becomes empty, a null text stays null, and texts without a
    repeated passage stay as they are."""
    _ready(spark)
    rows = substrings.without_repeats(docs)
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each text is placed. Null and empty texts are one piece of one token,
    a null id stays null, and repeated rows are placed each for itself."""
    _ready(spark)
    return packing.sequences(docs, public_tokenizers.path(WORD_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", packed_sequences),
]

# Expectation-maximisation, learned scores and packing cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
