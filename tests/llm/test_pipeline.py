"""The pipeline and the registered queries of the package."""

import numpy as np
import pandas as pd
import pytest

import __spark_entry__
import corpus_pipeline
from linklake.llm import jaccard
from linklake.llm.oracles import ORACLES
from linklake.llm.tables import stored
from verification.compare import _counted, connect

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_never_add_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == COLUMNS and 0 < docs.count() <= before
        before = docs.count()
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert placed.select("doc_id").distinct().count() == before


def test_stages_take_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, words, None, "s", 1), (3, words, None, "s", 1), (4, words + " x", "en", None, 2), (None, words[5:], "en", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, docs.limit(0)):
            assert stage(spark, frame, FOLDER).count() >= 0, name
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()
    assert len({r["doc_id"] for r in kept}) == len(kept) and {1, 2} <= {r["doc_id"] for r in kept}


def test_near_duplicates_tells_rows_that_share_an_id_apart(spark):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(60))

    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (5, text("a") + " x"), (9, text("b") + " x"), (7, text("d")), (7, text("e")), (7, text("e")), (8, text("f"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == COLUMNS
    want = [(None, text("a")), (None, text("b")), (None, text("c")), (7, text("d")), (7, text("e")), (8, text("f"))]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_stages_bound_what_is_read_and_handed_over_at_a_time(spark):
    keys = ["spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], 4_096)
        spark.conf.set(keys[1], 10_000)
        corpus_pipeline._ready(spark)
        assert [spark.conf.get(k) for k in keys] == ["256", "2000", "2m"]
        spark.conf.set(keys[0], 100)
        corpus_pipeline._ready(spark)
        assert spark.conf.get(keys[0]) == "100"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_counts_of_a_task_leave_it_in_parts():
    texts = [" ".join(f"{k}-{i}" for i in range(9_000)).encode() for k in range(4)]
    found = list(jaccard._members(5)(iter([pd.DataFrame({"doc": range(4), "text": texts})])))
    assert max(sum(map(len, f["data"])) for f in found) <= 1 << 20
    slices = pd.concat(found).query("part >= 0").sort_values("part")
    counts = np.zeros((jaccard.CELLS // jaccard.SLICE, jaccard.SLICE), int)
    for part, data in zip(slices["part"], slices["data"]):
        counts[part] += np.frombuffer(data, np.int32)
    tokens = np.concatenate([jaccard.shingle_set(t) for t in texts])
    want = np.bincount((tokens >> np.uint64(64 - jaccard.CELL_BITS)).astype(int), minlength=jaccard.CELLS)
    assert slices["part"].is_unique and (counts.reshape(-1) == want).all()


def test_packing_takes_one_python_worker_a_task(spark, monkeypatch):
    kept = []

    def stored_and_kept(frame, name):
        kept.append(frame._jdf.queryExecution().executedPlan().toString())
        return stored(frame, name)

    monkeypatch.setattr("linklake.llm.packing.stored", stored_and_kept)
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(20)], "doc_id long, text string")
    assert corpus_pipeline.packed_sequences(spark, docs, FOLDER).count() == 20
    assert kept and all(plan.count("MapInPandas") == 1 for plan in kept)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, name):
    frame = __spark_entry__.queries()[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert _counted(frame.columns, frame.collect()) == _counted(names, cursor.fetchall())
