"""Each pipeline stage against a brute-force version, on the input that its predecessor kept."""

import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from linklake.llm import quality, toxicity
from linklake.llm.tables import stored, table

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"w{i}" for i in range(80))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, PASSAGE, None, "s", 1), (3, PASSAGE, None, "s", 1), (4, PASSAGE + " x", "en", None, 2),
    (None, PASSAGE[5:], "en", "s", 3), (5, " \n\t", "en", "s", 1), (6, " ".join(f"v{i}" for i in range(40)) + "\n" + PASSAGE[:200], "de", "s", 9),
]


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def lowered(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def nearly_equal_groups(rows):
    """Groups of rows (by place) whose shingle sets are linked."""
    sets = []
    for r in rows:
        words = lowered(r[1])
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    at, label = defaultdict(list), list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, own in enumerate(sets):
        for other in {j for s in own for j in at[s]}:
            common = len(own & sets[other])
            if 100 * common >= 75 * (len(own) + len(sets[other]) - common):
                label[root(i)] = root(other)
        for s in own:
            at[s].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    return list(groups.values())


def without_repeats(rows):
    """Texts without the words of 35-word windows that start at two places or more."""
    words = [WORD.findall(r[1] or "") for r in rows]
    runs = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for r, w in zip(rows, words):
        gone = {i + k for i in range(len(w) - 34) if runs[tuple(w[i : i + 35])] > 1 for k in range(35)}
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r[1]
        out.append((r[0], text, r[2], r[3], None if text is None else len(text)))
    return out


@pytest.fixture(params=["given", "odd", "empty"])
def docs(request, spark):
    odd = spark.createDataFrame(ODD, SCHEMA)
    return {"given": table(spark, FOLDER, "documents"), "odd": odd, "empty": odd.limit(0)}[request.param]


def test_stages(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "toxicity", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]

    kept = stored(stages["quality_rules"](spark, docs, FOLDER), "s1")
    rows = docs.select(F.struct("*").alias("row"), quality.signals(F.col("text").cast("binary")).alias("s"))
    votes = [v.alias(f"v{i}") for i, v in enumerate(quality.votes(F.col("s")))]
    model = quality.fit(*quality.vote_frame(rows))
    want = []
    for r in rows.select("row", "s", *votes).collect():
        odds = np.log(model.prior / (1 - model.prior)) + sum(o[r[f"v{i}"] + 1] for i, o in enumerate(model.log_odds))
        if r["s"]["n_words"] >= 50 and 100 * r["s"]["n_repeat_words"] <= 50 * r["s"]["n_words"] and odds >= 0:
            want.append(tuple(r["row"]))
    assert Counter(rows_of(kept)) == Counter(want) and kept.columns == docs.columns

    clean = stored(stages["toxicity"](spark, kept, FOLDER), "s2")
    labels = table(spark, FOLDER, "labels")
    features = toxicity.lexicon(kept, labels)
    seen = stored(kept.select(F.col("doc_id").alias("ident"), F.struct("*").alias("row"), toxicity.looked_at(F.col("text"), features).alias("seen")), "seen")
    score = toxicity.trained(seen, features).score(F.col("seen"))
    want = [tuple(r["row"]) for r in seen.where(score < toxicity.THRESHOLD).select("row").collect()]
    assert Counter(rows_of(clean)) == Counter(want)

    single = stored(stages["ngram_jaccard_join"](spark, clean, FOLDER), "s3")
    known = sorted(set(rows_of(clean)), key=lambda r: (r[0] is not None, r[0] or 0))
    got = rows_of(single)
    groups = nearly_equal_groups(known)
    least = [min((known[i] for i in g), key=lambda r: (r[0] is not None, r[0] or 0))[0] for g in groups]
    assert Counter(r[0] for r in got) == Counter(least) and set(got) <= set(known)

    cut = stored(stages["substring_dedup"](spark, single, FOLDER), "s4")
    assert Counter(rows_of(cut)) == Counter(without_repeats(got))

    placed = stages["best_fit_packing"](spark, cut, FOLDER).collect()
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = []
    for r in rows_of(cut):
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((r[0], piece, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert Counter(tuple(r)[:5] for r in placed) == Counter(want)
    filled = defaultdict(list)
    for r in placed:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in filled.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048
