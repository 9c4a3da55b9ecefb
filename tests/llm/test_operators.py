"""Each operator against a brute-force version, on given tables and on edge cases."""

import base64
import hashlib
import itertools
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linklake.llm import bpe, html_tree, jaccard, mtree, packing, quality, substrings, token_counts, toxicity, warc_dictionary
from linklake.llm.tables import ship

FOLDER = "/root/testdata/sf0.001"
RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"Wort{i % 9000} é{i}" for i in range(30_000))
EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, PASSAGE), (5, PASSAGE), (5, PASSAGE), (6, PASSAGE + " end"), (7, "a b c"), (8, "A B C"),
    (9, "x " * 200), (10, "line\nline\n\nline two # $"), (11, LONG), (12, "  tab\x1cé é \U0001f600" * 3), (None, "no id at all"), (13, "z" * 40_000),
    (14, "you idiot!!! STOP THAT NOW"), (15, "start " + PASSAGE + " " + PASSAGE),
]
COLUMNS = "doc_id long, text string, row string, s string, doc string, key string, places string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def given(spark):
    ship(spark)
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls, blanks, copies, equal ids, a very long text, and columns with clashing names."""
    ship(spark)
    return spark.createDataFrame([(i, t, "r", None, "d", None, "p", "en", None, 0) for i, t in EDGES], COLUMNS)


@pytest.fixture(scope="module", params=["given", "edges", "empty"])
def docs(request, given, edges):
    return {"given": given, "edges": edges, "empty": edges.limit(0)}[request.param]


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def same(got, want):
    assert Counter(map(tuple, got)) == Counter(want)


@pytest.mark.parametrize("chunk,overlap", [(16_384, 1_024), (150, 30)])
def test_byte_bpe(docs, chunk, overlap):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    codec = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in texts_of(docs):
        ids = codec.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    same(bpe.encoded(docs, RANKS, P.PATTERN, chunk=chunk, overlap=overlap).collect(), want)


def test_quality_signals(docs):
    want = []
    for i, t in texts_of(docs):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        runs, hit = Counter(zip(words, words[1:], words[2:])), set()
        for k, run in enumerate(zip(words, words[1:], words[2:])):
            hit |= {k, k + 1, k + 2} if runs[run] > 1 else set()
        want.append((i, len(words), len("".join(words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit)))
    s = quality.signals(F.col("text").cast("binary"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    same(docs.select("doc_id", s.alias("found")).select("doc_id", *(f"found.{n}" for n in names)).collect(), want)


def test_quality_keeps_columns_and_drops_the_bad(edges):
    kept = quality.good_rows(edges)
    assert kept.columns == edges.columns
    assert {r["doc_id"] for r in kept.collect()} <= {4, 5, 6, 11, 15}
    assert quality.good_rows(edges.limit(0)).count() == 0


def test_quality_model_trusts_rules_by_their_votes():
    patterns = np.array([[1, 1, 1], [1, 0, 1], [0, 1, 0], [-1, -1, -1]])
    model = quality.fitted(patterns, np.array([900.0, 50.0, 40.0, 10.0]))
    odds = [sum(row[v + 1] for row, v in zip(model.log_odds, p)) for p in patterns.tolist()]
    assert odds[0] > 0 > odds[2] and odds[3] == 0
    assert odds[1] > 0 and model.log_odds[1][1] > model.log_odds[0][1]  # two rules that agree overrule the third


def verdicts(patterns, model):
    prior = np.log(model.prior / (1 - model.prior))
    return np.array([prior + sum(row[v + 1] for row, v in zip(model.log_odds, p)) >= 0 for p in patterns.tolist()])


@pytest.mark.parametrize("noise", [0.1, 0.3])
def test_quality_model_overrules_a_rule_that_errs(noise):
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    votes = np.where(good[:, None], rng.random((20_000, 6)) > 0.02, rng.random((20_000, 6)) > 0.7).astype(int)
    votes[:, 0] = rng.random(20_000) > noise  # says bad at random
    votes[rng.random(votes.shape) < 0.2] = -1
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality.fitted(patterns, counts.astype(float))
    kept = verdicts(patterns, model)[place.ravel()]
    one_bad = (votes[:, 0] == 0) & (votes[:, 1:] != 0).all(1) & (votes[:, 1:] == 1).any(1)
    assert kept[one_bad].mean() > 0.9 and (kept == good).mean() > 0.95
    assert model.log_odds[0][1] > max(row[1] for row in model.log_odds[1:]) + 1  # trusted least


def test_quality_abstentions_are_neutral():
    patterns = np.array([[1, 1, 1], [-1, 1, 1], [-1, -1, -1], [0, 1, 1], [0, 0, 1]])
    model = quality.fitted(patterns, np.array([800.0, 90.0, 30.0, 50.0, 30.0]))
    assert all(row[0] == 0 for row in model.log_odds)
    assert verdicts(patterns, model).tolist() == [True, True, True, False, False]


def test_quality_verdict(docs):
    """Kept and base_failed as worked out row by row from the model's numbers."""
    rows = docs.select("doc_id", quality.signals(F.col("text").cast("binary")).alias("s"))
    model = quality.fit(*quality.vote_frame(rows))
    posterior, kept = quality.verdict(model)
    given = [v.alias(f"v{i}") for i, v in enumerate(quality.votes(F.col("s")))]
    for r in rows.select("s", *given, posterior.alias("p"), kept.alias("kept"), quality.base_failed(F.col("s")).alias("failed")).collect():
        words, repeated = r["s"]["n_words"], r["s"]["n_repeat_words"]
        assert r["failed"] == (words < 50 or 100 * repeated > 50 * words)
        odds = np.log(model.prior / (1 - model.prior)) + sum(model.log_odds[i][r[f"v{i}"] + 1] for i in range(len(given)))
        assert abs(r["p"] - 1 / (1 + np.exp(-odds))) < 1e-9 and r["kept"] == (not r["failed"] and r["p"] >= 0.5)


def test_packing(docs):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = packing.sequences(docs, WORDS).collect()
    want = []
    for i, t in texts_of(docs):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((i, p, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    same([tuple(r)[:5] for r in rows], want)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-sum(w[3] for w in want) // 2048) + 1


def test_few_small_bins_of_many_tasks_meet(spark):
    ship(spark)
    for count in (2, 3):
        rows = spark.sparkContext.parallelize([(i, 0, 0, 100, 7) for i in range(count)], 25)
        found = packing.packed(spark.createDataFrame(rows, packing.PIECE)).collect()
        assert sorted(r["offset"] for r in found) == [100 * i for i in range(count)] and len({r["sequence_id"] for r in found}) == 1


def test_best_fit_takes_the_tightest_bin():
    assert packing.best_fit([6, 5, 4, 3, 2], 10) == [[0, 2], [1, 3, 4]]


def test_jaccard_groups(docs):
    sets = {}
    rows = texts_of(docs)
    for i, t in rows:
        words = WORD.findall((t or "").encode().lower())
        sets.setdefault(i, []).append(frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset())
    order = {i: (i is not None, i or 0) for i in sets}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets, key=order.get), 2):
        if any(x and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
            low, high = sorted((find(a), find(b)), key=order.get)
            root[high] = low
    same(jaccard.components(docs).collect(), [(i, len(sets[i][0]), find(i)) for i, _ in rows])


def test_jaccard_groups_of_a_doubled_table(spark, tmp_path):
    """Tight groups joined by a weak link, in a table that holds every row twice."""
    rows = []
    changed = {20, 60, 100, 140, 180, 210, 211, 212, 213}  # 33 of 236 shingles: 203 of 269 are common
    for group in range(8):
        base = [f"g{group}w{i}" for i in range(240)]
        centre = [*base[:225], "centre", *base[226:]]  # shares most with all, but is not similar to ``other``
        other = [f"{w}y" if i in changed else w for i, w in enumerate(base)]
        for words in (centre, [*centre, f"end{group}"], base, other, [*other, f"last{group}"]):
            rows.append((len(rows), " ".join(words)))
    for _ in range(2):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "rows"))
    files = sorted(str(p) for p in (tmp_path / "rows").glob("*.parquet"))
    docs = spark.read.parquet(files[0]).union(spark.read.parquet(files[1]))
    assert docs.rdd.getNumPartitions() > 1
    found = {r["doc_id"]: r["component_id"] for r in jaccard.components(docs).collect()}
    assert found == {i: i - i % 5 for i, _ in rows}


def test_jaccard_fine_bound_never_rules_out_a_similar_pair():
    rng = np.random.default_rng(11)
    passed = 0
    for size in rng.integers(1, 3_000, 300).tolist():
        own = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        other = np.unique(np.concatenate([own[: int(len(own) * rng.uniform(0.5, 1))], rng.integers(0, 2**63, int(size * rng.uniform(0, 0.4))).astype(np.uint64)]))
        may = jaccard.finely_bounded(jaccard.fine_spread(own), jaccard.fine_spread(other), 75)
        passed += may
        assert may or not jaccard.similar(own, other, 75)
    assert 0 < passed < 300
    assert jaccard.finely_bounded(np.empty(0, np.uint8), jaccard.fine_spread(own), 75)


def test_jaccard_overlap_bound_never_rules_out_a_similar_pair():
    rng = np.random.default_rng(1)
    for _ in range(300):
        base = rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64)
        left, right = (np.unique(base[rng.random(len(base)) < 0.95]) for _ in range(2))
        if len(left) and len(right) and jaccard.similar(left, right, 75):
            assert jaccard.may_be_similar(len(left), jaccard.spread(left)[None], len(right), jaccard.spread(right), 75).all()


def test_jaccard_gives_each_pair_out_once():
    import pandas as pd

    rng = np.random.default_rng(3)
    shared = np.sort(rng.integers(1, 1 << 60, 30))
    rows = []
    for d in range(40):  # alike under every shared token, each a group of its own
        spread = jaccard.spread(shared.view(np.uint64)).tobytes()
        rows += [(t, 0, 0, 0, d, d, 30, spread, shared[: jaccard.EARLIER]) for t in shared.tolist()]
    names = ["token", "low", "high", "side", "doc", "label", "n", "spread", "earlier"]
    frame = pd.DataFrame(sorted(rows, key=lambda r: r[:3]), columns=names)
    found = pd.concat(jaccard._candidates(75)(iter([frame[:500], frame[500:]])))
    assert len(found) == len(found.drop_duplicates()) == 40 * 39 // 2


def test_jaccard_further_orders_rule_out_no_similar_pair():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 200, jaccard.CELLS).astype(np.uint16)
    missed = 0
    for _ in range(300):
        base = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
        for share in (0.9, 0.1):
            other = np.unique(np.concatenate([rng.choice(base, int(len(base) * share), False), rng.integers(0, 1 << 63, 20).astype(np.uint64)]))
            sides = [jaccard.further(t, counts, 75) for t in (base, other)]
            if jaccard.similar(base, other, 75):
                assert jaccard.meet(*sides)
            missed += not jaccard.meet(*sides)
    assert missed > 0


@pytest.mark.parametrize("length", [35, 4])
def test_repeated_passages(docs, length):
    words = [(i, WORD.findall((t or "").encode())) for i, t in texts_of(docs)]
    starts = Counter(tuple(w[k : k + length]) for _, w in words for k in range(len(w) - length + 1))
    want = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - length + 1) if starts[tuple(w[k : k + length])] > 1 for j in range(length)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    same(substrings.removals(docs, length=length).collect(), want)


def test_cut_texts_keep_columns(edges):
    cut = substrings.without_repeats(edges)
    assert cut.columns == edges.columns and cut.count() == len(EDGES)
    found = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert found[5] == "" and found[6] == "end" and found[1] is None and found[3] == " \t\n"


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_line_counts(docs, rule):
    codec = bpe.codec(RANKS, P.PATTERN)
    want = []
    for i, t in texts_of(docs):
        lines = re.findall(r"[^\n]*\n|[^\n]+", t or "") or [""]
        line_of = [n for n, line in enumerate(lines) for _ in line.encode()]
        counts, crossing, at = [0.0] * len(lines), [0] * len(lines), 0
        for token in codec.encode(t or ""):
            own = line_of[at : at + len(codec.bytes_of[token])]
            at += len(own)
            crossing[own[0]] += own[0] != own[-1]
            for n in [own[0]] if rule == "first" else [own[-1]] if rule == "last" else own:
                counts[n] += 1 / (len(own) if rule == "share" else 1)
        starts = [0, *itertools.accumulate(len(line.encode()) for line in lines)]
        want.extend((i, n, starts[n], starts[n + 1] - starts[n], round(counts[n], 3), crossing[n]) for n in range(len(lines)))
    same([(*r[:4], round(r[4], 3), r[5]) for r in token_counts.line_counts(docs, RANKS, P.PATTERN, rule=rule).collect()], want)


def test_field_counts(edges):
    rows = token_counts.field_counts(edges, ["lang", "text", "source"], RANKS, P.PATTERN).where("doc_id = 7").orderBy("section").collect()
    assert [(r["section"], r["length"]) for r in rows] == [(0, 3), (1, 6), (2, 0)]
    assert sum(r["n_tokens"] for r in rows) == len(bpe.codec(RANKS, P.PATTERN).encode("en\na b c\n"))


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    ship(spark)
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    features = toxicity.lexicon(docs, labels)
    rows = docs.select(F.col("doc_id").alias("ident"), toxicity.looked_at(F.col("text"), features).alias("seen"))
    score = toxicity.trained(rows, features).score(F.col("seen"))
    found = rows.select(F.col("ident").alias("doc_id"), toxicity.held_out(F.col("ident")).alias("out"), score.alias("score"))
    counts = Counter((r["toxic"], r["score"] >= 0.7) for r in found.where("out").join(labels, "doc_id").collect())
    assert counts[1, True] >= 0.75 * (counts[1, True] + counts[1, False])
    assert counts[0, True] <= 0.01 * counts[0, False]


def test_lexicon_is_counted_over_all_labelled_rows(spark):
    """Terms that few of many labelled rows have; copies of a text count once."""
    ship(spark)
    rows = [(i, f"plain text of row n{i} qqrare" if i % 50 == 0 else f"plain text of row n{i}", i % 50 == 0) for i in range(1_500)]
    rows += [(2_000 + i, f"zzcopied {i % 2}", True) for i in range(30)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(toxic)) for i, _, toxic in rows], "doc_id long, toxic int")
    whole = toxicity.lexicon(docs, labels)
    assert "w qqrare" in whole and not {"w zzcopied", "w plain"} & set(whole)
    assert toxicity.lexicon(docs, labels, rows=40) == whole and toxicity.lexicon(docs, labels, rows=40, at_once=3) == whole


def test_toxicity_without_labels(edges, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = toxicity.clean_rows(edges, labels)
    assert kept.columns == edges.columns and kept.count() == len(EDGES)
    assert toxicity.clean_rows(edges.limit(0), labels).count() == 0


def test_archives(spark):
    ship(spark)
    big, small = "p" * 100, "p" * 99
    rows = [(3, "http://a/ \r\nX: y", big, 1), (1, None, big, 1), (1, "u", big, 1), (5, "u", small, 1), (4, "u", small, 1), (6, "u", None, 1), (7, "u", "é" * 60, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    for frame in (pages, pages.limit(0)):
        want = []
        for i, _, h, _ in frame.collect():
            raw = (h or "").encode()
            revisit = h == big and i != 1
            want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 1 if revisit else None))
        same(warc_dictionary.roundtrip(frame).collect(), want)


def test_archive_has_a_leading_dictionary(spark, tmp_path):
    ship(spark)
    rows = warc_dictionary.deduplicated(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    manifest = warc_dictionary.write_archives(rows.coalesce(1), str(tmp_path / "w"), archive_bytes=40_000)
    places = [r["path"] for r in manifest.collect()]
    with open(places[0], "rb") as data:
        assert struct.unpack("<I", data.read(4))[0] == warc_dictionary.DICTIONARY_MAGIC
    read = warc_dictionary.read_archives(manifest)
    same(read.select("page_id", "payload").collect(), [(r["page_id"], r["payload"]) for r in rows.select("page_id", "payload").collect()])


@pytest.mark.parametrize("leaf", [128, 4])
def test_top_k(spark, monkeypatch, leaf):
    ship(spark)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8)]) for i in range(300)]
    rows += [(300 + i, [1.0] * 8) for i in range(40)] + [(900, None), (901, []), (902, [float("nan")] * 8), (903, [1.0, None]), (904, [2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("r"))
    usable = [(i, np.floor(256 * np.pad(np.array(v), (0, 8 - len(v)))).astype(int)) for i, v in rows if v and None not in v and not np.isnan(v).any()]
    want = []
    for i, q in usable:
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in usable if j != i)[:5]
            want.extend((i, n, j, -s) for n, (s, j) in enumerate(best, 1))
    monkeypatch.setattr(mtree, "LEAF_ROWS", leaf)
    same(mtree.top_k(frame, F.col("vec_id") % 50 == 0).collect(), want)
    assert mtree.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("shard", [16_384, 40])
def test_top_k_keeps_every_row(spark, monkeypatch, shard):
    """Repeated ids, rows without an id and empty vectors are rows like all others."""
    ship(spark)
    monkeypatch.setattr(mtree, "SHARD_ROWS", shard)
    rng = np.random.default_rng(8)
    rows = [(50, [1.0, 0.0]), (7, [3.0, 0.0]), (7, [2.0, 0.0]), (None, [2.5, 0.0]), (8, [0.5, 0.0]), (50, [1.0, 1.0]), (100, []), (None, [1.0, 0.0])]
    rows += [(int(rng.integers(0, 60)), [float(x) for x in rng.integers(-2, 3, 2)]) for _ in range(150)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    known = [(i, np.floor(256 * np.pad(np.array(v, float), (0, 2 - len(v)))).astype(int)) for i, v in rows]
    want = []
    for n, (i, q) in enumerate(known):
        if i is not None and i % 50 == 0:
            ranked = sorted((-int(q @ v), j is None, j or 0) for m, (j, v) in enumerate(known) if m != n)[:5]
            want.extend((i, place, None if none else j, -s) for place, (s, none, j) in enumerate(ranked, 1))
    same(mtree.top_k(frame, F.col("vec_id") % 50 == 0).collect(), want)


def test_queries_share_the_pages_they_open():
    import pandas as pd

    rng = np.random.default_rng(5)
    vectors = rng.integers(-200, 200, (3000, 16))
    longest = int((vectors * vectors).sum(1).max())
    pages = mtree._built(longest, 16)((0,), pd.DataFrame({"vec_id": np.arange(3000) // 2, "row": np.arange(3000), "vector": list(vectors)}))
    tree, opened = mtree.Tree(pages, 16, longest), []

    class Counting(dict):
        def __getitem__(self, number):
            opened.append(number)
            return super().__getitem__(number)

    tree.pages = Counting(tree.pages)
    asking = np.arange(0, 3000, 15)
    got = tree.best_of_each(asking, vectors[asking], 5)
    assert len(opened) <= len(pages)
    for own, best in zip(asking, got, strict=True):
        scores = vectors @ vectors[own]
        order = [int(i) for i in np.lexsort((np.arange(3000), np.arange(3000) // 2, -scores)) if i != own][:5]
        assert best == [(int(scores[i]), i // 2, i) for i in order]


def test_tree_passes_over_most_rows():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 400, (40, 16))
    vectors = np.rint(np.repeat(centres, 100, 0) + rng.normal(0, 5, (4000, 16))).astype(np.int64)
    longest = int((vectors**2).sum(1).max())
    import pandas as pd

    pages = mtree._built(longest, 16)((0,), pd.DataFrame({"vec_id": np.arange(4000), "row": np.arange(4000), "vector": list(vectors)}))
    tree = mtree.Tree(pages, 16, longest)
    for i in range(0, 4000, 400):
        scores = vectors @ vectors[i]
        order = [j for j in np.lexsort((np.arange(4000), -scores)) if j != i][:5]
        assert tree.best(i, vectors[i], 5) == [(int(scores[j]), int(j), int(j)) for j in order]
    assert tree.computed < 0.5 * 10 * 4000


PAGE = (
    '<html><head><title>t</title></head><body><header>top</header><nav><a href="/">menu</a></nav><div class="cookie-notice">ok?</div>'
    "<article><h1>Head &amp; tail</h1><p><b>One<br>two <i>th</i>ree<p>Four\n five</p><div class='promo'>{0}</div><p>{0}</p></article>"
    "<section id='comments'><p>nice</p></section><aside>side</aside><footer>foot</footer></body></html>"
)


def test_main_text():
    assert html_tree.main_text(PAGE.format("x")) == "Head & tail\n\nOne two three\n\nFour five\n\nx"
    assert html_tree.main_text(None) == html_tree.main_text("") == html_tree.main_text("<p") == ""
    assert html_tree.main_text("a < b <p>c") == "a < b\n\nc"


@pytest.mark.parametrize(
    "tag,kept",
    [
        ("<div style='overflow:hidden'>", True), ("<p style='visibility: hidden'>", True), ("<p title='well hidden gem'>", True),
        ("<div data-class='promo'>", True), ("<p data-id='nav'>", True), ("<div class='related-work'>", True), ("<div class=promo>", False),
        ("<div hidden>", False), ("<div aria-hidden = 'true'>", False), ("<div title=\"a > b\" class='x promo'>", False),
        ("<div CLASS='Related-Posts'>", False), ("<div class='a' class='promo'>", True), ("<div role=navigation>", False), ("<div data-x=1 hidden=''>", False),
    ],
)
def test_attributes_are_read_by_name(tag, kept):
    name = tag[1:].split()[0].rstrip(">")
    page = f"<body><article><p>one</p>{tag}two</{name}><p>three</p></article></body>"
    assert html_tree.main_text(page) == ("one\n\ntwo\n\nthree" if kept else "one\n\nthree")


def test_article_is_not_judged_by_its_subject():
    assert html_tree.main_text("<article class='post review'><p>text</p></article>") == "text"
    assert html_tree.main_text("<article><p>text</p></article><article class='comment-body'><p>me too</p></article>") == "text"


def test_site_tree_removes_what_every_page_has(spark):
    ship(spark)
    page = "<body><article><p>story {0}</p><div class='box'>Read our paper every day</div><p>more {0}</p></article></body>"
    rows = [(i, f"http://Host.com/{i}", page.format(i), "t") for i in range(12)] + [(20, None, page.format(20), "t"), (21, "http://other.org/", None, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_tree.extracted(pages).collect()}
    assert found[3] == ("story 3\n\nmore 3", 15) and found[21] == ("", 0)
    assert found[20][0] == "story 20\n\nRead our paper every day\n\nmore 20"
    assert html_tree.extracted(pages.limit(0)).count() == 0
    assert html_tree.with_text(pages).columns == pages.columns


def test_deep_pages_keep_their_blocks():
    for tag in ("div", "section", "center", "blockquote"):
        deep = f"<{tag}>" * 3_000
        assert html_tree.main_text(f"<p>one</p>{deep}<p>two</p><div class='promo'>x</div><p>three</p>") == "one\n\ntwo\n\nthree"
        assert html_tree.main_text(f"<p>one</p>{deep}<article><p>two</p><p>three</p></article>") == "two\n\nthree"


def test_site_tree_counts_copies_once(spark):
    ship(spark)
    page = "<body><div><p>story {0}</p><p>more {0}</p></div></body>"
    rows = [(i, "http://copies.com/", page.format("x")) for i in range(12)]
    rows += [(20 + i, None, page.format(max(i, 8))) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_tree.extracted(pages).collect()}
    assert found == {i: "story {0}\n\nmore {0}".format("x" if i < 20 else max(i - 20, 8)) for i, _, _ in rows}


@pytest.mark.parametrize("part", ["<b ", "<b x='", '<a href="x ', "<![CDATA[ x ", "<!-- x ", "</b ", "<div>", "<p>", "</p>", "<li>", "<svg>"])
def test_broken_pages_take_linear_time(part):
    import time

    start = time.process_time()
    html_tree.main_text("<div>" * 300 + part * (300_000 // len(part)))
    assert time.process_time() - start < 8
