"""Every operator and stage on nulls in any column, repeated rows, ties, very long texts, empty tables and clashing names."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_llm import DATA, ODD, WORD, counts_of, frame, true_classes
from weft.llm import ann, linededup, lm, mixing, neardup, quality, tokens, toxicity, warc
from weft.llm.common import OWN

#: Names that operators use for columns of their own.
CLASHES = ["a", "b", "v", "c", "n", "i", "k", "s", "t", "w", "x", "key", "k1", "k2", "bands", "lo", "hi", "start", "total", "slots", "block", "position", "ps", "first", "row", "rare", "score", "features", "toxic", "quality", "kept", "at", "covers", "lines", "marks", "ids", "good", "class_id", "cell", "code", "digest", "payload", "size", "d", "z"]


@pytest.fixture(scope="module")
def docs(spark):
    long = "\n".join(f"long line number {i % 900} of a text" for i in range(4000))
    rows = [(i, t, "en", f"s{i % 3}", 1) for i, t in enumerate(ODD)]
    rows += rows + [(None, "a text without an id\nof two lines", None, None, None), (None, None, None, None, None), (100, long, None, "s1", None), (101, long, "en", None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit(j).alias(c) for j, c in enumerate(CLASHES)))


@pytest.fixture(scope="module")
def labels(spark):
    real = spark.read.parquet(f"{DATA}/labels.parquet")
    return real.union(spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 0, None), (2, 1, 1), (2, 1, 1)], real.schema))


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_every_operator_returns_each_row(spark, docs, labels):
    want = ids(docs.collect())
    for name, f in {
        "op1": lambda d: mixing.scheduled(spark, d),
        "op2": lambda d: tokens.encoded(spark, d),
        "op4": lambda d: tokens.token_counts(spark, d),
        "op5": lambda d: neardup.classes(spark, d),
        "op6": lambda d: quality.assess(spark, d, labels),
        "op7": lambda d: lm.score(spark, d),
        "op9": lambda d: toxicity.score(spark, d, labels),
        "op10": lambda d: linededup.dedup_lines(spark, d),
    }.items():
        assert ids(f(docs).collect()) == want, name
        assert f(docs.limit(0)).collect() == [], name
        assert ids(f(docs.filter("text is null")).collect()) == ids(docs.filter("text is null").collect()), name


def test_repeated_rows_get_equal_results(spark, docs, labels):
    for out in (tokens.token_counts(spark, docs), neardup.classes(spark, docs), quality.assess(spark, docs, labels), lm.score(spark, docs), toxicity.score(spark, docs, labels)):
        rows = out.filter(f"doc_id < {len(ODD)}").collect()
        assert len({tuple(r) for r in rows}) == len(ODD) and len(rows) == 2 * len(ODD)


def test_mixing_passes_clashing_columns(spark, docs):
    out = mixing.scheduled(spark, docs, block_rows=2)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = out.collect()
    assert len({r[OWN + "position"] for r in got}) == len(got)
    assert all(r[c] == j for r in got for j, c in enumerate(CLASHES))


def test_very_long_text_loses_later_windows_only(spark, docs):
    got = [r for r in linededup.dedup_lines(spark, docs).filter("doc_id in (100, 101)").collect()]
    left = {r["doc_id"]: (r["text"].count("\n") + 1 if r["text"] else 0, r[OWN + "removed"]) for r in got}
    assert left == {100: (900, 3100), 101: (0, 4000)}


def test_warc_edges(spark):
    big = "<p>" + "é" * 900
    rows = [(None, None, None), (None, "u", big), (5, None, big), (5, None, big), (6, "a\nb \x00", big), (7, "u", ""), (8, "u", "x" * 999), (9, "u", "x" * 999), (-3, "u", "y" * 1000), (-4, "u", "y" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *(F.lit(j).alias(c) for j, c in enumerate(CLASHES)))
    got = warc.round_trip(spark, pages).collect()
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
    seen = {(r["page_id"], r["payload_digest"]): (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got}
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    assert seen[5, sha(big)] == (1803, "revisit", 6) and seen[6, sha(big)] == (1803, "response", None) and seen[None, sha(big)][1:] == ("revisit", 6)
    assert seen[8, sha("x" * 999)][1:] == ("response", None) and seen[-4, sha("y" * 1000)] == (1000, "revisit", -3)
    assert seen[None, sha("")] == (0, "response", None)
    assert warc.round_trip(spark, pages.limit(0)).collect() == []


def test_neighbours_edges(spark):
    rows = [(100 * i, [1.0, float(i % 2)]) for i in range(40)] + [(100, [1.0, 1.0]), (7, None), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [float("inf"), 1.0]), (10, [0.0, 0.0])]
    x = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *(F.lit(j).alias(c) for j, c in enumerate(CLASHES)))
    got = ann.search(spark, x).collect()
    mine = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 0), key=lambda r: r["rank"])]
    assert mine == [200 * i for i in range(1, 11)]
    assert {r["query_id"] for r in got} == {100 * i for i in range(40)}


def test_stages_keep_columns(spark, docs, labels):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        out.collect()
        assert stage(spark, docs.limit(0), DATA).collect() == [], name


def node_by_node(trees, x):
    total = trees.bias
    for root in trees.roots:
        node = int(root)
        while trees.left[node] != node:
            node = int(trees.left[node] if x[trees.feature[node]] <= trees.cut[node] else trees.right[node])
        total += trees.value[node]
    return 1 / (1 + np.exp(-total))


def without_repeats(texts):
    """Texts by (id, text) after removal of later three-line windows, by a plain scan in the order of ids."""
    first, gone = set(), {i: set() for i in texts}
    for i in sorted(texts):
        wordy = [k for k, x in enumerate(texts[i].split("\n")) if WORD.search(x)]
        lines = texts[i].split("\n")
        for a in range(len(wordy) - 2):
            window = tuple(lines[k] for k in wordy[a : a + 3])
            if window in first:
                gone[i].update(wordy[a : a + 3])
            first.add(window)
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in texts.items()}


def test_pipeline_equals_brute_force(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL_PATH)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    trees = quality.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    features = {r["doc_id"]: r["features"] for r in quality.document_statistics(docs).collect()}
    texts = {}
    for i, r in rows.items():
        n, *_, again = counts_of(r["text"])
        if n >= 10 and 100 * again <= 20 * n and node_by_node(trees, features[i]) >= 0.5:
            texts[i] = r["text"]
    texts = without_repeats(texts)
    of = true_classes([{"doc_id": i, "text": t} for i, t in texts.items()])
    kept = {i: t for i, t in texts.items() if of[i] == i}

    got = corpus_pipeline.run(spark, DATA).collect()
    assert {r["doc_id"]: r["token_ids"] for r in got} == {i: library.encode(t) for i, t in kept.items()}
    assert len(got) == len(kept) < len(rows)

    # the mixing stage hands on every row, in blocks whose order meets every source's deadlines
    before = docs.filter(F.col("doc_id").isin(list(kept)))
    order = [r["doc_id"] for r in mixing.mixed(spark, before).collect()]
    placed = {r["doc_id"]: r for r in mixing.scheduled(spark, before).collect()}
    assert sorted(order) == sorted(kept) and order == sorted(order, key=lambda i: placed[i][OWN + "position"])
    blocks = {(r["source"], r[OWN + "block"]): r[OWN + "slot"] for r in placed.values()}
    assert sorted(blocks.values()) == list(range(len(blocks)))


def test_short_and_null_texts_in_the_near_dedup_stage(spark):
    docs = frame(spark, ["", "", None, None, "one two", "one two", "one two three four five six"])
    got = {r["doc_id"] for r in neardup.keep_one(spark, docs).collect()}
    assert got == {0, 2, 3, 4, 6}


def test_one_row_of_each_class_stays(spark):
    a, b, t = "a text of its own for id five " * 3, "b text of another kind with id five " * 3, "t text without any id at all " * 3
    near = " ".join(f"w{i}" for i in range(200))
    rows = [(None, t), (None, t), (5, a), (5, b), (5, a), (None, a), (7, a), (None, None), (None, None), (8, None), (8, None), (20, near), (21, near + " end"), (None, near + " end"), (None, near + " other end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("x"), "source": F.lit("y"), "n_chars": F.lit(1)})
    got = Counter((r["doc_id"], r["text"]) for r in neardup.keep_one(spark, docs).collect())
    five = [x for x in got if x[0] == 5]
    assert len(five) == 1 and got[five[0]] == 1
    assert got == Counter([(None, t), five[0], (None, None), (8, None), (20, near), (None, near + " other end")])
    links = {(r["doc_id"], r["class_id"]): r["n_links"] for r in neardup.classes(spark, docs).collect()}
    assert links[20, 20] == links[21, 20] == 1 and links[8, 8] == 0
