"""Cases of the findings of round 3."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from weft.functions import tokenizers
from weft.functions.tokenizers import FileTokenizer
from weft.operators import clean, evaluation, similarity, tokens
from weft.operators.dedup_index import DedupIndex


class Elsewhere:
    """A session whose master isn't local and whose shared folder is given; all else is the session's."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.sparkContext = type("Context", (), {"master": "spark://name:7077"})
        self.conf = type("Conf", (), {"get": lambda _, key, *other: folder if key == "spark.checkpoint.dir" else spark.conf.get(key, *other)})()

    def __getattr__(self, name):
        return getattr(self.spark, name)


def test_index_in_a_shared_folder_without_scheme(spark, tmp_path):
    other = Elsewhere(spark, str(tmp_path))
    index = DedupIndex(other, f"{tmp_path}/index")
    assert index.uri == f"{tmp_path}/index" and index.table("buckets").count() == 0
    rows = spark.createDataFrame([(1, "a b c"), (2, "A  b c"), (3, "x")], "doc_id long, text string")
    assert {r["doc_id"]: r["why"] for r in index.add(rows, "one").collect()} == {1: None, 2: "duplicate", 3: None}
    index.forget("one")
    assert index.table("digests").count() == index.table("buckets").count() == 0
    with pytest.raises(ValueError):
        DedupIndex(other, "/data/index")


def test_batches_of_texts_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, "64m")
    spark.conf.set(key, "64m")
    try:
        texts = ["e\u0301 a", "plain", "\u00a0\u00aa", None, "\u1100\u1161"]
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r["doc_id"]: r["text"] for r in clean.normalized(rows).collect()}
        assert got == {0: "\u00e9 a", 1: "plain", 2: "\u00aa", 3: "", 4: "\uac00"} and int(spark.conf.get(key)) <= 8 << 20
    finally:
        spark.conf.set(key, before)


def test_texts_are_encoded_some_at_a_time(monkeypatch):
    monkeypatch.setattr(tokenizers, "TEXTS", 10)
    asked = []

    def encode(texts):
        asked.append(texts)
        return [[len(w) for w in x.split()] for x in texts]

    texts = ["a bb", None, "cc d", "e" * 30, "", "f"]
    assert tokenizers._encoded(encode, texts).to_pylist() == [[1, 2], [], [2, 1], [30], [], [1]]
    assert [x for part in asked for x in part] == [x or "" for x in texts]
    assert all(len(part) == 1 or sum(map(len, part)) <= 10 for part in asked) and len(asked) == 3


def grams(text, n):
    text = "".join(text.split())
    return Counter(text[i : i + n] for i in range(len(text) - n + 1))


def test_chrf_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "CHARS", 12)
    made = [(1, "abc abd abd", "abd abc x"), (2, "", "none here"), (3, "\U0001f600\U0001f600 y", "\U0001f600 y z"), (4, "aaaa", None), (5, "one half", "one"), (5, " other half", "half one"), (None, "abc", "abc"), (None, "abc", "abc")]
    h, r, m = Counter(), Counter(), Counter()
    for n in range(1, 7):
        sides = {}
        for k, (i, a, b) in enumerate(made):
            for side, text in enumerate((a, b)):
                mine = sides.setdefault(i if i is not None else (k, side), (Counter(), Counter()))
                mine[side].update(grams(text or "", n))
        for a, b in sides.values():
            h[n], r[n], m[n] = h[n] + a.total(), r[n] + b.total(), m[n] + (a & b).total()
    orders = [n for n in h if h[n] and r[n]]
    p, q = (sum(m[n] / x[n] for n in orders) / len(orders) for x in (h, r))
    df = spark.createDataFrame(made, "id long, hypothesis string, reference string").repartition(3)
    out = evaluation.chrf(df)
    assert out.first()["chrf"] == pytest.approx(500 * p * q / (4 * p + q))
    # pairs of one row send only sums away
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()


def test_running_total_shuffles_rows_once(spark):
    rows = spark.createDataFrame([(5, "a", 2), (1, "b", 3), (None, "c", 1), (5, "d", None), (9, "e", 4)], "k long, text string, n int")
    out = clean.running_total(spark, rows, "k", "n")
    got = {r["text"]: r["before"] for r in out.collect()}
    assert got["c"] == 0 and got["b"] == 1 and got["e"] == 6 and {got["a"], got["d"]} in ({4, 6}, {4})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange" in x and "text" in x] and "Window [" not in plan.replace("Window [coalesce", "").split("BroadcastExchange")[0]


def test_ids_are_stored_before_they_are_packed(spark):
    asked = spark.sparkContext.accumulator(0)

    class Counting(FileTokenizer):
        def tokens(self, text):
            @F.arrow_udf("array<int>")
            def run(s):
                import pyarrow as pa

                asked.add(len(s))
                return pa.array([[len(w) for w in x.split()] for x in s.to_pylist()], pa.list_(pa.int32()))

            return run(text)

    rows = spark.createDataFrame([(i, "a bb ccc") for i in range(8)], "doc_id long, text string").coalesce(1)
    out = tokens.packed(spark, rows, 4, tokenizer=Counting(""))
    assert [r["tokens"] for r in out.orderBy("block").collect()][:2] == [[1, 2, 3, 1], [2, 3, 1, 2]] and out.count() == 6
    assert asked.value == 8


def test_similar_sets_travel_as_numbers(spark):
    words = ["alpha", "beta", "gamma", "delta", "lone"]
    rows = [(1, words[:4]), (2, [*words[:3], "own"]), (3, words[:4]), (4, ["beta", "gamma"]), (4, ["alpha", "delta"]), (5, ["far"])]
    sets = spark.createDataFrame(rows, "doc_id long, ws array<string>")
    got = {(r["a"], r["b"]): round(r["jaccard"], 3) for r in similarity.similar_pairs(spark, sets, 0.5).collect()}
    # 4 counts as one row with the words of both
    assert got == {(1, 2): 0.6, (2, 3): 0.6, (2, 4): 0.6, (1, 3): 1.0, (1, 4): 1.0, (3, 4): 1.0}
    one, members = similarity.distinct_sets(spark, sets)
    assert sorted(r["doc_id"] for r in one.collect()) == [1, 2, 5] and members.count() == 5
    numbered = {r["doc_id"]: (r["n"], len(r["ids"])) for r in similarity._numbered(spark, one).collect()}
    assert numbered == {1: (4, 3), 2: (4, 3)} and dict(similarity._numbered(spark, one).dtypes)["ids"] == "array<int>"
