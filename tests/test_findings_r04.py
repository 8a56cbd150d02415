"""Cases of the findings of round 4."""

import random

import pytest
from pyspark.sql import functions as F

from weft.functions import text as X
from weft.operators import clean, prefix, similarity


def family(rng, n, words=40, edits=3):
    """Sets near one base, and as many that have but one word in common with another."""
    base = [f"w{k}" for k in range(words)]
    near = [[w if rng.random() > edits / words else f"x{rng.randrange(50)}" for w in base] for _ in range(n)]
    far = [[f"one{i // 2}", *(f"own{i}_{k}" for k in range(words))] for i in range(n)]
    short = [[f"s{rng.randrange(4)}" for _ in range(rng.randrange(1, 4))] for _ in range(10)]
    return {i: sorted(set(ws)) for i, ws in enumerate(near + far + short)}


def by_brute_force(sets, least):
    rows = {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for a, x in sets.items() for b, y in sets.items() if a < b}
    return {k: v for k, v in rows.items() if v >= least}


def kept(spark, sets):
    return clean.stored(spark, spark.createDataFrame(list(sets.items()), "doc_id long, ws array<string>"), "sets")


@pytest.mark.parametrize("few, block", [(0, 1), (2, 100), (32, 1 << 20)])
def test_pairs_of_a_family_share_the_copies_of_its_sets(spark, monkeypatch, few, block):
    """the sets of a pair went along with each pair, and pairs of one common word were verified like others."""
    tables, plain = {}, clean.stored

    def stored(s, df, name, **options):
        tables[name] = plain(s, df, name, **options)
        return tables[name]

    monkeypatch.setattr(prefix, "FEW", few)
    monkeypatch.setattr(similarity, "BLOCK_WORDS", block, raising=False)
    monkeypatch.setattr(similarity, "stored", stored)
    sets = family(random.Random(few), 40)
    for least in (0.3, 0.5, 0.85):
        out = similarity.linked(spark, kept(spark, sets), least)
        assert "array_intersect" not in out._jdf.queryExecution().analyzed().toString()
        assert {(r["a"], r["b"]): r["jaccard"] for r in out.collect()} == pytest.approx(by_brute_force(sets, least))
        # two sets of 41 words that share one
        assert not tables["candidates"].filter("a between 40 and 79 and b between 40 and 79").count()


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    plain = similarity._number
    monkeypatch.setattr(similarity, "_number", lambda word, kind, seed: F.length(word).cast(kind) if kind == "int" or seed < 2 else plain(word, kind, seed))
    sets = family(random.Random(1), 10)
    df = kept(spark, sets)
    assert similarity._ranked(spark, df)[:2] == ("bigint", 2)
    assert {(r["a"], r["b"]) for r in similarity.linked(spark, df, 0.7).collect()} == set(by_brute_force(sets, 0.7))


def test_participants_beyond_a_broadcast(spark):
    sets = family(random.Random(2), 20)
    df = kept(spark, sets)
    pairs = spark.createDataFrame([(a, b) for a in sets for b in sets if a < b], "a long, b long")
    ranked = similarity._ranked(spark, df)
    got = similarity._verified(spark, df, pairs, ranked, 0.6, most=0)
    assert {(r["a"], r["b"]): r["jaccard"] for r in got.collect()} == pytest.approx(by_brute_force(sets, 0.6))
    assert similarity.linked(spark, df.limit(0)).count() == 0


def test_sets_take_one_pass_over_a_text(spark):
    """a text was stripped, collapsed and stripped again before it was cut into words."""
    spaces = [c for c in range(1, 0x3100) if chr(c).isspace() or c in (0x180E, 0x200B, 0x2060, 0x1C)]
    rows = [(c, f"{chr(c)}\n Aa{chr(c)}bB {chr(c)} aa\n{chr(c)}") for c in spaces] + [(0, None), (-1, ""), (-2, " 　\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old = F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower("text"), "(?U)\\s+", " "), " "), lambda w: w != ""))
    out = similarity.word_sets(df)
    assert sorted(map(str, out.collect())) == sorted(map(str, df.select("doc_id", old.alias("ws")).collect()))
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
    ends = df.select((X.strip(F.col("text")) == F.regexp_replace("text", "(?U)^\\s+|\\s+$", "")).alias("same"))
    assert ends.filter("not same").count() == 0


def test_repetition_of_lines_as_before(spark):
    made = ["a\r\na\n\n b  b 　\na", "a\x85a\x0ba", "", "x", "x\nx", "\n \n", "　y\r y \n\ny z", None]
    df = spark.createDataFrame([(t,) for t in made], "text string")
    lines = F.filter(F.transform(F.split("text", "\\r\\n|[\\n\\r\\u2028\\u2029]"), lambda x: F.regexp_replace(x, "(?U)^\\s+|\\s+$", "")), lambda x: x != "")
    old = F.when(F.size(lines) <= 1, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(lines)) / F.size(lines))
    assert df.filter(~X.repetition_ratio(F.col("text")).eqNullSafe(old)).count() == 0
