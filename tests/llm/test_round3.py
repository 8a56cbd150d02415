"""Conversation repair, centroid clustering and decontamination against brute force, whichever way they take."""

import hashlib
import random
import re
from collections import Counter
from functools import lru_cache
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_edges import CLASHES
from tests.llm.test_llm import DATA, ODD
from weft.llm import decontaminate, kmeans, lm, mixing, repair
from weft.llm.common import OWN

TURN = "conv_id long, turn long, role string, text string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain_repair(rows):
    """The report of one conversation by plain recursion over (edits left, last said)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        core = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, last, fresh):
        """(cost, letters, turns); ``fresh`` empty turns were just put in."""
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        options = [(3, "I", w, (w, "")) for w in ("user", "assistant") if fresh < 2]
        if i < len(rows):
            _, role, text = rows[i]
            options.append((4, "D", None, None))
            if faults[i] in ("", "truncated"):
                more = 3 * (faults[i] == "truncated")
                options += [(more, "K", role, (role, text))] + [(3 + more, "R", w, (w, text)) for w in ("user", "assistant")]
        for cost, letter, role, turn in options:
            to = last if role is None else follow.get((last, role[:1]))
            if to is not None:
                rest = best(i + (letter != "I"), to, fresh + 1 if letter == "I" else 0)
                if rest:
                    found.append((cost + rest[0], letter + rest[1], ((turn,) if turn else ()) + rest[2]))
        return min(found) if found else None

    cost, audit, turns = best(0, "", 0)
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    count = Counter(faults)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha("\n".join(f"{r}:{x}" for r, x in turns))), turns


def conversations(seed, n=60):
    rng, rows = random.Random(seed), []
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "upper", "s"]
    texts = ["Yes.", "No!", "a long\nline?  \t", "cut off", "", " \n", None, "Why?", "Так.", "x" * 300 + "."]
    for c in range(n):
        for t in range(rng.randrange(0, 14)):
            turn = rng.choice([t, t, t, t + 3, None])
            rows += [(c if c else None, turn, rng.choice(roles[: 4 if c % 3 else 10]), rng.choice(texts))] * rng.choice([1, 1, 1, 2])
    return rows


def as_report(df):
    return {r["conv_id"]: tuple(r[c] for c in (*repair.COUNTS, "audit", "repaired_sha256")) for r in df.collect()}


def test_repair_equals_plain_search_on_both_ways(spark):
    rows = conversations(1)
    rows += [(999, t, ("user", "assistant")[t % 2], "Right." if t % 5 else "open") for t in range(40)] + [(999, 7, "user", "same.")] * 9
    df = spark.createDataFrame(rows, TURN).repartition(5)
    own = {c: [r[1:] for r in g] for c, g in groupby(sorted(rows, key=lambda r: -1 if r[0] is None else r[0]), key=lambda r: r[0])}
    want = {c: plain_repair(g) for c, g in own.items()}
    reports = {c: x for c, (x, _) in want.items()}
    assert as_report(repair.reports(spark, df)) == reports
    for most, chunk in ((5, 4), (0, 2), (20, 4096)):
        assert as_report(repair.reports(spark, df, most_rows=most, chunk=chunk)) == reports, (most, chunk)
    for most in (10**6, 3):
        turns: dict = {}
        for r in sorted(repair.repaired(spark, df, most_rows=most, chunk=4).collect(), key=lambda r: r["place"]):
            turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert turns == {c: list(t) for c, (_, t) in want.items() if t}


def test_repair_chooses_the_least_letters(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "Hi."), (2, 0, "user", "Hi."), (3, 0, "system", "Hi."), (4, 0, "tool", "x."), (4, 1, "assistant", "y.")], TURN)
    got = as_report(repair.reports(spark, df))
    assert {c: (x[5], x[6]) for c, x in got.items()} == {1: (3, "IK"), 2: (3, "KI"), 3: (4, "D"), 4: (3, "RK")}
    assert got[1][7] == sha("user:\nassistant:Hi.") and got[3][7] == sha("")


def test_damage_and_lost_conversations(spark):
    zlib = pytest.importorskip("zlib")
    rows = [(c, t, "assistant", "Well. Done! Right?") for c in [*range(300), None] for t in (0, None)]
    got = {(r["conv_id"], r["turn"]): [] for r in repair.damaged(spark.createDataFrame(rows, TURN)).collect()}
    for r in repair.damaged(spark.createDataFrame(rows, TURN)).collect():
        got[r["conv_id"], r["turn"]].append((r["role"], r["text"], r["live"]))
    for c, t, role, text in rows:
        mark = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        want = ("user" if mark == 4 else role, "" if mark == 1 else "Well Done Right" if mark == 2 else text, mark != 0)
        assert got[c, t] == [want] * (2 if mark == 3 else 1)
    gone = spark.createDataFrame([(5, 0, "user", "x", False), (6, 0, "user", "x.", True), (6, 1, "user", "y", False)], TURN + ", live boolean")
    for most in (100, 0):
        out = as_report(repair.reports(spark, gone, most_rows=most))
        assert out[5] == (0, 0, 0, 0, 0, 0, "", sha("")) and out[6][5:7] == (3, "KI")
    assert repair.reports(spark, gone.limit(0)).collect() == [] and repair.repaired(spark, gone.limit(0)).collect() == []
    clash = spark.createDataFrame([(1, 0, "user", "x."), (1, 1, "assistant", "y.")], TURN).select("*", *(F.lit(1).alias(c) for c in [*CLASHES, "kind", "h1", "pos", "live2"]))
    assert as_report(repair.reports(spark, clash))[1][5:7] == (0, "KK")


def test_conversation_longer_than_a_batch(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "word " * 50 + ".") for t in range(12000)]
    df = spark.createDataFrame(rows + [(0, 0, "user", "a."), (2, 0, "assistant", "b.")], TURN)
    want = (0, 0, 0, 0, 0, 0, "K" * 12000, sha("\n".join(f"{r}:{x}" for _, _, r, x in rows)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        for most in (10**9, 1000):
            got = as_report(repair.reports(spark, df, most_rows=most, most_bytes=1 << 40))
            assert got[1] == want and got[0][6] == "KI" and got[2][6] == "IK"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def plain_clusters(rows, k, rounds, d):
    """Lloyd's rounds with Python integers."""
    kept = [(i, [int(np.floor(256 * float(e))) for e in x]) for i, x in rows if x is not None and len(x) == d and all(e is not None and np.isfinite(e) for e in x)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"2:{r[0]}"), r[1]))[:k]
    cents = [x for _, x in first]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own: dict = {}
        for _, x in kept:
            own.setdefault(near(x)[1], []).append(x)
        cents = [[sum(col) // len(own[j]) for col in zip(*own[j])] if j in own else c for j, c in enumerate(cents)]
    out = [(i, *near(x)[::-1]) for i, x in kept]
    total = Counter()
    for _, j, far in out:
        total[j] += far
    return Counter((i, j, far, total[j], sum(total.values()), sha(",".join(map(str, cents[j])))) for i, j, far in out)


@pytest.mark.parametrize("seed", range(3))
def test_clusters_equal_plain_lloyd(spark, seed):
    rng = np.random.default_rng(seed)
    d = 4
    clumps = rng.normal(0, [1, 30, 1e5][seed], (6, d))[rng.integers(0, 6, 300)] + rng.normal(0, 0.05, (300, d))
    if seed == 0:
        clumps = np.round(clumps * 2) / 512  # many ties
    rows = [(i, [float(e) for e in x]) for i, x in enumerate(clumps)]
    rows += [(i, rows[0][1]) for i in range(1000, 1200)] + [(7, rows[3][1]), (7, rows[4][1]), (None, rows[5][1]), (None, None)]
    rows += [(2000, [1.0] * (d - 1)), (2001, [None] + [1.0] * (d - 1)), (2002, [float("nan")] + [1.0] * (d - 1)), (2003, [float("inf")] * d), (2004, [0.0] * d), (2005, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).select("*", F.lit(1).alias("x"), F.lit(2).alias("cluster"))
    for k in (7, 900):
        got = Counter(tuple(r) for r in kmeans.clusters(spark, df, k=k, rounds=3, components=d).collect())
        assert got == plain_clusters(rows, k, 3, d)


def test_clusters_of_no_vector(spark):
    df = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert kmeans.clusters(spark, df).collect() == [] and kmeans.clusters(spark, df.limit(0)).collect() == []


def test_cover_tree_and_pruning():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (25, 8))[rng.integers(0, 25, 700)] + rng.integers(-9, 9, (700, 8))
    tree = kmeans.CoverTree(x)
    assert sorted(tree.points) == list(range(700)) and tree.size[0] == 700
    for i in range(len(tree.centre)):
        mine = tree.points[tree.start[i] : tree.start[i] + tree.size[i]]
        assert tree.centre[i] in mine
        assert np.sqrt(((x[mine] - x[tree.centre[i]]) ** 2).sum(1)).max() <= tree.radius[i] + 1e-9
        if tree.kids[i]:
            kids = range(tree.child[i], tree.child[i] + tree.kids[i])
            assert sorted(np.concatenate([tree.points[tree.start[j] : tree.start[j] + tree.size[j]] for j in kids])) == sorted(mine)
    cents = x[rng.integers(0, 700, 40)]
    to, work = kmeans.assigned(x, tree, cents, kmeans.CentroidTree(cents))
    assert (to == kmeans.squared(x, cents).argmin(1)).all() and work < 700 * 40 / 2


RUN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOUND = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def fold(text):
    return RUN.findall("" if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def plain_scan(text, items, width=10):
    words = fold(text)
    hit, found = set(), set()
    for item, body in items:
        own = fold(body)
        k = min(width, len(own))
        known = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i : i + k]) in known:
                hit.update(range(i, i + k))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit), hit


BENCH = [
    (1, "The quick Brown fox jumps over the lazy dog and runs away from all of them."), (2, "Unbelievable!"), (3, "two words"), (4, None), (5, " -- "), (10, "the quick brown fox JUMPS over the lazy dog and then sleeps until noon"),
    (None, "nobody owns this item at all but it has ten words or so"), (2, "unbelievable"), (7, "日本語 の 文 — naïve ☃"), (8, "deed " * 30),
]
TEXTS = [
    *ODD, "so: THE QUICK brown-fox, jumps over the lazy dog; and runs away", "unbelievable story of two  words", "Nobody owns this item at all but it has ten words or so it goes", "日本語 の 文 naïve ☃ and more", "deed " * 25 + "end",
    "The quick brown fox jumps over the lazy dog and " * 400, "KK and İ stay as they are: unbelievableİ",
]


@pytest.mark.parametrize("most", [1 << 30, -1])
def test_decontamination_equals_plain_scan(spark, most):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[-3]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).select("*", *(F.lit(i).alias(c) for i, c in enumerate([*CLASHES, "window", "item"])))
    bench = spark.createDataFrame(BENCH, "item_id long, text string").select("*", F.lit(1).alias("k"), F.lit(2).alias("h"))
    got = Counter((r["doc_id"], *(r[OWN + c] for c in FOUND)) for r in decontaminate.scanned(spark, docs, bench, most=most).collect())
    assert got == Counter((i, *plain_scan(t, BENCH)[:5]) for i, t in rows)
    kept = decontaminate.without_documents(spark, docs, bench, most=most)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, t in rows if not plain_scan(t, BENCH)[4])
    half = decontaminate.without_documents(spark, docs, bench, share=0.5, most=most).collect()
    assert Counter(r["doc_id"] for r in half) == Counter(i for i, t in rows if plain_scan(t, BENCH)[1] <= 0.5 * len(fold(t)))
    left = decontaminate.without_spans(spark, docs, bench, most=most)
    assert left.columns == docs.columns
    for r in left.collect():
        hit = plain_scan(dict(rows)[r["doc_id"]], BENCH)[5] if r["doc_id"] is not None else set()
        if r["doc_id"] is not None:
            was = dict(rows)[r["doc_id"]]
            assert (r["text"] == was) if not hit else fold(r["text"]) == [w for i, w in enumerate(fold(was)) if i not in hit]


@pytest.mark.parametrize("most", [1 << 30, -1])
def test_decontamination_of_empty_tables(spark, most):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    for b in (bench.limit(0), bench.filter("text is null"), bench.filter("item_id = 5")):
        assert sorted(tuple(r) for r in decontaminate.report(spark, docs, b, most=most).collect()) == [(1, 3, 0, 0, sha(""), False), (2, 0, 0, 0, sha(""), False)]
    assert decontaminate.report(spark, docs.limit(0), bench, most=most).collect() == []


def test_colliding_hashes_are_told_apart():
    from weft.llm.textbatch import Texts

    import pyarrow as pa

    t = Texts(np.frombuffer(b"one two", np.uint8), np.array([0, 7])).lowered()
    start, end, first = decontaminate._words(t)
    h, _ = decontaminate._windows_of(t, t.span_hash(start, end), first, 2)
    rows = pa.table({"item": ["1", "2"], "k": [2, 2], "h": [int(h.view(np.int64)[0])] * 2, "window": [b"two one", b"one two"]})
    found = decontaminate.WindowSet(rows)
    (begin, width, window), = found.hits(t, start, end, first)
    assert list(begin) == [0] and width == 2 and [found.lists[found.of[w]] for w in window] == [("2",)]


def test_whole_benchmark_on_both_ways(spark):
    docs, bench = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    a, b = ({tuple(r) for r in decontaminate.report(spark, docs, bench, most=m).collect()} for m in (1 << 30, -1))
    assert a == b and any(r[-1] for r in a)


def test_weights_may_be_far_apart():
    rng = random.Random(8)
    for _ in range(60):
        blocks = {k: rng.randrange(1, 60) for k in "abcdefgh"[: rng.randrange(1, 8)]}
        weights = mixing.integer_weights({k: rng.choice([1, 3, 7, 1e-3, 1e6, 0.1, 1e-300, 5e-324, 1e300]) for k in blocks})
        slots, (releases, due) = mixing.placed_blocks(blocks, weights), zip(*mixing.windows(blocks, weights).values())
        assert sorted(x for s in slots.values() for x in s) == list(range(sum(blocks.values())))
        for mine, r, d in zip(slots.values(), releases, due):
            assert all(a <= x < b for a, x, b in zip(r, mine, d))


@pytest.mark.parametrize("wrong", [-1.0, float("nan"), float("inf"), float("-inf")])
def test_wrong_weights_are_refused(spark, wrong):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    with pytest.raises(ValueError, match="finite"):
        mixing.scheduled(spark, df, weights={"a": wrong})
    many = spark.createDataFrame([(i, "b") for i in range(9)] + [(9, "a")], "doc_id long, source string")
    far = mixing.scheduled(spark, many, weights={"a": 1e-300, "b": 1.0}, block_rows=1).collect()
    assert sorted(r[OWN + "slot"] for r in far) == list(range(10))


def test_slices_of_a_shard_equal_one_task(spark):
    """One context has most codes; its groups are shared by tasks, whose logs are those of one task."""
    rng = random.Random(1)
    texts = ["the the " * rng.randrange(1, 30) + " ".join(rng.choice(["the", "cat", "sat", "ate"]) for _ in range(30)) for _ in range(60)] + [None, "", "é ☃"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    docs = docs.select("doc_id", "text")
    one = {r["doc_id"]: tuple(r) for r in lm.score(spark, docs, group_bytes=700).collect()}
    for slice_groups, fan in ((1, 2), (5, 32)):
        lm_fan = lm.summed.__defaults__
        try:
            lm.summed.__defaults__ = (fan,)
            got = {r["doc_id"]: tuple(r) for r in lm.score(spark, docs, group_bytes=700, slice_groups=slice_groups).collect()}
        finally:
            lm.summed.__defaults__ = lm_fan
        assert got.keys() == one.keys() and all(got[i] == pytest.approx(one[i], rel=1e-9) for i in one)
