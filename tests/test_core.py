"""Behaviour of the cleaning, chat, evaluation, licence and plan layers on small made rows."""

import json
import math
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weft import queries
from weft.functions import langid, patterns, tables
from weft.functions import text as X
from weft.functions.tokenizers import FileTokenizer, _encoder
from weft.operators import bootstrap, chat, clean, evaluation, licensing, prefix, similarity, tokens
from weft.operators.dedup_index import DedupIndex
from weft.plans.manifest import Manifest, run
from weft.sources import files
from weft.sources.registry import SourceUnavailable, connector
from weft.streaming import dedup as stream_dedup
from weft.streaming.clean import clean_stream

DATA = "/root/testdata/sf0.001"
GOOD = ["The river crossed the old town and its market every morning of the year. " * 2 + f"Only {k} people knew where it began and nobody asked them about the long way that it took down from the hills." for k in ("two", "nine", "many")]


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "s", "en") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


def test_normalize(spark):
    assert one(spark, "يك٠١٢", lambda c: X.normalize(c, digits=True, rules=("persian_yeh_kaf", "no_such_rule"))) == "یک012"
    assert one(spark, "a\x00b\x07c", X.normalize) == "abc"
    assert one(spark, "é  x\n\n\n\ny  ", X.normalize) == "é x\n\ny"
    assert one(spark, None, X.normalize) == ""


def test_reasons_and_dedup(spark):
    texts = [GOOD[0], GOOD[0].upper(), GOOD[1], "short", "#$%& " * 80, "", None, "\n".join(["the same line of words again"] * 12), GOOD[2]]
    got = rows(clean.with_duplicates(spark, clean.judged(docs(spark, texts))), "doc_id", "reason")
    assert [r for _, r in got] == [None, "duplicate", None, "too_short_chars", "too_few_words", "empty_after_normalize", "empty_after_normalize", "repetitive", None]
    card = clean.data_card(spark, docs(spark, texts)).first()
    assert (card["docs_in"], card["docs_out"], card["duplicate"]) == (9, 3, 1)
    assert clean.data_card(spark, docs(spark, [])).first()["docs_out"] == 0


def test_pii(spark):
    row = docs(spark, ["mail a.b@example.org or see https://example.org/x and call 030 1234-5678, not 1234567"])
    r = clean.scrubbed(row).first()
    assert (r["n_email"], r["n_url"], r["n_num"]) == (1, 1, 1)
    assert r["text"] == "mail [EMAIL] or see [URL] and call [NUM], not 1234567"


def test_greedy_keeps_the_end_of_a_chain(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (5, 7), (6, 7)], "a long, b long")
    assert rows(similarity.greedy_drops(spark, edges), "doc_id") == [(2,), (6,), (7,)]


def plain_greedy(edges):
    gone = set()
    for b in sorted({b for _, b in edges}):
        if any(a not in gone for a, x in edges if x == b):
            gone.add(b)
    return gone


def test_greedy_equals_a_plain_walk(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(1000)]
    more = [tuple(sorted(rng.sample(range(2000, 2060), 2))) for _ in range(150)] + [(3000, 3001)] * 3
    edges = [*chain, *more]
    want = sorted(plain_greedy(set(edges)))
    df = spark.createDataFrame(edges, "a long, b long")
    assert [r[0] for r in rows(similarity.greedy_drops(spark, df), "doc_id")] == want
    small = spark.createDataFrame([*chain[:40], *more], "a long, b long")
    want = sorted(plain_greedy(set([*chain[:40], *more])))
    assert [r[0] for r in rows(similarity.greedy_drops(spark, small, 1, 60), "doc_id")] == want
    assert similarity.greedy_drops(spark, df.limit(0)).count() == 0


def test_similar_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(w if rng.random() > p else f"n{rng.randrange(40)}" for w in base) for p in [0.0] * 3 + [0.03] * 8 + [0.1] * 8] + ["a b", "b a", "a b c", "", None, "hot word"] + [f"hot {k}" for k in range(20)]
    df = docs(spark, texts).union(spark.createDataFrame([(None, "a b", "s", "en"), (3, texts[3], "s", "en")], "doc_id long, text string, source string, lang string"))
    sets = {i: set(t.split()) for i, t in enumerate(texts) if t}
    want = {(a, b): len(x & y) / len(x | y) for a, x in sets.items() for b, y in sets.items() if a < b and len(x & y) / len(x | y) >= 0.85}
    got = {(r["a"], r["b"]): r["jaccard"] for r in similarity.similar_pairs(spark, similarity.word_sets(df)).collect()}
    assert got == pytest.approx(want)
    distinct = docs(spark, texts)
    assert {r[0] for r in rows(similarity.near_drops(spark, similarity.word_sets(distinct)), "doc_id")} == plain_greedy(set(want))


def test_buckets(spark):
    rng = random.Random(7)
    base = [f"w{k}" for k in range(80)]
    texts = [" ".join(w if rng.random() > p else f"n{rng.randrange(99)}" for w in base) for p in [0.0] * 3 + [0.01] * 10 + [0.05] * 10 + [1.0] * 10] + ["", None]
    df = docs(spark, texts)
    members = {}
    for r in similarity.minhash_bands(df).collect():
        members.setdefault((r["band"], r["bucket"]), set()).add(r["doc_id"])
    assert {k for m in members.values() for k in m} == set(range(33))
    got = {(r["doc_id"], r["band"], r["bucket"], r["first"]) for r in similarity.lsh_candidates(df).collect()}
    assert got == {(i, *k, min(m)) for k, m in members.items() if len(m) > 1 for i in m}
    kept, gone = set(), set()
    for i in range(33):
        (gone if any(i in m and m & kept for m in members.values()) else kept).add(i)
    assert {r[0] for r in rows(similarity.lsh_drops(spark, df), "doc_id")} == gone and {1, 2} <= gone
    # registers agree as often as the sets are similar
    a, b = [set(texts[i].split()) for i in (0, 3)]
    agree = sum({0, 3} <= m for m in members.values()) / 8
    assert agree >= 0.3 or len(a & b) / len(a | b) < 0.9


def test_byte_budget_crosses_once(spark):
    got = clean.byte_budget(spark, docs(spark, ["aaaa", "bbbb", "cccc", "dddd"]), 6)
    assert rows(got, "doc_id") == [(0,), (1,)]
    assert clean.byte_budget(spark, docs(spark, ["aaaa"]), 0).count() == 1


def test_pairs(spark):
    made = spark.createDataFrame([(0, "Hello ", "x x x x x x"), (1, "hello", "fine"), (2, " HELLO", "late"), (3, " ", "y")], "ord long, instruction string, response string")
    assert [r[1] for r in rows(chat.pair_status(made), "ord", "status")] == ["degenerate", "accepted", "duplicate", "blank"]
    tree = spark.createDataFrame([("r", None, "user", "q", 1), ("a", "r", "assistant", "one", 2), ("b", "r", "assistant", "two", 3), ("c", "a", "assistant", "deep", 4), ("z", None, "user", "late", 9), ("y", "z", "assistant", "early", 5)], "message_id string, parent_id string, role string, text string, ord long")
    assert rows(chat.replies(tree), "id") == [("a",), ("b",)]
    queue = chat.review_queue(spark, made.select("ord", "instruction"))
    prior = spark.createDataFrame([(1, "accepted"), (9, "rejected")], "id long, status string")
    assert rows(chat.merge_reviews(queue, prior), "id", "status")[1] == (1, "accepted")


def test_packing_and_cloze(spark):
    blocks = rows(tokens.packed(spark, docs(spark, ["a b c", "", "d e"]), 3).select("block", F.array_join("tokens", " ").alias("t")), "block", "t")
    assert blocks == [(0, "a b c"), (1, "</s> d e")]
    assert tokens.fitting_length(100, 256) == 64 and tokens.fitting_length(3, 256) is None
    got = tokens.sentences_tail(docs(spark, ["One two three four five six seven."]), 5).first()
    assert (got["prompt"], got["target"]) == ("One two three four five six ", "seven")


def test_scores(spark):
    assert evaluation.parse_pairs(spark.createDataFrame([(1, 'ok [{"instruction": "a", "response": "b"}, {"instruction": ""}] end')], "id long, reply string")).count() == 1
    same = spark.createDataFrame([(1, "a cat sat", "a cat sat")], "id long, hypothesis string, reference string")
    assert evaluation.chrf(same).first()["chrf"] == pytest.approx(100)


def test_licences(spark):
    prov = lambda *ls: spark.createDataFrame([(f"s{i}", x) for i, x in enumerate(ls)], "source string, license string")
    assert licensing.release_license(prov("CC0-1.0", "pd")) == "CC0-1.0"
    assert licensing.release_license(prov("mit", "CC-BY-SA-4.0")) == "CC-BY-SA-4.0"
    for bad in (("unknown",), ("cc-by-nc-4.0",), ("cc-by-sa-4.0", "cc-by-sa-3.0"), ("mixed",)):
        with pytest.raises(licensing.LicenseError):
            licensing.release_license(prov(*bad))


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("plain text")
    (tmp_path / "b.html").write_text("<html><head><title>t</title></head><nav>menu</nav><p>Body &amp; soul<p>more<script>x()</script></html>")
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps({"text": t}) for t in ("one", " ", "two")))
    got = files.read_local(spark, str(tmp_path))
    assert rows(got, "text") == [("Body & soul\nmore",), ("one",), ("plain text",), ("two",)]
    assert files.read_local(spark, str(tmp_path), max_docs=2).count() == 2
    files.write_shards(got.select("text", "source", "meta"), str(tmp_path / "out"), 2)
    assert files.read_shards(spark, str(tmp_path / "out")).count() == 4
    with pytest.raises(ValueError):
        connector("nope")
    with pytest.raises(ValueError):
        connector("local").documents(spark, {})
    with pytest.raises(PermissionError):
        connector("culturax").documents(spark, {"lang": "cy"})
    with pytest.raises(SourceUnavailable):
        connector("wikipedia").documents(spark, {"wiki": "cy"})


def test_manifest(tmp_path):
    work = {s: (lambda: ([], {})) for s in ("ingest", "clean", "export")}
    go = lambda config: run(Manifest.load(tmp_path / "m.json"), ["export", "ingest", "clean"], config, work)
    assert go({}) == {"ingest": "ran", "clean": "ran", "export": "ran"}
    assert set(go({}).values()) == {"skipped"}
    assert go({"clean": {"min_quality": 0.6}}) == {"ingest": "skipped", "clean": "ran", "export": "ran"}
    with pytest.raises(ValueError):
        run(Manifest.load(tmp_path / "m.json"), ["nope"], {}, work)


def test_stream(spark, tmp_path):
    docs(spark, [GOOD[0], GOOD[0], GOOD[1], "short"]).write.parquet(str(tmp_path / "in"))
    rows_ = spark.readStream.schema("doc_id long, text string, source string, lang string").parquet(str(tmp_path / "in"))
    q = clean_stream(rows_).writeStream.format("memory").queryName("cleaned").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("cleaned").count() == 2


def test_main_text_of_pages():
    pages = {
        "<html><head><title>t</title></head><nav>menu</nav><p>Body &amp; soul<p>more<script>x()</script></html>": "Body & soul\nmore",
        "<div class='sidebar'><p>no</p></div><h1>Head</h1>a <b>b</b>\n c<br>d<ul><li>one<li>two</ul>": "Head\na b c\nd\none\ntwo",
        "<footer><div>x</div></footer><td>cell</td><table><tr><td>1<td>2</table>": "cell\n1\n2",
        "<style>p{}</style><nav>only</nav>": "",
        "plain text &lt;3\nin two lines": "plain text <3 in two lines",
        "<pre>a\n b</pre>c\nd": "a\nb\nc d",
        "<p class='ad'>buy</p>stay<aside>aside<p>in</aside>here": "stay\nhere",
        "": "",
    }
    assert {k: files.main_text(k) for k in pages} == pages and files.main_text(None) == ""


def test_pdf_pages(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF one")
    got = files.read_pdf(spark, str(tmp_path), lambda data: data.decode().removeprefix("%PDF "))
    assert rows(got, "text") == [("one",)]


def plain_weight(order, round_):
    """The Poisson weight of one item in one round."""
    x = (order ^ (round_ * 0x9E3779B1)) & 0xFFFFFFFF
    for m in (0x45D9F3B, 0x2C1B3C6D):
        x = ((x ^ (x >> 16)) * m) & 0xFFFFFFFF
    x ^= x >> 16
    share, k, term = x / 2**32, 0, math.exp(-1)
    while share >= term and k < 13:
        k += 1
        term += math.exp(-1) / math.factorial(k)
    return k


def test_bootstrap_equals_a_plain_one(spark):
    values = {"x": [float(k % 3 == 0) for k in range(40)], "y": [1.0, 0.0, 2.5]}
    made = [(n, k, v) for n, vs in values.items() for k, v in enumerate(vs)] + [("x", 99, None), ("z", 0, None)]
    got = {r["name"]: r for r in bootstrap.intervals(spark.createDataFrame(made, "name string, ord long, value double").repartition(3)).collect()}
    for name, vs in values.items():
        means = []
        for r in range(1000):
            w = [plain_weight(k, r) for k in range(len(vs))]
            if sum(w):
                means.append(sum(a * b for a, b in zip(w, vs)) / sum(w))
        means.sort()
        want = (len(vs), means[int(0.025 * len(means))], means[int(0.975 * len(means))], sum(vs) / len(vs))
        assert (got[name]["n"], got[name]["lo"], got[name]["hi"], got[name]["mean"]) == pytest.approx(want)
    assert (got["z"]["n"], got["z"]["mean"], got["z"]["lo"]) == (0, None, None)
    # weights are those of drawing with replacement: of mean and variance 1
    w = bootstrap.weights(np.arange(2000), 500, 0)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02
    # an interval of a share of 0.8 of 100 items is as wide as its standard error says
    ci = bootstrap.intervals(spark.createDataFrame([("x", (k, "a"), float(k % 5 > 0)) for k in range(100)], "name string, ord struct<i: long, s: string>, value double")).first()
    assert ci["n"] == 100 and 0.68 < ci["lo"] < 0.76 < 0.84 < ci["hi"] < 0.92
    assert "FlatMapGroups" not in bootstrap.intervals(spark.createDataFrame(made, "name string, ord long, value double"))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_search(seed):
    rng = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcé☃ "
    found = ["".join(rng.choices(alphabet, k=rng.randrange(1, 9))).encode() for _ in range(60)] + [b"a" * 40]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 90))).encode() for _ in range(80)] + [b"a" * 5000, b"", b"b" * 2047 + b"a" * 60]
    machine = patterns.Automaton(found)
    data, offs = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
    got = set(zip(*map(list, machine.found(data, offs))))
    assert got == {(i, k) for i, t in enumerate(texts) for k, p in enumerate(machine.patterns) if p in t}
    assert [len(g) for g in patterns.grouped([b"aa", b"bb", b"c" * 9], 4)] == [2, 1]


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_patterns_of_a_table(spark, most):
    texts = ["a cat", None, "", "Cat and dog", "dogma of the cat", "x" * 9000 + "dog"]
    rows_ = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("found", F.lit(1)).drop("found")
    names = ["cat", "dog", "dogma", "", None, "nothing at all", "x" * 30, "cat"]
    got = {r["doc_id"]: r["has"] for r in patterns.containing(spark, rows_, "text", names, "has", listed=True, most=most).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {i: sorted({p for p in names if p is not None and p in t}) if t is not None else [] for i, t in enumerate(texts)}
    flags = {r["doc_id"]: r["has"] for r in patterns.containing(spark, rows_, "text", ["dog", None], "has", most=most).collect()}
    assert flags == {i: t is not None and "dog" in t for i, t in enumerate(texts)}
    assert patterns.containing(spark, rows_, "text", [], "has").filter("has").count() == 0
    long = spark.createDataFrame([(i, "q", "r", f"source number {i}") for i in range(30)], "ord long, i string, r string, s string")
    few, many = (chat.native_set(long, "i", "r", "s", tuple(f"NUMBER {k}" for k in range(3, n))) for n in (6, 31))
    assert few.count() == 30 - 3 and rows(many, "ord") == [(i,) for i in (0, 1, 2)]


def test_increments_equal_one_run(spark, tmp_path):
    rng = random.Random(9)
    words_ = [f"w{i}" for i in range(40)]
    base = [rng.sample(words_, 20) for _ in range(12)]
    texts = [" ".join(base[i % 12][: 20 - (i // 12) % 3]) if i % 5 else f"lone {i} " + " ".join(rng.sample(words_, 9)) for i in range(80)] + ["", "!!", ""]
    df = docs(spark, texts)

    def run(cuts, name):
        index = DedupIndex(spark, str(tmp_path / name))
        out = {}
        for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(texts)])):
            got = index.add(df.filter(f"doc_id >= {a} and doc_id < {b}"), f"p{k}")
            out |= {r["doc_id"]: r["why"] for r in got.collect()}
        return index, out

    (_, one), (index, four) = run([], "one"), run([20, 41, 60], "four")
    assert one == four and {"duplicate", "near_duplicate", None} == set(one.values())
    # exact copies go first, then what shares a bucket with an earlier kept row
    firsts = {t: i for i, t in reversed(list(enumerate(texts)))}
    kept = df.filter(F.col("doc_id").isin([i for t, i in firsts.items()]))
    near = {r[0] for r in rows(similarity.lsh_drops(spark, kept), "doc_id")}
    assert one == {i: "duplicate" if firsts[t] != i else "near_duplicate" if i in near else None for i, t in enumerate(texts)}
    # an increment that is added again replaces itself, and one that is forgotten can come back
    again = {r["doc_id"]: r["why"] for r in index.add(df.filter("doc_id >= 60"), "p3").collect()}
    assert again == {i: w for i, w in four.items() if i >= 60}
    before = index.table("buckets").count()
    index.forget("p3")
    assert index.table("buckets").count() < before and index.add(df.limit(0), "p9").count() == 0
    plan = index.add(df.filter("doc_id < 5").withColumn("text", F.concat(F.lit("other "), "text")), "p7")._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "four") not in plan  # its result is decided: no table of the index is read again
    with pytest.raises(ValueError):
        index.add(df, "a/b")


def as_stream(spark, folder, parts, schema):
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder / f"{k}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def test_streams_drop_near_duplicates(spark, tmp_path):
    rng = random.Random(2)
    words_ = [f"w{i}" for i in range(30)]
    base = [rng.sample(words_, 15) for _ in range(6)]
    rows_ = [(i, " ".join(base[i % 6][: 15 - i // 18]) if i % 4 else " ".join(rng.sample(words_, 8)), f"s{i % 2}") for i in range(54)]
    schema, parts = "doc_id long, text string, source string", [rows_[:20], rows_[20:37], rows_[37:]]
    df = spark.createDataFrame(rows_, schema)
    firsts = lambda rs: [r for k, r in enumerate(rs) if r[1] not in {x[1] for x in rs[:k]}]

    def kept(rs):
        part = spark.createDataFrame(firsts(rs), schema)
        return {r[0] for r in firsts(rs)} - {r[0] for r in rows(similarity.lsh_drops(spark, part), "doc_id")}

    got, index = [], DedupIndex(spark, str(tmp_path / "index"))
    stream = as_stream(spark, tmp_path / "in", parts, schema)
    q = stream_dedup.index_stream(stream, index, lambda batch, n: got.extend(r["doc_id"] for r in batch.collect())).option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(got) == sorted(kept(rows_)) and df.count() > len(got)

    def within(live_ms, pause):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        out = stream_dedup.near_dedup_stream(stream, live_ms=live_ms)
        seen, state, batches = [], [0], []

        def sink(batch, n):
            seen.extend((r["key"], r["doc_id"]) for r in batch.collect())
            batches.append(n)
            time.sleep(pause)

        q = out.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", str(tmp_path / f"c{live_ms}")).start()
        until = time.time() + 60
        # with timers by the clock Spark goes on with empty batches after those of the three files
        while time.time() < until and q.isActive and len(batches) < 5:
            state += [o.numRowsTotal for p in [q.lastProgress] if p for o in p.stateOperators]
            time.sleep(0.1)
        assert q.exception() is None
        q.stop()
        return sorted(seen), max(state)

    want = sorted((s, i) for s in ("s0", "s1") for i in kept([r for r in rows_ if r[2] == s]))
    all_, held = within(3_600_000, 0)
    assert all_ == want
    short, bounded = within(500, 1.5)  # what a batch kept is forgotten before the next one
    fresh = sorted((s, i) for part in parts for s in ("s0", "s1") for i in kept([r for r in part if r[2] == s]))
    assert short == fresh and len(short) > len(want) and bounded < held


def test_pages_and_sentences_as_tables(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"first page\x0c second\x0c \x0c")
    (tmp_path / "b.pdf").write_bytes(b"broken")

    def pages(data):
        if data == b"broken":
            raise ValueError("no pages")
        return data.decode().split("\x0c")

    got = files.read_pdf(spark, str(tmp_path), pages).collect()
    assert sorted((r["path"][-5:], r["line"], r["text"], r["error"]) for r in got) == [("a.pdf", 0, "first page", None), ("a.pdf", 1, "second", None), ("b.pdf", 0, "", "ValueError: no pages")]
    tables.register(spark)
    texts = ["One. Two!  Three?\nfour\n\n five", "", None, "no end"]
    df = docs(spark, texts)
    want = [(r["doc_id"], i, s) for r in df.select("doc_id", X.sentences(F.col("text")).alias("ss")).collect() for i, s in enumerate(r["ss"] or [])]
    assert rows(tables.with_sentences(df), "doc_id", "place", "sentence") == sorted(want) and len(want) == 6
    df.createOrReplaceTempView("some_docs")
    assert spark.sql("select doc_id, s.* from some_docs, lateral sentences(text) s").count() == 6


def test_language_model(spark):
    docs_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs_.filter("doc_id % 2 = 0"))
    met = langid.identified(docs_.filter("doc_id % 2 = 1 and lang <> '' and length(text) > 100").withColumn("told", F.col("lang")), model)
    right = met.agg(F.avg((F.col("lang") == F.col("told")).cast("int")).alias("x"), F.min("prob").alias("lo"), F.max("prob").alias("hi")).first()
    assert right["x"] > 0.9 and 0 < right["lo"] <= right["hi"] <= 1
    assert model.predict(["", None, " \n"]) == ([""] * 3, [0.0] * 3)
    empty = langid.train(docs_.limit(0))
    assert empty.predict(["any text"]) == ([""], [0.0]) and langid.opened(None) is None
    # the same shares by a plain count of one bucket
    rows_ = [(r["text"], r["lang"]) for r in docs_.filter("doc_id % 2 = 0").collect() if r["text"] and r["lang"]]
    counts = {}
    for t, lang in rows_:
        for b in langid.buckets(t).tolist():
            counts.setdefault(lang, {}).setdefault(b, 0)
            counts[lang][b] += 1
    for i, lang in enumerate(model.languages):
        total = sum(counts[lang].values()) + 0.5 * langid.BUCKETS
        b, n = max(counts[lang].items(), key=lambda x: x[1])
        assert model.logs[i, b] == pytest.approx(math.log((n + 0.5) / total), rel=1e-6)
    # and the same labels by a plain sum for each text
    some = [r["text"] for r in docs_.filter("doc_id % 2 = 1").limit(60).collect()] + ["ß", "a", "  x  Y "]
    labels, probs = model.predict(some)
    for t, label, p in zip(some, labels, probs):
        if (t or "").split():
            score = model.logs[:, langid.buckets(t)].astype(float).sum(1)
            assert model.languages[int(score.argmax())] == label and p == pytest.approx(1 / np.exp(score - score.max()).sum(), rel=1e-6)


def test_language_model_of_many_languages(spark, monkeypatch):
    """Two thousand labels are told apart, in one block or in several."""
    letters = "abcdefghijklmnopqrst"
    name = lambda k: "".join(letters[k // 20**j % 20] for j in range(3))
    made = [(k, f"{name(k)}x {name(k)}yy {name(k)}zz{k} " * 2, f"l{k:04d}") for k in range(2000)]
    df = spark.createDataFrame(made, "doc_id long, text string, told string").repartition(4)
    model = langid.train(df.withColumnRenamed("told", "lang"))
    assert len(model.languages) == 2000
    several = {r["doc_id"]: (r["lang"], round(r["prob"], 6), r["told"]) for r in langid.identified(df.filter("doc_id % 50 = 0"), model).collect()}
    monkeypatch.setattr(langid, "BLOCK", 4000)
    one = {r["doc_id"]: (r["lang"], round(r["prob"], 6), r["told"]) for r in langid.identified(df.filter("doc_id % 50 = 0"), model).collect()}
    assert several == one and all(a == c for a, _, c in one.values())
    right = {r["lang"]: (r["n"], r["right"]) for r in langid.accuracy(df.withColumnRenamed("told", "lang").limit(20), model).collect()}
    assert all(v == (1, 1) for v in right.values())


@pytest.mark.parametrize("file, end", [("byte_bpe_50k.json", 50256), ("piece_bpe_32k.model", 2), ("byte_bpe_50k.tiktoken", None)])
def test_tokenizer_files(spark, file, end):
    path = f"/opt/tokenizers/{file}"
    tokenizer = FileTokenizer(path, end)
    texts = ["one two three", "", None, "naïve ☃ text", "more words to fill some blocks of the table"]
    encode = _encoder(path, None)[0]
    ids = [encode([t])[0] + ([end] if end is not None else []) for t in texts if t]
    stream = [x for part in ids for x in part]
    want = [(i // 4, stream[i : i + 4]) for i in range(0, len(stream) - 3, 4)]
    assert sorted((r["block"], r["tokens"]) for r in tokens.packed(spark, docs(spark, texts), 4, tokenizer=tokenizer).collect()) == want
    assert tokens.token_total(docs(spark, texts), tokenizer) == len(stream)
    f = tokens.fertility(docs(spark, texts), tokenizer).first()
    assert (f["n_tokens"], f["n_words"]) == (len(stream) - (end is not None) * 3, 15)
    base = tokenizer.vocabulary(spark)
    novel = tokens.novel_tokens(spark.createDataFrame([("zzqq", 7), ("qqzz", 9), ("e", 1)], "token string, id int"), base, 1)
    longer = tokens.extension(base, novel)
    assert [r[0] for r in novel.collect()] == ["zzqq"] and longer.count() == base.count() + 1
    assert longer.filter("token = 'zzqq'").first()["id"] == base.agg(F.max("id")).first()[0] + 1


@pytest.mark.parametrize("name", ["benchmark_choices", "vocabulary_extension", "hub_documents", "near_dedup_greedy", "moses_zip", "output_review_merge", "quality_reasons", "exact_dedup", "clean_data_card", "near_dup_pairs", "pair_dedup", "token_packing", "chrf", "license_resolution"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    want = con.execute(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, DATA).toPandas()[list(want.columns)]
    plain = lambda x: int(x) if isinstance(x, float) and x.is_integer() else x
    key = lambda df: sorted(repr([plain(x) for x in row]) for row in df.astype(object).where(df.notna(), None).values.tolist())
    assert key(got.round(6)) == key(want.round(6))


def test_texts_stay_where_they_are_read(spark):
    rows = [(i, GOOD[i % 2] if i % 5 else GOOD[0] + f" number {i} of them", "s", "en") for i in range(40)] + [(None, GOOD[0], "s", "en"), (41, "", "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    judged = clean.judged(docs)
    small, large = (clean.with_duplicates(spark, judged, most=m) for m in (100, 0))
    plan = small._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange" in x and "BroadcastExchange" not in x]
    assert not shuffles and "BroadcastHashJoin" in plan and "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    told = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["reason"] or "") for r in df.collect())
    seen, want = set(), []
    for i, t, _, _ in rows:
        fault = {r["text"]: r["reason"] for r in judged.filter(f"doc_id {'is null' if i is None else f'= {i}'}").select("text", "reason").collect()}
        why = next(iter(fault.values())) or ("duplicate" if t in seen or i is None else "")
        seen.add(t)
        want.append((i is None, i or 0, why))
    assert told(small) == told(large) == sorted(want)


@pytest.mark.parametrize("few", [0, 2, 32])
def test_prefix_join_loses_no_pair(spark, monkeypatch, few):
    monkeypatch.setattr(prefix, "FEW", few)
    rng = random.Random(few)
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 40))] for _ in range(25)]
    sets = {i: sorted({w if rng.random() > 0.08 else f"x{rng.randrange(40)}" for w in base[i % 25]}) for i in range(150)}
    for least in (0.8, 0.85):
        df = clean.stored(spark, spark.createDataFrame(list(sets.items()), "doc_id long, ws array<string>"), "sets")
        got = {(r["a"], r["b"]): r["jaccard"] for r in similarity.linked(spark, df, least).collect()}
        want = {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for a, x in sets.items() for b, y in sets.items() if a < b}
        assert got == pytest.approx({k: v for k, v in want.items() if v >= least})


def test_a_family_of_one_template_is_not_paired(spark):
    """Texts of one template below the similarity: what meets grows as their number, not as its square."""
    met = []
    for n in (200, 400):
        rows = [(i, [f"t{k}" for k in range(84)] + [f"own{i}_{k}" for k in range(16)]) for i in range(n)]
        df = clean.stored(spark, spark.createDataFrame(rows, "doc_id long, ws array<string>"), "sets")
        words = df.select(F.col("doc_id").alias("v"), F.size("ws").alias("n"), F.posexplode(F.slice(F.reverse("ws"), 1, 21)).alias("i", "t"))
        met.append(prefix.pairs(spark, prefix.counted(words), 0.8).count())
        assert similarity.linked(spark, df, 0.8).count() == 0
    assert met == [0, 0]


def test_lsh_walks_equal_rounds(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(words[max(0, i - 9) : i + 9]) for i in range(30)] + [" ".join(rng.sample(words, 12)) for _ in range(20)] * 2
    df = docs(spark, texts)
    want = rows(similarity.lsh_drops(spark, df), "doc_id")
    members = {}
    for r in similarity.lsh_candidates(df).collect():
        members.setdefault(r["doc_id"], set()).add((r["band"], r["bucket"]))
    held, gone = set(), []
    for i in sorted(members):
        if held & members[i]:
            gone.append((i,))
        else:
            held |= members[i]
    assert want == gone
    for walked in (0, 30):
        assert rows(similarity.lsh_drops(spark, df, walked), "doc_id") == gone


def test_queries_without_sql_on_whole_tables(spark, tmp_path):
    """Language queries on what they didn't learn from, increments against one run, main texts row by row."""
    told = queries.language_accuracy(spark, "/root/testdata/sf0.01").collect()
    n, right = sum(r["n"] for r in told), sum(r["right"] for r in told)
    assert n > 150 and right / n > 0.97
    table_ = spark.read.parquet(f"{DATA}/documents.parquet")
    rows_ = {r["doc_id"]: r for r in queries.language_predict(spark, DATA).collect()}
    learnt = {r["doc_id"] for r in table_.filter(queries.LEARNT).select("doc_id").collect()}
    assert set(rows_) == {r["doc_id"] for r in table_.select("doc_id").collect()} and all(r["held_out"] == (i not in learnt) for i, r in rows_.items())
    for r in queries.language_filter_predicted(spark, DATA).collect():
        assert r["reason"] != "wrong_language" or r["lang"] not in ("", "en")
    four = {r["doc_id"]: r["why"] for r in queries.dedup_increments(spark, DATA).collect()}
    one = {r["doc_id"]: r["why"] for r in DedupIndex(spark, str(tmp_path / "one")).add(table_.select("doc_id", "text"), "all").collect()}
    assert four == one and {None, "duplicate"} <= set(one.values())
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    assert {r["page_id"]: r["text"] for r in queries.html_main_text(spark, DATA).collect()} == {k: files.main_text(v) for k, v in pages.items()}
    assert all(t.strip() == t and "<p>" not in t for t in map(files.main_text, pages.values()))
