"""The ten operators against brute force, exact round trips and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weft.llm import ann, linededup, lm, mixing, neardup, quality, queries, tokens, toxicity, warc
from weft.llm.common import OWN

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, **extra):
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, EMPTY)


ODD = ["", None, " \t\n", "a", "one two three", "x" * 20000, "naïve ☃ 日本語 text with marks " * 30, "line one\nline two\nline three\n\nline one\nline two\nline three", "word " * 5000]


def test_mixing_stays_within_a_block(spark):
    sizes = {"a": 400, "b": 70, "c": 130, None: 16}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"a": 0.5, "b": 0.2, "c": 0.25, None: 0.05}
    got = mixing.scheduled(spark, df, weights=weights, block_rows=4).toPandas()
    assert len(got) == len(rows) and got[OWN + "position"].is_unique
    blocks = got.groupby(["source", OWN + "block"], dropna=False)[OWN + "slot"].agg(["nunique", "first", "count"])
    assert (blocks["nunique"] == 1).all() and blocks["first"].is_unique
    slots = blocks["first"].reset_index().sort_values("first")
    ends = min(len(slots[slots["source"].isna() if s is None else slots["source"] == s]) / weights[s] for s in sizes)
    seen = Counter()
    for t, s in enumerate(slots["source"].where(slots["source"].notna(), None)[: int(ends) - 1], 1):
        seen[s] += 1
        assert all(abs(seen[k] - t * w) < 1 for k, w in weights.items())


def test_blocks_meet_deadlines():
    for w in ({"a": 1}, {"a": 3, "b": 5, "c": 7}, {"a": 1, "b": 998, "c": 1}):
        total = sum(w.values())
        got = mixing.placed_blocks(w, w)
        assert sorted(x for s in got.values() for x in s) == list(range(total))
        assert all(k * total // w[s] <= x < -(-(k + 1) * total // w[s]) for s in w for k, x in enumerate(got[s]))


def test_mixing_follows_the_ideal_mix_when_sources_end():
    rng = random.Random(3)
    for _ in range(40):
        targets = {s: rng.choice([1, 2, 7, 1 / 3, rng.random(), 1e-3]) for s in range(rng.randint(1, 9))}
        blocks = {s: rng.randint(1, 60) for s in targets}
        got = mixing.placed_blocks(blocks, mixing.integer_weights(targets))
        order = sorted((x, s) for s, mine in got.items() for x in mine)
        assert [x for x, _ in order] == list(range(sum(blocks.values()))) and all(len(got[s]) == blocks[s] for s in blocks)
        # the ideal mix, slot by slot: each slot is shared by the sources that are left, by weight
        ideal, seen = dict.fromkeys(targets, Fraction(0)), Counter()
        for _, s in order:
            seen[s] += 1
            time = Fraction(1)
            while time:
                left = {x for x in targets if ideal[x] < blocks[x]}
                total = sum(Fraction(targets[x]) for x in left)
                step = min([time, *((blocks[x] - ideal[x]) * total / Fraction(targets[x]) for x in left)])
                for x in left:
                    ideal[x] += step * Fraction(targets[x]) / total
                time -= step
            assert all(abs(seen[x] - ideal[x]) < 1 for x in targets)


def test_mixing_takes_very_many_sources(spark):
    blocks = {s: 1 + s % 3 for s in range(100_000)}
    slots = mixing.placed_blocks(blocks, mixing.integer_weights({s: float(1 + s % 977) ** 0.5 for s in blocks}))
    assert sorted(x for mine in slots.values() for x in mine) == list(range(sum(blocks.values())))
    df = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("host"), F.col("id") % 20_000).alias("source"))
    got = mixing.scheduled(spark, df).agg(F.count_distinct(OWN + "position"), F.count("*")).first()
    assert tuple(got) == (40_000, 40_000)


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL_PATH)


@pytest.mark.parametrize("giant", [41, 300, tokens.GIANT_CHARS])
def test_encoding_equals_the_library(spark, library, giant):
    rng = random.Random(giant)
    texts = ODD + ["a" * 400, " " * 90 + "x", "".join(rng.choice("abcdefghiotnrse") for _ in range(900)), "".join(rng.choice("ab cdefgh iotn\n日é") for _ in range(900))]
    got = {r["doc_id"]: r for r in tokens.encoded(spark, frame(spark, [t and t[:1500] for t in texts]), giant=giant).collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(spark, frame(spark, [t and t[:1500] for t in texts])).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else library.encode(t[:1500])
        assert got[i]["token_ids"] == want and counts[i] == len(want or [])
        assert got[i]["round_trip"] is (None if t is None else True)
    back = tokens.decoded(spark, tokens.encoded(spark, frame(spark, ["a  b", "", None]))).toPandas()
    assert sorted(back["text"].where(back["text"].notna(), "NULL")) == ["", "NULL", "a  b"]
    whole = {r["doc_id"]: r["token_ids"] for r in tokens.encoded(spark, frame(spark, texts)).collect()}
    assert whole == {i: None if t is None else library.encode(t) for i, t in enumerate(texts)}


@pytest.fixture(scope="module", params=["unigram", "unigram with bytes", "bpe"])
def made_model(request, tmp_path_factory):
    """A small model written down piece by piece (nothing is trained), and the library's reading of it."""
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as proto

    rng = random.Random(request.param)
    m = proto.ModelProto()
    add = lambda piece, score, kind: m.pieces.add(piece=piece, score=score, type=kind)
    for piece, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        add(piece, 0.0, kind)
    if "bytes" in request.param:
        for i in range(256):
            add(f"<0x{i:02X}>", 0.0, 6)
    singles = list("▁abcdefgh")
    if request.param == "bpe":
        merges = ["ab", "▁a", "cd", "▁ab", "abc", "abcd", "ef", "▁ef", "efg", "gh", "▁▁"]
        for i, piece in enumerate([*merges, *singles]):
            add(piece, -float(i), 1)
    else:
        for piece in [*singles, *{"".join(rng.choice("▁abcdefghx") for _ in range(rng.randint(2, 5))) for _ in range(120)}]:
            add(piece, -rng.uniform(1, 14), 1)
    m.trainer_spec.model_type = 2 if request.param == "bpe" else 1
    m.trainer_spec.byte_fallback = "bytes" in request.param
    m.trainer_spec.vocab_size = len(m.pieces)
    m.normalizer_spec.name = "identity"
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = True, False, True
    path = tmp_path_factory.mktemp("model") / "made.model"
    path.write_bytes(m.SerializeToString())
    return str(path), sentencepiece.SentencePieceProcessor(model_file=str(path))


@pytest.mark.parametrize("giant", [37, tokens.GIANT_CHARS])
def test_made_models_equal_the_library(spark, made_model, giant):
    path, library = made_model
    rng = random.Random(giant)
    texts = ["", "zzz abc  d", "zzz", " z z zz", "abcdefgh" * 40, "x" * 90, "axb xx☃☃日a", "☃" * 200, None]
    texts += ["".join(rng.choice("abcdefgh  xz☃") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r for r in tokens.encoded(spark, docs, path, giant).collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(spark, docs, path).collect()}
    back = {r["doc_id"]: r["text"] for r in tokens.decoded(spark, tokens.encoded(spark, docs, path, giant), path).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else library.encode(t)
        assert got[i]["token_ids"] == want and counts[i] == len(want or []), t
        assert back[i] == (None if t is None else library.decode(want)) and got[i]["round_trip"] == (None if t is None else back[i] == t)


def test_very_long_texts_equal_the_library(spark, library):
    rng = random.Random(9)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    texts = [" ".join(rng.choice(words) for _ in range(60_000)), "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(70_000)), "é日" * 40_000]
    assert min(map(len, texts)) > tokens.GIANT_CHARS
    for r in tokens.encoded(spark, frame(spark, texts)).collect():
        assert r["token_ids"] == library.encode(texts[r["doc_id"]]) and r["round_trip"]


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/ b", "y" * 2000), (2, None, "y" * 2000), (3, "u", None), (4, "u", "z"), (5, "u", "z"), (6, "http://x", "y" * 2000)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc.round_trip(spark, pages).collect()}
    assert [got[i]["record_type"] for i in range(1, 7)] == ["revisit", "revisit", "response", "response", "response", "response"]
    assert got[1]["refers_to"] == 6 and got[1]["payload_bytes"] == 2000 and got[3]["payload_bytes"] == 0


def test_warc_ranges_own_each_record_once(spark, tmp_path):
    data = b"".join(warc.record_bytes(i, "u", (b"\x1f\x8b\x08" + bytes([i])) * 50, hashlib.sha1((b"\x1f\x8b\x08" + bytes([i])) * 50).hexdigest()) for i in range(40))
    (tmp_path / "x.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(f"file://{tmp_path}/x.warc.gz", len(data))], "path string, bytes long")
    for split in (97, 1000, 1 << 20):
        ids = sorted(warc.page_of(r["record_id"]) for r in warc.read(spark, files, split).collect())
        assert ids == list(range(40))


def foreign(kind, block, **headers):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{kind}>", f"Content-Length: {len(block)}", *(f"{k.replace('_', '-')}: {v}" for k, v in headers.items())]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_warc_of_other_writers(spark, tmp_path):
    http, body = "application/http; msgtype=response", b"hello chunked world"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nX-Long: a\r\n b\r\n\r\n5\r\nhello\r\ne;x=1\r\n chunked world\r\n0\r\n\r\n"
    sha = hashlib.sha1(body).hexdigest()
    decoys = b"".join(warc.record_bytes(i, "u", b"nested", hashlib.sha1(b"nested").hexdigest()) for i in range(200))
    plain = b"HTTP/1.1 200 OK\r\nContent-Type: application/gzip\r\n\r\n" + decoys
    records = [
        (foreign("warcinfo", b"software: x\r\nformat: WARC", Content_Type="application/warc-fields"), None, len(b"software: x\r\nformat: WARC")),
        (foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", Content_Type="application/http; msgtype=request", WARC_Target_URI="http://a/"), None, 0),
        (foreign("response", chunked, Content_Type=http, WARC_Payload_Digest=f"sha1:{sha}"), None, len(body)),
        (foreign("metadata", b"fetchTimeMs: 1", WARC_Target_URI="http://a/\r\n  folded"), None, 14),
        (foreign("conversion", b"text of a page", WARC_Payload_Digest="sha256:00"), None, 14),
        (foreign("resource", b"bytes", WARC_Payload_Digest="sha1:" + "A" * 32), "digest differs", 5),
        (foreign("response", plain, Content_Type=http), None, len(decoys)),
        (foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", Content_Type=http, WARC_Refers_To="<urn:uuid:x>"), None, None),
        (foreign("response", b"HTTP/1.1 200 OK\r\n\r\n" + b"z" * 500, Content_Type=http), "truncated", None),
    ]
    parts = []
    for i, (r, _, _) in enumerate(records):
        # stored as it is where the payload is an archive, so its members stand in the file as they are
        packer = zlib.compressobj(0 if i == 6 else 6, zlib.DEFLATED, 31)
        parts.append(packer.compress(r) + packer.flush())
    parts[-1] = parts[-1][:-9]
    data = b"".join(parts)
    assert data.count(b"\x1f\x8b\x08") > 150
    (tmp_path / "x.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(f"file://{tmp_path}/x.warc.gz", len(data))], "path string, bytes long")
    starts = np.append(0, np.cumsum([len(x) for x in parts]))[:-1].tolist()
    for split in (333, 5_000, 1 << 20):
        got = sorted(warc.read(spark, files, split).collect(), key=lambda r: r["offset"])
        assert [(r["offset"], r["problem"], r["payload_bytes"]) for r in got] == [(at, p, n) for at, (_, p, n) in zip(starts, records)]
    assert got[2]["payload"] == body and got[2]["payload_digest"] == sha and got[3]["target_uri"] == "http://a/ folded" and got[7]["refers_to"] == "<urn:uuid:x>"


def test_warc_without_a_broadcast(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "u", f"{i % 3}" * 2000) for i in range(12)], "page_id long, url string, html string")
    want = sorted(warc.round_trip(spark, pages).collect())
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert sorted(warc.round_trip(spark, pages).select(warc.round_trip(spark, pages).columns).collect(), key=str) == sorted(want, key=str)


def true_classes(docs):
    sets, first, by_text = {}, {}, {}
    for i, t in sorted((r["doc_id"], r["text"]) for r in docs if r["text"] is not None):
        by_text.setdefault(t, i)
        w = WORD.findall(t)
        sets[by_text[t]] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
        first[i] = by_text[t]
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: find(f) for i, f in first.items()}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [" ".join(w if rng.random() > p else "new" + str(rng.random()) for w in base) for p in [0] + [0.01] * 12 + [0.02] * 12 + [0.05] * 12]
    texts += [t for t in ODD if t is not None] + ["", "one two three", None, None]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark, docs).collect()}
    want = true_classes(docs.collect()) | {i: i for i, t in enumerate(texts) if t is None}
    assert got == want
    real = spark.read.parquet(f"{DATA}/documents.parquet")
    assert {r["doc_id"]: r["class_id"] for r in neardup.classes(spark, real).collect()} == true_classes(real.collect())
    assert neardup.keep_one(spark, docs).count() == len(set(want.values()))


def test_probminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    a, w = rng.integers(1, 2**63, 400).astype(np.uint64), np.ones(400)
    keys, text = np.concatenate([a[:300], a[100:]]), np.repeat([0, 1], 300)
    s = neardup.signatures(keys, np.concatenate([w[:300], w[100:]]), text, 2)
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.17


def counts_of(text):
    words = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    many = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if many[x] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_quality(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(frame(spark, ODD).withColumn("doc_id", F.col("doc_id") + 10**6))
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.assess(spark, docs, labels).collect()}
    for r in docs.collect():
        want, mine = counts_of(r["text"]), got[r["doc_id"]]
        assert tuple(mine[c] for c in quality.COUNTS) == want
        assert mine["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (mine["kept"] and mine["base_failed"])
    assert quality.assess(spark, docs.limit(0), labels.limit(0)).count() == 0


def test_trees_are_monotonic():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 2))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + 0.2 * rng.random(3000)) < 0.6).astype(float)
    t = quality.fit(x, y, [-1, 0])
    grid = np.stack([np.linspace(0, 1, 200), np.full(200, 0.5)], 1)
    assert (np.diff(t.probability(grid)) <= 1e-12).all()
    assert ((t.probability(x) > 0.5) == y).mean() > 0.85


def test_language_model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(frame(spark, ODD).withColumn("doc_id", F.col("doc_id") + 10**6)).cache()
    low = lambda t: (t or "").translate({i: i + 32 for i in range(65, 91)})
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    rows = docs.collect()
    c = Counter(w for r in rows if not held(r["doc_id"]) for w in [*WORD.findall(low(r["text"])), None])
    total, distinct = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in lm.score(spark, docs, most_words=50).collect()}
    for r in rows:
        w, mine = [*WORD.findall(low(r["text"])), None], got[r["doc_id"]]
        assert (mine["held_out"], mine["n_tokens"], mine["n_known"], mine["train_tokens"]) == (held(r["doc_id"]), len(w), sum(c[x] > 0 for x in w), total)
        assert mine["base_score"] == pytest.approx(sum(math.log10((c[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w))
        assert mine["score"] < 0


def plain_ppm(learnt, text, order):
    """log10 probability of a text by dictionaries of contexts, straight from the definition."""
    counts = {}
    for t in learnt:
        symbols = [257] * order + [*t, 256]
        for i in range(order, len(symbols)):
            for k in range(order + 1):
                counts.setdefault(tuple(symbols[i - k : i]), Counter())[symbols[i]] += 1
    symbols, total = [257] * order + [*text, 256], 0.0
    for i in range(order, len(symbols)):
        p, out = 1.0, set()
        for k in range(order, -1, -1):
            here = {s: n for s, n in counts.get(tuple(symbols[i - k : i]), {}).items()}
            left = sum(n for s, n in here.items() if s not in out)
            if symbols[i] in here:
                p *= (here[symbols[i]] - 0.5) / left
                break
            if fresh := set(here) - out:
                p *= 0.5 * len(fresh) / left
                out |= fresh
        else:
            p /= 257 - len(out)
        total += math.log10(p)
    return total


@pytest.mark.parametrize("order, group_bytes", [(2, 60), (lm.ORDER, 200), (lm.ORDER, lm.GROUP_BYTES)])
def test_ppm_equals_a_plain_one(spark, order, group_bytes):
    rng = random.Random(order)
    texts = ["abracadabra", "ABBA", "cab\n", "", None, "ünïcode ☃", "zz top"] + ["".join(rng.choice("ab cd") for _ in range(rng.randint(1, 90))) for _ in range(30)]
    docs = frame(spark, texts)
    low = [(t or "").translate({i: i + 32 for i in range(65, 91)}).encode() for t in texts]
    learnt = [t for i, t in enumerate(low) if zlib.crc32(str(i).encode()) % 5 != 1]
    got = {r["doc_id"]: r["score"] for r in lm.score(spark, docs.repartition(3), order=order, group_bytes=group_bytes).collect()}
    for i, t in enumerate(low):
        assert got[i] == pytest.approx(plain_ppm(learnt, t, order))


def test_ppm_sums_to_one():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 400).astype(np.uint8)
    codes, n = np.unique(lm.grams(lm.Texts(data, np.array([0, 150, 400])), 2)[0], return_counts=True)
    trie = lm.Trie([lm.Level(*lm.marginals(codes, n, k)) for k in range(3)])
    for context in ("ab", "ra", "zz", "bz"):
        a, b = context.encode()
        every = np.array([(a << 18) | (b << 9) | s for s in range(257)])
        assert (10 ** trie.log10(every)).sum() == pytest.approx(1)


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 12))
    x[700:900] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(10**6, None), (2 * 10**6, [0.0] * 12), (3 * 10**6, [float("nan")] * 12), (4 * 10**6, [1.0]), (None, [1.0] * 12)]
    got = ann.search(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    hits = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(1500), d))[:10]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert len(mine) == 10 and np.allclose(mine["score"], d[mine["vec_id"]])
        hits += len(set(want) & set(mine["vec_id"]))
    assert set(got["query_id"]) == set(range(0, 1500, 100)) and hits >= 0.9 * 150
    few = spark.createDataFrame([(100, [1.0, 2.0]), (7, [1.0, 2.5])], "vec_id long, embedding array<double>")
    assert [(r["query_id"], r["vec_id"], r["rank"]) for r in ann.search(spark, few).collect()] == [(100, 7, 1)]
    assert ann.search(spark, few.limit(0)).count() == 0


def test_segments_equal_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        s = [rng.choice([-3, -1, -0.5, 1, 2, 4]) for _ in range(rng.randint(1, 14))]
        total = np.append(0.0, np.cumsum(s))
        hot = [i for i, v in enumerate(s) if v > 0]
        got = toxicity.segments(total[hot], total[np.array(hot, int) + 1])

        def best(lo, hi):  # the maximal segments by the recursive definition: the best one, then both sides
            spans = [(total[b] - total[a], -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)]
            if not spans or max(spans)[0] <= 0:
                return []
            v, _, a, b = max(spans)
            return best(lo, a) + [v] + best(b, hi)

        assert max((g[0] for g in got), default=0) == pytest.approx(max(best(0, len(s)), default=0))
        assert sum(g[0] for g in got) == pytest.approx(sum(best(0, len(s))))


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"  # the smaller tables hold some thirty toxic labels
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score(spark, docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got["predicted"] == got["toxic"]).mean() > 0.95 and got["score"].between(0, 1).all()
    odd = toxicity.score(spark, frame(spark, ODD), labels.limit(0)).collect()
    assert len(odd) == len(ODD) and all(r["predicted"] == 0 for r in odd)


def test_line_dedup(spark):
    block = "alpha one\nbeta two\ngamma three"
    texts = [block + "\ndelta", "start\n" + block + "\n\nend", "x\nx\nx\nx", "a\n" + "alpha one\nbeta two", None, "", block]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark, frame(spark, texts)).collect()}
    assert got == {0: texts[0], 1: "start\n\nend", 2: "x", 3: texts[3], 4: None, 5: "", 6: ""}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{DATA}/documents.parquet')")
    want = sorted(con.execute(queries.OP10_SQL).fetchall())
    assert sorted(tuple(r) for r in queries.op10_line_dedup(spark, DATA).select("doc_id", "text", "removed_lines").collect()) == want


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, DATA).collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "sentencepiece"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert 0 < len(got) <= docs.count() and len({r["doc_id"] for r in got}) == len(got)
    extra = docs.withColumn("n", F.lit(1)).withColumn("c", F.lit("x")).withColumn("key", F.lit(2))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, DATA)
        assert out.columns == extra.columns, name
        assert stage(spark, extra.limit(0), DATA).count() == 0


def test_language_model_keeps_every_count(spark):
    rng = random.Random(8)
    signs = "abcdefghijklmnopqrstuvwxyz0123456789!?.,;:()[]{}<>+-*/=_&%$#@~^"
    docs = frame(spark, ["".join(rng.choice(signs) for _ in range(20_000)) for _ in range(45)] + ODD).cache()
    coded = lambda t: lm.grams(lm.Texts(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())])).lowered(), lm.ORDER)[0]
    rows = docs.collect()
    codes, n = np.unique(np.concatenate([coded(r["text"]) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1]), return_counts=True)
    whole = lm.Trie([lm.Level(*lm.marginals(codes, n, k)) for k in range(lm.ORDER + 1)])
    assert sum(len(level.codes) for level in whole.levels) > 2_000_000
    got = {r["doc_id"]: r["score"] for r in lm.score(spark, docs, group_bytes=300_000).collect()}
    for r in rows:
        assert got[r["doc_id"]] == pytest.approx(whole.log10(coded(r["text"])).sum())


def test_mixing_holds_exact_targets():
    for targets, n in (({"a": 1 / 3, "b": 2 / 3}, 20_000), ({s: (10_000 / (s + 1)) ** 0.5 for s in range(20)}, 30_000), ({"a": 0.0001, "b": 0.9999}, 60_000), (dict.fromkeys(range(1500), 1.0) | {0: 700.5}, 6_000)):
        weights, total = mixing.integer_weights(targets), sum(targets.values())
        blocks = {s: int(n * x / total) + 1 for s, x in targets.items()}
        slots = mixing.placed_blocks(blocks, weights)
        first_end = min(blocks[s] * total / x for s, x in targets.items())
        for s, mine in slots.items():
            # just before and just after each block of the source, until a source is used up
            at = np.array([x for x in mine if x + 1 < first_end])
            k, share = np.arange(len(at)), targets[s] / total
            assert (np.abs(k - at * share) < 1 + 1e-6).all() and (np.abs(k + 1 - (at + 1) * share) < 1 + 1e-6).all()


def test_mixing_places_a_source_of_weight_zero_last():
    assert mixing.placed_blocks({"a": 3, "b": 2, "c": 1}, mixing.integer_weights({"a": 0.0, "b": 0.5, "c": 0.5})) == {"a": [3, 4, 5], "b": [0, 2], "c": [1]}


def test_pipeline_rows_follow_the_mix(spark):
    got = corpus_pipeline.run(spark, DATA).collect()
    kept = spark.read.parquet(f"{DATA}/documents.parquet").filter(F.col("doc_id").isin([r["doc_id"] for r in got]))
    want = mixing.scheduled(spark, kept).sort(OWN + "position").collect()
    assert [(r["doc_id"], r["source"], r["slot"], r["position"]) for r in got] == [(r["doc_id"], r["source"], r[OWN + "slot"], r[OWN + "position"]) for r in want]


def test_toxic_passages(spark):
    bad, fine = "vile scum filth rot", "a calm day by the green river with many quiet boats"
    docs = frame(spark, [f"{fine} {i} {bad} {bad} {i} {fine}" if i % 2 else f"{fine} {i} {fine}" for i in range(300)] + [f"é {fine} {bad} {' '.join([fine] * 9)} {bad} ü", fine])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    got = toxicity.passages(spark, docs, labels).collect()
    mine = sorted((r["start"], r["end"]) for r in got if r["doc_id"] == 300)
    assert [texts[300][a:z].decode() for a, z in mine] == [bad, bad]
    assert {r["doc_id"] for r in got} == {i for i in range(300) if i % 2} | {300}
    total = Counter()
    for r in got:
        assert r["significance"] > 0 and r["score"] > 0
        total[r["doc_id"]] += r["significance"]
    for r in toxicity.score(spark, docs, labels).collect():
        assert r["evidence"] == pytest.approx(total[r["doc_id"]])


def test_near_duplicates_with_a_repeated_line(spark):
    rng = random.Random(6)
    texts = []
    for i in range(12):
        rest = " ".join(f"r{i}x{rng.randrange(10**9)}" for _ in range(92))
        texts += [" ".join([f"a{i} b{i} c{i} d{i} e{i}"] * n + [rest]) for n in (2, 20, 50, 200)]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark, docs).collect()}
    assert got == {i: i - i % 4 for i in range(len(texts))} == true_classes(docs.collect())


def test_near_duplicates_along_a_path(spark):
    words = [f"p{k}" for k in range(1040)]
    docs = frame(spark, [" ".join(words[k : k + 40]) for k in range(1000)])
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark, docs).collect()}
    assert got == dict.fromkeys(range(1000), 0)


def test_neighbours_in_a_group_of_near_copies(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 24))
    x = centres[rng.integers(0, 60, 9000)] + 0.4 * rng.normal(size=(9000, 24))
    x[2000:5000] = x[0] + 0.01 * rng.normal(size=(3000, 24))
    x[5000:6000] = x[1]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(spark, df).toPandas()
    for lo, hi in ((2000, 5000), (0, 9000)):
        hits = total = 0
        for q in range(lo, hi, 100):
            d = np.sqrt(((x - x[q]) ** 2).sum(1))
            d[q] = np.inf
            want = np.sort(d)[:10]
            mine = got[got["query_id"] == q].sort_values("rank")
            assert len(mine) == 10 and np.allclose(mine["score"], d[mine["vec_id"]])
            hits += (mine["score"].to_numpy() <= want[-1] + 1e-12).sum()
            total += 10
        assert hits >= 0.95 * total
    # equal vectors: the smallest ids, without the query's own
    same = got[got["query_id"] == 5000].sort_values("rank")["vec_id"].tolist()
    assert same == [1, *range(5001, 5010)]


def plain_tokens(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode()
    return [(m.group().decode("utf-8", "replace"), m.start(), m.end()) for m in re.finditer(rb"[0-9a-z\x80-\xff]+", low)]


def plain_toxicity(rows, least_z=2.0, least_texts=4):
    """(odds by (kind, token), decay, K) of (text, toxic) rows, by dictionaries."""
    counts = {}
    for text, toxic in rows:
        seen = set()
        for word, _, _ in plain_tokens(text):
            for key in ((0, word), (1, word[: toxicity.STEM])):
                c = counts.setdefault(key, [0, 0, 0])
                c[0 if toxic else 1] += 1
                if toxic and key not in seen:
                    c[2] += 1
                    seen.add(key)
    n_toxic, n_clean = (sum(c[k] for key, c in counts.items() if key[0] == 0) for k in (0, 1))
    prior, odds, clean = 0.01 * n_toxic, {}, []
    for key, (t, c, texts) in counts.items():
        a = (t + c) * prior / (n_toxic + n_clean) + 0.01
        o = math.log((t + a) / (n_toxic + prior)) - math.log((c + a) / (n_clean + prior))
        if o / math.sqrt(1 / (t + a) + 1 / (c + a)) >= least_z and texts >= least_texts:
            odds[key] = o
            clean.append(c)
    steps = np.array([*odds.values(), 0.0]) - toxicity.DRIFT
    shares = np.array([c + 0.5 for c in clean] + [max(1.0, n_clean - sum(clean))])
    shares = shares / shares.sum()
    lo, hi = 0.0, 64.0
    while (shares * np.exp(np.minimum(hi * steps, 600))).sum() < 1 and hi < 64:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (shares * np.exp(np.minimum(mid * steps, 600))).sum() < 1 else (lo, mid)
    return odds, hi, steps, shares


def plain_evidence(text, odds, decay, factor):
    words = plain_tokens(text)
    s = [odds.get((0, w), 0) or odds.get((1, w[: toxicity.STEM]), 0) for w, _, _ in words]
    total = np.append(0.0, np.cumsum(np.array(s) - toxicity.DRIFT))

    def best(lo, hi):
        spans = [(total[b] - total[a], -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)]
        if not spans or max(spans)[0] <= 0:
            return []
        v, _, a, b = max(spans)
        return best(lo, a) + [v] + best(b, hi)

    chance = math.log(max(1.0, factor * len(s))) if s else 0.0
    return sum(decay * v - chance for v in best(0, len(s)) if decay * v > chance)


def test_toxicity_equals_brute_force(spark):
    rng = random.Random(11)
    bad, fine = ["vile", "scum", "filthy", "rotten", "füßen"], [f"w{k}" for k in range(60)] + ["ünder", "fine"]
    texts = []
    for i in range(260):
        words = [rng.choice(fine) for _ in range(rng.randint(3, 40))]
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(bad) + ("" if rng.random() < 0.7 else "er") for _ in range(rng.randint(1, 6))]
        texts.append(" ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words))
    texts += ["", None, "vile " * 30]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(260)], "doc_id long, quality int, toxic int")
    part = {i: zlib.crc32(str(i).encode()) % 5 for i in range(len(texts))}
    known = [i for i in range(260) if part[i]]
    fit = lambda some: plain_toxicity([(texts[i], i % 3 == 0) for i in some])
    odds, decay, steps, shares = fit(known)
    model = toxicity.train(spark, docs, labels, least_z=2.0)
    assert len(odds) > 3 and sorted(model.odds) == pytest.approx(sorted(odds.values())) and model.decay == pytest.approx(decay)
    factor = model.factor
    assert 0 < factor < 10
    outside = {}
    for k in range(1, 5):
        o, d, *_ = fit([i for i in known if part[i] != k])
        f = toxicity.fitted(spark.createDataFrame(*rates_of([(texts[i], i % 3 == 0) for i in known if part[i] != k])), 2.0, 4).factor
        outside |= {i: plain_evidence(texts[i], o, d, f) for i in known if part[i] == k}
    x, y = np.log1p(np.round([outside[i] for i in known], 2)), np.array([i % 3 == 0 for i in known], float)
    a, b = toxicity.logistic(x, y, np.ones(len(x)))
    for r in toxicity.score(spark, docs, labels, least_z=2.0).collect():
        want = plain_evidence(texts[r["doc_id"]], odds, decay, factor)
        assert r["evidence"] == pytest.approx(want, abs=1e-6)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(a + b * math.log1p(want)))), abs=2e-2)
    # K by definition: chances of the best of drawn sequences
    total = np.cumsum(steps[np.minimum(np.searchsorted(np.cumsum(shares), np.random.default_rng(1).random((32, 32768))), len(steps) - 1)], axis=1)
    top = np.array([max(0.0, (t - np.minimum.accumulate(np.append(0.0, t))[:-1]).max()) for t in total])
    assert factor == pytest.approx(32 / (32768 * np.exp(-decay * top).sum()), rel=0.6)


def rates_of(rows):
    counts = {}
    for text, toxic in rows:
        seen = set()
        for word, _, _ in plain_tokens(text):
            for key in ((0, word), (1, word[: toxicity.STEM])):
                c = counts.setdefault(key, [0, 0, 0])
                c[0 if toxic else 1] += 1
                if toxic and key not in seen:
                    c[2] += 1
                    seen.add(key)
    return [(k, hash(w), *c) for (k, w), c in counts.items()], "kind long, token long, toxic long, clean long, texts long"
