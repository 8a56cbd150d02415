"""SentencePiece encoding and decoding by a max-plus scan (operator 2), and token counts by a trie (4).

Counts: distinct pre-tokens (segments that no piece crosses) are inserted in a trie, the recurrence
runs once for each shared prefix, and the terminal nodes hold the counts that texts add up.

Encoding: texts up to ``giant`` characters are one chunk. Longer ones are cut in chunks that spread
over tasks. Each chunk, knowing only a little text before it, yields a sparse max-plus matrix from the
states (overhang, last piece) at its left cut to those at its right cut; the matrices of a text are
multiplied pairwise in a tree, down which the best state at each cut is then fixed, and every chunk is
backtraced on its own. A text's matrices (one for GIANT_CHARS characters) meet in one task.
Results equal those of the sentencepiece library for the same model.

Cases: a null text has null ids and no tokens; an empty one has an empty list; repeated rows are
encoded each; texts that hold U+2581 decode with blanks in its place, so their round_trip is false;
only doc_id and text are read.
"""

from __future__ import annotations

import pickle
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import bounded_batches, stored
from weft.llm.pieces import FREE, SPACE_MARK, PieceModel, encoder, joints, ragged, solve, walk
from weft.llm.textbatch import lean

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SLICE_CHARS = 1_000_000
GIANT_CHARS = 65_536
MIDDLE = ("middle", 0)
_tags = count()


def load(path: str = MODEL_PATH) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel(f.read())


def _share(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(load(path)), next(_tags)


def _slices(texts: list[str | None], most: int = SLICE_CHARS):
    row = 0
    while row < len(texts):
        to, chars = row, 0
        while to < len(texts) and (to == row or chars + len(texts[to] or "") <= most):
            chars += len(texts[to] or "")
            to += 1
        yield row, to
        row = to


def _parts(model: PieceModel, s: str, most: int) -> list[str]:
    """Symbols in parts of about ``most``, cut only where no piece crosses."""
    out, at = [], 0
    while len(s) - at > most:
        cut = at + most
        while cut < len(s):
            codes = np.frombuffer(s[cut - 1 : cut + 1024].encode("utf-32-le"), np.uint32)
            # nor between unknown characters, which may be one id
            free = np.flatnonzero(joints(model, codes) & (model.fallback | ~(model.lonely[codes[1:]] & model.lonely[codes[:-1]])))
            if len(free):
                cut += int(free[0])
                break
            cut = min(cut + 1023, len(s))
        out.append(s[at:cut])
        at = cut
    return [*out, s[at:]]


def token_counts(spark: SparkSession, docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of every row."""
    bounded_batches(spark)
    shared, tag = _share(spark, model_path)

    @lean
    def run(batches):
        model = shared.value
        enc = encoder(model, tag)
        for b in batches:
            texts = b.column(1).to_pylist()
            tokens, segments = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for row, to in _slices(texts):
                if to == row + 1 and len(texts[row] or "") > SLICE_CHARS:
                    for part in _parts(model, model.symbols(texts[row]), SLICE_CHARS):
                        n, s = enc.counts([part])
                        tokens[row] += n[0]
                        segments[row] += s[0]
                else:
                    tokens[row:to], segments[row:to] = enc.counts([model.symbols(t or "") for t in texts[row:to]])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(segments), pa.array(tokens)], ["doc_id", "n_pretokens", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_pretokens long, n_tokens long")


def _decoder(model: PieceModel):
    """Piece bytes side by side, for decoding many ids at once."""
    data = np.frombuffer(b"".join(model.decoded), np.uint8)
    size = np.array([len(x) for x in model.decoded], np.int64)
    start = np.append(0, np.cumsum(size))[:-1]

    def decode(ids: np.ndarray, offs: np.ndarray) -> list[bytes]:
        sizes = size[ids]
        raw = data[ragged(start[ids], sizes)].tobytes()
        at = np.append(0, np.cumsum(sizes))[offs].tolist()
        return [raw[a:z] for a, z in zip(at, at[1:])]

    return decode


def _strip(model: PieceModel, raw: bytes, first: int | None) -> bytes:
    """``raw`` without the blank that was put before the text."""
    return raw[1:] if model.dummy and raw[:1] == b" " and first != model.unk else raw


def _firsts(ids: np.ndarray, offs: np.ndarray) -> list[int | None]:
    return [int(ids[a]) if z > a else None for a, z in zip(offs[:-1].tolist(), offs[1:].tolist())]


def decoded(spark: SparkSession, encoded: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id and text of rows with doc_id and token_ids; null ids give a null text."""
    shared, _ = _share(spark, model_path)

    @lean
    def run(batches):
        decode = _decoder(shared.value)
        for b in batches:
            lists = b.column(1)
            ids = lists.flatten().to_numpy()
            offs = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))).astype(np.int64)
            texts = [_strip(shared.value, x, k).decode("utf-8", "replace") if v else None for x, k, v in zip(decode(ids, offs), _firsts(ids, offs), lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "token_ids").mapInArrow(run, f"doc_id {kind}, text string")


def states(model: PieceModel, s: str, cut: int) -> list[tuple[int, int]]:
    """States (overhang, last piece) that a path may have at a place inside s, going by the text before it."""
    free = joints(model, np.frombuffer(s.encode("utf-32-le"), np.uint32)) if len(s) > 1 else np.zeros(0, bool)
    out = []
    for over in range(min(model.longest, cut + 1)):
        q = cut - over
        if q == 0 or q == len(s) or free[q - 1]:
            out.append((over, FREE))
            break
        if model.kind == "unigram":
            out.append((over, FREE))
        else:
            out += [(over, t) for k in range(1, min(model.longest, q) + 1) if (t := model.ids.get(s[q - k : q])) is not None and model.whole[t]]
    return out


def _frame(model: PieceModel, before: str, body: str, after: str):
    """The text of a chunk with what stands before it, its cut, and its first and last free place.

    ``after`` is the next character (none at the end), which tells whether the right cut is free.
    """
    s, cut, final = before + body, len(before), not after
    codes = np.frombuffer((s + after).encode("utf-32-le"), np.uint32)
    free = np.flatnonzero(joints(model, codes)) + 1 if len(codes) > 1 else np.zeros(0, int)
    places = [int(x) for x in free if x >= cut]
    if not before:
        places = [0, *places]
    if final:
        places.append(len(s))
    return s, cut, (places[0], places[-1]) if places else None


def _exits(model: PieceModel, best: list, n: int, final: bool) -> list[tuple[tuple[int, int], float]]:
    if final:
        return [((0, FREE), best[n][0])] if best[n] else []
    return [((n - at, best[at][1] if model.kind == "bpe" else FREE), best[at][0]) for at in range(max(0, n - model.longest + 1), n + 1) if best[at]]


def transfer(model: PieceModel, before: str, body: str, after: str) -> list[tuple]:
    """The chunk's matrix as (from state, to state, weight); with free places, the product through MIDDLE."""
    s, cut, places = _frame(model, before, body, after)
    final = not after
    into = states(model, s[: cut + 1], cut) if before else [(0, FREE)]
    rows, seen = [], []
    for over, last in into:
        at = cut - over
        best = solve(model, s[: places[0]] if places else s, at, last, tuple(seen))
        seen.append(best)
        if not places:
            rows += [((over, last), to, w) for to, w in _exits(model, best, len(s), final)]
        elif best[places[0]]:
            rows.append(((over, last), MIDDLE, best[places[0]][0]))
    if places:
        rows += [(MIDDLE, to, w) for to, w in _exits(model, solve(model, s[places[1] :]), len(s) - places[1], final)]
    return rows


def _times(a: dict, b: dict) -> dict:
    """Max-plus product of two sparse matrices {from: {to: (weight, ...)}}, with the best state between them."""
    out: dict = {}
    for x, row in a.items():
        mine = out.setdefault(x, {})
        for m, (w, *_) in row.items():
            for z, (v, *_) in b.get(m, {}).items():
                if z not in mine or w + v > mine[z][0]:
                    mine[z] = (w + v, m)
    return out


def combine(matrices: list[list[tuple]]) -> list[tuple[tuple, tuple]]:
    """(state at the left cut, state at the right cut) of each chunk on the best path of the whole text.

    Products are associative, so they form a tree: up it, neighbours are multiplied; down it, the states at
    both ends of a product give the state between its factors.
    """
    factors, owner = [], []
    for k, rows in enumerate(matrices):
        inner = [r for r in rows if r[1] == MIDDLE]
        for group in ([inner, [r for r in rows if r[0] == MIDDLE]] if inner else [rows]):
            factor: dict = {}
            for x, z, w in group:
                if z not in factor.setdefault(x, {}) or w > factor[x][z][0]:
                    factor[x][z] = (w,)
            factors.append(factor)
            owner.append(k)
    levels = [factors]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_times(last[i], last[i + 1]) if i + 1 < len(last) else last[i] for i in range(0, len(last), 2)])
    ends = [((0, FREE), (0, FREE))]
    for level, below in zip(reversed(levels), [*reversed(levels[:-1])]):
        split = []
        for i, (x, z) in enumerate(ends):
            m = level[i][x][z][1] if 2 * i + 1 < len(below) else None
            split += [(x, z)] if m is None else [(x, m), (m, z)]
        ends = split
    out: list[list] = []
    for k, (x, z) in zip(owner, ends):
        if len(out) > k:
            out[k][1] = z
        else:
            out.append([x, z])
    return [tuple(x) for x in out]


def backtrace(model: PieceModel, enc, before: str, body: str, after: str, into: tuple, to: tuple) -> tuple[np.ndarray, str]:
    """Pieces of a chunk between its two states, and the symbols they stand for."""
    s, cut, places = _frame(model, before, body, after)
    at, end = cut - into[0], len(s) - to[0]
    if not places:
        return np.array(walk(model, s, solve(model, s, at, into[1]), at, end), np.int32), s[at:end]
    head = walk(model, s, solve(model, s[: places[0]], at, into[1]), at, places[0])
    inner = [enc.encode([x])[0] for x in _parts(model, s[places[0] : places[1]], SLICE_CHARS)]
    tail = walk(model, s[places[1] :], solve(model, s[places[1] :]), 0, end - places[1])
    return np.concatenate([np.array(head, np.int32), *inner, np.array(tail, np.int32)]), s[at:end]


def _plain(symbols: str) -> bytes:
    return symbols.replace(SPACE_MARK, " ").encode()


def encoded(spark: SparkSession, docs: DataFrame, model_path: str = MODEL_PATH, giant: int = GIANT_CHARS) -> DataFrame:
    """doc_id, n_tokens, token_ids and round_trip (decoding gives the text again) of every row."""
    bounded_batches(spark)
    shared, tag = _share(spark, model_path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens long, token_ids array<int>, round_trip boolean"

    @lean
    def whole(batches):
        model = shared.value
        enc, decode = encoder(model, tag), _decoder(model)
        for b in batches:
            texts = b.column(1).to_pylist()
            for row, to in _slices(texts):
                marked = [model.symbols(t or "") for t in texts[row:to]]
                ids, offs = enc.encode(marked)
                good = [None if t is None else _strip(model, x, k) == t.encode() for t, x, k in zip(texts[row:to], decode(ids, offs), _firsts(ids, offs))]
                lists = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids), mask=pa.array([t is None for t in texts[row:to]]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, to - row), pa.array(np.diff(offs)), lists, pa.array(good, pa.bool_())], ["doc_id", "n_tokens", "token_ids", "round_trip"])

    docs = docs.select("doc_id", "text")
    large = F.length("text") > giant
    small = docs.filter(~F.coalesce(large, F.lit(False))).mapInArrow(whole, out)

    @lean
    def cut(batches):
        model = shared.value
        for b in batches:
            for key, doc, text, has_mark in zip(*(c.to_pylist() for c in b.columns)):
                s, around = model.symbols(text), 2 * model.longest
                n = -(-len(s) // giant)
                for k in range(n):
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((key, pa.int64()), (doc, b.schema.field("doc_id").type), (k, pa.int64()), (has_mark, pa.bool_()), (s[max(0, k * giant - around) : k * giant], pa.string()), (s[k * giant : (k + 1) * giant], pa.string()), (s[(k + 1) * giant : (k + 1) * giant + 1], pa.string()))], ["key", "doc_id", "k", "marked", "before", "body", "after"])

    marked = F.contains("text", F.lit(SPACE_MARK))
    numbered = docs.filter(large).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text", marked.alias("marked"))
    chunks = numbered.mapInArrow(cut, f"key long, doc_id {kind}, k long, marked boolean, before string, body string, after string")
    chunks = stored(spark, chunks.repartition("key", "k"), "chunks")

    @lean
    def matrix(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("before", "body", "after")))
            packed = [pickle.dumps(transfer(shared.value, *r)) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("k"), pa.array(packed, pa.binary())], ["key", "k", "m"])

    def product(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        ways = combine([pickle.loads(m) for m in group["m"]])
        return pd.DataFrame({"key": group["key"].to_numpy(), "k": group["k"].to_numpy(), "way": [pickle.dumps(w) for w in ways]})

    ways = chunks.mapInArrow(matrix, "key long, k long, m binary").groupBy("key").applyInPandas(product, "key long, k long, way binary")
    ways = stored(spark, ways, "ways")

    @lean
    def trace(batches):
        model = shared.value
        enc, decode = encoder(model, tag), _decoder(model)
        for b in batches:
            ids, good = [], []
            for has_mark, before, body, after, way in zip(*(b.column(c).to_pylist() for c in ("marked", "before", "body", "after", "way"))):
                got, symbols = backtrace(model, enc, before, body, after, *pickle.loads(way))
                ids.append(got)
                good.append(decode(got, np.array([0, len(got)]))[0] == _plain(symbols) and not has_mark)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("doc_id"), b.column("k"), pa.array(ids, pa.list_(pa.int32())), pa.array(good)], ["key", "doc_id", "k", "ids", "good"])

    traced = chunks.join(ways.hint("merge"), ["key", "k"]).select("key", "doc_id", "k", "marked", "before", "body", "after", "way").mapInArrow(trace, f"key long, doc_id {kind}, k long, ids array<int>, good boolean")
    parts = F.sort_array(F.collect_list(F.struct("k", "ids")))
    joined = traced.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.flatten(F.transform(parts, lambda x: x["ids"])).alias("token_ids"), F.bool_and("good").alias("good"))
    model = shared.value
    if not model.fallback:
        # a run of unknown characters may go over a cut
        again = lambda x, i: (x == model.unk) & (i > 0) & (F.get("token_ids", i - 1) == model.unk)
        joined = joined.withColumn("token_ids", F.filter("token_ids", lambda x, i: ~F.coalesce(again(x, i), F.lit(False))))
    long = joined.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", F.col("good").alias("round_trip"))
    return small.unionByName(long)
