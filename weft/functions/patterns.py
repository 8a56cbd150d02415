"""Which of thousands of patterns a text contains: an Aho-Corasick automaton in numpy arrays over bytes.

Edges of the trie lie in one open hash table of (node, byte), with a failure link for each node, so memory follows the
bytes of the patterns (about 60 for each). Texts are cut into lanes that overlap by the longest pattern less one
byte, and one array step takes the next byte of all lanes at once. A column of patterns is broadcast as automata
of MOST_BYTES of patterns each; more of them are several passes, with the rows stored between, so a worker
never holds more than one.

Cases: null texts contain nothing; the empty pattern is in every text that isn't null, null patterns in none; equal
patterns are one; patterns and texts are compared byte by byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from weft.storage import stored

MOST_BYTES, LANE, AT_ONCE = 1 << 20, 2048, 2 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Automaton:
    """Built once from the distinct patterns, which are numbered in order of their bytes."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = sorted(set(patterns) - {b""})
        self.longest = max(map(len, self.patterns), default=0)
        data = np.frombuffer(b"".join(self.patterns), np.uint8)
        size = np.array([len(p) for p in self.patterns], np.int64)
        first = np.cumsum(size) - size
        # a pattern makes new nodes from where it leaves the one before it, as they are in order
        shared = np.array([0, *(_common(a, b) for a, b in zip(self.patterns, self.patterns[1:]))], np.int64)[: len(size)]
        fresh = np.zeros(len(data), bool)
        for a, b, c in zip(first, shared, size):
            fresh[a + b : a + c] = True
        new = np.cumsum(fresh)
        node = np.where(fresh, new, 0)
        # of the shared part, the nodes are those of the pattern before
        for k in range(1, len(size)):
            a, b = first[k], first[k - 1]
            node[a : a + shared[k]] = node[b : b + shared[k]]
        n = int(new[-1]) + 1 if len(data) else 1
        before = np.append(0, node[:-1])[: len(node)]
        before[first] = 0
        parent, byte, depth = (np.zeros(n, np.int64) for _ in range(3))
        place = np.arange(len(data)) - np.repeat(first, size)
        parent[node], byte[node], depth[node] = before, data, place + 1
        self.root = np.zeros(256, np.int64)
        self._edges(parent[1:], byte[1:], np.arange(1, n))
        ends = np.full(n, -1)
        ends[node[first + size - 1]] = np.arange(len(size))
        # failure links, level by level: those of parents are known
        self.fail, self.end, self.link = np.zeros(n, np.int64), ends, np.zeros(n, np.int64)
        order = np.argsort(depth, kind="stable")[1:]
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []:
            deep = level[depth[level] > 1]
            self.fail[deep] = self.step(self.fail[parent[deep]], byte[deep])
            # the nearest suffix, itself included, that is a pattern
            self.link[level] = np.where(ends[level] >= 0, level, self.link[self.fail[level]])

    def _edges(self, parent: np.ndarray, byte: np.ndarray, child: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(2 * len(child) + 1))))
        self.shift, self.keys, self.to = np.uint64(64 - bits), np.full(1 << bits, -1), np.zeros(1 << bits, np.int64)
        top = parent == 0
        self.root[byte[top]] = child[top]
        key, value = (parent * 256 + byte)[~top], child[~top]
        spot = self._spot(key)
        while len(key):
            free = self.keys[spot] < 0
            self.keys[spot[free]] = key[free]  # of several for one place the last stays
            won = self.keys[spot] == key
            self.to[spot[won]] = value[won]
            key, value, spot = key[~won], value[~won], (spot[~won] + 1) & (len(self.keys) - 1)

    def _spot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def _child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node, 0 if there is none; nodes other than the root."""
        key = node * 256 + byte
        spot, out = self._spot(key), np.zeros(len(node), np.int64)
        open_ = np.arange(len(node))
        while len(open_):
            held = self.keys[spot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.to[spot[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
            spot[open_] = (spot[open_] + 1) & (len(self.keys) - 1)
        return out

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        out, node = np.zeros(len(node), np.int64), node.copy()
        open_ = np.arange(len(node))
        while len(open_):
            at_root = node[open_] == 0
            out[open_[at_root]] = self.root[byte[open_[at_root]]]
            open_ = open_[~at_root]
            found = self._child(node[open_], byte[open_])
            out[open_[found > 0]] = found[found > 0]
            open_ = open_[found == 0]
            node[open_] = self.fail[node[open_]]
        return out

    def found(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, pattern) of all occurrences in texts side by side, in order."""
        none = np.zeros((0, 2), np.int64)
        if not self.longest or not len(data):
            return none[:, 0], none[:, 1]
        size = np.diff(offs)
        lanes = -(-size // LANE)
        text = np.repeat(np.arange(len(size)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        end = np.minimum(offs[text] + (nth + 1) * LANE, offs[text + 1])
        at = np.maximum(offs[text] + nth * LANE - (self.longest - 1), offs[text])
        order = np.argsort(at - end, kind="stable")
        text, at, long = text[order], at[order], (end - at)[order]
        node, seen = np.zeros(len(text), np.int64), [none]
        for k in range(int(long[0])):
            m = int(np.searchsorted(-long, -k, side="left"))
            node = self.step(node[:m], data[at[:m] + k].astype(np.int64))
            hit = np.flatnonzero(self.link[node])
            if len(hit):
                seen.append(np.stack([text[hit], self.link[node[hit]]], 1))
                if len(seen) > 4096:
                    seen = [np.unique(np.concatenate(seen), axis=0)]
        pairs = np.unique(np.concatenate(seen), axis=0)
        # shorter patterns end where longer ones do
        text, node, out = pairs[:, 0], pairs[:, 1], []
        while len(node):
            out.append(np.stack([text, self.end[node]], 1))
            node = self.link[self.fail[node]]
            text, node = text[node > 0], node[node > 0]
        pairs = np.unique(np.concatenate(out), axis=0) if out else none
        return pairs[:, 0], pairs[:, 1]


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(np.argmax(x))


def grouped(patterns: list[bytes], most: int) -> list[list[bytes]]:
    """The distinct patterns in lists of ``most`` bytes, or of one pattern each if it is longer."""
    out, held = [[]], 0
    for p in sorted(set(patterns)):
        if out[-1] and held + len(p) > most:
            out.append([])
            held = 0
        out[-1].append(p)
        held += len(p)
    return [g for g in out if g]


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def _pass(spark: SparkSession, rows: DataFrame, column: str, out: str, patterns: list[bytes], listed: bool) -> DataFrame:
    shared, at, had = spark.sparkContext.broadcast(Automaton(patterns)), rows.columns.index(column), rows.columns.index(out)

    def run(batches):
        machine = shared.value
        names = [p.decode() for p in machine.patterns]
        every = "" in [p.decode() for p in patterns]
        for b in batches:
            data, offs = _bytes(b.column(at))
            some: list[list[str]] = [[] for _ in range(b.num_rows)]
            row = 0
            while row < b.num_rows:
                to = max(row + 1, int(np.searchsorted(offs, offs[row] + AT_ONCE, side="right")) - 1)
                for t, p in zip(*machine.found(data[offs[row] : offs[to]], offs[row : to + 1] - offs[row])):
                    some[row + t].append(names[p])
                row = to
            real = b.column(at).is_valid().to_pylist()
            some = [[*([""] if every and r else []), *x] for x, r in zip(some, real)]
            before = b.column(had).to_pylist()
            new = pa.array([x + y for x, y in zip(before, some)], pa.list_(pa.string())) if listed else pa.array([x or bool(y) for x, y in zip(before, some)])
            yield pa.RecordBatch.from_arrays([new if i == had else c for i, c in enumerate(b.columns)], b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def containing(spark: SparkSession, rows: DataFrame, column: str, patterns: list[str | None], out: str, listed: bool = False, most: int = MOST_BYTES) -> DataFrame:
    """``rows`` with the column ``out``: whether the text contains any pattern, or with ``listed`` which ones, each once."""
    from pyspark.sql import functions as F

    parts = grouped([p.encode() for p in patterns if p is not None], most)
    kind = ArrayType(StringType()) if listed else BooleanType()
    start = F.array().cast(kind) if listed else F.lit(False)
    rows = rows.select("*", start.alias(out))
    rows = rows.to(StructType([StructField(f.name, f.dataType, True) for f in rows.schema.fields]))
    for i, part in enumerate(parts):
        rows = _pass(spark, rows if i == 0 else stored(spark, rows, "patterns"), column, out, part, listed)
    return rows
