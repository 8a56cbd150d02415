"""Repair of conversation structure by the arcs of all cheapest edits (operator 11).

Rows of a conversation, by turn, are kept, given another role, deleted, or preceded by new empty turns, so that the
initials of the roles read (s?(ua)+)?. States are what has been said last (nothing, system, user, assistant); a layer
lies before each row and one behind the last. Forward and backward least costs of every node tell which arcs lie on
a cheapest path (forward + arc + backward = total). Those tight arcs form a DAG, as insertions cost something; a walk
from its start with the set of all nodes that the letters so far lead to takes the least letter that goes on, which
gives the ASCII-least audit. A letter and a state tell the next state, so a walk from one node stays with one node.

A step of all these sweeps is taken for all conversations of a batch at once. Conversations of MOST_ROWS rows and
MOST_BYTES of text are whole in a task, which needs one shuffle. A longer one is put in order by ranges that split
it anywhere, copies included, and cut into chunks; each chunk becomes a min-plus matrix, the matrices of a
conversation give the costs at the cuts, and each chunk is walked on its own from each state that it can be entered by.
Repeated rows are then told by an aggregate and an equi-join on 128-bit digests. Only the hash of a
repaired conversation, which by definition reads it from first to last byte, streams through one task, holding one batch.

Faults: blank, then duplicate, then truncated; each row counts for its first. Cases: rows are ordered by turn (null
first), role and md5 of the text; a null role or text is one space; an initial is the first character of the role
exactly as it stands, and a role without one can't be kept; a null conv_id is a conversation; a conversation of which no
row is left has zeros, an empty audit and the empty string's hash; no rows give no conversations; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import bounded_batches, stored
from weft.llm.textbatch import lean

MOST_ROWS, MOST_BYTES, CHUNK = 8192, 4 << 20, 4096
FAR = 1 << 40
START, S, U, A = range(4)
#: The state after an empty or renamed turn, and after a kept one by class of its role (s, u, a, other); -1: not allowed.
GIVES = np.array([U, U, A, U])
KEEPS = np.array([[S, -1, -1, -1], [U, U, -1, U], [-1, -1, A, -1], [-1, -1, -1, -1]])
ENDS = np.array([0, FAR, FAR, 0])
#: Costs; a row's kind is three times its role's class plus 0, 1 (truncated) or 2 (to be deleted).
DELETE, INSERT = 4, 3
KEEP = np.array([0, 3, FAR] * 4)
REROLE = np.array([3, 6, FAR] * 4)
LETTERS = "DIKR"
LEGAL = ((0, 1), (1, 2), (2, 1))
EMPTY = hashlib.sha256(b"").hexdigest()


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Min-plus matrices: insertions; by kind a row then insertions; by kind insertions then a row."""
    between = np.full((4, 4), FAR)
    for q in range(4):
        between[q, q] = 0
        between[q, GIVES[q]] = INSERT
    between = (between[:, :, None] + between[None]).min(1)
    rows = np.full((12, 4, 4), FAR)
    for kind in range(12):
        for q in range(4):
            for to, cost in ((q, DELETE), (GIVES[q], REROLE[kind]), (KEEPS[kind // 3, q], KEEP[kind])):
                if to >= 0:
                    rows[kind, q, to] = min(rows[kind, q, to], cost)
    return between, (rows[:, :, :, None] + between[None, None]).min(2), (between[None, :, :, None] + rows[:, None]).min(2)


BETWEEN, ROW_FIRST, ROW_LAST = _tables()


class Sweeps:
    """Runs of row kinds side by side, cut at ``offs``; layer i of run c is row offs[c] + c + i of a table of costs."""

    def __init__(self, kind: np.ndarray, offs: np.ndarray):
        self.kind, self.offs, self.n = kind, offs, np.diff(offs)
        self.base = offs[:-1] + np.arange(len(self.n))
        self.order = np.argsort(-self.n, kind="stable")
        self.live = np.searchsorted(-self.n[self.order], -np.arange(int(self.n.max(initial=0))), side="left")

    def product(self) -> np.ndarray:
        """The matrix of each run."""
        out = np.broadcast_to(BETWEEN, (len(self.n), 4, 4)).copy()
        for t, m in enumerate(self.live):
            of = self.order[:m]
            out[of] = (out[of][:, :, :, None] + ROW_FIRST[self.kind[self.offs[of] + t]][:, None]).min(2)
        return np.minimum(out, FAR)

    def forward(self, entry: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.kind) + len(self.n), 4), np.int64)
        out[self.base] = (entry[:, :, None] + BETWEEN).min(1)
        for t, m in enumerate(self.live):
            of = self.order[:m]
            out[self.base[of] + t + 1] = np.minimum((out[self.base[of] + t][:, :, None] + ROW_FIRST[self.kind[self.offs[of] + t]]).min(1), FAR)
        return out

    def backward(self, leave: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.kind) + len(self.n), 4), np.int64)
        out[self.base + self.n] = (BETWEEN + leave[:, None, :]).min(2)
        for t, m in enumerate(self.live):
            of = self.order[:m]
            row = self.offs[of] + self.n[of] - 1 - t
            out[self.base[of] + self.n[of] - 1 - t] = np.minimum((ROW_LAST[self.kind[row]] + out[self.base[of] + self.n[of] - t][:, None, :]).min(2), FAR)
        return out

    def walk(self, f: np.ndarray, b: np.ndarray, total: np.ndarray, front: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edits, nodes left): the least letters through tight arcs from the nodes ``front`` (runs x 4).

        Edits are rows of run, letter, row within the run and new state, in order. A run that isn't ``final`` ends
        when its last row is done; empty turns there belong to the next run.
        """
        front, layer, busy, said = front.copy(), np.zeros(len(self.n), np.int64), np.ones(len(self.n), bool), []
        while True:
            of = np.flatnonzero(busy)
            at, more = self.base[of] + layer[of], layer[of] < self.n[of]
            here = front[of] & (f[at] + b[at] == total[of][:, None])
            done = ~more & (~final[of] | (here & (b[at] == 0)).any(1)) | ~here.any(1)
            busy[of[done]] = False
            of, at, more, here = of[~done], at[~done], more[~done], here[~done]
            if not len(of):
                return np.concatenate(said) if said else np.zeros((0, 4), np.int64), front
            want = total[of][:, None] - f[at]
            after = np.where(more[:, None], b[np.minimum(at + 1, len(b) - 1)], FAR)
            kind = np.where(more, self.kind[np.minimum(self.offs[of] + layer[of], len(self.kind) - 1)] if len(self.kind) else 0, 0)
            keeps, gives = KEEPS[kind // 3], np.broadcast_to(GIVES, here.shape)
            rest = [
                (np.broadcast_to(np.arange(4), here.shape), DELETE + after),
                (gives, INSERT + b[at][:, GIVES]),
                (keeps, np.where(keeps >= 0, KEEP[kind][:, None] + np.take_along_axis(after, np.maximum(keeps, 0), 1), FAR)),
                (gives, REROLE[kind][:, None] + after[:, GIVES]),
            ]
            tight = np.stack([here & (cost == want) for _, cost in rest], 1)
            letter = tight.any(2).argmax(1)
            rows = np.arange(len(of))
            to, good = np.stack([x for x, _ in rest], 1)[rows, letter], tight[rows, letter]
            new = np.zeros_like(here)
            for q in range(4):
                new[rows[good[:, q]], to[good[:, q], q]] = True
            said.append(np.stack([of, letter, layer[of], new.argmax(1)], 1))
            front[of] = new
            layer[of] += letter != 1


def _sorted_edits(edits: np.ndarray) -> np.ndarray:
    """Edits run by run; within a run they are in order already."""
    return edits[np.argsort(edits[:, 0], kind="stable")]


def _letters(edits: np.ndarray, runs: int) -> list[str]:
    cut = np.searchsorted(edits[:, 0], np.arange(runs + 1))
    text = np.frombuffer(LETTERS.encode(), np.uint8)[edits[:, 1]].tobytes().decode()
    return [text[a:b] for a, b in zip(cut[:-1], cut[1:])]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and live of ``conversations`` after the damage that the hash of each place chooses."""
    space = F.lit(" ")
    said = F.coalesce(F.col("text").cast("string"), space)
    fault = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))).cast("binary")) % 20
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        (fault != 0).alias("live"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def _prepared(rows: DataFrame) -> DataFrame:
    """key, conv_id, turn, role, text, live, kind before duplicates are told, h1, h2 and the order of ties."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    live = F.col("live") if "live" in rows.columns else F.lit(True)
    out = rows.select(key.alias("key"), "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), live.alias("live"))
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", 0).when(first == "u", 3).when(first == "a", 6).otherwise(9)
    seen = F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    ended = F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    fault = F.when(~seen, 2).when(~ended, 1).otherwise(0)
    same = [F.xxhash64(F.lit(s), F.col("key"), F.col("role"), F.col("text")) for s in (31, 37)]
    return out.withColumns({"kind": (kind + fault).cast("int"), "h1": same[0], "h2": same[1], "tie": F.md5(F.col("text").cast("binary"))})


def _order() -> list[Column]:
    return [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TURNS = "conv_id {id}, place long, role string, text string"


def _firsts(group: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Flags of rows that equal an earlier one of their group."""
    order = np.lexsort((np.arange(len(group)), *keys, group))
    same = np.ones(len(group), bool)
    same[:1] = False
    for k in (group, *keys):
        same[1:] &= k[order][1:] == k[order][:-1]
    out = np.zeros(len(group), bool)
    out[order] = same
    return out


def _gaps(turn: np.ndarray, null: np.ndarray, conv: np.ndarray, n: int) -> np.ndarray:
    """Turns that are missing between the first and the last of each conversation; rows are in order."""
    turn, conv = turn[~null], conv[~null]
    if not len(turn):
        return np.zeros(n, np.int64)
    cut = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
    last = np.append(cut[1:], len(conv)) - 1
    fresh = np.append(True, (turn[1:] != turn[:-1]) | (conv[1:] != conv[:-1]))
    out = np.zeros(n, np.int64)
    out[conv[cut]] = turn[last] - turn[cut] + 1 - np.add.reduceat(fresh.astype(np.int64), cut)
    return out


def _illegal(group: np.ndarray, kind: np.ndarray, n: int) -> np.ndarray:
    role = kind // 3
    fits = np.zeros((4, 4), bool)
    for a, b in LEGAL:
        fits[a, b] = True
    bad = (group[1:] == group[:-1]) & ~fits[role[:-1], role[1:]]
    return np.bincount(group[1:][bad], minlength=n)


def _short(rows: DataFrame, turns: bool) -> DataFrame:
    """Reports, or repaired turns, of conversations that are whole in a task."""
    kind_of = dict(rows.dtypes)["conv_id"]

    def finish(t: pa.Table) -> Iterator[pa.RecordBatch]:
        ends = pc.run_end_encode(t.column("key").combine_chunks()).run_ends.to_numpy()
        n = len(ends)
        live = t.column("live").to_numpy()
        conv = np.searchsorted(ends, np.arange(t.num_rows), side="right")[live]
        ids = t.column("conv_id").take(pa.array(ends.astype(np.int64) - 1)).combine_chunks()
        t = t.filter(pa.array(live))
        kind = t.column("kind").to_numpy().astype(np.int64)
        blank = kind % 3 == 2
        again = _firsts(conv, t.column("h1").to_numpy(), t.column("h2").to_numpy()) & ~blank
        kind = np.where(again, kind // 3 * 3 + 2, kind)
        offs = np.append(0, np.cumsum(np.bincount(conv, minlength=n)))
        run = Sweeps(kind, offs)
        start = np.full((n, 4), FAR)
        start[:, START] = 0
        f, b = run.forward(start), run.backward(np.broadcast_to(ENDS, (n, 4)))
        total = b[run.base, START]
        edits = _sorted_edits(run.walk(f, b, total, start == 0, np.ones(n, bool))[0])
        cut = np.searchsorted(edits[:, 0], np.arange(n + 1))
        roles, texts = t.column("role").to_pylist(), t.column("text").to_pylist()
        said = []  # the repaired turns of each conversation
        for c in range(n):
            own = []
            for _, letter, i, state in edits[cut[c] : cut[c + 1]].tolist():
                if letter:
                    at = offs[c] + i
                    own.append((roles[at] if letter == 2 else "user" if state == U else "assistant", "" if letter == 1 else texts[at]))
            said.append(own)
        if turns:
            n_own = np.array([len(x) for x in said], np.int64)
            flat = [x for own in said for x in own]
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n_own) - n_own, n_own)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(n), n_own))), pa.array(place), pa.array([r for r, _ in flat], pa.string()), pa.array([x for _, x in flat], pa.string())], ["conv_id", "place", "role", "text"])
            return
        turn = t.column("turn")
        null = turn.is_null().to_numpy()
        counts = [_gaps(turn.fill_null(0).to_numpy(), null, conv, n), *(np.bincount(conv[x], minlength=n) for x in (blank, again, kind % 3 == 1)), _illegal(conv, kind, n), total]
        digests = [hashlib.sha256("\n".join(f"{r}:{x}" for r, x in own).encode()).hexdigest() for own in said]
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(x.astype(np.int64)) for x in counts), pa.array(_letters(edits, n), pa.string()), pa.array(digests, pa.string())], ["conv_id", *COUNTS, "audit", "repaired_sha256"])

    @lean
    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            first = b.column(0)
            last = first[b.num_rows - 1].as_py()
            at = int(pc.index(first, last).as_py())  # the last conversation may go on in the next batch
            if at or held[0].column(0)[0].as_py() != last:
                yield from finish(pa.Table.from_batches([*held[:-1], b.slice(0, at)]))
                held = [b.slice(at)]
        if held:
            yield from finish(pa.Table.from_batches(held))

    schema = TURNS.format(id=kind_of) if turns else f"conv_id {kind_of}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    return rows.repartition("key").sortWithinPartitions(*_order()).drop("tie").mapInArrow(run, schema)


def _chunks(narrow: DataFrame) -> DataFrame:
    """Chunks of long conversations: their row kinds, matrix and what their counts need at the cuts."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        kind, again = t.column("kind").to_numpy().astype(np.int64), t.column("again").to_numpy()
        blank = kind % 3 == 2
        again = again & ~blank
        kind = np.where(again, kind // 3 * 3 + 2, kind)
        turn = t.column("turn").drop_null().to_numpy()
        one = np.zeros(len(kind), np.int64)
        return pa.table({
            "key": t.column("key").slice(0, 1), "chunk": t.column("chunk").slice(0, 1), "first": t.column("pos").slice(0, 1),
            "kinds": pa.array([kind.astype(np.uint8).tobytes()], pa.binary()),
            "product": pa.array([Sweeps(kind, np.array([0, len(kind)])).product()[0].ravel().tolist()], pa.list_(pa.int64())),
            "counts": pa.array([[int(x.sum()) for x in (blank, again, kind % 3 == 1)] + [int(_illegal(one, kind, 1)[0])]], pa.list_(pa.int64())),
            "lo": pa.array([int(turn[0]) if len(turn) else None], pa.int64()), "hi": pa.array([int(turn[-1]) if len(turn) else None], pa.int64()),
            "turns": pa.array([int(len(np.unique(turn)))], pa.int64()),
            "ends": pa.array([[int(kind[0]), int(kind[-1])]], pa.list_(pa.int64())),
        })

    schema = "key string, chunk long, first long, kinds binary, product array<long>, counts array<long>, lo long, hi long, turns long, ends array<long>"
    return narrow.groupBy("key", "chunk").applyInArrow(run, schema)


def _costs(chunks: DataFrame) -> DataFrame:
    """Costs at the cuts of each conversation, from the matrices of its chunks, and its counts."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("chunk")
        m = [np.array(x).reshape(4, 4) for x in t.column("product").to_pylist()]
        entry, leave = [BETWEEN[START]], [(BETWEEN + ENDS).min(1)]
        for x in m[:-1]:
            entry.append(np.minimum((entry[-1][:, None] + x).min(0), FAR))
        for x in m[:0:-1]:
            leave.append(np.minimum((x + leave[-1]).min(1), FAR))
        total = int((entry[-1][:, None] + m[-1] + ENDS[None]).min())
        counts = np.array(t.column("counts").to_pylist()).sum(0).tolist()
        ends = t.column("ends").to_pylist()
        counts[3] += sum((a[1] // 3, b[0] // 3) not in LEGAL for a, b in zip(ends, ends[1:]))
        some = [(lo, hi, n) for lo, hi, n in zip(*(t.column(c).to_pylist() for c in ("lo", "hi", "turns"))) if n]
        distinct = sum(n for _, _, n in some) - sum(a[1] == b[0] for a, b in zip(some, some[1:]))
        gaps = some[-1][1] - some[0][0] + 1 - distinct if some else 0
        k = t.num_rows
        kind = pa.list_(pa.int64())
        return pa.table({"key": t.column("key"), "chunk": t.column("chunk"), "entry": pa.array([x.tolist() for x in entry], kind), "leave": pa.array([x.tolist() for x in leave[::-1]], kind), "final": pa.array([i == k - 1 for i in range(k)]), "found": pa.array([[gaps, *counts, total]] * k, kind)})

    return chunks.select("key", "chunk", "product", "counts", "lo", "hi", "turns", "ends").groupBy("key").applyInArrow(run, "key string, chunk long, entry array<long>, leave array<long>, final boolean, found array<long>")


def _walks(met: DataFrame) -> DataFrame:
    """For each chunk and state that it may be entered by: the letters and the state that it is left in (-1: no way)."""

    @lean
    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                x = {c: v[0] for c, v in b.slice(row, 1).to_pydict().items()}
                kind = np.frombuffer(x["kinds"], np.uint8).astype(np.int64)
                lone = Sweeps(kind, np.array([0, len(kind)]))
                f, back = lone.forward(np.array([x["entry"]])), lone.backward(np.array([x["leave"]]))
                four = Sweeps(np.tile(kind, 4), np.arange(5) * len(kind))
                edits, left = four.walk(np.tile(f, (4, 1)), np.tile(back, (4, 1)), np.full(4, x["found"][-1]), np.eye(4, dtype=bool), np.full(4, x["final"]))
                letters = _letters(_sorted_edits(edits), 4)
                whole = [sum(c != "I" for c in s) == len(kind) for s in letters]
                yield pa.RecordBatch.from_pylist([{"key": x["key"], "chunk": x["chunk"], "letters": letters, "left": [int(left[q].argmax()) if whole[q] else -1 for q in range(4)]}], schema=out)

    out = pa.schema([("key", pa.string()), ("chunk", pa.int64()), ("letters", pa.list_(pa.string())), ("left", pa.list_(pa.int64()))])
    return met.select("key", "chunk", "kinds", "entry", "leave", "final", "found").mapInArrow(run, "key string, chunk long, letters array<string>, left array<long>")


def _entered(walks: DataFrame) -> DataFrame:
    """The state in which each chunk is entered: a few numbers for each chunk of a conversation."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("chunk")
        state, states = START, []
        for left in t.column("left").to_pylist():
            states.append(state)
            state = left[state]
        return pa.table({"key": t.column("key"), "chunk": t.column("chunk"), "state": pa.array(states, pa.int64())})

    return walks.select("key", "chunk", "left").groupBy("key").applyInArrow(run, "key string, chunk long, state long")


def _edits(chosen: DataFrame) -> DataFrame:
    """(key, pos, j, letter, role): the edits of each chunk, before which row and in which order; role of new or renamed turns."""

    @lean
    def run(batches):
        for b in batches:
            for key, first, kinds, state, letters in zip(*(b.column(i).to_pylist() for i in range(5))):
                pos, j, made = first, 0, []
                for c in letters:
                    after = int(KEEPS[kinds[pos - first] // 3, state]) if c == "K" else state if c == "D" else int(GIVES[state])
                    # empty turns behind the last row of all follow it
                    past = pos - first == len(kinds)
                    made.append((pos - past, j + 3 * past, c, "user" if after == U else "assistant"))
                    state, pos, j = after, pos + (c != "I"), j + 1 if c == "I" else 0
                cols = list(zip(*made)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(made), pa.string()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())], ["key", "pos", "j", "letter", "role"])

    return chosen.select("key", "first", "kinds", "state", "letters").mapInArrow(run, "key string, pos long, j long, letter string, role string")


def _digests(turns: DataFrame) -> DataFrame:
    """(key, repaired_sha256): turns in order through one hash for each conversation, holding one batch."""

    @lean
    def run(batches):
        key, digest = None, None
        for b in batches:
            for k, line in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
                if k != key:
                    if digest is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "repaired_sha256"])
                    key, digest = k, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "repaired_sha256"])

    lines = turns.select("key", "pos", "j", F.concat_ws(":", "role", "text").alias("line"))
    return lines.repartition("key").sortWithinPartitions("key", "pos", "j").mapInArrow(run, "key string, repaired_sha256 string")


def _long(spark: SparkSession, rows: DataFrame, keys: DataFrame, turns: bool, chunk: int) -> DataFrame:
    # a row's own number breaks ties, so that a range can end anywhere among copies
    lone = F.monotonically_increasing_id().alias("lone")
    placed = rows.select("*", lone).repartitionByRange(*_order(), F.col("lone")).sortWithinPartitions(*_order(), F.col("lone")).drop("lone")
    placed = stored(spark, placed.withColumn("pos", F.monotonically_increasing_id()), "placed")
    narrow = placed.select("key", "pos", "turn", "kind", "h1", "h2")
    first = narrow.groupBy("h1", "h2").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first")
    first = stored(spark, first, "repeated")
    met = narrow.join(first.hint("merge"), (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    told = met.select("key", (F.col("pos") - F.col("pos") % chunk).alias("chunk"), "pos", "turn", "kind", F.coalesce(F.col("pos") > F.col("first"), F.lit(False)).alias("again"))
    chunks = stored(spark, _chunks(told), "chunks")
    costs = stored(spark, _costs(chunks), "costs")
    met = chunks.select("key", "chunk", "kinds", "first").join(costs.hint("merge"), ["key", "chunk"])
    walks = stored(spark, _walks(met), "walks")
    chosen = chunks.select("key", "chunk", "kinds", "first").join(_entered(walks).hint("merge"), ["key", "chunk"]).join(walks.select("key", "chunk", "letters").hint("merge"), ["key", "chunk"])
    chosen = stored(spark, chosen.withColumn("letters", F.get("letters", F.col("state").cast("int"))), "chosen")
    edits = _edits(chosen).filter("letter <> 'D'").withColumnRenamed("role", "given")
    said = edits.join(placed.select("pos", F.col("role").alias("own"), F.col("text").alias("was")).hint("merge"), "pos")
    said = said.select("key", "pos", "j", F.when(F.col("letter") == "K", F.col("own")).otherwise(F.col("given")).alias("role"), F.when(F.col("letter") == "I", "").otherwise(F.col("was")).alias("text"))
    if turns:
        # at most two empty turns stand before a row and two behind the last; places grow, though not one by one
        return said.join(keys.hint("merge"), "key").select("conv_id", (F.col("pos") * 8 + F.col("j")).alias("place"), "role", "text")
    parts = F.array_sort(F.collect_list(F.struct("chunk", "letters")))
    audit = chosen.groupBy("key").agg(F.array_join(F.transform(parts, lambda x: x["letters"]), "").alias("audit"))
    out = costs.filter("final").join(audit.hint("merge"), "key").join(_digests(said).hint("merge"), "key", "left").join(keys.hint("merge"), "key")
    return out.select("conv_id", *(F.get("found", i).alias(c) for i, c in enumerate(COUNTS)), "audit", F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"))


def _both(spark: SparkSession, conversations: DataFrame, turns: bool, most_rows: int, most_bytes: int, chunk: int) -> DataFrame:
    bounded_batches(spark)
    rows = _prepared(conversations)
    sizes = rows.filter("live").groupBy("key").agg(F.first("conv_id").alias("conv_id"), F.count("*").alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("bytes"))
    large = stored(spark, sizes.filter((F.col("n") > most_rows) | (F.col("bytes") > most_bytes)).select("key", "conv_id"), "large")
    if not large.limit(1).count():
        return _short(rows, turns)
    # Spark broadcasts these keys only below its own threshold
    short = _short(rows.join(large.select("key"), "key", "left_anti"), turns)
    return short.unionByName(_long(spark, rows.filter("live").join(large.select("key"), "key", "left_semi"), large, turns, chunk))


def reports(spark: SparkSession, conversations: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, chunk: int = CHUNK) -> DataFrame:
    """For each conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    Rows of (conv_id, turn, role, text) whose column live, if there is one, is false only say that their conversation exists.
    """
    return _both(spark, conversations, False, most_rows, most_bytes, chunk)


def repaired(spark: SparkSession, conversations: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, place, role, text): the turns after repair, in order of place within each conversation."""
    return _both(spark, conversations, True, most_rows, most_bytes, chunk)
