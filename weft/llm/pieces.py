"""Max-plus segmentation with the pieces of a SentencePiece model.

A segmentation is a path over the positions of a text; an edge is a piece. In a unigram model an edge
weighs its log-probability. In a BPE model an edge weighs 0 if the piece may follow the piece before it
and minus infinity if not: a sequence of pieces is the result of greedy merging exactly if each
adjacent pair is, alone, merged into itself, so one finite path reaches each position. Both are
max-plus recurrences whose state is (position, last piece).

No piece spans two neighbouring characters that stand together in no piece. Such places cut a text
into segments that are solved alone, whatever stands around them. All segments go through a trie, where the
recurrence runs once for each shared beginning: short ones level by level in arrays, long ones (and those
with runs of blanks, whose pieces tie) in a walk over the sorted segments.

A character without piece becomes its bytes if the model has pieces for these; else it is unknown, and a
run of unknown characters is one id. Weights are summed in double precision; where a unigram model gives two
segmentations the same weight to about seven digits, the library's float sums may choose another one.
"""

from __future__ import annotations

from os.path import commonprefix

import numpy as np
import pandas as pd

from weft.llm.textbatch import BASE, U, _power, mix

SPACE_MARK = "▁"
#: The state after a place that no piece spans.
FREE = -1
#: Longer segments, and those with runs of blanks, are solved in a walk over the sorted segments.
TRIE_LENGTH = 48
CACHE_SEGMENTS = 500_000


class PieceModel:
    """Tables of a model; plain arrays, so it can be broadcast."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(model)
        kinds = {int(m.trainer_spec.UNIGRAM): "unigram", int(m.trainer_spec.BPE): "bpe"}
        self.kind = kinds.get(int(m.trainer_spec.model_type))
        norm = m.normalizer_spec
        if not self.kind or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with identity normalisation and marks before words are supported")
        self.dummy = norm.add_dummy_prefix
        self.pieces = [p.piece for p in m.pieces]
        types = np.array([p.type for p in m.pieces])
        if (types == 4).any():
            raise ValueError("user-defined pieces are not supported")
        self.scores = np.array([p.score for p in m.pieces], float)
        self.unk = int(np.flatnonzero(types == 2)[0])
        self.bytes = np.full(256, self.unk, np.int32)
        self.fallback = bool((types == 6).any())
        for i in np.flatnonzero(types == 6):
            self.bytes[int(self.pieces[i][3:5], 16)] = i
        normal = np.flatnonzero(types == 1)
        self.ids = {self.pieces[i]: int(i) for i in normal}
        self.least = float(self.scores[normal].min()) - 10
        self.longest = max(map(len, self.ids), default=1)
        self.length = np.array([len(p) for p in self.pieces], np.int64)
        self.control = types == 3
        self.decoded = [m.trainer_spec.unk_surface.encode() if t == 2 else b"" if t == 3 else bytes([int(p[3:5], 16)]) if t == 6 else p.replace(SPACE_MARK, " ").encode() for p, t in zip(self.pieces, types)]
        self._classes()
        self._hashes(normal)
        self.spines = self._spines() if self.kind == "bpe" else None
        self.pairs: dict[tuple[int, int], bool] = {}

    def _classes(self) -> None:
        """Which characters may stand together inside a piece."""
        many = [p for p in self.ids if len(p) > 1]
        chars = sorted({c for p in many for c in p})
        self.char_class = np.zeros(0x110000, np.uint16)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in many:
            c = self.char_class[[ord(x) for x in p]]
            self.joins[c[:-1], c[1:]] = True
        #: Characters that are no piece of their own.
        self.lonely = np.ones(0x110000, bool)
        self.lonely[[ord(p) for p in self.ids if len(p) == 1]] = False

    def _hashes(self, normal: np.ndarray) -> None:
        h = np.array([piece_hash(p) for p in (self.pieces[i] for i in normal)], U)
        order = np.argsort(h)
        self.keys, self.key_ids = h[order], normal[order].astype(np.int32)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(h >> U(44)).astype(np.int64)] = True
        self.hash_of = np.zeros(len(self.pieces), U)
        self.hash_of[normal] = h

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 if none."""
        out = np.full(len(h), -1, np.int32)
        some = np.flatnonzero(self.maybe[(h >> U(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
        out[some] = np.where(self.keys[at] == h[some], self.key_ids[at], -1)
        return out

    def merge(self, symbols: list[str]) -> tuple[list[str], dict[str, tuple[str, str]]]:
        """Greedy merging, the best score first and the leftmost of equals; also how each result was built."""
        built: dict[str, tuple[str, str]] = {}
        symbols = list(symbols)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                k = self.ids.get(symbols[i] + symbols[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if best is None:
                break
            built[symbols[at] + symbols[at + 1]] = (symbols[at], symbols[at + 1])
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols, built

    def _spines(self):
        """For each piece the parts at its right and left edge while it is built: part, built at, merged at."""
        n, deep = len(self.pieces), self.longest + 1
        right, left = np.full((n, deep), -1, np.int32), np.full((n, deep), -1, np.int32)
        r_die, l_die = np.full((n, deep), np.inf), np.full((n, deep), np.inf)
        self.whole = np.zeros(n, bool)
        self.time = np.where(self.length > 1, -self.scores, -np.inf)
        # whitespace runs tie, and a piece that is older than its parts would break the order of times
        self.regular = np.zeros(n, bool)
        for p, i in self.ids.items():
            got, tree = self.merge(list(p))
            self.whole[i] = got == [p]
            if not self.whole[i]:
                continue
            fine = SPACE_MARK * 2 not in p
            for spine, die, side in ((right, r_die, 1), (left, l_die, 0)):
                part, dies, k = p, np.inf, 0
                while True:
                    j = self.ids.get(part)
                    if j is None:
                        fine = False
                        break
                    spine[i, k], die[i, k] = j, dies
                    if len(part) == 1:
                        break
                    fine &= self.time[j] < dies
                    dies, part, k = self.time[j], tree[part][side], k + 1
            self.regular[i] = fine
        return right, r_die, left, l_die

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the two pieces alone gives just them."""
        if (a, b) not in self.pairs:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            p, q = self.pieces[a], self.pieces[b]
            self.pairs[a, b] = self.merge(list(p + q))[0] == [p, q]
        return self.pairs[a, b]

    def follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``follows`` for arrays: no part at a's right edge ever merges with one at b's left edge.

        Parts x and y stand side by side from the later of their births to the earlier of their own
        merges; their joint piece wins if it is due before that end (on the right of equals, leftmost first).
        """
        right, r_die, left, l_die = self.spines
        good = np.ones(len(a), bool)
        odd = ~(self.regular[a] & self.regular[b])
        for k in range(right.shape[1]):
            x, xd = right[a, k], r_die[a, k]
            if not (x >= 0).any():
                break
            for j in range(left.shape[1]):
                y, yd = left[b, j], l_die[b, j]
                side = np.flatnonzero((x >= 0) & (y >= 0) & good & (np.maximum(self.time[x], self.time[y]) < np.minimum(xd, yd)))
                if not len(side):
                    if not (y >= 0).any():
                        break
                    continue
                xs, ys = x[side], y[side]
                joint = self.lookup(self.hash_of[xs] * _power("up", self.longest + 1)[self.length[ys]] + self.hash_of[ys])
                due = np.where(joint >= 0, self.time[joint], np.inf)
                good[side[(due < xd[side]) & (due <= yd[side]) & (joint >= 0)]] = False
        for i in np.flatnonzero(odd):
            good[i] = self.follows(int(a[i]), int(b[i]))
        return good

    def symbols(self, text: str) -> str:
        if not text:
            return ""
        return (SPACE_MARK if self.dummy else "") + text.replace(" ", SPACE_MARK)

    def unknown(self, char: str) -> list[int]:
        return self.bytes[list(char.encode())].tolist() if self.fallback else [self.unk]

    def one_unknown(self, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of texts with one id for each run of unknown ones."""
        if self.fallback or not len(ids):
            return ids, offs
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] != self.unk) | (ids[:-1] != self.unk)
        keep[offs[offs < len(ids)]] = True
        return ids[keep], np.append(0, np.cumsum(keep))[offs]


def piece_hash(s: str) -> int:
    h = 0
    for v in mix(np.array([ord(c) for c in s], U) * BASE).tolist():
        h = (h * int(BASE) + v) & ((1 << 64) - 1)
    return h


def solve(model: PieceModel, s: str, start: int = 0, last: int = FREE, earlier: tuple = (), known: list | None = None):
    """The best path over s[start:] from state (start, last): for each position (weight, piece, from) or None.

    ``known`` are the first results, taken from a text with the same beginning. As soon as the last
    positions agree with those of an ``earlier`` result but for a constant weight, the rest is taken from there.
    """
    n, reach, ids, bpe = len(s), model.longest, model.ids, model.kind == "bpe"
    best: list = [None] * (n + 1)
    best[start] = (0.0, last, None)
    if known:
        best[: len(known)] = known
    for end in range(max(start + 1, len(known or ())), n + 1):
        for begin in range(max(start, end - reach), end):
            b = best[begin]
            if b is None:
                continue
            piece = ids.get(s[begin:end])
            if piece is None:
                continue
            if bpe:
                if model.whole[piece] and (b[1] < 0 or model.follows(b[1], piece)):
                    best[end] = (0.0, piece, begin)
                    break
            elif best[end] is None or b[0] + model.scores[piece] > best[end][0]:
                best[end] = (b[0] + model.scores[piece], piece, begin)
        if (alone := best[end - 1]) is not None and s[end - 1] not in ids:
            # a character without piece may stand alone
            if best[end] is None or not bpe and alone[0] + model.least > best[end][0]:
                best[end] = (alone[0] + model.least, FREE, end - 1)
        if earlier and end % 64 == 0 and end - reach > start:
            for other in earlier:
                gaps = {None if a is None else a[0] - b[0] for a, b in zip(best[end - reach : end + 1], other[end - reach : end + 1]) if (a is None) == (b is None) and (a is None or a[1:] == b[1:])}
                same = sum((a is None) == (b is None) and (a is None or a[1:] == b[1:]) for a, b in zip(best[end - reach : end + 1], other[end - reach : end + 1]))
                gaps.discard(None)
                if same == reach + 1 and len(gaps) == 1:
                    gap = gaps.pop()
                    return best[: end + 1] + [x and (x[0] + gap, *x[1:]) for x in other[end + 1 :]]
    return best


def solve_sorted(model: PieceModel, texts: list[str]) -> dict[str, np.ndarray]:
    """Pieces of each text, by a walk over their trie: sorted texts with the same beginning share its results."""
    out, before, best = {}, "", []
    for s in sorted(set(texts)):
        best = solve(model, s, known=best[: len(commonprefix([before, s])) + 1])
        out[s] = np.array(walk(model, s, best, 0, len(s)), np.int32)
        before = s
    return out


def walk(model: PieceModel, s: str, best: list, start: int, end: int) -> list[int]:
    out: list[list[int]] = []
    while end > start:
        _, piece, begin = best[end]
        out.append([piece] if piece >= 0 else model.unknown(s[begin:end]))
        end = begin
    return [x for part in reversed(out) for x in part]


def joints(model: PieceModel, codes: np.ndarray) -> np.ndarray:
    """Flags between neighbouring characters that no piece spans (place i is before character i + 1)."""
    c = model.char_class[codes]
    return ~model.joins[c[:-1], c[1:]]


class Trie:
    """Distinct segments in a trie; the recurrence runs once for each node, level by level."""

    def __init__(self, model: PieceModel, codes: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.model, n = model, len(start)
        node = np.zeros(n, np.int64)
        char_code = mix(codes.astype(U) * BASE)
        parent, hashes, count, piece, back = [np.array([-1])], [np.zeros(1, U)], [np.zeros(1, np.int64)], [np.full(1, FREE, np.int32)], [np.array([-1])]
        weight = [np.zeros(1)]
        n_nodes, starts = 1, [0]
        up = _power("up", model.longest + 1)
        for depth in range(int(size.max(initial=0))):
            active = np.flatnonzero(size > depth)
            at = start[active] + depth
            key, first, inverse = np.unique(node[active] << 21 | codes[at].astype(np.int64), return_index=True, return_inverse=True)
            par = key >> 21
            node[active] = n_nodes + inverse
            h = hashes[-1][par - starts[-1]] * BASE + char_code[at[first]]
            m = len(key)
            cnt, pc, bk, w = np.zeros(m, np.int64), np.full(m, -2, np.int32), np.full(m, -1), np.full(m, -np.inf)
            # ancestors of all nodes of this level, one step up for each length of the last piece
            anc, level = par, len(parent) - 1
            todo = np.arange(m)
            for length in range(1, min(depth + 1, model.longest) + 1):
                local = anc[todo] - starts[level]
                tok = model.lookup(h[todo] - hashes[level][local] * up[length])
                some = np.flatnonzero(tok >= 0)
                if len(some):
                    rows, t, prev = todo[some], tok[some], local[some]
                    if model.kind == "bpe":
                        before = piece[level][prev]
                        good = model.whole[t] & (before != -2)
                        check = np.flatnonzero(good & (before >= 0))
                        good[check] = self._follow(before[check], t[check])
                        rows, t, prev = rows[good], t[good], prev[good]
                        w[rows] = 0.0
                    else:
                        # of equal weights the longest last piece
                        new = weight[level][prev] + model.scores[t]
                        good = (new >= w[rows]) & (new > -np.inf)
                        rows, t, prev = rows[good], t[good], prev[good]
                        w[rows] = new[good]
                    pc[rows], bk[rows], cnt[rows] = t, anc[rows], count[level][prev] + 1
                    if model.kind == "bpe":
                        todo = todo[pc[todo] == -2]
                        if not len(todo):
                            break
                if level:
                    step = np.full(m, -1)
                    step[todo] = parent[level][anc[todo] - starts[level]]
                    anc, level = step, level - 1
            chars, up1 = key & 0x1FFFFF, par - starts[-1]
            alone = weight[-1][up1] + model.least
            for k in np.flatnonzero(model.lonely[chars] & (piece[-1][up1] != -2) & ((pc == -2) | (model.kind != "bpe") & (alone > w))):
                # a character without piece may stand alone
                pc[k], bk[k], w[k] = -3 - int(chars[k]), par[k], alone[k]
                cnt[k] = count[-1][up1[k]] + len(model.unknown(chr(int(chars[k]))))
            for store, x in ((parent, par), (hashes, h), (count, cnt), (piece, pc), (back, bk), (weight, w)):
                store.append(x)
            starts.append(n_nodes)
            n_nodes += m
        self.piece, self.back = np.concatenate(piece), np.concatenate(back)
        self.counts = np.concatenate(count)[node]
        self.node = node

    def _follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code, inverse = np.unique(a.astype(np.int64) << 32 | b, return_inverse=True)
        return PAIRS.check(self.model, code)[inverse]

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all segments, offsets)."""
        offs = np.append(0, np.cumsum(self.counts))
        out = np.zeros(offs[-1], np.int32)
        spot, node = offs[1:].copy(), self.node.copy()
        live = np.flatnonzero(node > 0)
        while len(live):
            p = self.piece[node[live]]
            plain = p >= 0
            spot[live[plain]] -= 1
            out[spot[live[plain]]] = p[plain]
            for k in live[~plain]:
                ids = self.model.unknown(chr(-3 - int(self.piece[node[k]])))
                spot[k] -= len(ids)
                out[spot[k] : spot[k] + len(ids)] = ids
            node[live] = self.back[node[live]]
            live = live[node[live] > 0]
        return out, offs


class PairCache:
    """Sorted codes of checked pairs; only a memo, so it may be emptied."""

    def __init__(self):
        self.codes, self.good = np.zeros(0, np.int64), np.zeros(0, bool)

    def check(self, model: PieceModel, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, code), max(len(self.codes) - 1, 0))
        known = self.codes[at] == code if len(self.codes) else np.zeros(len(code), bool)
        out = np.zeros(len(code), bool)
        out[known] = self.good[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = model.follow(code[new] >> 32, code[new] & 0xFFFFFFFF)
            if len(self.codes) > 4_000_000:
                self.codes, self.good = np.zeros(0, np.int64), np.zeros(0, bool)
            codes, good = np.append(self.codes, code[new]), np.append(self.good, out[new])
            order = np.argsort(codes, kind="stable")
            self.codes, self.good = codes[order], good[order]
        return out


PAIRS = PairCache()


class Encoder:
    """Pieces of texts, with the segments solved so far kept for later texts of the same worker."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.keys, self.rows = np.zeros(0, U), np.zeros(0, np.int64)
        self.flat, self.offs = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _solve(self, codes, start, size) -> tuple[np.ndarray, np.ndarray]:
        model = self.model
        mark = codes == ord(SPACE_MARK)
        double = np.zeros(len(codes), np.int64)
        np.cumsum(mark[1:] & mark[:-1], out=double[1:])
        odd = (size > TRIE_LENGTH) | ((size > 1) & (double[start + size - 1] > double[start]))
        plain = np.flatnonzero(~odd)
        flat, offs = Trie(model, codes, start[plain], size[plain]).sequences() if len(plain) else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        counts = np.zeros(len(start), np.int64)
        counts[plain] = np.diff(offs)
        names = {k: codes[start[k] : start[k] + size[k]].astype(np.uint32).tobytes().decode("utf-32-le") for k in np.flatnonzero(odd)}
        solved = solve_sorted(model, list(names.values()))
        lone = {k: solved[s] for k, s in names.items()}
        for k, ids in lone.items():
            counts[k] = len(ids)
        to = np.append(0, np.cumsum(counts))
        out = np.zeros(to[-1], np.int32)
        out[ragged(to[:-1][plain], counts[plain])] = flat
        for k, ids in lone.items():
            out[to[k] : to[k + 1]] = ids
        return out, to

    def segments(self, codes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cache row of each segment of the code points; ``cuts``: texts' bounds. Returns (rows, segment starts)."""
        n = len(codes)
        begin = np.ones(n, bool)
        begin[1:] = joints(self.model, codes)
        begin[cuts[cuts < n]] = True
        start = np.flatnonzero(begin)
        size = np.diff(np.append(start, n))
        prefix = np.zeros(n + 1, U)
        np.cumsum(mix(codes.astype(U) * BASE) * _power("up", n + 1)[:n], out=prefix[1:])
        h = mix((prefix[start + size] - prefix[start]) * _power("down", n + 1)[start] + size.astype(U) * U(0xD6E8FEB86659FD93))
        code, unique = pd.factorize(h)
        at = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        known = self.keys[at] == unique if len(self.keys) else np.zeros(len(unique), bool)
        row = np.zeros(len(unique), np.int64)
        row[known] = self.rows[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.keys) + len(new) > CACHE_SEGMENTS and len(self.keys):
                self.reset()
                return self.segments(codes, cuts)
            first = np.zeros(len(unique), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            flat, offs = self._solve(codes, start[first[new]], size[first[new]])
            row[new] = len(self.offs) - 1 + np.arange(len(new))
            self.flat, self.offs = np.append(self.flat, flat), np.append(self.offs, self.offs[-1] + offs[1:])
            keys, rows = np.append(self.keys, unique[new]), np.append(self.rows, row[new])
            order = np.argsort(keys)
            self.keys, self.rows = keys[order], rows[order]
        return row[code], start

    def _codes(self, marked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.append(0, np.cumsum([len(t) for t in marked])).astype(np.int64)
        return np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32), cuts

    def counts(self, marked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of pieces and of segments of each text (of its symbols)."""
        codes, cuts = self._codes(marked)
        rows, start = self.segments(codes, cuts)
        total = np.append(0, np.cumsum(np.diff(self.offs)[rows]))
        spot = np.searchsorted(start, cuts)
        if not self.model.fallback:
            return np.diff(self.encode(marked)[1]), np.diff(spot)
        return np.diff(total[spot]), np.diff(spot)

    def encode(self, marked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all texts, offsets), from their symbols."""
        codes, cuts = self._codes(marked)
        rows, start = self.segments(codes, cuts)
        sizes = np.diff(self.offs)[rows]
        total = np.append(0, np.cumsum(sizes))
        return self.model.one_unknown(self.flat[ragged(self.offs[rows], sizes)], total[np.searchsorted(start, cuts)])


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each row, one after the other."""
    total = np.cumsum(size)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.int64)
    return np.arange(total[-1]) + np.repeat(start - total + size, size)


_encoders: dict[int, Encoder] = {}


def encoder(model: PieceModel, tag: int) -> Encoder:
    """This worker's encoder of a broadcast model."""
    if tag not in _encoders:
        _encoders.clear()
        _encoders[tag] = Encoder(model)
    return _encoders[tag]
