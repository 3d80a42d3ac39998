"""SentencePiece encoding and decoding by a batched Viterbi in numpy.

The text becomes units: white space turns into the meta symbol, one goes in front, and a unit is a run of meta symbols
with the run of other characters behind it; no piece crosses a unit's border.  The distinct units of a batch are
grouped by length (long ones padded to a common length), and the units of a group advance together: at every position,
rolling hashes of the substrings that end there probe the sorted piece hashes, admissible arcs get their length, and a
vectorised maximum stores the backpointer.

The model is a merge model: its segmentation is not the one with the best sum of scores.  But a sequence of pieces
is the merged one exactly if merging the text of each two neighbours gives those two back, since a merge across
their border would already happen there.  So an arc is admissible if its piece follows the best path's last piece in
that sense, each position has one admissible arc, and the path equals the library's segmentation.

Whether two pieces stay apart is read off their merge trees, for many pairs at once.  Where scores fall along a piece's
merges, time is the score: undo the later of the two pieces' last merges, again and again, and see whether the parts
that then face each other would merge before the merge just undone.  A piece whose scores don't fall is merged
step by step instead.  Recent answers stay in a table of fixed size.  Characters without a piece become their bytes.

No merge crosses a border between two characters that stand side by side in no piece, so units above ``LONG``
characters are first cut at such borders (scripts without spaces mostly fall into single characters).  What is longer
still, such as one letter a million times, goes through the same Viterbi a position at a time, without numpy calls: its
time and memory are linear.

Defined results: null and empty texts have no id and decode to the empty text.  Very long texts are coded whole, a
bounded number of units at a time.  U+2581 itself decodes to a space, as in the library.  Repeated rows are encoded
alike.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8
from .packing import tokenizer_path

META = "▁"
MODEL = "piece_bpe_32k.model"
_UNIT = re.compile(f"{META}*[^{META}]+|{META}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
LONG = 64  # characters of a unit that advances with others


class Pieces:
    """The model's pieces with their hashes, sorted, and the neighbour test."""

    def __init__(self, model: str = MODEL):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=tokenizer_path(model))
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: sp.get_score(i) for i in plain}
        self.byte = np.full(256, sp.unk_id(), np.int64)
        self.byte_of = {}
        for i in range(n):
            if sp.is_byte(i):
                self.byte[int(self.text[i][3:5], 16)] = i
                self.byte_of[i] = int(self.text[i][3:5], 16)
        self.hidden = {i for i in range(n) if sp.is_control(i)}
        self._trees(plain)
        reached = np.flatnonzero(self.reached)
        self.longest = max((len(self.text[i]) for i in reached), default=1)
        keys = np.array([self.hash(np.array([[ord(c) for c in self.text[i]]], np.uint64))[0] for i in reached], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], reached[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        self.seen = np.zeros(1 << 20, bool)  # low bits of the keys, so that most other hashes need no search
        self.seen[(keys & np.uint64(len(self.seen) - 1)).astype(np.int64)] = True
        self.memo = np.full(1 << 20, -1, np.int64)  # the last pair of each slot, doubled, plus whether it stays apart

    def _trees(self, plain: list[int]) -> None:
        """Which pieces merging reaches, their last merges, and the score of every two parts that merge."""
        n = len(self.text)
        self.points = np.array([self.score.get(t, 0.0) for t in self.text])
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.reached, self.stepwise = np.zeros(n, bool), np.zeros(n, bool)
        splits = [(a, b, i) for i in plain for k in range(1, len(self.text[i])) if (a := self.id.get(self.text[i][:k])) is not None and (b := self.id.get(self.text[i][k:])) is not None]
        a, b, whole = np.array(splits, np.int64).reshape(-1, 3).T
        order = np.argsort(a << 32 | b)
        self.pair, self.pair_points = (a << 32 | b)[order], self.points[whole[order]]
        size = np.array([len(t) for t in self.text])
        self.reached[[i for i in plain if size[i] == 1]] = True
        for length in range(2, max(size[plain], default=1) + 1):
            use = np.flatnonzero((size[whole] == length) & self.reached[a] & self.reached[b] & ~self.stepwise[a] & ~self.stepwise[b])
            later = lambda part: (size[part] == 1) | (self.points[part] > self.points[whole[use]])
            use = use[later(a[use]) & later(b[use])]
            use = use[self.faced(a[use], b[use], self.points[whole[use]])]
            self.reached[whole[use]], self.left[whole[use]], self.right[whole[use]] = True, a[use], b[use]
            for i in (i for i in plain if size[i] == length and not self.reached[i]):
                if self.merged(self.text[i]) == [self.text[i]]:
                    self.reached[i] = self.stepwise[i] = True

    @staticmethod
    def hash(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for k in range(codes.shape[1]):
            h = (h + codes[:, k] + np.uint64(1)) * _BASE
            h ^= h >> np.uint64(29)
        return h

    def merged(self, text: str) -> list[str]:
        """Best-first merges of a short text: the highest score, then the leftmost pair."""
        parts = list(text)
        while len(parts) > 1:
            best = min(
                ((-self.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None
            )
            if best is None:
                break
            parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]
        return parts

    def faced(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether no merge across the border of ``left`` and ``right``, other than theirs at score ``limit``, comes first."""
        apart, live, x, y = np.ones(len(left), bool), np.arange(len(left)), left, right
        behind = np.zeros(len(left), bool)  # whether the merge undone last lay behind the border
        while len(live):
            at = np.minimum(np.searchsorted(self.pair, x << 32 | y), len(self.pair) - 1)
            points = np.where(self.pair[at] == (x << 32 | y), self.pair_points[at], -np.inf)
            fires = (points > limit) | ((points == limit) & behind)  # of two equal merges the one in front comes first
            apart[live[fires]] = False
            go = np.flatnonzero(~fires & ((self.left[x] >= 0) | (self.left[y] >= 0)))
            live, x, y = live[go], x[go], y[go]
            behind = (self.left[x] < 0) | ((self.left[y] >= 0) & (self.points[y] <= self.points[x]))
            limit = np.where(behind, self.points[y], self.points[x])
            x, y = np.where(behind, x, self.right[x]), np.where(behind, self.left[y], y)
        return apart

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each piece ``right`` may follow ``left``; a negative number is a character without a piece, -1 the start."""
        out = left < 0
        ask = np.flatnonzero(~out)
        pair = left[ask] << 32 | right[ask]
        slot = ((pair * -0x61C8864680B583EB) >> 40) & (len(self.memo) - 1)
        held = self.memo[slot]
        out[ask] = (held & 1).astype(bool)
        new = np.flatnonzero(held >> 1 != pair)
        if len(new):
            a, b = left[ask[new]], right[ask[new]]
            said = self.faced(a, b, np.full(len(new), -np.inf))
            for i in np.flatnonzero(self.stepwise[a] | self.stepwise[b]).tolist():
                two = [self.text[a[i]], self.text[b[i]]]
                said[i] = self.merged("".join(two)) == two
            self.memo[slot[new]] = pair[new] << 1 | said
            out[ask[new]] = said
        return out

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of equal length as code points, one a column: the last piece at each position, and its length."""
        n, units = codes.shape
        piece = np.full((n + 1, units), -1, np.int64)
        back = np.ones((n + 1, units), np.int64)
        rolling = np.zeros((min(n, self.longest), units), np.uint64)  # hashes of the substrings from each start to here
        every = np.arange(units)
        for end in range(1, n + 1):
            live = rolling[:end]
            live[(end - 1) % len(rolling)] = 0
            live += codes[end - 1] + np.uint64(1)
            live *= _BASE
            live ^= live >> np.uint64(29)
            maybe = np.flatnonzero(self.seen[(live & np.uint64(len(self.seen) - 1)).view(np.int64)])
            h = live.ravel()[maybe]
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[at] == h
            got, where = self.ids[at[hit]], maybe[hit]
            line, unit = np.divmod(where, units)
            length = (end - 1 - line) % len(rolling) + 1
            ok = self.stay_apart(piece[end - length, unit], got)
            arc, ids = np.zeros(live.shape, np.int16), np.full(live.shape, -2, np.int32)
            arc.ravel()[where[ok]], ids.ravel()[where[ok]] = length[ok], got[ok]
            best = arc.argmax(axis=0)
            piece[end] = ids[best, every]
            back[end] = np.maximum(arc[best, every], 1)  # a character without a piece stands alone
        return piece, back

    @cached_property
    def inner(self) -> np.ndarray:
        """Sorted pairs of neighbouring characters within pieces, as one number each."""
        return np.array(sorted({ord(a) << 21 | ord(b) for t in self.id for a, b in zip(t, t[1:])}), np.int64)

    def segments(self, unit: str) -> list[str]:
        """A unit cut at the borders that no merge can cross."""
        codes = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        pairs = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.inner, pairs), len(self.inner) - 1)
        cuts = [0, *(np.flatnonzero(self.inner[at] != pairs) + 1).tolist(), len(unit)]
        return [unit[a:b] for a, b in zip(cuts, cuts[1:])]

    @cached_property
    def plain(self) -> tuple:
        """The tables of ``apart`` as Python objects, for one pair at a time."""
        pairs = dict(zip(self.pair.tolist(), self.pair_points.tolist()))
        return pairs, self.left.tolist(), self.right.tolist(), self.points.tolist(), {self.text[i]: i for i in np.flatnonzero(self.reached).tolist()}, {}

    def apart(self, a: int, b: int) -> bool:
        """``stay_apart`` of one pair of pieces."""
        if self.stepwise[a] or self.stepwise[b]:
            return self.merged(self.text[a] + self.text[b]) == [self.text[a], self.text[b]]
        pairs, left, right, points, _, _ = self.plain
        limit, behind = -np.inf, False
        while True:
            score = pairs.get(a << 32 | b)
            if score is not None and (score > limit or score == limit and behind):
                return False
            if left[a] < 0 and left[b] < 0:
                return True
            behind = left[a] < 0 or (left[b] >= 0 and points[b] <= points[a])
            if behind:
                limit, b = points[b], left[b]
            else:
                limit, a = points[a], right[a]

    def single(self, unit: str) -> bytes:
        """Ids of one long unit: the Viterbi of ``viterbi``, a position at a time."""
        ids, said = self.plain[4], self.plain[5]
        piece, back = [-1] * (len(unit) + 1), bytearray(len(unit) + 1)
        for end in range(1, len(unit) + 1):
            found, step = -2, 1
            for length in range(min(end, self.longest), 0, -1):
                here = ids.get(unit[end - length : end])
                if here is None:
                    continue
                last = piece[end - length]
                ok = last < 0 or said.get(last << 32 | here)
                if ok is None:
                    if len(said) > 1 << 18:
                        said.clear()
                    ok = said[last << 32 | here] = self.apart(last, here)
                if ok:
                    found, step = here, length
                    break
            piece[end], back[end] = found, step
        path, end = [], len(unit)
        while end:
            path.append(piece[end])
            end -= back[end]
        path = np.array(path[::-1])
        return self._with_bytes(unit, path) if (path == -2).any() else path.astype("<u4").tobytes()

    def units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit, little-endian unsigned 32-bit."""
        cut = {u: self.segments(u) for u in units if len(u) > LONG}
        if not cut:
            return self.together(units)
        parts = {s for own in cut.values() for s in own}
        short = list(parts.union(u for u in units if u not in cut) - {s for s in parts if len(s) > LONG})
        known = dict(zip(short, self.together(short), strict=True))
        known |= {s: self.single(s) for s in parts if len(s) > LONG}
        return [b"".join([known[s] for s in cut[u]]) if u in cut else known[u] for u in units]

    def together(self, units: list[str]) -> list[bytes]:
        """``units`` for units that advance together, those of a length at once."""
        out: list = [b""] * len(units)
        size = np.array([len(u) for u in units], np.int64)
        grain = 1 << np.maximum(np.frexp(size)[1] - 3, 0) * (size > 12)
        padded = -(-size // grain) * grain  # up to 12 exact, beyond at most a quarter more
        order = np.argsort(padded, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(padded[order])) + 1):
            n = int(padded[own[0]]) if len(own) else 0
            step = max(1, (1 << 18) // (n + 16)) if n else len(own) + 1
            for at in range(0, len(own) if n else 0, step):
                some = own[at : at + step]
                text = "".join([units[i].ljust(n, "\0") for i in some]).encode("utf-32-le", "surrogatepass")
                piece, back = self.viterbi(np.frombuffer(text, "<u4").reshape(len(some), n).T.astype(np.uint64, order="C"))
                end, every, path = size[some].copy(), np.arange(len(some)), []
                while end.any():
                    path.append(np.where(end > 0, piece[end, every], -1))  # -1: before the start
                    end = np.maximum(end - back[end, every], 0)
                path = np.array(path[::-1]).T
                for row in np.flatnonzero((path == -2).any(axis=1)).tolist():
                    out[some[row]] = self._with_bytes(units[some[row]], path[row])
                plain = np.flatnonzero(~(path == -2).any(axis=1))
                here = path[plain] >= 0
                flat, ends = path[plain][here].astype("<u4").tobytes(), (4 * np.cumsum(here.sum(axis=1))).tolist()
                for i, a, b in zip(some[plain].tolist(), [0, *ends], ends):
                    out[i] = flat[a:b]
        return out

    def _with_bytes(self, unit: str, path: np.ndarray) -> bytes:
        """Ids of a unit some of whose characters, -2 in its path, are spelt in bytes."""
        ids, at = [], 0
        for i in path[path != -1].tolist():
            ids += [i] if i >= 0 else self.byte[list(unit[at].encode("utf-8", "surrogatepass"))].tolist()
            at += len(self.text[i]) if i >= 0 else 1
        return np.array(ids, "<u4").tobytes()

    @cached_property
    def spelt(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes that ids stand for, one after the other, and each id's start and size there."""
        raw = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.hidden else t.replace(META, " ").encode() for i, t in enumerate(self.text)]
        sizes = np.array([len(x) for x in raw])
        return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes

    def raw(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of ids, looked up for many ids at once."""
        table, starts, sizes = self.spelt
        out = []
        for at in range(0, len(ids), 1 << 16):
            some = ids[at : at + (1 << 16)]
            n = sizes[some]
            total = np.cumsum(n)
            out.append(table[np.repeat(starts[some] - (total - n), n) + np.arange(int(total[-1]))].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        parts, raw = [], bytearray()
        for i in ids.tolist():
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.hidden:
                parts.append(self.text[i])
        parts.append(raw.decode("utf-8", "replace"))
        text = "".join(parts).replace(META, " ")
        return text[1:] if text.startswith(" ") else text


@cache
def coder_of(model: str) -> Coder:
    """A worker's encoder, kept for all its tasks."""
    return Coder(model)


@cache
def pieces_of(model: str) -> Pieces:
    """A worker's tables, built once for all its tasks."""
    return Pieces(model)


def split_units(text: str) -> list[str]:
    return _UNIT.findall(META + text.replace(" ", META)) if text else []


def slabs(texts: pa.Array, size: int) -> Iterator[list]:
    """The texts as lists of about ``size`` bytes, one text at least."""
    at, ends = 0, np.cumsum(np.diff(utf8(texts)[1]))
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield texts.slice(at, end - at).to_pylist()
        at = end


class Coder:
    """An encoder that remembers the ids of units in about twice ``remembered`` bytes: units met since the memory was last
    full and those of the time before.  It encodes up to ``together`` units at once.  Neither changes a result."""

    def __init__(self, model: str = MODEL, remembered: int = 40 << 20, together: int = 1 << 17):
        self.pieces, self.remembered, self.together = pieces_of(model), remembered, together
        self.known, self.before, self.held = {}, {}, 0

    def lookup(self, units: list[str]) -> list[bytes]:
        if self.held > self.remembered:
            self.known, self.before, self.held = {}, self.known, 0
        known, before, new = self.known, self.before, []
        for u in {*units}.difference(known):
            ids = before.get(u)
            if ids is None:
                new.append(u)
            else:
                known[u] = ids
                self.held += 200 + len(u) + len(ids)
        found = self.pieces.units(new)
        known.update(zip(new, found, strict=True))
        self.held += sum(map(len, found)) + 2 * sum(map(len, new)) + 200 * len(new)
        return [known[u] for u in units]

    def __call__(self, texts: list) -> list[bytes]:
        """Ids of each text, a bounded number of units at a time."""
        out, rows, units = [[] for _ in texts], [], []

        def flush() -> None:
            got = self.lookup([u for own in units for u in own])
            at = 0
            for row, own in zip(rows, units, strict=True):
                out[row].append(b"".join(got[at : at + len(own)]))
                at += len(own)
            rows.clear()
            units.clear()

        waiting = 0
        for row, text in enumerate(texts):
            if not text:
                continue
            text = META + text.replace(" ", META)
            found = (m[0] for m in _UNIT.finditer(text)) if len(text) > self.together else _UNIT.findall(text)
            found = iter(found)
            while own := list(islice(found, self.together)):
                rows.append(row)
                units.append(own)
                waiting += len(own)
                if waiting >= self.together:
                    flush()
                    waiting = 0
        flush()
        return [b"".join(parts) for parts in out]


def encode(docs: DataFrame, model: str = MODEL, slab: int = 1 << 20) -> DataFrame:
    """``doc_id, text, ids, n_ids``: ids are little-endian unsigned 32-bit.  ``slab`` bounds the bytes of text that a
    worker splits at a time, which changes no result."""

    @F.arrow_udf("ids binary, n_ids long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = coder_of(model)
        for texts in batches:
            data = [d for some in slabs(texts, slab) for d in coder(some)]
            yield pa.StructArray.from_arrays([pa.array(data, pa.binary()), pa.array([len(d) // 4 for d in data], pa.int64())], ["ids", "n_ids"])

    return docs.select("doc_id", "text", run("text").alias("r")).select("doc_id", "text", "r.*")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the text of its ``ids``.

    Only rows with byte pieces that are no valid UTF-8 or with control pieces are put together one by one.
    """

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = pieces_of(model)
        for batch in batches:
            out = []
            for one in batch.fill_null(b""):
                ids = np.frombuffer(one.as_buffer(), "<u4")
                try:
                    text = pieces.raw(ids).decode()
                    out.append(text[1:] if text.startswith(" ") else text)
                except UnicodeDecodeError:
                    out.append(pieces.decode(ids))
            yield pa.array(out, pa.string())

    return encoded.withColumn("decoded", run("ids"))


def round_trip(docs: DataFrame, model: str = MODEL, slab: int = 1 << 20) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, exact``: whether decoding gives the text back, with U+2581 as a space.

    One function encodes, decodes and compares, so neither texts nor ids travel twice and a task keeps one worker.
    """

    @F.arrow_udf("n_ids long, ids_crc32 long, exact boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = coder_of(model)
        raw = coder.pieces.raw
        for texts in batches:
            rows = []
            for some in slabs(texts, slab):
                for text, ids in zip(some, coder(some), strict=True):
                    want = f" {text.replace(META, ' ')}".encode() if text else b""
                    rows.append((len(ids) // 4, zlib.crc32(ids), raw(np.frombuffer(ids, "<u4")) == want))
            n, crc, exact = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(exact, pa.bool_())]
            yield pa.StructArray.from_arrays(columns, ["n_ids", "ids_crc32", "exact"])

    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
