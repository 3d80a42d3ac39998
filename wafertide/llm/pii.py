"""Personal data: fixed patterns, and bootstrapped contextual extraction of identifiers that no fixed pattern knows.

Base spans are e-mail addresses, IPv4 addresses, card numbers and phone numbers.  Bootstrapping (after DIPRE, Brin
1998, and Basilisk, Thelen and Riloff 2002): every word is an instance, wherever it stands, and the one to three words
on its left and on its right are its lexical patterns.  White space (that of ASCII), quotes, brackets, commas,
semicolons and the signs ``#$*`<>`` part words, and a word ends behind its marks ``:`` and ``=``, so any of these may
stand before a value; base spans and values written in groups (``DE89 3704 0044``) are one word.  In a pattern a word
shows as its last ``word_length`` bytes (cut between characters), in lower case (A-Z), digits as 0.  Seeds are the base
spans and tokens of well-known credential shapes.  Rounds on the pattern-instance graph, which Spark aggregates over the
whole corpus: a pattern's confidence is the trusted share of all its instances, plain words included; an instance that
is no seed has the trust of its best accepted pattern.  A pattern is accepted with ``support`` distinct trusted
instances and ``confidence``; rounds run to the fixpoint.  Plain words never gain trust, so they are only counted, in a
second scan, and only for patterns with enough seeds and identifiers.  Behind or before an accepted pattern each
identifier-shaped token (four characters at least, a digit among them) becomes a span of kind ``id``.  Spans that touch
a base span are not added.

Both scans find the words of many texts at once in numpy, on bytes, so their time and memory are linear in the texts;
Python looks at single words only where they may be identifiers or seeds.

Defined results: a null text is an empty one and has no span.  Very long texts are scanned whole; an identifier above
``longest`` characters keeps its exact span and enters the graph by its digest.  Ties and repeated rows are judged each
for itself and count each in the graph.  An empty table gives no row.  Other columns are ignored, or kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, slabs, utf8, written

KINDS = ("email", "ip", "card", "phone", "id")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive runs from a run's first digit: later starts in it would meet the same end
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_SHAPE = re.compile(r"(?=[^0-9]*[0-9])[A-Za-z0-9._@+/=-]{4,}")
# values written in groups: account numbers like an IBAN, and digits
_GROUPS = re.compile(
    r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[0-9]{2,}(?: [0-9]{2,}){1,7})(?![A-Za-z0-9])"
)
#: What a byte is: 0 parts words, 1 is a mark at a word's end, 2 belongs to a word.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[list(b" \t\n\x0b\x0c\r,;<>\"'#$()*`{}[]")] = 0
_CLASS[list(b":=")] = 1
_SHOWN = np.arange(256, dtype=np.uint8)
_SHOWN[65:91] += 32
_SHOWN[48:58] = 48
_JOINED = np.where(_CLASS < 2, ord("_"), _SHOWN).astype(np.uint8)  # within a span that is one word
BITS = 26  # of the hash that preselects patterns to count
_MIX = np.uint64(0x9E3779B97F4A7C15)
SPAN = "array<struct<start:int,kind:int,end:int>>"
CANDIDATE = "array<struct<start:int,end:int,instance:string,level:int,patterns:array<string>>>"
PLAIN, IDENTIFIER, SEED = 0, 1, 2


@dataclass(frozen=True)
class Settings:
    words: int = 3
    word_length: int = 32  # bytes of a pattern's word, its last ones; a multiple of 8
    longest: int = 64  # characters of an instance that is kept as it is
    confidence: float = 0.8
    support: int = 3
    rounds: int = 1000  # a limit that raises, not an end
    epsilon: float = 1e-6
    seeds: str = r"AKIA[0-9A-Z]{16}|[0-9a-f]{32,64}"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ so that long runs without one cost nothing."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        tail, start = _DOMAIN.match(text, at), at
        if tail:
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
        if tail and start < at:
            out.append((start, tail.end()))
            last = tail.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, sorted."""
    out = [(s, 0, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def merged(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, level) of what is one word though it may hold several: base spans, and groups that touch none."""
    out: list[tuple[int, int, int]] = []
    for s, _, e in base:
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]), SEED)
        else:
            out.append((s, e, SEED))
    if not _DIGIT.search(text):
        return out
    groups, b = [], 0
    for m in _GROUPS.finditer(text):
        while b < len(out) and out[b][1] <= m.start():
            b += 1
        if b == len(out) or out[b][0] >= m.end():
            groups.append((m.start(), m.end(), IDENTIFIER))
    return sorted(out + groups)


class Words:
    """The words of a batch of texts: ``start`` and ``end`` in its bytes, ``row``, and ``shown``, the bytes in patterns.

    ``whole`` are byte ranges that are one word each.
    """

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, whole: list[tuple[int, int]], width: int):
        kind, self.shown, self.width = _CLASS[flat], _SHOWN[flat], width
        forced = np.zeros(len(flat) + 1, bool)
        for s, e in whole:
            kind[s:e], self.shown[s:e] = 2, _JOINED[flat[s:e]]
            forced[[s, e]] = True
        forced[offsets] = True
        forced, inside = forced[:-1], kind == 2
        begin = inside.copy()
        begin[1:] &= kind[:-1] < 2
        lone = kind == 1
        lone[1:] &= kind[:-1] == 0
        begin |= lone | (forced & (kind > 0))
        stops = np.append(np.flatnonzero(begin | forced | (kind == 0)), len(flat))
        at = np.flatnonzero(begin[stops[:-1]])
        self.start, self.end = stops[at], stops[at + 1]
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(self.start, offsets)))
        self.first = np.maximum(self.start, self.end - width)  # of the bytes shown
        for _ in range(3):
            self.first += ((flat[self.first] & 0xC0) == 0x80) & (self.first > self.start)

    def form(self, i: int) -> str:
        return self.shown[self.first[i] : self.end[i]].tobytes().decode("utf-8", "replace")

    def hashes(self) -> np.ndarray:
        return word_hashes(self.shown, self.first, self.end, self.width)


def word_hashes(shown: np.ndarray, first: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each range of at most ``width`` bytes."""
    padded, out, nth = np.concatenate([np.zeros(width, np.uint8), shown]), np.empty(len(end), np.uint64), np.arange(width)
    for at in range(0, len(end), 1 << 14):
        here, size = end[at : at + (1 << 14)], (end - first)[at : at + (1 << 14)]
        cells = padded[here[:, None] + nth]
        cells[nth < width - size[:, None]] = 0
        h = size.astype(np.uint64)
        for part in cells.view("<u8").T:
            h = _mixed(h, part)
        out[at : at + (1 << 14)] = h
    return out


def _mixed(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    h = (h ^ more) * _MIX
    return h ^ (h >> np.uint64(29))


_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A5F00DCAFE1235)  # a pattern's side, where its hash starts


def pattern_hash(pattern: str, width: int) -> int:
    """The hash of a pattern such as ``send to _``: its words' hashes mixed in from the nearest to the farthest."""
    words, side = (pattern[2:].split(" "), _RIGHT) if pattern.startswith("_ ") else (pattern[:-2].split(" ")[::-1], _LEFT)
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    hashes = word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends, width)
    h = np.array([side])
    for i in range(len(hashes)):
        h = _mixed(h, hashes[i : i + 1])
    return int(h.view(np.int64)[0])


def examined(texts: pa.Array, cfg: Settings) -> tuple[list, dict[int, int], Words, np.ndarray, np.ndarray]:
    """Base spans of each text, levels of the words that are whole spans by first byte, all words, bytes and offsets."""
    flat, offsets = utf8(texts)
    bases, whole, levels = [], [], {}
    for row, text in enumerate(texts.to_pylist()):
        bases.append(base_spans(text) if text else [])
        spans = merged(text, bases[-1]) if text else []
        if spans:
            low, place = int(offsets[row]), None
            if not text.isascii():
                own = flat[offsets[row] : offsets[row + 1]]
                place = np.append(np.flatnonzero((own & 0xC0) != 0x80), len(own))
            for s, e, level in spans:
                s, e = (low + s, low + e) if place is None else (low + int(place[s]), low + int(place[e]))
                whole.append((s, e))
                levels[s] = level
    return bases, levels, Words(flat, offsets, whole, cfg.word_length), flat, offsets


def instances(texts: pa.Array, cfg: Settings, seed: re.Pattern) -> tuple[list, list]:
    """Per text its base spans, and (start, end, instance, level, patterns) of every seed and identifier-shaped word."""
    bases, levels, words, flat, offsets = examined(texts, cfg)
    found: list[list] = [[] for _ in bases]
    if not len(words.start):
        return bases, found
    digit = (flat - np.uint8(48)) < 10
    bounds = np.column_stack([words.start, words.end]).ravel()
    some = np.logical_or.reduceat(np.append(digit, False), bounds)[::2] | (words.end - words.start >= 20)
    some[np.searchsorted(words.start, list(levels))] = True
    shown, row, place = {}, -1, None

    def form(i: int) -> str:
        if i not in shown:
            shown[i] = words.form(i)
        return shown[i]

    for i in np.flatnonzero(some).tolist():
        start, end = int(words.start[i]), int(words.end[i])
        if words.row[i] != row:
            row = int(words.row[i])
            low, high, place = int(offsets[row]), int(offsets[row + 1]), None
            begin, stop = np.searchsorted(words.row, [row, row + 1]).tolist()
            shown.clear()
        level = levels.get(start)
        met = level == SEED
        value = flat[start:end].tobytes().decode("utf-8", "replace")
        if level is None:
            # a mark ends a word that a value follows; at a word's end, = may fill a value up
            if value[-1] == "=" and end < high and flat[end] not in b" \t\n\x0b\x0c\r":
                value = value.rstrip(":=")
            value = value.rstrip(".:!?")
            if seed.fullmatch(value):
                level = SEED
            elif _SHAPE.fullmatch(value):
                level = IDENTIFIER
            else:
                continue
            end = start + len(value.encode())
        if place is None:
            place = np.cumsum((flat[low:high] & 0xC0) != 0x80, dtype=np.int32) if (flat[low:high] > 127).any() else False
        s, e = (start - low, end - low) if place is False else (int(place[start - low]) - 1, int(place[end - 1 - low]))
        left = [form(j) for j in range(max(begin, i - cfg.words), i)]
        right = [form(j) for j in range(i + 1, min(stop, i + 1 + cfg.words))]
        patterns = [" ".join(left[-k:]) + " _" for k in range(1, len(left) + 1)]
        patterns += ["_ " + " ".join(right[:k]) for k in range(1, len(right) + 1)]
        name = value.lower() if len(value) <= cfg.longest else hashlib.sha256(value.lower().encode()).hexdigest()
        found[row].append((s, e, name, level + 4 * met, patterns))
    return bases, found


def marked(docs: DataFrame, keep: list, name: str, cfg: Settings = Settings()) -> DataFrame:
    """``keep`` columns and a struct ``name``: ``spans`` (base) and ``found`` (seeds and identifiers)."""

    @F.arrow_udf(f"spans {SPAN}, found {CANDIDATE}")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seed = re.compile(cfg.seeds)
        span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        candidate = pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("level", pa.int32()), ("patterns", pa.list_(pa.string()))]
        )
        for texts in batches:
            spans, found = [], []
            for some in slabs(texts):
                bases, got = instances(some, cfg, seed)
                spans += [[{"start": s, "kind": k, "end": e} for s, k, e in base] for base in bases]
                found += [[dict(zip(candidate.names, x, strict=True)) for x in own] for own in got]
            yield pa.StructArray.from_arrays([pa.array(spans, span), pa.array(found, pa.list_(candidate))], ["spans", "found"])

    return docs.select(*keep, scan(F.col("text")).alias(name))


def settled(edges: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """``pattern`` of the accepted patterns at the fixpoint, from ``pattern, instance, n, level``.

    Trust only rises, so rounds run until no pattern is newly accepted and no confidence rises by more than ``epsilon``.
    """
    before = None
    for _ in range(cfg.rounds):
        trust = F.when(F.col("level") == SEED, 1.0).otherwise(0.0)
        graph = edges
        if before is not None:
            known = edges.where(F.col("level") == IDENTIFIER).join(before.where("good"), "pattern")
            known = known.groupBy("instance").agg(F.max("confidence").alias("best"))
            graph = edges.join(known, "instance", "left")
            trust = F.greatest(trust, F.when(F.col("level") == IDENTIFIER, F.coalesce("best", F.lit(0.0))).otherwise(0.0))
        scored = graph.withColumn("trust", trust).groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("trust")) / F.sum("n")).alias("confidence"),
            F.count_if(F.col("trust") >= cfg.confidence).alias("support"),
        )
        good = (F.col("confidence") >= cfg.confidence) & (F.col("support") >= cfg.support)
        now = written(scored.select("pattern", "confidence", good.alias("good")), "scored")
        if before is None:
            moved = now.where("good")
        else:
            last = before.select("pattern", F.col("confidence").alias("was"), F.col("good").alias("had"))
            moved = now.join(last, "pattern").where((F.col("good") & ~F.col("had")) | (F.col("confidence") - F.col("was") > cfg.epsilon))
        if not moved.limit(1).count():
            return now.where("good").select("pattern")
        before = now
    raise RuntimeError(f"patterns have not settled in {cfg.rounds} rounds")


def totals(docs: DataFrame, wanted: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """``pattern, total``: all words of ``docs`` in each wanted pattern.

    Patterns are counted by a 64-bit hash.  Workers get a bitmap of the wanted ones' hashes, whose size is fixed, and
    count what it lets through; the join then drops the others.  A pattern's words extend those of a shorter one, which
    has its instances and more and is so wanted too; so the longer ones are only looked up behind a hit.
    """
    spark = docs.sparkSession

    @F.arrow_udf("long")
    def hashed(patterns: pa.Array) -> pa.Array:
        return pa.array([pattern_hash(p, cfg.word_length) for p in patterns.to_pylist()], pa.int64())

    keyed = written(wanted.select("pattern", hashed(F.col("pattern")).alias("h")), "wanted-hashes")
    place = F.col("h").bitwiseAND((1 << BITS) - 1)
    cells = keyed.groupBy(F.shiftright(place, 6).cast("int").alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    dense, got = np.zeros(1 << (BITS - 6), np.int64), cells.toArrow()  # at most 2 ** (BITS - 6) rows
    dense[got.column("cell").to_numpy()] = got.column("bits").to_numpy()
    sent = spark.sparkContext.broadcast(dense.tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, counts, mask = np.frombuffer(sent.value, np.uint64), {}, np.uint64((1 << BITS) - 1)

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["h", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for texts in slabs(batch.column(0)):
                words = examined(texts, cfg)[2]
                own, row, last = words.hashes(), words.row, len(words.start) - 1
                met = []
                for side, step in ((_LEFT, -1), (_RIGHT, 1)):
                    # the pattern's nearest word, whose neighbour on the other side is the instance
                    at = np.arange(1, last + 1) if step > 0 else np.arange(0, last)
                    at = at[row[at] == row[at - step]]
                    h = np.full(len(at), side)
                    for k in range(cfg.words):
                        if k:
                            inside = (at + step >= 0) & (at + step <= last)
                            at, h = at[inside] + step, h[inside]
                            same = row[at] == row[at - step]
                            at, h = at[same], h[same]
                        h = _mixed(h, own[at])
                        low = h & mask
                        hit = (bitmap[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1
                        at, h = at[hit], h[hit]
                        met.append(h)
                names, times = np.unique(np.concatenate(met).view(np.int64), return_counts=True)
                for name, n in zip(names.tolist(), times.tolist(), strict=True):
                    counts[name] = counts.get(name, 0) + n
                if len(counts) > 100_000:
                    yield out()
        yield out()

    counted = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("total"))
    return keyed.join(counted, "h").select("pattern", "total")


def learn(found: DataFrame, docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """``pattern`` of the accepted lexical patterns, from rows with an array ``found`` and the texts that it comes from.

    Patterns that could not be accepted if all their seeds and identifiers were trusted leave the graph at once.
    """
    edges = found.select(F.explode("found").alias("c")).select(
        F.explode("c.patterns").alias("pattern"), F.col("c.instance").alias("instance"), (F.col("c.level") % 4).alias("level")
    )
    edges = written(edges.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("level").alias("level")), "patterns")
    wanted = edges.groupBy("pattern").agg(F.sum("n").alias("known"), F.count("*").alias("most")).where(F.col("most") >= cfg.support)
    wanted = written(wanted.select("pattern", "known"), "wanted")
    able = wanted.join(totals(docs, wanted, cfg), "pattern").where(F.col("known") / F.col("total") >= cfg.confidence)
    able = written(able, "able")
    plain = able.select("pattern", F.lit(None).cast("string").alias("instance"), (F.col("total") - F.col("known")).alias("n"), F.lit(PLAIN).alias("level"))
    return settled(written(edges.join(able.select("pattern"), "pattern").unionByName(plain.where("n > 0")), "graph"), cfg)


def added(rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """``row, more``: new spans of rows with ``row, found``; identifiers in an accepted pattern."""
    tokens = rows.select("row", F.explode("found").alias("c")).where(F.col("c.level").isin(IDENTIFIER, SEED))
    tokens = tokens.select("row", "c.start", "c.end", F.explode("c.patterns").alias("pattern")).join(accepted, "pattern", "left_semi")
    span = F.struct(F.col("start"), F.lit(len(KINDS) - 1).alias("kind"), F.col("end"))
    return tokens.groupBy("row").agg(F.collect_set(span).alias("more"))


def _joined(spans) -> F.Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, base counts, ``base_sha256`` and all ``spans``."""
    rows = marked(docs, ["doc_id"], "m", cfg).select(F.monotonically_increasing_id().alias("row"), "doc_id", "m.*")
    rows = written(rows, "pii")
    more = added(rows, learn(rows, docs, cfg))
    full = rows.drop("found").join(more, "row", "left")
    every = F.sort_array(F.concat("spans", F.coalesce("more", F.array().cast(SPAN))))
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = {k})")).cast("long").alias(f"n_{n}") for k, n in enumerate(KINDS[:-1])]
    return full.select("doc_id", *counts, F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"), _joined(every).alias("spans"))


def masked(text: str, spans: list[dict]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are masked as one, by the first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], s["kind"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The documents, all columns, with the spans masked in ``text`` and ``n_chars`` (if there) counted anew.

    Rows are numbered in a written copy, so that spans found by the learned patterns meet their texts again; texts
    without any span pass by the masking.
    """
    row, m, spans = fresh(docs, "row", "__pii", "__spans")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = marked(docs, names, m, cfg).withColumn(row, F.monotonically_increasing_id())
    rows = written(rows, "pii-texts")
    small = rows.select(F.col(row).alias("row"), F.col(f"{m}.found").alias("found"))
    more = written(added(small, learn(small, rows, cfg)).select(F.col("row").alias(row), F.col("more").alias(spans)), "more-spans")
    every = F.concat(f"{m}.spans", F.coalesce(spans, F.array().cast(SPAN)))

    @F.arrow_udf("string")
    def mask(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            pairs = zip(texts.to_pylist(), lists.to_pylist(), strict=True)
            yield pa.array([masked(t, s) if t and s else t for t, s in pairs], pa.string())

    full = rows.join(more, row, "left")
    text = mask(F.col("text"), every)
    shown = full.withColumn("text", text).select(*names)
    if "n_chars" in docs.columns:
        shown = shown.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return shown
