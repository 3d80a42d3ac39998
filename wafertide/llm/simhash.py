"""SimHash near-duplicates with covering locality-sensitive hashing (Pagh, 2016).

Fingerprints: a text's words are cut into shingles of four; a bit of the fingerprint is set where more than half of
the shingles' hashes set it.

Covering masks for radius r: each bit position gets a nonzero vector of r + 1 bits; the table of a nonzero vector v
drops the positions whose vectors are orthogonal to v.  For any r differing positions some v is orthogonal to all
their vectors, so that table drops every difference: each pair within the radius meets in some table.  With 64 bits
and r = 4 the 31 tables keep about half of the bits each.

Equal fingerprints are one node.  Only buckets with two or more nodes go on; a bucket above ``most`` nodes is dealt
into blocks, and each pair of blocks is one unit of work.  A unit emits a spanning forest of its links, never all
pairs, so a group of g near copies yields about g edges.

Defined results: a null, empty or blank text has no shingle and fingerprint zero, which links like any other.
Repeated rows are copies of each other.  A null id keeps its fingerprint and gets its group's smallest id.  An empty
table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, meet, utf8, written
from .graph import components

BITS = 64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def masks(radius: int) -> list[int]:
    """The covering tables' masks as unsigned 64-bit numbers, whose set bits are kept."""
    top = 1 << (radius + 1)
    vectors = [1 + i % (top - 1) for i in range(BITS)]
    return [sum(1 << i for i, a in enumerate(vectors) if bin(a & v).count("1") % 2) for v in range(1, top)]


def shingle_bounds(flat: np.ndarray, offsets: np.ndarray, words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with words joined by single spaces, and the start, end and row of every shingle there."""
    rows = len(offsets) - 1
    blank = _SPACE[flat]
    inside = ~blank
    first = inside.copy()
    if len(flat):
        first[1:] &= blank[:-1]
        begins = offsets[:-1][(offsets[:-1] < len(flat)) & (np.diff(offsets) > 0)]
        first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    row = np.searchsorted(offsets, starts, side="right") - 1
    # a space replaces the white space before each word, so the kept bytes are the words' and one for each later word
    lead = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(inside, out=lead[1:])
    nth = np.arange(len(starts))
    new_start = lead[starts] + nth
    ends = np.append(starts[1:], len(flat))
    new_end = lead[ends] + nth
    joined = np.full(int(lead[-1]) + len(starts), 0x20, np.uint8)
    joined[np.repeat(new_start - lead[starts], new_end - new_start) + np.arange(int(lead[-1])) if len(starts) else []] = _LOWER[
        flat[inside]
    ]
    count = np.bincount(row, minlength=rows)
    base = np.cumsum(count) - count
    shingles = np.where(count > 0, np.maximum(1, count - words + 1), 0)
    owner = np.repeat(np.arange(rows), shingles)
    at = base[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = np.minimum(at + words, base[owner] + count[owner]) - 1
    return joined.tobytes(), new_start[at], new_end[last], owner


def fingerprints(texts: pa.Array, words: int = 4, seed: int = 42) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text."""
    from xxhash import xxh64_intdigest

    flat, offsets = utf8(texts)
    rows = len(offsets) - 1
    out = np.zeros(rows, np.uint64)
    shifts = np.arange(BITS, dtype=np.uint64)
    row = 0
    while row < rows:  # slabs of about 1 MB bound the expanded bits
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + (1 << 20), side="right")) - 1)
        data, start, end, owner = shingle_bounds(flat[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], words)
        hashes = np.fromiter(
            (xxh64_intdigest(data[s:e], seed) for s, e in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(start)
        )
        total = np.bincount(owner, minlength=last - row)
        ones = np.zeros((last - row, BITS), np.int64)
        for at in range(0, len(hashes), 1 << 16):
            part, own = hashes[at : at + (1 << 16)], owner[at : at + (1 << 16)]
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            ones[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
        out[row:last] = ((2 * ones > total[:, None]).astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)
        row = last
    return out


def with_fingerprint(docs: DataFrame, keep: tuple, name: str = "fp", words: int = 4, seed: int = 42) -> DataFrame:
    """``keep`` columns and the fingerprint of ``text`` as a signed long."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(fingerprints(texts, words, seed).view(np.int64))

    return docs.select(*keep, of(F.col("text")).alias(name))


def forest(fps: np.ndarray, side: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Indices of a spanning forest of the links within ``radius``; with ``side``, of those between two sides.

    Breadth first: each reached node is compared with the nodes that are not yet reached, so a dense group is cheap.
    """
    edges, left = [], np.arange(len(fps))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[i]) <= radius
            if side is not None:
                near &= side[left] != side[i]
            if near.any():
                edges += [(int(i), int(j)) for j in left[near]]
                queue += left[near].tolist()
                left = left[~near]
    return edges


def runs(keys: list[np.ndarray]) -> np.ndarray:
    """Starts of the runs of equal rows of sorted keys, and the end."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), n)


def links(nodes: DataFrame, radius: int = 4, most: int = 32768) -> DataFrame:
    """Edges ``a, b`` between the distinct fingerprints ``fp`` of ``nodes``: a spanning set of all links in the radius."""
    tables = masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in tables]
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("t", "key"))
    crowd = keyed.groupBy("t", "key").count().where("count > 1")
    blocks = F.ceil(F.col("count") / F.lit(most)).cast("int")
    # buckets are many times the nodes that they are made of, which the planner doesn't see; they must not be broadcast
    members = keyed.join(crowd.hint("merge"), ["t", "key"]).withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    cells = members.select(
        "t", "key", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("t", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp")

    def solve(keys: tuple, part: pa.RecordBatch) -> list:
        fps = part["fp"].view(np.uint64)
        side = None if part["i"][0] == part["j"][0] else part["block"]
        return [(int(part["fp"][a]), int(part["fp"][b])) for a, b in forest(fps, side, radius)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rest = ["t", "key", "i", "j", "block", "fp"], None
        seen = iter(batches)
        while True:
            batch = next(seen, None)
            if batch is not None:
                now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
                rest = now if rest is None else {c: np.concatenate([rest[c], now[c]]) for c in names}
            if rest is None:
                return
            cut = runs([rest[c] for c in names[:4]])
            whole = len(cut) - (1 if batch is None else 2)  # the last run may go on in the next batch
            found = []
            sizes = np.diff(cut)
            for k in np.flatnonzero(sizes[: max(0, whole)] > 1):
                found += solve((), {c: rest[c][cut[k] : cut[k + 1]] for c in names})
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            if batch is None:
                return
            rest = {c: rest[c][cut[max(0, whole)] :] for c in names}

    dealt = cells.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j", "fp")
    return dealt.mapInArrow(scan, "a long, b long").distinct()


def grouped(marked: DataFrame, radius: int = 4) -> DataFrame:
    """``fp, copies, component_id`` for the distinct fingerprints of ``marked`` (``doc_id, fp``)."""
    n = marked.count()
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "fingerprints", n)
    roots = components(links(nodes.select("fp"), radius), "a", "b")
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = written(placed, "placed", n)
    least = written(placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("size")), "least", n)
    return written(meet(placed, least, ["root"], "size").select("fp", "copies", "component_id"), "groups", n)


def near_duplicates(docs: DataFrame, radius: int = 4) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    marked = written(with_fingerprint(docs, ("doc_id",)), "simhash")
    return meet(marked, grouped(marked, radius), ["fp"], "copies").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, radius: int = 4) -> DataFrame:
    """The documents, all columns, without all but the first id of each group; repeated rows of it stay once.

    Rows without an id stay only where their whole group has none, once for each fingerprint.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    fp, group = fresh(docs, "__fp", "__group")
    marked = written(with_fingerprint(docs, ("doc_id",)), "simhash")
    found = grouped(marked, radius)
    losers = written(
        meet(marked, found, ["fp"], "copies")
        .where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("first"))
        .where("not first")
        .select("doc_id"),
        "losers",
    )  # ids that are first of no group; its size on disk decides whether texts have to be shuffled
    repeated = marked.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count() > 0
    kept = docs.join(losers, "doc_id", "left_anti").select(*names)
    if not repeated:
        return kept
    again = with_fingerprint(kept, tuple(names), fp)
    again = again.join(found.select(F.col("fp").alias(fp), F.col("component_id").alias(group)), fp)
    return again.where(F.col("doc_id").eqNullSafe(F.col(group))).dropDuplicates(["doc_id", fp]).select(*names)
