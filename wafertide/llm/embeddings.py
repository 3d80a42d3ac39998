"""Embedding near-duplicates with a pivot-permutation index (Chavez et al., 2008; Amato and Savino, 2008).

Equal vectors form one class.  Pivots are spread over a bounded sample of the vectors (``sample`` rows by hash); every
class is described by its ``nearest`` pivots in order.  An inverted list belongs to two pivots and holds the classes
that have both among their first ``prefix`` ones, so the order decides where a class is looked for, and lists stay
short as the number of pivots grows with the square root of the classes.  Two classes of a list are candidates if they
share ``shared`` of their nearest pivots; the list of their smallest common pair counts them.

Lists carry ids and pivots only.  A list's candidates go on as pairs, which fetch their two vectors and are verified by
cosine in double precision.  A list with more than ``dense`` candidates for each member would emit about all pairs of
a group; it fetches its members' vectors instead, verifies inside the task, and returns sums of links and a spanning
forest.  A list above ``most`` classes is dealt into blocks, and each pair of blocks is one unit of work, so a hot list is
spread over tasks.

Vectors are divided by their largest component before their norm, so that very small and very large ones neither
vanish nor overflow.

Defined results: a null, empty or zero vector, or one with a null or non-finite component, links with nothing and is
its own component.  Vectors of different lengths never link.  Repeated rows are vectors of their own.  A row without
an id links, but its id is never a component's smallest.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import meet, written
from .graph import components
from .simhash import runs

NONE = 0xFFFF  # no pivot
UNIT = ["key", "i", "j"]
PAIRS = "dense boolean, a long, b long, c long"
LINKS = "edge boolean, a long, b long"


@dataclass(frozen=True)
class Settings:
    """``nearest`` pivots describe a vector, the first ``prefix`` of them, two at a time, are its lists.  There are
    ``growth`` times the square root of the classes' number of pivots, within ``fewest_pivots`` and ``most_pivots``."""

    least: float = 0.95
    nearest: int = 12
    prefix: int = 6
    shared: int = 4
    growth: float = 4.0
    fewest_pivots: int = 32
    most_pivots: int = 4096
    sample: int = 16384
    most: int = 2048
    dense: int = 8
    seed: int = 3


def valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision, whatever their size."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def choose_pivots(vectors: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Up to ``n`` unit vectors, each as far as possible from those before."""
    unit = units(vectors)
    order = [int(np.random.default_rng(seed).integers(len(unit)))]
    close = unit @ unit[order[0]]
    while len(order) < min(n, len(unit)):
        order.append(int(close.argmin()))
        close = np.maximum(close, unit @ unit[order[-1]])
    return unit[order]


def dense_rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def describe(vectors: pa.Array, pivots: dict[int, np.ndarray], cfg: Settings) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each vector's nearest pivots in order, and the keys of its lists."""
    near, keys = np.full((len(vectors), cfg.nearest), NONE, np.uint16), [np.empty(0, np.int64)] * len(vectors)
    lengths = np.diff(vectors.offsets.to_numpy())
    for d in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == d)
        if d in pivots:
            close = units(dense_rows(vectors.take(pa.array(own)))) @ pivots[d].T
            top = np.argsort(-close, axis=1, kind="stable")[:, : cfg.nearest]
        else:
            top = np.zeros((len(own), 1), np.int64)  # a length without sampled vectors has one list
        near[own, : top.shape[1]] = top
        first = np.sort(top[:, : cfg.prefix].astype(np.int64), axis=1)
        both = list(combinations(range(first.shape[1]), 2)) or [(0, 0)]
        made = np.column_stack([(d << 32) | (first[:, a] << 16) | first[:, b] for a, b in both])
        for i, row in zip(own.tolist(), made):
            keys[i] = row
    return near, keys


def candidates(near: np.ndarray, part: dict, cfg: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one unit of work that share enough pivots and whose smallest common pair is this list's."""
    key, i, j = (int(part[c][0]) for c in UNIT)
    low, high, same = key >> 16 & 0xFFFF, key & 0xFFFF, i == j
    a, b = (np.flatnonzero(part["block"] == x) for x in (i, j))
    names, place = np.unique(near, return_inverse=True)
    member = np.zeros((len(near), len(names)), np.float32)
    np.put_along_axis(member, place.reshape(near.shape), 1.0, axis=1)
    member[:, names == NONE] = 0
    need = min(cfg.shared, int((near[0] != NONE).sum()))
    first = near[:, : cfg.prefix]
    for at in range(0, len(a), 256):
        rows = a[at : at + 256]
        x, y = np.nonzero(member[rows] @ member[b].T >= need)
        x, y = rows[x], b[y]
        if same:
            x, y = x[x < y], y[x < y]
        for k in range(0, len(x), 1 << 16):
            p, q = x[k : k + (1 << 16)], y[k : k + (1 << 16)]
            own = first[p]
            before = (own < low) | ((own > low) & (own < high))
            p, q = (z[~(before & (own[:, :, None] == first[q][:, None, :]).any(axis=2)).any(axis=1)] for z in (p, q))
            if len(p):
                yield p, q


def short_lists(part: dict, starts: np.ndarray, sizes: np.ndarray, cfg: Settings) -> pa.RecordBatch | None:
    """``candidates`` of many units of few classes at once, as pairs of classes."""
    near, key, block, k = part["near"], part["key"], part["block"], part["k"]
    across, found = part["i"] != part["j"], []
    for n in np.unique(sizes).tolist():
        x, y = np.triu_indices(n, 1)
        own = starts[sizes == n][:, None]
        p, q = (own + x).ravel(), (own + y).ravel()
        use = ~across[p] | (block[p] != block[q])
        p, q = p[use], q[use]
        for at in range(0, len(p), 1 << 14):
            a, b = p[at : at + (1 << 14)], q[at : at + (1 << 14)]
            same = (near[a][:, :, None] == near[b][:, None, :]) & (near[a] != NONE)[:, :, None]
            need = np.minimum(cfg.shared, (near[a] != NONE).sum(axis=1))
            low, high, first = key[a][:, None] >> 16 & 0xFFFF, key[a][:, None] & 0xFFFF, near[a][:, : cfg.prefix]
            before = same[:, : cfg.prefix, : cfg.prefix].any(axis=2) & ((first < low) | ((first > low) & (first < high)))
            hit = (same.sum(axis=(1, 2)) >= need) & ~before.any(axis=1)
            found.append((k[a[hit]], k[b[hit]]))
    a, b = (np.concatenate([f[s] for f in found]) if found else np.empty(0, np.int64) for s in (0, 1))
    if not len(a):
        return None
    return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(a), bool)), pa.array(a), pa.array(b), pa.array(np.zeros(len(a), np.int64))], ["dense", "a", "b", "c"])


def settle(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[p], label[q])
        np.minimum.at(label, p, low)
        np.minimum.at(label, q, low)
        label = label[label]
        if (label == before).all():
            return label


def counted(cfg: Settings) -> Callable:
    """One unit's candidates as pairs of classes, or the unit itself if they are too many."""

    def solve(part: dict) -> pa.RecordBatch | None:
        near, k = part["near"], part["k"]
        found, n = [], 0
        for p, q in candidates(near, part, cfg):
            found.append((p, q))
            n += len(p)
            if n > cfg.dense * len(k):
                one = [np.array([int(part[c][0])]) for c in UNIT]
                return pa.RecordBatch.from_arrays([pa.array([True]), *map(pa.array, one)], ["dense", "a", "b", "c"])
        if not n:
            return None
        p, q = (np.concatenate([f[s] for f in found]) for s in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(n, bool)), pa.array(k[p]), pa.array(k[q]), pa.array(np.zeros(n, np.int64))], ["dense", "a", "b", "c"])

    return solve


def linked(cfg: Settings) -> Callable:
    """One dense unit's sums of links and a spanning forest of its links."""

    def solve(part: dict) -> pa.RecordBatch | None:
        near, k = part["near"], part["k"]
        unit, pairs = units(dense_rows(part["vector"])), []
        for p, q in candidates(near, part, cfg):
            hit = np.einsum("ij,ij->i", unit[p], unit[q]) >= cfg.least
            pairs.append((p[hit], q[hit]))
        p, q = (np.concatenate([x[s] for x in pairs]) if pairs else np.empty(0, int) for s in (0, 1))
        if not len(p):
            return None
        size = len(k)
        links = np.bincount(p, part["copies"][q], size) + np.bincount(q, part["copies"][p], size)
        label, hit = settle(size, p, q), np.flatnonzero(links)
        child = np.flatnonzero(label != np.arange(size))
        edge = np.repeat([False, True], [len(hit), len(child)])
        left = k[np.concatenate([hit, child])]
        right = np.concatenate([links[hit].astype(np.int64), k[label[child]]])
        return pa.RecordBatch.from_arrays([pa.array(edge), pa.array(left), pa.array(right)], ["edge", "a", "b"])

    return solve


def by_unit(cells: DataFrame, solve: Callable, schema: str, cfg: Settings, together: Callable | None = None) -> DataFrame:
    """``solve`` applied to the rows of each unit of work, or ``together`` to all units of a batch that are too small to be
    dense; a task holds one unit and one batch at a time."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, seen = [], iter(batches)
        while True:
            batch = next(seen, None)
            rest += [batch] if batch is not None and len(batch) else []
            if not rest:
                if batch is None:
                    return
                continue
            whole = pa.Table.from_batches(rest).combine_chunks()
            part = {c: whole.column(c).to_numpy() for c in (*UNIT, "block", "k", "copies") if c in whole.column_names}
            packed = whole.column("near").combine_chunks()
            ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
            part["near"] = np.frombuffer(packed.buffers()[2], np.uint8)[ends[0] : ends[-1]].view("<u2").reshape(len(packed), -1)
            cut = runs([part[c] for c in UNIT])
            starts = cut[: -1 if batch is None else -2]
            sizes = np.diff(cut)[: len(starts)]
            few = sizes <= (2 * cfg.dense if together else 0)
            out = [together(part, starts[few & (sizes > 1)], sizes[few & (sizes > 1)], cfg)] if together else []
            for at, n in zip(starts[~few & (sizes > 1)].tolist(), sizes[~few & (sizes > 1)].tolist()):
                one = {c: v[at : at + n] for c, v in part.items()}
                if "vector" in whole.column_names:
                    one["vector"] = whole.slice(at, n).column("vector").combine_chunks()
                out.append(solve(one))
            if out := [x for x in out if x is not None]:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            if batch is None:
                return
            rest = whole.slice(cut[-2]).to_batches()

    return cells.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(scan, schema)


def lists(described: DataFrame, cfg: Settings) -> DataFrame:
    """One row for each class and unit of work: ``key, i, j, block, k, near``; lists of one class are left out."""
    listed = described.select(F.explode("keys").alias("key"), "k", "near")
    counts = described.select(F.explode("keys").alias("key")).groupBy("key").count().where("count > 1")
    counts = counts.select("key", F.ceil(F.col("count") / cfg.most).cast("int").alias("blocks"))
    # lists are many times the rows that they are made of, which the planner doesn't see; they must not be broadcast
    cells = listed.join(counts.hint("merge"), "key").withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cells.select("key", F.least("block", "other").cast("long").alias("i"), F.greatest("block", "other").cast("long").alias("j"), "block", "k", "near")


def close(cfg: Settings) -> Column:
    """Whether the vectors of columns ``va`` and ``vb`` reach the least cosine."""

    @F.arrow_udf("boolean")
    def test(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for one, two in batches:
            out, lengths = np.zeros(len(one), bool), np.diff(one.offsets.to_numpy())
            for d in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == d)
                x, y = (units(dense_rows(c.take(pa.array(own)))) for c in (one, two))
                out[own] = np.einsum("ij,ij->i", x, y) >= cfg.least
            yield pa.array(out)

    return test(F.col("va"), F.col("vb"))


def near_duplicates(table: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    spark = table.sparkSession
    kind = table.schema["embedding"].dataType.simpleString()
    own = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    # equal vectors have equal hashes of 128 bits, which name their class wherever the vector itself is not needed
    rows = table.select("vec_id", own.alias("vector")).withColumn("known", valid(F.col("vector")))
    rows = rows.withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit(cfg.seed), "vector")})
    classes = rows.where("known").groupBy("h", "g").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    classes = written(classes.withColumn("k", F.monotonically_increasing_id()), "vectors")
    n = classes.count()
    picked = classes.orderBy(F.xxhash64("h", F.lit(cfg.seed)), "k").limit(cfg.sample).select("vector").toArrow().column("vector").combine_chunks()
    many = int(min(cfg.most_pivots, max(cfg.fewest_pivots, round(cfg.growth * n**0.5))))
    sizes = np.diff(picked.offsets.to_numpy()) if len(picked) else np.empty(0, int)
    pivots = {d: choose_pivots(dense_rows(picked.take(pa.array(np.flatnonzero(sizes == d)))), many, cfg.seed) for d in np.unique(sizes).tolist()}
    shared = spark.sparkContext.broadcast(pivots)  # most_pivots vectors of each length in the sample at most

    @F.arrow_udf("near binary, keys array<long>")
    def index(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            near, keys = describe(vectors, shared.value, cfg)
            yield pa.StructArray.from_arrays([pa.array([r.tobytes() for r in near], pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["near", "keys"])

    described = written(classes.select("k", index("vector").alias("x")).select("k", "x.near", "x.keys"), "permutations")
    found = written(by_unit(lists(described, cfg), counted(cfg), PAIRS, cfg, short_lists), "candidates")
    vectors = classes.select("k", "copies", "vector")
    pairs = found.where("not dense").select("a", "b")
    pairs = pairs.join(vectors.toDF("a", "na", "va"), "a").join(vectors.toDF("b", "nb", "vb"), "b").withColumn("near", close(cfg)).where("near")
    pairs = written(pairs.select("a", "b", "na", "nb"), "vector-pairs")
    sums = pairs.select(F.col("a").alias("k"), F.col("nb").alias("n")).unionByName(pairs.select(F.col("b").alias("k"), F.col("na").alias("n")))
    edges = pairs.select("a", "b")
    crowded = found.where("dense").select(F.col("a").alias("key"), F.col("b").alias("i"), F.col("c").alias("j"))
    if not crowded.isEmpty():
        cells = lists(described, cfg).join(crowded, UNIT, "left_semi").join(vectors, "k")
        inside = written(by_unit(cells, linked(cfg), LINKS, cfg), "vector-links")
        sums = sums.unionByName(inside.where("not edge").select(F.col("a").alias("k"), F.col("b").alias("n")))
        edges = edges.unionByName(inside.where("edge").select("a", "b"))
    sums = sums.groupBy("k").agg(F.sum("n").alias("links"))
    roots = components(edges, "a", "b").withColumnRenamed("node", "k")
    placed = classes.drop("vector").join(sums, "k", "left").join(roots, "k", "left").withColumn("root", F.coalesce("root", "k"))
    placed = written(placed, "vector-classes", n)
    least = written(placed.groupBy("root").agg(F.min("first_id").alias("least_id"), F.count("*").alias("size")), "vector-roots", n)
    placed = meet(placed, least, ["root"], "size").select(
        "h", "g", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("least_id").alias("component_id")
    )
    rows = written(rows.select("vec_id", "known", "h", "g"), "vector-rows")
    # vectors that link with nothing stay out of the join, where their equal keys would meet in one task
    linking = meet(rows.where("known"), written(placed, "vector-places", n), ["h", "g"], "copies").select("vec_id", "n_links", "component_id")
    alone = rows.where("not known").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linking.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
