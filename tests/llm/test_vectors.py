import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wafertide.llm import embeddings, sharding

from .helpers import AWKWARD, Union, frame


def plain(rows):
    ok = [r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    union, links = Union(), [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float64), np.array(rows[b][1], np.float64)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    union.join(a, b)
                    links[a] += 1
                    links[b] += 1
    least = {}
    for a, r in enumerate(rows):
        if r[0] is not None:
            least[union.find(a)] = min(r[0], least.get(union.find(a), r[0]))
    return sorted(((r[0], links[a], least.get(union.find(a)), r[0] == least.get(union.find(a))) for a, r in enumerate(rows)), key=repr)


def vectors(seed, n=300, d=24):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n // 6):
        base = rng.normal(size=d)
        for k in range(int(rng.integers(1, 12))):
            noise = rng.normal(size=d) * rng.choice([0, 0.02, 0.1])
            rows.append((1000 + len(rows), [float(x) for x in np.float32((base + noise) * rng.choice([1, 3]))]))
    rows += [(1, None), (2, [0.0] * d), (3, [None] + [1.0] * (d - 1)), (4, [math.nan] + [1.0] * (d - 1)), (5, [math.inf] * d), (6, [])]
    rows += [(7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [-0.0, 1.0]), (10, [0.0, 1.0]), (1000, rows[0][1]), (None, rows[0][1])]
    return rows


@pytest.mark.parametrize("cfg", [embeddings.Settings(), embeddings.Settings(most=16, nearest=8)])
def test_against_brute_force(spark, cfg):
    rows = vectors(1)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    table = table.withColumns({"vector": F.lit("clash"), "pivot": F.lit(1), "label": F.lit(None).cast("int")})
    got = sorted((tuple(r) for r in embeddings.near_duplicates(table, cfg).collect()), key=repr)
    want = plain(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    found, there = sum(g[1] for g in got), sum(w[1] for w in want)
    assert 0.99 * there <= found <= there
    if found == there:
        assert [g[1:] for g in got] == [(w[1], w[2], w[0] == w[2]) for w in want]


def test_extreme_components(spark):
    """Vectors whose squares vanish or overflow, and other element types."""
    rows = [(1, [1e-200, 1e-200]), (2, [2e-200, 2e-200]), (3, [1e200, 1e200]), (4, [2e200, 2e200]), (5, [5e-324, 0.0]), (6, [1e308, 1.0]), (7, [-1e300, 1e300])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table).collect()}
    assert [got[i] for i in range(1, 8)] == [(3, 1, True), (3, 1, False), (3, 1, False), (3, 1, False), (1, 5, True), (1, 5, False), (0, 7, True)]
    whole = spark.createDataFrame([(1, [1, 2]), (2, [2, 4]), (3, [-1, 5])], "vec_id long, embedding array<int>")
    assert {r.vec_id: r.component_id for r in embeddings.near_duplicates(whole).collect()} == {1: 1, 2: 1, 3: 3}


def planted(d, pairs, alone, cosine, seed=5):
    """Pairs at one cosine among unrelated vectors, and one crowd of near copies."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    a, other = unit(rng.normal(size=(pairs, d))), rng.normal(size=(pairs, d))
    away = unit(other - (other * a).sum(axis=1, keepdims=True) * a)
    crowd = unit(rng.normal(size=d)) + rng.normal(size=(300, d)) * 0.01
    return np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * away, unit(rng.normal(size=(alone, d))), crowd])


@pytest.mark.parametrize("pivots", [226, 1024])
def test_recall_of_planted_pairs(spark, pivots):
    """Pairs just above the limit in 64 dimensions: at least 0.95 of them, and all of a crowd, as by brute force."""
    x = planted(64, 600, 1500, 0.9501)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    there = int((np.triu(unit @ unit.T, 1) >= 0.95).sum())
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    cfg = embeddings.Settings(fewest_pivots=pivots, most_pivots=pivots)
    got = {r.vec_id: r for r in embeddings.near_duplicates(table, cfg).collect()}
    found = sum(r.n_links for r in got.values()) // 2
    assert there >= 600 + 300 * 299 // 2 and found <= there
    assert sum(got[i].component_id == got[i + 600].component_id for i in range(600)) >= 570
    assert sum(got[i].n_links for i in range(2700, 3000)) == 300 * 299
    assert len({got[i].component_id for i in range(2700, 3000)}) == 1


def test_crowds_equal_pairs(spark):
    """Units solved inside their task, short ones solved together and ones that emit pairs give the same rows."""
    rows = vectors(4)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    one, two = (sorted((tuple(r) for r in embeddings.near_duplicates(table, embeddings.Settings(dense=n)).collect()), key=repr) for n in (0, 10**6))
    assert one == two == sorted((tuple(r) for r in embeddings.near_duplicates(table, embeddings.Settings(dense=3)).collect()), key=repr)


def test_no_vectors(spark):
    got = embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"] and got.count() == 0


def test_table_is_balanced_and_stable():
    shards = sharding.SHARDS
    table = sharding.lookup_table(shards)
    share = np.bincount(table, minlength=len(shards))
    assert share.max() - share.min() <= 1 and share.sum() == sharding.SIZE
    fewer = sharding.lookup_table(shards[:-1])
    moved = (table != fewer) & (table != len(shards) - 1)
    assert moved.mean() < 0.1
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 100)
    with pytest.raises(ValueError):
        sharding.lookup_table(("a", "a"))


def test_table_by_hand():
    """Turns in plain Python over explicit preference lists."""
    shards, size = ("a", "b", "c"), 13
    lists = [
        [(sharding._hash(s, "offset") % size + j * (sharding._hash(s, "skip") % (size - 1) + 1)) % size for j in range(size)] for s in shards
    ]
    want, turn = {}, 0
    while len(want) < size:
        want[next(x for x in lists[turn % 3] if x not in want)] = turn % 3
        turn += 1
    assert sharding.lookup_table(shards, size).tolist() == [want[i] for i in range(size)]


def test_placement(spark, tmp_path):
    import hashlib

    table = sharding.lookup_table(sharding.SHARDS)
    docs = frame(spark, [*AWKWARD, *[(100 + i, "t") for i in range(500)]]).withColumn("shard", F.lit("clash"))
    rows = sharding.place(docs).collect()
    for r in rows:
        at = int(hashlib.md5(("null" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % sharding.SIZE
        assert (r.slot, r._shard) == (at, sharding.SHARDS[table[at]])
    assert len(rows) == len(AWKWARD) + 500 and r.__fields__[: len(docs.columns)] == docs.columns
    sharding.write_shards(docs.drop("shard"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert sharding.place(docs.where("false")).count() == 0
