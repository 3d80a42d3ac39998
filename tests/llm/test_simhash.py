import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from wafertide.llm import graph, simhash

from .helpers import AWKWARD, Union, frame, prose


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    union = Union()
    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= 4:
                union.join(a, b)
    least = {}
    for a, (i, _) in enumerate(fps):
        r = union.find(a)
        least[r] = min(x for x in (i, least.get(r)) if x is not None) if (i, least.get(r)) != (None, None) else None
    return [(i, f"{fp:016x}", least[union.find(a)]) for a, (i, fp) in enumerate(fps)]


def documents(rng):
    rows = list(AWKWARD)
    for g in range(12):
        base = prose(rng, 400).split()
        for k in range(rng.randrange(1, 12)):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + 50 * g + k, " ".join(words)))
    rng.shuffle(rows)
    return rows


def key(r):
    return (r[0] is None, r[0] or 0, r[1])


def test_against_brute_force(spark):
    rows = documents(random.Random(4))
    docs = frame(spark, rows).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("clash"))
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=key) == sorted(plain_components(rows), key=key)


def test_large_buckets_are_dealt_into_blocks(spark):
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:
        x = rng.choice(sorted(fps)[:20])
        for _ in range(rng.randrange(1, 4)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    edges = [tuple(r) for r in simhash.links(nodes, 4, most=16).collect()]
    whole, plain = Union(), Union()
    for a, b in edges:
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= 4
        whole.join(a, b)
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 4:
                plain.join(a, b)
    assert [whole.find(f) for f in signed] == [plain.find(f) for f in signed]
    assert len(edges) < 400 * 60


def test_masks_cover_every_pair_within_the_radius():
    masks, rng = simhash.masks(4), random.Random(7)
    assert len(masks) == 31
    for _ in range(5000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5)))
        assert any(diff & m == 0 for m in masks)


def test_fingerprints_of_slices():
    texts = ["A b\tC  d e", None, "", "x", " lead and trail \n"]
    array = pa.array(["skip", *texts]).slice(1)
    assert simhash.fingerprints(array).tolist() == [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprints(pa.array([], pa.string())).tolist() == []


def test_keep_first(spark):
    rows = documents(random.Random(8))
    docs = frame(spark, rows).withColumn("__fp", F.lit(1))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    want = plain_components(rows)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({c for _, _, c in want if c is not None})
    assert simhash.keep_first(frame(spark, [])).count() == 0


def test_keep_first_with_one_id_in_two_groups(spark):
    """Id 1 is the first of one group and a loser in another; neither group may vanish."""
    one, two = (" ".join(f"{w}{i}" for i in range(40)) for w in ("river", "stone"))
    kept = simhash.keep_first(frame(spark, [(0, two), (1, two), (1, one), (2, one), (2, one)]))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, two), (1, one)]


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(2000 + rng.randrange(80), 2000 + rng.randrange(80)) for _ in range(60)] + [(5, 5)]
    rng.shuffle(edges)
    union = Union()
    for a, b in edges:
        union.join(a, b)
    df = spark.createDataFrame([*edges, (None, 3), (3, None)], "a long, b long")
    got = {r.node: r.root for r in graph.components(df, "a", "b").collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: union.find(x) for x in nodes}
    assert graph.components(df.where("false"), "a", "b").count() == 0
