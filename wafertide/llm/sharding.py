"""Shard placement by a permutation-filled lookup table (Maglev hashing; Eisenbud et al., 2016).

Each shard prefers the slots of a prime-sized table in its own order, (offset + j * skip) mod size; shards take turns
claiming their next free slot until the table is full, so shares differ by one slot at most and few slots move when a
shard comes or goes.  The table has a fixed size and travels with the plan; placing a row is one hash and one lookup.

Defined results: the key is the document id, so copies of a text may lie apart and a hot source spreads evenly; a null
id is placed like the text ``null``.  Repeated rows go to the same shard.  An empty table gives no row.  Other columns
are ignored, or kept by ``place``.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _hash(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...], size: int = SIZE) -> np.ndarray:
    """Per slot the number of the shard that claimed it."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > size:
        raise ValueError("shards need distinct names, and at least a slot each")
    if size < 3 or any(size % p == 0 for p in range(2, int(size**0.5) + 1)):
        raise ValueError(f"{size} is not a prime above 2")
    offset = np.array([_hash(s, "offset") % size for s in shards])
    skip = np.array([_hash(s, "skip") % (size - 1) + 1 for s in shards])
    slots, next_try, free = np.full(size, -1, np.int32), [0] * len(shards), size
    while free:
        for i in range(len(shards)):
            while slots[at := (offset[i] + next_try[i] * skip[i]) % size] >= 0:
                next_try[i] += 1
            slots[at] = i
            next_try[i] += 1
            free -= 1
            if not free:
                break
    return slots


def slot(key: Column, size: int = SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size).cast("int")


def place(docs: DataFrame, shards: tuple[str, ...] = SHARDS, size: int = SIZE, key: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` and ``slot`` and ``shard`` (with underscores in front where those names are taken)."""
    at, name = fresh(docs, "slot", "shard")
    table, names = F.lit(lookup_table(shards, size).astype("<u2").tobytes()), F.array(*map(F.lit, shards))
    if len(shards) > 1 << 16:
        raise ValueError("a slot holds a 16-bit shard number")
    placed = docs.withColumn(at, slot(F.col(key), size))
    pair = F.hex(F.substring(table, F.col(at) * 2 + 1, F.lit(2)))  # low byte first
    number = F.conv(F.concat(F.substring(pair, 3, 2), F.substring(pair, 1, 2)), 16, 10).cast("int")
    return placed.withColumn(name, F.get(names, number))


def write_shards(docs: DataFrame, path: str, shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> None:
    """Write ``docs`` as Parquet, one folder for each shard; rows are spread over tasks by shard and slot."""
    at, name = fresh(docs, "slot", "shard")
    placed = place(docs, shards, size)
    placed.repartition(name, F.col(at) % 16).drop(at).write.partitionBy(name).parquet(path)
