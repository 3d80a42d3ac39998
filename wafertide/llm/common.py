"""Shared helpers: scratch tables, temporary column names and array plumbing for Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for scratch tables, which ``spark.checkpoint.dir`` names.

    A session without one is refused, unless it is local: there one process does all, and a temporary folder will do.
    On a cluster a folder of the machine's own would be lost to the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="wafertide-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back, which cuts the lineage.

    Where ``rows`` bounds its rows, a slim table gets a file for each 250,000 of them, or eight, instead of one for each
    shuffle partition.

    The folder is registered for deletion when the driver's JVM ends, since plans built on it stay lazy until then.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/wafertide/{label}-{uuid.uuid4().hex}"
    df = df if rows is None else df.coalesce(max(8, rows // 250_000))
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def meet(left: DataFrame, right: DataFrame, on: list[str], weight: str, most: int = 1000) -> DataFrame:
    """Inner join with the stored table ``right``, which has one row per key; ``weight`` counts the rows of ``left`` with it.

    Keys that hold more than one in ``most`` of the rows of ``left`` would meet in one task.  They are fewer than
    ``most``, so they are broadcast; the others are joined as any.
    """
    total, highest = (x or 0 for x in right.agg(F.sum(weight), F.max(weight)).first())
    limit = max(total // most, most // 10)  # a key of so few rows is no burden
    if highest <= limit:
        return left.join(right, on)
    few, rest = right.where(F.col(weight) > limit), right.where(F.col(weight) <= limit)
    return left.join(F.broadcast(few), on).unionByName(left.join(F.broadcast(few.select(*on)), on, "left_anti").join(rest, on))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with no column of ``df``, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its ``n + 1`` offsets, without copying; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[off[0] : off[-1]], off - off[0]


def slabs(column: pa.Array, size: int = 1 << 20) -> Iterator[pa.Array]:
    """Slices of a string array of about ``size`` bytes, one row at least, which bound what is expanded at a time."""
    offsets, at = utf8(column)[1], 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield column.slice(at, end - at)
        at = end


def binaries(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array whose rows are the bytes between ``offsets``."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(flat)]
    ).cast(pa.binary())
