"""Waveform tables derived from the generic tables of the catalog's queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..schema import RAW

#: Series are scaled by an odd factor, so that no rounded result sits on a decimal tie.
SCALE = 0.7310585786
POINTS = 16
SUPPLIERS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def equipment():
    """A line item's equipment: its line status and its block of suppliers."""
    return F.concat("l_linestatus", F.floor(F.col("l_suppkey") / SUPPLIERS))


def waveforms(spark: SparkSession, sf_dir: str, unit: str = "quarter", pm: bool = False) -> DataFrame:
    """Two-channel chips from ``lineitem``, of which every row lands in a chip.

    Equipment is the line status and a block of ``SUPPLIERS`` suppliers, so groups grow in number, not in size; a wafer
    is a span of ship dates.  The rows of a part number modulo 32 are dealt, in order, into as many chips as hold
    ``POINTS`` rows each, and a chip's prices and quantities are averaged to ``POINTS`` points, as many rows to each as
    to any other; a chip of fewer rows repeats some.  With ``pm`` every ninth wafer comes after maintenance.
    """
    rows = table(spark, sf_dir, "lineitem").select(
        equipment().alias("equipment_id"),
        F.date_trunc(unit, "l_shipdate").alias("first_ts"),
        (F.col("l_partkey") % 32).cast("int").alias("part"),
        F.struct(
            "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
        ).alias("p"),
    )
    group = Window.partitionBy("equipment_id", "first_ts", "part")
    rows = rows.withColumns({"rn": F.row_number().over(group.orderBy("p")) - 1, "n": F.count("*").over(group)})
    slices = F.floor(F.col("rn") * F.greatest(F.lit(1), F.floor(F.col("n") / POINTS)) / F.col("n")).cast("int")
    chip = ["equipment_id", "first_ts", "bond_order"]
    rows = rows.withColumn("bond_order", F.col("part") + 32 * slices)
    chips = rows.groupBy(*chip).agg(F.array_sort(F.collect_list(F.struct("rn", "p"))).alias("s"))
    number = Window.partitionBy("equipment_id").orderBy("first_ts")
    wafers = chips.select("equipment_id", "first_ts").distinct().withColumn("wafer_seq", F.row_number().over(number).cast("bigint"))

    def series(name: str):
        return A.downsample(F.transform("s", lambda e: e["p"][name] * F.lit(SCALE)), POINTS)

    return chips.join(wafers, ["equipment_id", "first_ts"]).select(
        "equipment_id", F.lit("R1").alias("recipe"), F.lit("H1").alias("head"),
        F.date_format("first_ts", "yyyy-MM-dd").alias("wafer_id"), "wafer_seq", "first_ts",
        (F.col("bond_order") % 8).alias("x"), F.floor(F.col("bond_order") / 8).cast("int").alias("y"), "bond_order",
        series("l_extendedprice").alias("temp_series"), series("l_quantity").alias("resist_series"),
        (F.lit(pm) & (F.col("wafer_seq") % 9 == 0)).alias("pm_event"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-length two-channel chips from ``embeddings``: 25 to a wafer; the second channel is the first reversed."""
    order = Window.partitionBy("g").orderBy("vec_id")
    rows = table(spark, sf_dir, "embeddings").select((F.col("label") % 2).cast("string").alias("g"), "vec_id", "embedding")
    rows = rows.withColumn("rn", F.row_number().over(order) - 1).withColumn("s", F.transform("embedding", lambda x: x.cast("double")))
    return rows.select(
        F.col("g").alias("equipment_id"), F.lit("R1").alias("recipe"), F.lit("H1").alias("head"),
        F.concat(F.lit("W"), F.floor(F.col("rn") / 25)).alias("wafer_id"), (F.floor(F.col("rn") / 25) + 1).alias("wafer_seq"),
        F.lit(None).cast("timestamp").alias("first_ts"), (F.col("rn") % 5).alias("x"), F.floor(F.col("rn") % 25 / 5).cast("int").alias("y"),
        (F.col("rn") % 25).cast("int").alias("bond_order"), F.col("s").alias("temp_series"), F.reverse("s").alias("resist_series"),
        F.lit(False).alias("pm_event"),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw measurement rows from ``events``: wafers are days; rows of a value below 2 have no waveform."""
    rows = table(spark, sf_dir, "events")
    word = F.when(F.col("value") >= 2, F.when(F.col("event_id") % 2 == 0, "0000803f000000c0ff").otherwise("000000410000c8c1"))
    shaped = rows.select(
        (F.col("user_id") % 2).cast("string").alias("eqp_id"), F.col("event_type").alias("product"), F.lit("H1").alias("module_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("wafer_id"), (F.col("event_id") % 10).cast("int").alias("x"),
        (F.col("event_id") % 7).cast("int").alias("y"), word.alias("temp_raw"), F.col("ts").cast("timestamp").alias("event_tmstp"),
    )
    return shaped.select([c.split()[0] for c in RAW.split(", ")])
