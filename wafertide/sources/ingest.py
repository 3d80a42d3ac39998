"""Raw measurement rows to chips, wafer sequences, lookback selection and the baseline policy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Lookback
from ..functions import arrays as A
from ..schema import GROUP

COLUMNS = ["eqp_id", "product", "module_id", "wafer_id", "x", "y", "temp_raw", "event_tmstp"]


def scan_after(rows: DataFrame, start, end) -> DataFrame:
    """Rows after ``start`` up to ``end``: the half-open window of incremental runs."""
    ts = F.col("event_tmstp")
    return rows.where((ts > F.lit(start).cast("timestamp")) & (ts <= F.lit(end).cast("timestamp"))).select(*COLUMNS)


def scan_between(rows: DataFrame, start, end, **equal) -> DataFrame:
    """Rows from ``start`` to ``end``, both included, with optional equalities such as ``eqp_id="E1"``; None is no filter."""
    out = rows.where(F.col("event_tmstp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    for name, value in equal.items():
        out = out if value is None else out.where(F.col(name) == value)
    return out.select(*COLUMNS)


def equipment(rows: DataFrame, start, end) -> DataFrame:
    return scan_between(rows, start, end).select("eqp_id").distinct().orderBy("eqp_id")


def chips_from_rows(rows: DataFrame) -> DataFrame:
    """Chips of raw rows: renamed columns with defaults, decoded series, dense bond order and wafer sequence.

    A wafer's first time counts rows whose series is empty, which are dropped after it; ties in time are broken by
    position.  Rows with a null group column are left out.  Wafer numbers come from one row for each wafer.
    """
    head = F.col("module_id") if "module_id" in rows.columns else F.col("head") if "head" in rows.columns else F.lit("unknown")

    def column(name, kind, default):
        return F.coalesce(F.col(name).cast(kind), F.lit(default)) if name in rows.columns else F.lit(default)

    chips = rows.select(
        F.col("eqp_id").alias("equipment_id") if "eqp_id" in rows.columns else F.lit("unknown").alias("equipment_id"),
        (F.col("product") if "product" in rows.columns else F.lit("unknown")).alias("recipe"),
        head.alias("head"),
        F.col("wafer_id").cast("string").alias("wafer_id"),
        column("x", "int", 0).alias("x"),
        column("y", "int", 0).alias("y"),
        "event_tmstp",
        "temp_raw",
    ).where("equipment_id is not null and recipe is not null and head is not null and wafer_id is not null")
    wafers = chips.groupBy(*GROUP, "wafer_id").agg(F.min("event_tmstp").alias("first_ts"))
    chips = chips.withColumn("temp_series", A.decode_hex("temp_raw")).drop("temp_raw").where(F.size("temp_series") > 0)
    kept = chips.select(*GROUP, "wafer_id").distinct()
    order = Window.partitionBy(*GROUP).orderBy("first_ts", "wafer_id")
    wafers = wafers.join(kept, [*GROUP, "wafer_id"], "left_semi").withColumn("wafer_seq", F.row_number().over(order).cast("bigint"))
    chips = chips.join(wafers, [*GROUP, "wafer_id"])
    bond = F.row_number().over(Window.partitionBy(*GROUP, "wafer_id").orderBy("event_tmstp", "x", "y")) - 1
    return chips.withColumn("bond_order", bond).withColumns(
        {"resist_series": F.lit(None).cast("array<double>"), "pm_event": F.lit(False)}
    )


def group_text() -> F.Column:
    return F.concat_ws("|", *GROUP)


def lookback(wafers: DataFrame, today: dt.date, cfg: Lookback = Lookback(), run_ts: dt.datetime | None = None) -> DataFrame:
    """Wafers (group, wafer_id, first_ts) of the chunks that a backward walk from yesterday would read.

    With ``run_ts`` it is the walk of a first run: it starts from today, whose chunk ends at that time.

    Chunk c holds ``chunk_days`` days; the walk ends after the first chunk at which every group seen so far has enough
    wafers.  One scan finds that chunk from per-group counts; days are half-open, so nothing falls between chunks.
    """
    last = today - dt.timedelta(days=1) if run_ts is None else today
    wafers = wafers if run_ts is None else wafers.where(F.col("first_ts") <= F.lit(run_ts))
    age = F.datediff(F.lit(last), F.to_date("first_ts"))
    rows = wafers.withColumn("chunk", F.floor(age / cfg.chunk_days).cast("int"))
    oldest = today - dt.timedelta(days=cfg.days)
    rows = rows.where((age >= 0) & (F.to_date("first_ts") >= F.lit(oldest)))
    counts = rows.groupBy(*GROUP, "chunk").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(*GROUP).orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumn("so_far", so_far)
    group = counts.groupBy(*GROUP).agg(
        F.min("chunk").alias("first_chunk"), F.min(F.when(F.col("so_far") >= cfg.least_wafers, F.col("chunk"))).alias("done_chunk")
    )
    # the walk ends at chunk c if every group first seen by c is done by c
    chunks = (cfg.days + cfg.chunk_days - 1) // cfg.chunk_days
    at = F.explode(F.sequence(F.lit(0), F.lit(chunks)))
    open_at = group.withColumn("c", at).groupBy("c").agg(
        F.count_if(F.col("first_chunk") <= F.col("c")).alias("seen"),
        F.count_if((F.col("first_chunk") <= F.col("c")) & (F.coalesce("done_chunk", F.lit(1 << 30)) > F.col("c"))).alias("open"),
    )
    stop = open_at.where("seen > 0 and open = 0").agg(F.min("c")).first()[0]  # one number
    return rows if stop is None else rows.where(F.col("chunk") <= stop)


def baseline_policy(history: DataFrame, today: DataFrame, least: int = 5) -> DataFrame:
    """One row per group: wafers in the history and today, and how its baseline is built.

    ``full``: history alone; ``partial``: history, then today's wafers for the reference only; ``today``: today's wafers
    for the reference only.
    """
    a = history.groupBy(*GROUP).agg(F.count("*").alias("n_history"))
    b = today.groupBy(*GROUP).agg(F.count("*").alias("n_today"))
    rows = a.join(b, GROUP, "full_outer").na.fill(0, ["n_history", "n_today"])
    route = F.when(F.col("n_history") >= least, "full").when(F.col("n_history") > 0, "partial").otherwise("today")
    return rows.withColumn("route", route)


def ready_only(events: DataFrame, wafers: DataFrame, least: int = 5) -> DataFrame:
    """Events of wafers that at least ``least`` wafers of their group came before."""
    seen = F.row_number().over(Window.partitionBy(*GROUP).orderBy("wafer_seq")) - 1
    ready = wafers.select(*GROUP, "wafer_seq").distinct().withColumn("seen", seen).where(F.col("seen") >= least)
    return events.join(ready.drop("seen"), [*GROUP, "wafer_seq"], "left_semi")
