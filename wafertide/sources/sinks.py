"""Event, summary and baseline sinks."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..schema import GROUP
from .ingest import group_text

BASELINE = (
    "version string, created_at string, groups array<struct<group_key:struct<equipment_id:string,recipe:string,head:string>,"
    "reference:struct<n_points:int,temp_ref:array<double>,n_wafers_seen:int>,inter_wafer_state:struct<ewma_value:double,"
    "baseline_mean:double,baseline_std:double,n_samples:int,m2:double,initialized:boolean,baseline_frozen:boolean>>>"
)


def write_events(events: DataFrame, path: str, by_equipment: bool = False) -> bool:
    """Write events as CSV with a header; nothing is written without events.  Returns whether there were any."""
    if events.isEmpty():
        return False
    columns = [F.col("equipment_id").alias("eqp_id"), "recipe", "head", "wafer_id", "anomaly_type", "severity", "details"]
    out = events.select(*columns)
    if by_equipment:
        out.repartition("eqp_id", F.xxhash64("wafer_id") % 16).write.partitionBy("eqp_id").csv(path, header=True, escape='"')
    else:
        out.write.csv(path, header=True, escape='"')
    return True


def group_summary(wafers: DataFrame, events: DataFrame, least: int = 5, new_after: int = 0) -> DataFrame:
    """One row per group: wafers seen, wafers of this run (``wafer_seq`` above ``new_after``) by gate, and anomalies."""
    seen = F.row_number().over(Window.partitionBy(*GROUP).orderBy("wafer_seq")) - 1
    rows = wafers.select(*GROUP, "wafer_seq").distinct().withColumn("ready", seen >= least)
    new = F.col("wafer_seq") > new_after
    found = events.groupBy(*GROUP).agg(F.count("*").alias("anomalies_this_run"))
    out = rows.groupBy(*GROUP).agg(
        F.count("*").alias("n_wafers_seen_total"),
        F.count_if(new).alias("n_new_wafers_this_run"),
        F.count_if(new & ~F.col("ready")).alias("n_building_this_run"),
        F.count_if(new & F.col("ready")).alias("n_ready_this_run"),
    )
    out = out.join(found, GROUP, "left").na.fill(0, ["anomalies_this_run"])
    status = F.when(F.col("n_wafers_seen_total") >= least, "ready").otherwise("building")
    return out.select(
        group_text().alias("group_key"), status.alias("status"), "n_wafers_seen_total", "n_new_wafers_this_run",
        "n_building_this_run", "n_ready_this_run", "anomalies_this_run",
    )


def run_summary(known: DataFrame, rows: DataFrame, chips: DataFrame, events: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """One row per equipment of ``known`` (``eqp_id``): a status and counts of rows, wafers, chips and anomalies.

    ``failed`` (``eqp_id, error``) are those whose analysis was given up; their counts are 0 and others go on.
    """
    raw = rows.groupBy("eqp_id").agg(F.count("*").alias("n_rows"))
    good = chips.groupBy(F.col("equipment_id").alias("eqp_id")).agg(
        F.count("*").alias("n_chips"), F.count_distinct("recipe", "head", "wafer_id").alias("n_wafers")
    )
    found = events.groupBy(F.col("equipment_id").alias("eqp_id")).agg(F.count("*").alias("n_anomalies"))
    out = known.select("eqp_id").distinct().join(raw, "eqp_id", "left").join(good, "eqp_id", "left").join(found, "eqp_id", "left")
    out = out.na.fill(0)
    has = "temp_raw" in rows.columns or "temp_series" in rows.columns
    status = F.when(F.col("n_rows") == 0, "no_data").when(F.lit(not has), "no_temp_column")
    out = out.withColumn("status", status.when(F.col("n_chips") == 0, "no_valid_temp_data").otherwise("success"))
    if failed is None:
        return out
    out = out.join(failed.select("eqp_id", "error"), "eqp_id", "left")
    counts = {c: F.when(F.col("error").isNull(), F.col(c)).otherwise(0) for c in ("n_rows", "n_chips", "n_wafers", "n_anomalies")}
    return out.withColumns(counts | {"status": F.when(F.col("error").isNull(), F.col("status")).otherwise("error")})


def run_totals(summary: DataFrame) -> DataFrame:
    """The totals that a run reports: equipment, wafers, chips and anomalies."""
    return summary.agg(
        F.count("*").alias("n_equipment"), F.sum("n_wafers").alias("n_wafers"), F.sum("n_chips").alias("n_chips"), F.sum("n_anomalies").alias("n_anomalies")
    )


def first_events(events: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` events of each equipment, as a report shows them, and ``rank``."""
    order = Window.partitionBy("equipment_id").orderBy("wafer_seq", "recipe", "head", "anomaly_type", "channel", "bond_order")
    return events.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def baseline_json(states: DataFrame, path: str, cfg: Config = Config()) -> None:
    """Write per-group states as one JSON document, in a folder of any store that Spark writes to.

    The document is an interchange format for one line's groups, so these are gathered; tables of states stay Parquet.
    """
    state = F.struct("group_key", "reference", "inter_wafer_state")
    rows = states.orderBy(*GROUP).select(F.to_json(state, {"ignoreNullFields": "false"}))
    config = {
        "reference": {"ewma_alpha": cfg.reference.alpha},
        "feature": {"min_points": cfg.feature.least_points},
        "intra_wafer": {"cusum_k": cfg.intra.k, "cusum_h": cfg.intra.h, "warmup_chips": cfg.intra.warmup},
        "inter_wafer": {"ewma_lambda": cfg.inter.weight, "alert_sigma": cfg.inter.sigma, "baseline_wafers": cfg.inter.baseline},
    }
    created = dt.datetime.now(dt.timezone.utc).isoformat()
    doc = {"version": "1.0", "created_at": created, "config": config, "groups": [json.loads(r[0]) for r in rows.toLocalIterator()]}
    states.sparkSession.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    """States of a baseline document: group columns, ``reference`` and ``inter_wafer_state``."""
    doc = spark.read.schema(BASELINE).json(path, multiLine=True)
    return doc.select(F.explode("groups").alias("g")).select("g.group_key.*", "g.group_key", "g.reference", "g.inter_wafer_state")
