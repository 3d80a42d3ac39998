"""Control charts and their alarms.

Each chart function returns all chart rows with ``is_alarm``; ``events`` shapes alarm rows into the event table.
Detectors never feed back into the references, so a group's whole history is a set of window and join plans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Coupling, Inter, Intra, Multivariate, Spike
from ..functions import arrays as A
from ..schema import EVENT_COLUMNS, GROUP, KEY, WAFER


def cusum(features: DataFrame, value: str, cfg: Intra = Intra()) -> DataFrame:
    """One-sided CUSUM along the bond order, standardised by the wafer's first chips.

    The recursion max(0, s + z - k) is P - min(0, running minimum of P) for the running sum P.  Wafers with fewer than
    two warm-ups are left out; a NaN resets the chart, so sums run between NaNs.
    """
    order, whole = Window.partitionBy(*WAFER).orderBy("bond_order"), Window.partitionBy(*WAFER)
    rows = features.withColumn("rn", F.row_number().over(order)).withColumn("n_chips", F.count("*").over(whole))
    rows = rows.where(F.col("n_chips") >= 2 * cfg.warmup).withColumn("v", F.col(value))
    first = F.when(F.col("rn") <= cfg.warmup, F.col("v"))
    spread = F.stddev_samp(first).over(whole) if cfg.warmup > 1 else F.lit(0.0)
    rows = rows.withColumn("warmup_mean", F.avg(first).over(whole))
    rows = rows.withColumn("effective_std", F.greatest(spread, F.col("warmup_mean") * cfg.least_cv, F.lit(1e-9)))
    rows = rows.withColumn("z", (F.col("v") - F.col("warmup_mean")) / F.col("effective_std"))
    rows = rows.where(F.col("rn") > cfg.warmup)
    broken = F.sum(F.isnan("z").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("part", broken)
    part = Window.partitionBy(*WAFER, "part").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("total", F.sum(F.when(F.isnan("z"), 0.0).otherwise(F.col("z") - cfg.k)).over(part))
    rows = rows.withColumn("s", F.col("total") - F.least(F.lit(0.0), F.min("total").over(part)))
    return rows.withColumn("is_alarm", A.exceeds(F.col("s"), F.lit(cfg.h)))


def intra(chart: DataFrame) -> DataFrame:
    """One row per wafer of a CUSUM chart: peak, first alarming chip (0-based, -1 without) and ``is_alarm``."""
    return chart.groupBy(*WAFER, "wafer_id").agg(
        F.max("s").alias("cusum_peak"),
        F.coalesce(F.min(F.when(F.col("is_alarm"), F.col("rn") - 1)), F.lit(-1)).alias("alarm_chip_index"),
        F.max("n_chips").alias("n_chips"),
        F.max("warmup_mean").alias("warmup_mean"),
        F.max("effective_std").alias("effective_std"),
        F.max("is_alarm").alias("is_alarm"),
    )


def wafer_features(features: DataFrame, two: bool = True) -> DataFrame:
    """Means over a wafer's chips, and ``n``, the wafer's number among the tracked ones of its epoch."""
    means = [F.avg(c).alias(c) for c in (("temp_roughness", "resist_roughness") if two else ("temp_roughness",))]
    rows = features.groupBy(*WAFER, "wafer_id").agg(*means, F.count("*").alias("n_chips"))
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(*KEY).orderBy("wafer_seq")))


def summary_stats(features: DataFrame, value: str) -> DataFrame:
    return features.groupBy(*WAFER, "wafer_id").agg(
        F.avg(value).alias("mean"), F.max(value).alias("max"), F.percentile(value, 0.9).alias("p90")
    )


def _baseline(rows: DataFrame, value: Column, size: int) -> tuple[Column, Column]:
    """Mean and floored sample spread over the first ``size`` samples so far; the spread of one sample is 1."""
    now = A.up_to_now(KEY, ["n"])
    first = F.when(F.col("n") <= size, value)
    spread = F.greatest(F.stddev_samp(first).over(now), F.lit(1e-9))  # greatest skips the null of a single sample
    return F.avg(first).over(now), F.when(F.count(first).over(now) < 2, 1.0).otherwise(spread)


def _resumed(wafers: DataFrame, value: str, cfg: Inter, start: DataFrame) -> DataFrame:
    """Wafers with their EWMA and baseline where a first epoch goes on from a saved tracker.

    The saved mean stands as the value of a wafer 0; the saved baseline's count, mean and sum of squares are combined
    with those of the new wafers.
    """
    state = start.where("inter_wafer_state.initialized").select(
        *GROUP, F.lit(0).cast("long").alias("epoch"), *[F.col(f"inter_wafer_state.{a}").alias(b) for a, b in
        (("n_samples", "n0"), ("baseline_mean", "mean0"), ("m2", "m0"), ("ewma_value", "e0"))],
    )
    rows = wafers.join(state, KEY, "left").withColumn("n", (F.col("n") + F.coalesce("n0", F.lit(0))).cast("int"))
    zero = state.select(*KEY, F.lit(0).alias("n"), F.col("e0").alias(value))
    rows = rows.unionByName(zero, allowMissingColumns=True)
    now = A.up_to_now(KEY, ["n"])
    first = F.when((F.col("n") > 0) & (F.col("n") <= cfg.baseline), F.col(value))
    n0, count = F.coalesce("n0", F.lit(0)), F.count(first).over(now)
    rows = rows.withColumns({"ewma": A.ewma(F.col(value), cfg.weight, KEY, ["n"]), "k": count, "mean1": F.coalesce(F.avg(first).over(now), F.lit(0.0))})
    rows = rows.withColumn("m1", F.coalesce(F.var_samp(first).over(now), F.lit(0.0)) * (F.col("k") - 1)).where("n > 0")
    size, mean0 = n0 + F.col("k"), F.coalesce("mean0", F.lit(0.0))
    gap = F.when((n0 > 0) & (F.col("k") > 0), F.col("mean1") - mean0).otherwise(0.0)
    squares = F.coalesce("m0", F.lit(0.0)) + F.when(F.col("k") > 0, F.col("m1")).otherwise(0.0) + gap * gap * n0 * F.col("k") / size
    rows = rows.withColumn("baseline_mean", (n0 * mean0 + F.col("k") * F.col("mean1")) / size)
    rows = rows.withColumn("baseline_std", F.when(size < 2, 1.0).otherwise(F.greatest(F.sqrt(squares / F.greatest(size - 1, F.lit(1))), F.lit(1e-9))))
    return rows.drop("n0", "mean0", "m0", "e0", "k", "mean1", "m1")


def ewma_chart(wafers: DataFrame, value: str, cfg: Inter = Inter(), start: DataFrame | None = None) -> DataFrame:
    """EWMA chart over wafers with a baseline that freezes at its last wafer, which is already tested."""
    if start is not None:
        rows = _resumed(wafers, value, cfg, start)
    else:
        mean, std = _baseline(wafers, F.col(value), cfg.baseline)
        rows = wafers.withColumns(
            {"ewma": A.ewma(F.col(value), cfg.weight, KEY, ["n"]), "baseline_mean": mean, "baseline_std": std}
        )
    rows = rows.withColumn("control_limit", F.col("baseline_mean") + cfg.sigma * F.col("baseline_std"))
    rows = rows.withColumn("severity", (F.col("ewma") - F.col("baseline_mean")) / F.col("baseline_std"))
    return rows.withColumn("is_alarm", (F.col("n") >= cfg.baseline) & A.exceeds(F.col("ewma"), F.col("control_limit")))


def t2_chart(wafers: DataFrame, cfg: Multivariate = Multivariate()) -> DataFrame:
    """Two-channel EWMA with Hotelling's T-squared; the chi-square limit for two channels is -2 ln(alpha)."""
    now = A.up_to_now(KEY, ["n"])
    t, r = (F.when(F.col("n") <= cfg.baseline, F.col(c)) for c in ("temp_roughness", "resist_roughness"))
    rows = wafers.withColumns(
        {
            "ewma_t": A.ewma(F.col("temp_roughness"), cfg.weight, KEY, ["n"]),
            "ewma_r": A.ewma(F.col("resist_roughness"), cfg.weight, KEY, ["n"]),
            "mean_t": F.avg(t).over(now),
            "mean_r": F.avg(r).over(now),
            "var_t": F.coalesce(F.var_samp(t).over(now), F.lit(1.0)),
            "var_r": F.coalesce(F.var_samp(r).over(now), F.lit(1.0)),
            "cov_tr": F.when(F.count(t).over(now) < 2, 0.0).otherwise(F.covar_samp(t, r).over(now)),
        }
    )
    a, b, c = F.col("var_t") + cfg.ridge, F.col("cov_tr"), F.col("var_r") + cfg.ridge
    x, y = F.col("ewma_t") - F.col("mean_t"), F.col("ewma_r") - F.col("mean_r")
    rows = rows.withColumn("t2", (c * x * x - 2 * b * x * y + a * y * y) / (a * c - b * b))
    rows = rows.withColumn("control_limit", F.lit(-2 * math.log(cfg.alpha)))
    return rows.withColumn("is_alarm", (F.col("n") >= cfg.baseline) & A.exceeds(F.col("t2"), F.col("control_limit")))


def mad_thresholds(features: DataFrame, cfg: Spike = Spike()) -> DataFrame:
    """One row per wafer: median, median absolute deviation and threshold of the resistance spikes."""
    middle = features.groupBy(*WAFER).agg(F.median("resist_spike").alias("med"))
    away = features.select(*WAFER, "resist_spike").join(middle, WAFER)
    mad = away.groupBy(*WAFER).agg(F.max("med").alias("med"), F.median(F.abs(F.col("resist_spike") - F.col("med"))).alias("mad"))
    return mad.withColumn("threshold", F.col("med") + cfg.sigma * F.greatest(1.4826 * F.col("mad"), F.lit(1e-9)))


def chip_spikes(features: DataFrame, cfg: Spike = Spike()) -> DataFrame:
    rows = features.join(mad_thresholds(features, cfg), WAFER)
    return rows.withColumn("is_alarm", A.exceeds(F.col("resist_spike"), F.col("threshold")))


def spike_rates(spikes: DataFrame, cfg: Spike = Spike()) -> DataFrame:
    """Spike rate per wafer against all earlier rates; tested from ``least_history`` earlier wafers on."""
    rows = spikes.groupBy(*WAFER, "wafer_id").agg(F.avg(F.col("is_alarm").cast("int")).alias("spike_rate"))
    before = Window.partitionBy(*KEY).orderBy("wafer_seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "n_history": F.count("*").over(before),
            "historical_mean_rate": F.avg("spike_rate").over(before),
            "historical_std_rate": F.greatest(F.stddev_pop("spike_rate").over(before), F.lit(1e-9)),
        }
    )
    rows = rows.withColumn("z_score", (F.col("spike_rate") - F.col("historical_mean_rate")) / F.col("historical_std_rate"))
    return rows.withColumn("is_alarm", (F.col("n_history") >= cfg.least_history) & A.exceeds(F.col("z_score"), F.lit(cfg.rate_sigma)))


def coupling_distances(chips: DataFrame, split: DataFrame, cfg: Coupling = Coupling()) -> DataFrame:
    """RMS distance between the mean temperature profiles of a wafer's two resistance clusters, for qualifying wafers."""
    ok = (F.col("n_chips") >= cfg.least_chips) & (F.col("spread") >= 1e-9) & A.exceeds(F.col("separation"), F.lit(cfg.separation))
    good = split.where(ok).select(*WAFER, "la", "lb", "separation")
    length = chips.groupBy(*WAFER).agg(F.min_by(F.size("temp_series"), "bond_order").alias("n_first"))
    seen = chips.where("track") if "track" in chips.columns else chips
    rows = seen.where("n_before > 0").join(good, WAFER).join(length, WAFER)
    second = F.abs(F.col("level") - F.col("lb")) < F.abs(F.col("level") - F.col("la"))
    points = rows.repartition(*WAFER).select(
        *WAFER, "wafer_id", "separation", second.alias("second"), F.posexplode(F.slice("temp_series", F.lit(1), F.col("n_first"))).alias("pos", "v")
    )
    by_point = points.groupBy(*WAFER, "wafer_id", "separation", "pos").agg(
        F.avg(F.when(~F.col("second"), F.col("v"))).alias("p0"), F.avg(F.when(F.col("second"), F.col("v"))).alias("p1")
    )
    gap = F.col("p0") - F.col("p1")
    return by_point.groupBy(*WAFER, "wafer_id", "separation").agg(F.sqrt(F.avg(gap * gap)).alias("distance")).where("distance is not null")


def coupling_chart(distances: DataFrame, cfg: Coupling = Coupling()) -> DataFrame:
    rows = distances.withColumn("n", F.row_number().over(Window.partitionBy(*KEY).orderBy("wafer_seq")))
    mean, std = _baseline(rows, F.col("distance"), cfg.baseline)
    rows = rows.withColumns(
        {"ewma_distance": A.ewma(F.col("distance"), cfg.weight, KEY, ["n"]), "baseline_mean": mean, "baseline_std": std}
    )
    rows = rows.withColumn("z_score", (F.col("ewma_distance") - F.col("baseline_mean")) / F.col("baseline_std"))
    return rows.withColumn("is_alarm", (F.col("n") >= cfg.baseline) & A.exceeds(F.col("z_score"), F.lit(cfg.sigma)))


def events(chart: DataFrame, kind: str, channel: str, severity: str, details: list[str], chip: bool = False) -> DataFrame:
    """Alarm rows of a chart as events; ``details`` columns become a JSON object."""
    place = {"chip_x": F.col("x"), "chip_y": F.col("y")} if chip else {"chip_x": F.lit(None).cast("int"), "chip_y": F.lit(None).cast("int")}
    rows = chart.where("is_alarm").withColumns(place)
    if not chip:
        rows = rows.withColumn("bond_order", F.lit(None).cast("int"))
    rows = rows.withColumns(
        {
            "anomaly_type": F.lit(kind),
            "channel": F.lit(channel),
            "severity": F.col(severity).cast("double"),
            "details": F.to_json(F.struct(*details)),
        }
    )
    return rows.select(*EVENT_COLUMNS)


def event_text(table: DataFrame) -> DataFrame:
    """Adds ``text``, a line for each event."""
    line = F.format_string(
        "[%s] wafer=%s group=%s/%s/%s channel=%s severity=%.3f",
        F.upper("anomaly_type"), "wafer_id", "equipment_id", "recipe", "head", "channel", "severity",
    )
    return table.withColumn("text", line)
