"""Reference profiles: pointwise medians smoothed over wafers, whole and by resistance cluster, and chip features.

Chips carry ``wafer_seq`` (1, 2, ... within a group).  A maintenance event starts a new epoch, which is part of every
key, so a reset is a partition border.  A wafer's features use the reference after the last earlier wafer that was
learned from; the first learned wafer of an epoch is a cold start and has no features.

``start`` are states of a baseline document (group columns, ``reference``, ``inter_wafer_state``).  A group's first epoch
then goes on from its profile, which stands as the row of wafer 0; a later maintenance event forgets it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config, Feature, Reference
from ..functions import arrays as A
from ..schema import GROUP, KEY, WAFER


def known(start: DataFrame) -> DataFrame:
    """Groups of ``start`` with a profile: ``epoch`` 0, ``seen`` wafers, ``length`` and ``profile``."""
    rows = start.where("reference is not null and size(reference.temp_ref) > 0")
    return rows.select(
        *GROUP, F.lit(0).cast("long").alias("epoch"), F.col("reference.n_wafers_seen").cast("long").alias("seen"),
        F.col("reference.n_points").alias("length"), F.col("reference.temp_ref").alias("profile"),
    )


def with_epochs(chips: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Adds ``epoch`` and ``n_before``, the learned wafers of the epoch before this wafer.

    Windows run over one row for each wafer, never over chips.  Columns ``pm_event``, ``learn`` (whether the reference
    learns from the wafer) and ``track`` (whether detectors see it) are optional.
    """
    pm = F.coalesce(F.col("pm_event"), F.lit(False)) if "pm_event" in chips.columns else F.lit(False)
    learn = F.coalesce(F.col("learn"), F.lit(True)) if "learn" in chips.columns else F.lit(True)
    wafers = chips.groupBy(*GROUP, "wafer_seq").agg(F.max(pm).alias("p"), F.max(learn).alias("l"))
    now = A.up_to_now(GROUP, ["wafer_seq"])
    wafers = wafers.withColumn("epoch", F.sum(F.col("p").cast("int")).over(now))
    before = Window.partitionBy(*KEY).orderBy("wafer_seq").rowsBetween(Window.unboundedPreceding, -1)
    learned = F.col("l").cast("int")
    wafers = wafers.withColumn("n_before", F.coalesce(F.sum(learned).over(before), F.lit(0)))
    if start is not None:
        wafers = wafers.join(known(start).select(*KEY, "seen"), KEY, "left")
        wafers = wafers.withColumn("n_before", F.col("n_before") + F.coalesce("seen", F.lit(0)))
    wafers = wafers.select(*GROUP, "wafer_seq", "epoch", "n_before", F.col("l").alias("learned"))
    return chips.join(wafers, [*GROUP, "wafer_seq"])


def lengths(chips: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """``n_points`` by epoch: the length of the first chip of its first learned wafer, or of the profile it starts from."""
    first = F.min_by(F.size("temp_series"), F.struct("wafer_seq", "bond_order"))
    found = chips.where("learned").groupBy(*KEY).agg(first.alias("n_points"))
    if start is None:
        return found
    both = found.join(known(start).select(*KEY, "length"), KEY, "full_outer")
    return both.select(*KEY, F.coalesce("length", "n_points").alias("n_points"))


def ragged_equipment(chips: DataFrame) -> DataFrame:
    """``eqp_id, error`` of equipment that ``pinned`` would refuse: a learned wafer has a chip with too few points."""
    ready = with_epochs(chips.where(F.size("temp_series") > 0))
    bad = ready.join(lengths(ready), KEY).where(F.col("learned") & (F.size("temp_series") < F.col("n_points")))
    text = F.concat(F.lit("chip with too few points in wafer "), F.min("wafer_id"))
    return bad.groupBy(F.col("equipment_id").alias("eqp_id")).agg(text.alias("error"))


def pinned(chips: DataFrame, cfg: Reference = Reference(), start: DataFrame | None = None) -> DataFrame:
    """Adds ``n_points`` and handles shorter chips."""
    out = chips.join(lengths(chips, start), KEY)
    ragged = F.size("temp_series") < F.col("n_points")
    if cfg.on_ragged == "drop":
        return out.where(~ragged | ~F.col("learned"))
    bad = F.concat(F.lit("chip with too few points in wafer "), F.col("wafer_id"))
    return out.withColumn("n_points", F.when(ragged & F.col("learned"), F.raise_error(bad).cast("int")).otherwise(F.col("n_points")))


def chip_levels(chips: DataFrame) -> DataFrame:
    """Adds ``level``, the chip's mean resistance over its whole series."""
    return chips.withColumn("level", A.mean(F.col("resist_series")))


def clusters(chips: DataFrame, cfg: Reference = Reference()) -> DataFrame:
    """One row per wafer: 2-means of the chip levels, their spread and separation, and ``is_bimodal``."""
    levels = F.transform(F.array_sort(F.collect_list(F.struct("bond_order", "level"))), lambda c: c["level"])
    wafers = chips.groupBy(*WAFER).agg(levels.alias("levels")).withColumn("m", A.two_means(F.col("levels")))
    spread = A.std_pop(F.col("levels"))
    wafers = wafers.select(*WAFER, F.size("levels").alias("n_chips"), "m.a", "m.b", "m.la", "m.lb", spread.alias("spread"))
    wafers = wafers.withColumn("separation", (F.col("b") - F.col("a")) / (F.col("spread") + 1e-9))
    split = A.exceeds(F.col("separation"), F.lit(cfg.separation))
    return wafers.withColumn("is_bimodal", (F.col("n_chips") >= cfg.least_chips) & split)


def medians(chips: DataFrame, extra: list[str], two: bool) -> DataFrame:
    """Pointwise medians by wafer (and ``extra``) in long form.

    Chips are dealt out by wafer once, before their points are exploded; the aggregation by point then needs no
    further exchange.
    """
    points = F.arrays_zip(
        F.slice("temp_series", F.lit(1), F.col("n_points")).alias("t"),
        F.slice("resist_series" if two else "temp_series", F.lit(1), F.col("n_points")).alias("r"),
    )
    local = chips.repartition(*WAFER).select(*WAFER, *extra, F.posexplode(points).alias("pos", "v"))
    return local.groupBy(*WAFER, *extra, "pos").agg(F.median("v.t").alias("t"), F.median("v.r").alias("r"))


def smoothed(profile: DataFrame, extra: list[str], alpha: float) -> DataFrame:
    """Exponential smoothing of long profiles over wafers."""
    keys = [*KEY, *extra, "pos"]
    return profile.select(
        *WAFER, *extra, "pos", A.ewma(F.col("t"), alpha, keys, ["wafer_seq"]).alias("t"), A.ewma(F.col("r"), alpha, keys, ["wafer_seq"]).alias("r")
    )


def as_arrays(long: DataFrame, extra: list[str]) -> DataFrame:
    packed = long.groupBy(*WAFER, *extra).agg(F.array_sort(F.collect_list(F.struct("pos", "t", "r"))).alias("p"))
    return packed.select(
        *WAFER, *extra, F.col("p.t").alias("temp_ref"), F.col("p.r").alias("resist_ref")
    )


def references(chips: DataFrame, cfg: Reference = Reference(), two: bool = True, start: DataFrame | None = None) -> DataFrame:
    """One row per learned wafer: the profiles after it, ``n`` (its number in the epoch), and its clusters.

    ``cluster_refs`` holds the two cluster profiles where the wafer is bimodal.
    """
    own = chips.where("learned")
    number = own.select(*WAFER, (F.col("n_before") + 1).alias("n")).distinct()
    profile = medians(own, [], two)
    if start is not None:
        zero = known(start).withColumn("wafer_seq", F.lit(0).cast("long"))
        points = zero.select(*WAFER, F.posexplode("profile").alias("pos", "t"))
        profile = profile.unionByName(points.withColumn("r", F.col("t")))
        number = number.unionByName(zero.select(*WAFER, F.col("seen").alias("n")))
    whole = as_arrays(smoothed(profile, [], cfg.alpha), []).join(number, WAFER)
    if not two:
        return whole.drop("resist_ref")
    split = clusters(own, cfg)
    nearest = (F.abs(F.col("level") - F.col("lb")) < F.abs(F.col("level") - F.col("la"))).cast("int")
    labelled = own.join(split.where("is_bimodal").select(*WAFER, "la", "lb"), WAFER).withColumn("cluster", nearest)
    by_cluster = as_arrays(smoothed(medians(labelled, ["cluster"], True), ["cluster"], cfg.alpha), ["cluster"])
    both = by_cluster.groupBy(*WAFER).agg(F.array_sort(F.collect_list(F.struct("cluster", "temp_ref", "resist_ref"))).alias("cluster_refs"))
    return whole.join(split.select(*WAFER, "is_bimodal", "a", "b"), WAFER).join(both, WAFER, "left")


def with_reference(chips: DataFrame, refs: DataFrame, two: bool = True) -> DataFrame:
    """Chips with the profile that was current before their wafer, their cluster and residuals; cold starts drop out."""
    seen = chips.where("track") if "track" in chips.columns else chips
    at = seen.where("n_before > 0").join(refs.drop("wafer_seq").withColumnRenamed("n", "n_before"), [*KEY, "n_before"])
    if not two:
        n = F.least(F.size("temp_ref"), F.size("temp_series"))
        return at.withColumn("n_used", n).withColumn("temp_residual", A.residual(F.col("temp_series"), F.col("temp_ref"), F.col("n_used")))
    near = F.abs(F.col("level") - F.col("b")) < F.abs(F.col("level") - F.col("a"))
    at = at.withColumn("cluster", F.when(F.col("is_bimodal") & near, 1).otherwise(0))
    chosen = F.get("cluster_refs", F.col("cluster"))
    use = F.col("is_bimodal") & chosen.isNotNull()
    at = at.withColumns(
        {
            "temp_ref": F.when(use, chosen["temp_ref"]).otherwise(F.col("temp_ref")),
            "resist_ref": F.when(use, chosen["resist_ref"]).otherwise(F.col("resist_ref")),
        }
    ).where((F.size("temp_ref") > 0) & (F.size("resist_ref") > 0))
    at = at.withColumn("n_used", F.least(F.size("temp_ref"), F.size("resist_ref"), F.size("temp_series")))
    return at.withColumns({f"{c}_residual": A.residual(F.col(f"{c}_series"), F.col(f"{c}_ref"), F.col("n_used")) for c in ("temp", "resist")})


def features(at: DataFrame, cfg: Feature = Feature(), two: bool = True) -> DataFrame:
    """Roughness and spike of the residuals; 0 for chips below the least number of points."""
    few = F.size("temp_series") < cfg.least_points
    found = {}
    for c in ("temp", "resist") if two else ("temp",):
        found[f"{c}_roughness"] = F.when(few, 0.0).otherwise(A.roughness(F.col(f"{c}_residual")))
        if two:
            found[f"{c}_spike"] = F.when(few, 0.0).otherwise(A.spike(F.col(f"{c}_residual")))
    return at.withColumns(found)


def prepared(chips: DataFrame, cfg: Config = Config(), two: bool = True, start: DataFrame | None = None) -> DataFrame:
    """Chips with a series, with their epochs, lengths and (with resistance) levels."""
    ready = pinned(with_epochs(chips.where(F.size("temp_series") > 0), start), cfg.reference, start)
    return chip_levels(ready) if two else ready
