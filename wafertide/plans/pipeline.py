"""Whole pipelines: chips in, features, charts and events out."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..operators import detectors as D
from ..operators import models as M
from ..operators import reference as R
from ..schema import GROUP, KEY, WAFER
from ..scratch import materialize


SLIM = ["wafer_id", "x", "y", "bond_order", "n_before"]


class Analysis:
    """One run over a chips table; every plan is built when it is asked for.

    Chips with their epochs are read by every plan, so they are written to the shared folder on first use, unless
    ``stored`` says that the chips come from a table already.  The references and the slim features (without arrays) are
    written on first use too; with ``once`` only where one chart reads them several times.  ``start`` holds states of a
    baseline document, from which its groups go on (one channel).
    """

    def __init__(self, chips: DataFrame, cfg: Config = Config(), two: bool = True, stored: bool = False, once: bool = False, start: DataFrame | None = None):
        self.cfg, self.two, self.stored, self.once, self.start = cfg, two, stored, once, start
        self.channels = ("temp", "resist") if two else ("temp",)
        if start is not None and two:
            raise ValueError("a baseline document holds the temperature channel only")
        self.source = chips

    @cached_property
    def chips(self) -> DataFrame:
        found = R.prepared(self.source, self.cfg, self.two, self.start)
        return found if self.stored else materialize(found, "chips")

    @cached_property
    def refs(self) -> DataFrame:
        found = R.references(self.chips, self.cfg.reference, self.two, self.start)
        return found if self.once else materialize(found, "references")

    @cached_property
    def at(self) -> DataFrame:
        return R.with_reference(self.chips, self.refs, self.two)

    @cached_property
    def slim(self) -> DataFrame:
        """The features without arrays, as a plan."""
        kinds = [f"{c}_{f}" for c in self.channels for f in (("roughness", "spike") if self.two else ("roughness",))]
        return R.features(self.at, self.cfg.feature, self.two).select(*WAFER, *SLIM, *(["cluster"] if self.two else []), *kinds)

    @cached_property
    def features(self) -> DataFrame:
        return materialize(self.slim, "features")

    @cached_property
    def wafers(self) -> DataFrame:
        return D.wafer_features(self.slim if self.once else self.features, self.two)

    def cusum(self, channel: str = "temp") -> DataFrame:
        return D.cusum(self.slim if self.once else self.features, f"{channel}_roughness", self.cfg.intra)

    def ewma(self, channel: str = "temp") -> DataFrame:
        return D.ewma_chart(self.wafers, f"{channel}_roughness", self.cfg.inter, self.start)

    def t2(self) -> DataFrame:
        return D.t2_chart(self.wafers, self.cfg.multivariate)

    def spikes(self) -> DataFrame:
        return D.chip_spikes(self.features, self.cfg.spike)

    def spike_rates(self) -> DataFrame:
        return D.spike_rates(self.spikes(), self.cfg.spike)

    def clusters(self) -> DataFrame:
        return R.clusters(self.chips, self.cfg.reference)

    def coupling(self) -> DataFrame:
        return D.coupling_chart(D.coupling_distances(self.chips, self.clusters(), self.cfg.coupling), self.cfg.coupling)

    def tracked(self) -> DataFrame:
        """Chips with residual vectors and their wafer's number among the tracked ones."""
        number = self.features.select(*WAFER).distinct()
        number = number.withColumn("n", F.row_number().over(Window.partitionBy(*KEY).orderBy("wafer_seq")))
        return self.at.join(number, WAFER)

    def autoencoder(self) -> DataFrame:
        return M.autoencoder_scores(M.vectors(self.tracked(), self.cfg.autoencoder.length), self.cfg.autoencoder)

    def spectrum(self, channel: str = "temp") -> DataFrame:
        return M.profile_scores(M.vectors(self.tracked(), self.cfg.spectrum.length), channel, self.cfg.spectrum)

    def roughness_baseline(self) -> DataFrame:
        """Running mean and sample spread of the wafers' mean roughness; a diagnostic that no detector uses."""
        now = Window.partitionBy(*KEY).orderBy("wafer_seq").rowsBetween(Window.unboundedPreceding, 0)
        found = {}
        for c in self.channels:
            found[f"{c}_mean"] = F.avg(f"{c}_roughness").over(now)
            spread = F.greatest(F.stddev_samp(f"{c}_roughness").over(now), F.lit(1e-9))
            found[f"{c}_std"] = F.when(F.count("*").over(now) < 2, 1.0).otherwise(spread)
        return self.wafers.withColumns(found)

    def events(self, models: bool = True) -> DataFrame:
        """All detectors' events; the random-matrix detector stands alone and is not among them."""
        intra = ["cusum_peak", "alarm_chip_index", "n_chips", "warmup_mean", "effective_std"]
        inter = ["ewma", "baseline_mean", "baseline_std", "control_limit", F.least("n", F.lit(self.cfg.inter.baseline)).alias("n_baseline_wafers")]
        parts = [D.events(D.intra(self.cusum(c)), "intra_drift", c, "cusum_peak", intra) for c in self.channels]
        if self.two:
            chip = [F.col("x").alias("chip_x"), F.col("y").alias("chip_y"), "bond_order"]
            parts += [
                D.events(self.spikes(), "spike", "resist", "resist_spike", [*chip, F.col("resist_spike").alias("spike_value"), "threshold"], True),
                D.events(self.spike_rates(), "spike", "resist", "z_score", ["spike_rate", "historical_mean_rate", "historical_std_rate", "z_score"]),
            ]
        parts += [D.events(self.ewma(c), "inter_drift", c, "severity", inter) for c in reversed(self.channels)]
        if self.two:
            vector = [
                "t2", "control_limit", F.array("ewma_t", "ewma_r").alias("ewma_vec"), F.array("mean_t", "mean_r").alias("baseline_mean"),
                F.array(F.array("var_t", "cov_tr"), F.array("cov_tr", "var_r")).alias("baseline_cov"),
            ]
            parts.append(D.events(self.t2(), "inter_drift_mv", "both", "t2", vector))
            coupling = [F.col("distance").alias("coupling_distance"), "ewma_distance", "baseline_mean", "baseline_std", "z_score"]
            parts.append(D.events(self.coupling(), "coupling", "both", "z_score", coupling))
            if models:
                deep = [*chip, "reconstruction_error", "threshold"]
                parts.append(D.events(self.autoencoder(), "deep_anomaly", "both", "severity", deep, True))
        return reduce(DataFrame.unionByName, parts)

    def spectrum_events(self) -> DataFrame:
        chip = [F.col("x").alias("chip_x"), F.col("y").alias("chip_y"), "bond_order", "mp_score", "threshold", "k_signal", "k_noise"]
        parts = [D.events(self.spectrum(c), f"mp_anomaly_{c}", c, "severity", chip, True) for c in ("temp", "resist")]
        return reduce(DataFrame.unionByName, parts)

    def states(self) -> DataFrame:
        """Per group the reference and tracker state after the last wafer, as the baseline document has them."""
        last = self.refs.withColumn("rank", F.row_number().over(Window.partitionBy("equipment_id", "recipe", "head").orderBy(F.desc("wafer_seq"))))
        refs = last.where("rank = 1").select(
            *KEY, F.struct(F.size("temp_ref").alias("n_points"), "temp_ref", F.col("n").cast("int").alias("n_wafers_seen")).alias("reference")
        )
        chart = self.ewma().withColumn("back", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("n")))).where("back = 1")
        size = F.least(F.col("n"), F.lit(self.cfg.inter.baseline)).cast("int")
        m2 = F.when(size < 2, 0.0).otherwise(F.col("baseline_std") * F.col("baseline_std") * (size - 1))
        tracker = F.struct(
            F.col("ewma").alias("ewma_value"), "baseline_mean", "baseline_std", size.alias("n_samples"), m2.alias("m2"),
            F.lit(True).alias("initialized"), (F.col("n") >= self.cfg.inter.baseline).alias("baseline_frozen"),
        )
        rows = refs.join(chart.select(*KEY, tracker.alias("inter_wafer_state")), KEY, "left").drop("epoch")
        if self.start is not None:  # a loaded group without a tracked wafer keeps its tracker
            rows = rows.join(self.start.select(*GROUP, F.col("inter_wafer_state").alias("was")), GROUP, "left")
            kind = rows.schema["inter_wafer_state"].dataType.simpleString()
            rows = rows.withColumn("inter_wafer_state", F.coalesce(F.col("inter_wafer_state").cast(kind), F.col("was").cast(kind))).drop("was")
        return rows.withColumn("group_key", F.struct(*GROUP))
