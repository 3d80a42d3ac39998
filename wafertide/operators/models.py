"""Models fitted per group: the random-matrix chi-square profile and the small autoencoder.

The first ``baseline`` tracked wafers train the first model; with a retrain interval every later block of that many
wafers trains the next.  So a wafer's model number and a training wafer's model number are both arithmetic on the
wafer's number, and scoring is an equi-join.  Only fitting runs in numpy, one (group, model) per call on a bounded
number of wafers; chi-square profiles score in the JVM.

A wafer's chips are scored together, so that a model travels once for each wafer and not with each chip.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Autoencoder, Spectrum
from ..functions import arrays as A
from ..schema import KEY, WAFER


def vectors(at: DataFrame, length: int) -> DataFrame:
    """Adds the downsampled residuals ``temp_vector`` and ``resist_vector``, and their concatenation ``vector``."""
    at = at.withColumns({f"{c}_vector": A.downsample(F.col(f"{c}_residual"), length) for c in ("temp", "resist")})
    return at.withColumn("vector", F.concat("temp_vector", "resist_vector"))


def model_number(n: Column, baseline: int, retrain: int) -> Column:
    """The model that scores tracked wafer ``n``; null in the baseline."""
    number = F.floor((n - baseline - 1) / retrain) if retrain > 0 else F.lit(0)
    return F.when(n > baseline, number.cast("long"))


def trains(n: Column, baseline: int, retrain: int) -> Column:
    """The model that tracked wafer ``n`` trains; null if none."""
    later = F.floor((n - baseline - 1) / retrain) + 1 if retrain > 0 else F.lit(None)
    return F.when(n <= baseline, F.lit(0)).otherwise(later).cast("long")


def complete(rows: DataFrame, baseline: int, retrain: int) -> DataFrame:
    """Training rows of models whose block of wafers is complete."""
    rows = rows.withColumn("model", trains(F.col("n"), baseline, retrain)).where("model is not null")
    seen = rows.groupBy(*KEY, "model").agg(F.max("n").alias("last"))
    ready = seen.where(F.col("last") >= F.lit(baseline) + F.col("model") * F.lit(retrain)).drop("last")
    return rows.join(ready, [*KEY, "model"])


def fit_profile(x: np.ndarray, least_rank: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean, precision matrix of the noise subspace and its rank.

    Eigenvalues up to the upper edge of the noise spectrum, mean eigenvalue times (1 + sqrt(p / n)) squared, are noise.
    """
    n, p = x.shape
    centre = x.mean(axis=0)
    values, axes = np.linalg.eigh(np.atleast_2d((x - centre).T @ (x - centre) / max(n - 1, 1)))
    noise = values <= values.mean() * (1 + np.sqrt(p / n)) ** 2
    if noise.sum() < least_rank:
        noise = np.arange(p) < least_rank
    own = axes[:, noise]
    return centre, own / np.maximum(values[noise], 1e-12) @ own.T, int(noise.sum())


def chi2_limits(spark: SparkSession, alpha: float, degrees: int) -> list[float]:
    """Upper chi-square quantiles for 1 to ``degrees`` degrees of freedom, from the JVM's statistics library."""
    make = spark.sparkContext._jvm.org.apache.commons.math3.distribution.ChiSquaredDistribution
    return [make(float(d)).inverseCumulativeProbability(1.0 - alpha) for d in range(1, degrees + 1)]


def profiles(at: DataFrame, channel: str, cfg: Spectrum = Spectrum()) -> DataFrame:
    """One row per (group, model): mean, precision, ranks and threshold."""
    train = complete(at.select(*KEY, "n", F.col(f"{channel}_vector").alias("v")), cfg.baseline, cfg.retrain)
    keys = [*KEY, "model"]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        centre, precision, rank = fit_profile(np.stack(pdf["v"].to_numpy()), cfg.least_rank)
        row = {k: pdf[k].iloc[0] for k in keys}
        return pd.DataFrame([row | {"centre": centre.tolist(), "precision": precision.tolist(), "k_noise": rank, "k_signal": len(centre) - rank}])

    schema = ", ".join(f"{k} {train.schema[k].dataType.simpleString()}" for k in keys)
    got = train.groupBy(*keys).applyInPandas(fit, f"{schema}, centre array<double>, precision array<array<double>>, k_noise int, k_signal int")
    limits = F.array(*map(F.lit, chi2_limits(at.sparkSession, cfg.alpha, cfg.length)))
    return got.withColumn("threshold", F.coalesce(F.get(limits, F.col("k_noise") - 1), F.lit(float("inf"))))


def by_wafer(at: DataFrame, vector: str, models: DataFrame, baseline: int, retrain: int) -> DataFrame:
    """One row per scored wafer: its ``chips`` (place and vector ``v``) and its model's columns."""
    rows = at.withColumn("model", model_number(F.col("n"), baseline, retrain)).where("model is not null")
    chip = F.struct("bond_order", "x", "y", F.col(vector).alias("v"))
    wafers = rows.groupBy(*WAFER, "wafer_id", "n", "model").agg(F.array_sort(F.collect_list(chip)).alias("chips"))
    return wafers.join(models, [*KEY, "model"])


def by_chip(wafers: DataFrame, scores: Column, name: str, *keep: str) -> DataFrame:
    """Scored chips of wafers with an array of scores, with their severity against the threshold."""
    both = F.explode(F.arrays_zip(F.col("chips").alias("c"), scores.alias("s")))
    rows = wafers.select(*WAFER, "wafer_id", "n", "model", "threshold", *keep, both.alias("b"))
    rows = rows.select("*", "b.c.bond_order", "b.c.x", "b.c.y", F.col("b.s").alias(name)).drop("b")
    rows = rows.withColumn("severity", F.col(name) / F.col("threshold"))
    return rows.withColumn("is_alarm", A.exceeds(F.col(name), F.col("threshold")))


def profile_scores(at: DataFrame, channel: str, cfg: Spectrum = Spectrum()) -> DataFrame:
    """Scored chips: ``mp_score`` is the quadratic form of the centred vector in the noise precision."""
    wafers = by_wafer(at, f"{channel}_vector", profiles(at, channel, cfg), cfg.baseline, cfg.retrain)

    def form(r):
        dot = lambda row: F.aggregate(F.zip_with(row, r, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        parts = F.zip_with(F.transform("precision", dot), r, lambda a, b: a * b)
        return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)

    def score(c):
        return F.when(F.col("k_noise") == 0, 0.0).otherwise(A.let(F.zip_with(c["v"], F.col("centre"), lambda a, b: a - b), form))

    return by_chip(wafers, F.transform("chips", score), "mp_score", "k_signal", "k_noise")


class Network:
    """Autoencoder with tanh hidden layers in, hidden, bottleneck, hidden, in, trained by full-batch Adam."""

    def __init__(self, size: int, cfg: Autoencoder):
        rng, dims = np.random.default_rng(cfg.seed), (size, cfg.hidden, cfg.bottleneck, cfg.hidden, size)
        shapes = list(zip(dims, dims[1:]))
        self.weights = [rng.normal(0.0, np.sqrt(2.0 / a), (a, b)) for a, b in shapes]
        self.biases = [np.zeros(b) for _, b in shapes]

    def layers(self, x: np.ndarray) -> list[np.ndarray]:
        out = [x]
        for i, (w, b) in enumerate(zip(self.weights, self.biases, strict=True)):
            z = out[-1] @ w + b
            out.append(z if i == len(self.weights) - 1 else np.tanh(z))
        return out

    def errors(self, x: np.ndarray) -> np.ndarray:
        return ((self.layers(x)[-1] - x) ** 2).mean(axis=1)

    def gradients(self, x: np.ndarray) -> list[np.ndarray]:
        """Of the mean squared reconstruction error, in the order of the weights, then the biases."""
        depth, seen = len(self.weights), self.layers(x)
        delta, grads = 2.0 * (seen[-1] - x) / x.size, [None] * (2 * depth)
        for i in range(depth - 1, -1, -1):
            grads[i], grads[depth + i] = seen[i].T @ delta, delta.sum(axis=0)
            if i:
                delta = (delta @ self.weights[i].T) * (1.0 - seen[i] ** 2)
        return grads

    def train(self, x: np.ndarray, epochs: int, rate: float) -> None:
        params = [*self.weights, *self.biases]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, epochs + 1):
            for p, g, m, v in zip(params, self.gradients(x), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def flat(self) -> list[float]:
        return np.concatenate([p.ravel() for p in (*self.weights, *self.biases)]).tolist()

    @classmethod
    def restored(cls, size: int, cfg: Autoencoder, values: np.ndarray) -> "Network":
        net, at = cls(size, cfg), 0
        for group in (net.weights, net.biases):
            for i, p in enumerate(group):
                group[i] = values[at : at + p.size].reshape(p.shape)
                at += p.size
        return net


def autoencoders(at: DataFrame, cfg: Autoencoder = Autoencoder()) -> DataFrame:
    """One row per (group, model): scales of the two halves, weights and the threshold on training errors."""
    train = complete(at.select(*KEY, "n", "wafer_seq", "bond_order", "vector"), cfg.baseline, cfg.retrain)
    keys = [*KEY, "model"]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["wafer_seq", "bond_order"])
        raw, half = np.stack(pdf["vector"].to_numpy()), cfg.length
        scale = [max(float(raw[:, :half].std()), 1e-9), max(float(raw[:, half:].std()), 1e-9)]
        x = raw / np.repeat(scale, half)
        net = Network(x.shape[1], cfg)
        net.train(x, cfg.epochs, cfg.rate)
        limit = float(np.percentile(net.errors(x), cfg.percentile))
        return pd.DataFrame([{k: pdf[k].iloc[0] for k in keys} | {"scale": scale, "weights": net.flat(), "threshold": limit}])

    schema = ", ".join(f"{k} {train.schema[k].dataType.simpleString()}" for k in keys)
    return train.groupBy(*keys).applyInPandas(fit, f"{schema}, scale array<double>, weights array<double>, threshold double")


def autoencoder_scores(at: DataFrame, cfg: Autoencoder = Autoencoder()) -> DataFrame:
    """Scored chips: mean squared reconstruction error against the model's threshold."""
    wafers = by_wafer(at, "vector", autoencoders(at, cfg), cfg.baseline, cfg.retrain)

    @F.arrow_udf("array<double>")
    def errors(vectors: pa.Array, scales: pa.Array, weights: pa.Array) -> pa.Array:
        out = []
        for chips, scale, values in zip(vectors, scales, weights, strict=True):
            x = np.array(chips.as_py(), float) / np.repeat(np.array(scale.as_py()), cfg.length)
            out.append(Network.restored(x.shape[1], cfg, np.array(values.as_py())).errors(x))
        return pa.array(out, pa.list_(pa.float64()))

    return by_chip(wafers.withColumn("errors", errors(F.col("chips.v"), "scale", "weights")), F.col("errors"), "reconstruction_error")
