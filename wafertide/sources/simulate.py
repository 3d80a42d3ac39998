"""Seeded waveform generators: normal production, vibration, spikes, two-mode resistance, drift and lost coupling.

Wafers are made inside tasks, one per row of a plan table, so any number of them is generated in parallel; a wafer's
random numbers depend on the seed and its number alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CHIPS


@dataclass(frozen=True)
class Wafer:
    """One wafer to generate.  ``noise`` multiplies the noise of the chips after ``onset``, where it ramps up from 1;
    ``even`` applies it to all chips.  ``two_mode`` alternates the resistance shapes, ``offset`` warms the odd chips."""

    wafer_id: str
    wafer_seq: int
    equipment_id: str = "EQ01"
    recipe: str = "R001"
    head: str = "H1"
    n_chips: int = 100
    n_points: int = 500
    temp_noise: float = 0.5
    resist_noise: float = 0.02
    noise: float = 1.0
    onset: float = 1.0
    even: bool = False
    ramp_mode: bool = False
    two_mode: bool = False
    offset: float = 0.0
    spike_share: float = 0.0
    spike_height: float = 0.0
    pm_event: bool = False
    seed: int = 42


def temperature(n: int, start: float = 25.0, peak: float = 300.0, ramp: float = 0.25, hold: float = 0.5) -> np.ndarray:
    """Ramp up, hold, and cool down to 20 degrees above the start."""
    up, flat = int(n * ramp), int(n * hold)
    return np.concatenate([np.linspace(start, peak, up), np.full(flat, peak), np.linspace(peak, start + 20, n - up - flat)])


def two_peaks(n: int, base: float = 0.5, at: tuple[float, float] = (0.35, 0.6), height: float = 2.0, width: float = 0.04) -> np.ndarray:
    """A flat level with a bell of ``exp(-4 x * x)``, x from -1 to 1, on the points around each peak."""
    out, half = np.full(n, base), int(n * width)
    for p in at:
        low, high = max(0, int(n * p) - half), min(n, int(n * p) + half)
        out[low:high] += height * np.exp(-4 * np.linspace(-1, 1, high - low) ** 2)
    return out


def ramp_hold(n: int, base: float = 0.2, jump: float = 0.55, level: float = 2.5) -> np.ndarray:
    k = int(n * jump)
    return np.concatenate([np.linspace(base, 1.5 * base, k), np.full(n - k, level)])


def chips_of(w: Wafer) -> list[tuple]:
    rng = np.random.default_rng([w.seed, w.wafer_seq])
    side, n = math.ceil(math.sqrt(w.n_chips)), w.n_points
    spiked = set(rng.choice(w.n_chips, int(w.n_chips * w.spike_share), replace=False).tolist()) if w.spike_share else set()
    rows, first = [], int(w.n_chips * w.onset)
    for i in range(w.n_chips):
        ramp = w.noise if w.even else 1 + (w.noise - 1) * (i - first) / max(1, w.n_chips - first) if i >= first else 1.0
        odd = w.two_mode and i % 2 == 1
        temp = temperature(n) + rng.normal(0, w.temp_noise * ramp, n) + (w.offset if odd else 0.0)
        shape = ramp_hold(n) if odd or w.ramp_mode else two_peaks(n)
        resist = shape + rng.normal(0, w.resist_noise * ramp, n)
        if i in spiked:
            centre, half = int(rng.uniform(0.2, 0.8) * n), max(1, int(0.03 * n))
            resist[max(0, centre - half) : centre + half] += w.spike_height
        rows.append((w.equipment_id, w.recipe, w.head, w.wafer_id, w.wafer_seq, i % side, i // side, i, temp, resist, w.pm_event))
    return rows


def wafers(spark: SparkSession, plan: list[Wafer]) -> DataFrame:
    """Chips of the planned wafers."""
    table = spark.createDataFrame(pd.DataFrame([asdict(w) for w in plan]))
    names = ["equipment_id", "recipe", "head", "wafer_id", "wafer_seq", "x", "y", "bond_order", "temp_series", "resist_series", "pm_event"]

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                made = pd.DataFrame(chips_of(Wafer(**row)), columns=names)
                made["first_ts"] = pd.Timestamp("2024-01-01") + pd.Timedelta(days=row["wafer_seq"])
                yield made[[c.split()[0] for c in CHIPS.split(", ")]]

    return table.repartition(max(1, min(len(plan), spark.sparkContext.defaultParallelism)), F.col("wafer_seq")).mapInPandas(make, CHIPS)


def normal(n: int = 20, **kw) -> list[Wafer]:
    return [Wafer(f"W{i:03d}", i + 1, **kw) for i in range(n)]


def drift(n_normal: int = 15, n_drift: int = 10, final: float = 3.0, **kw) -> list[Wafer]:
    """Normal wafers, then noise that grows linearly to ``final`` times."""
    grown = [Wafer(f"W{n_normal + i:03d}", n_normal + i + 1, noise=1 + (final - 1) * (i + 1) / n_drift, even=True, onset=0.0, **kw) for i in range(n_drift)]
    return normal(n_normal, **kw) + grown


def coupling_breakdown(n_normal: int = 15, n_broken: int = 5, offset: float = 15.0, **kw) -> list[Wafer]:
    """Two-mode wafers whose odd chips run warmer after the first ``n_normal``."""
    return [Wafer(f"W{i:03d}", i + 1, two_mode=True, offset=offset if i >= n_normal else 0.0, **kw) for i in range(n_normal + n_broken)]


def vibration(n_normal: int = 15, noise: float = 4.0, onset: float = 0.5, **kw) -> list[Wafer]:
    """Normal wafers, then one whose chips vibrate ever more after ``onset``."""
    return normal(n_normal, **kw) + [Wafer("W_INTRA", n_normal + 1, noise=noise, onset=onset, **kw)]


def spikes(n_normal: int = 15, n_spiked: int = 1, share: float = 0.15, height: float = 5.0, **kw) -> list[Wafer]:
    """Normal wafers, then wafers where a share of the chips has a resistance spike."""
    return normal(n_normal, **kw) + [Wafer(f"W_SPIKE{i}", n_normal + i + 1, spike_share=share, spike_height=height, **kw) for i in range(n_spiked)]
