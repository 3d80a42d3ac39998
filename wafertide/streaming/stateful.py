"""The temperature pipeline as keyed state: one state per group, the same results as the batch plans.

A micro-batch's rows of a group are put together to wafers in sequence; each wafer is scored against the state and
then folded into it.  Without a ``gap`` a wafer is taken as complete when its batch ends, as in a scheduled incremental
run.  With one, the watermark on ``first_ts`` lags by the gap, and a wafer's chips wait in the state until it has passed
their time, so a wafer may be spread over any batches; chips that come later still are left out.  ``forget`` drops the state
of a group that has been silent for as long.  State and source offsets share one checkpoint, so a crash neither
repeats nor loses a wafer.  A batch holds what its trigger reads; ``chips_of`` bounds that by files.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import Config
from ..schema import GROUP

CHART = (
    "equipment_id string, recipe string, head string, wafer_id string, wafer_seq bigint, n_chips int, roughness double, "
    "ewma double, baseline_mean double, baseline_std double, inter_alarm boolean, cusum_peak double, alarm_chip_index int, intra_alarm boolean"
)


@dataclass
class GroupTracker:
    """Reference profile and trackers of one group."""

    cfg: Config = field(default_factory=Config)
    profile: np.ndarray | None = None
    wafers: int = 0
    ewma: float | None = None
    mean: float = 0.0
    m2: float = 0.0
    samples: int = 0

    @classmethod
    def started(cls, reference: dict | None, state: dict | None, cfg: Config) -> "GroupTracker":
        """The tracker that a group of a baseline document goes on from."""
        out = cls(cfg)
        if reference and reference["temp_ref"]:
            out.profile, out.wafers = np.array(reference["temp_ref"]), reference["n_wafers_seen"]
        if state and state["initialized"]:
            out.ewma, out.mean, out.m2, out.samples = (state[k] for k in ("ewma_value", "baseline_mean", "m2", "n_samples"))
        return out

    @property
    def std(self) -> float:
        return max(float(np.sqrt(self.m2 / (self.samples - 1))), 1e-9) if self.samples > 1 else 1.0

    def reset(self) -> None:
        self.profile, self.wafers, self.ewma, self.mean, self.m2, self.samples = None, 0, None, 0.0, 0.0, 0

    def dump(self) -> str:
        kept = {k: getattr(self, k) for k in ("wafers", "ewma", "mean", "m2", "samples")}
        return json.dumps(kept | {"profile": None if self.profile is None else self.profile.tolist()})

    @classmethod
    def load(cls, text: str, cfg: Config) -> "GroupTracker":
        kept = json.loads(text)
        profile = kept.pop("profile")
        return cls(cfg, None if profile is None else np.array(profile), **kept)

    def roughness(self, series: np.ndarray) -> float:
        if len(series) < self.cfg.feature.least_points:
            return 0.0
        n = min(len(series), len(self.profile))
        residual = series[:n] - self.profile[:n]
        return float(np.diff(residual).std()) if n > 1 else 0.0

    def cusum(self, values: np.ndarray) -> tuple[float | None, int]:
        cfg = self.cfg.intra
        if len(values) < 2 * cfg.warmup:
            return None, -1
        head = values[: cfg.warmup]
        level, spread = float(head.mean()), float(head.std(ddof=1)) if cfg.warmup > 1 else 0.0
        z = (values[cfg.warmup :] - level) / max(spread, level * cfg.least_cv, 1e-9)
        total, s = 0.0, np.zeros(len(z))
        for i, x in enumerate(z):
            total = 0.0 if np.isnan(x) else max(0.0, total + x - cfg.k)
            s[i] = total
        above = np.flatnonzero(s > cfg.h)
        return float(s.max(initial=0.0)), cfg.warmup + int(above[0]) if len(above) else -1

    def process(self, series: list[np.ndarray], pm_event: bool = False, learn: bool = True) -> dict | None:
        """Score a wafer's chips in bond order and fold them in; None for a cold start."""
        if pm_event:
            self.reset()
        row, length = None, len(series[0]) if self.profile is None else len(self.profile)
        if learn and any(len(s) < length for s in series):
            if self.cfg.reference.on_ragged != "drop":
                raise ValueError("chip with too few points")
            series = [s for s in series if len(s) >= length]
            if not series:
                return None
        if self.profile is not None:
            values = np.array([self.roughness(s) for s in series])
            x, cfg = float(values.mean()), self.cfg.inter
            start = x if self.ewma is None else self.ewma
            self.ewma = (1 - cfg.weight) * start + cfg.weight * x
            if self.samples < cfg.baseline:
                self.samples += 1
                gap = x - self.mean
                self.mean += gap / self.samples
                self.m2 += gap * (x - self.mean)
            peak, first = self.cusum(values)
            alarm = self.samples >= cfg.baseline and self.ewma > self.mean + cfg.sigma * self.std
            row = {
                "n_chips": len(series), "roughness": x, "ewma": self.ewma, "baseline_mean": self.mean, "baseline_std": self.std,
                "inter_alarm": bool(alarm), "cusum_peak": peak, "alarm_chip_index": first, "intra_alarm": first >= 0,
            }
        if learn:
            median = np.median(np.stack([s[:length] for s in series]), axis=0)
            weight = self.cfg.reference.alpha
            self.profile = median if self.profile is None else (1 - weight) * self.profile + weight * median
            self.wafers += 1
        return row


def _wafers(rows: pd.DataFrame) -> dict[int, dict]:
    """Chips with a series by wafer, as the state keeps them."""
    out: dict[int, dict] = {}
    for seq, wafer in rows.groupby("wafer_seq", sort=True):
        chips = [[int(b), np.asarray(s, float).tolist()] for b, s in zip(wafer["bond_order"], wafer["temp_series"]) if s is not None and len(s)]
        if chips:
            pm, learn = (bool(wafer[c].fillna(d).any()) if c in wafer else d for c, d in (("pm_event", False), ("learn", True)))
            out[int(seq)] = {"wafer_id": wafer["wafer_id"].iloc[0], "at": float(wafer["seconds"].min()), "pm": pm, "learn": learn, "chips": chips}
    return out


def track(chips: DataFrame, cfg: Config = Config(), start: DataFrame | None = None, gap: str | None = None, forget: str | None = None) -> DataFrame:
    """Chart rows of a stream (or batch stream) of chips.

    ``start`` are states of a baseline document, a single file, so its groups are kept on the driver; a group without
    a state of its own goes on from them.
    """
    names = [c.split()[0] for c in CHART.split(", ")]
    saved = {}
    for r in start.collect() if start is not None else []:
        saved[tuple(r[c] for c in GROUP)] = (r.reference and r.reference.asDict(), r.inter_wafer_state and r.inter_wafer_state.asDict())
    idle = pd.Timedelta(forget).total_seconds() if forget else None
    if idle and not gap:
        raise ValueError("only event time can tell that a group is silent: set a gap")
    if gap:
        chips = chips.withWatermark("first_ts", gap)
    chips = chips.withColumn("seconds", F.col("first_ts").cast("double"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracker, pending, closed, last = GroupTracker.started(*saved.get(key, (None, None)), cfg), {}, 0, 0.0
        if state.exists:
            text, waiting, closed, last = state.get
            tracker, pending = GroupTracker.load(text, cfg), {int(k): v for k, v in json.loads(waiting).items()}
        rows = [b for b in batches if len(b)] if not state.hasTimedOut else []
        now = state.getCurrentWatermarkMs() / 1000 if gap else None
        out = []

        def close() -> None:
            nonlocal closed
            for seq in sorted(pending):
                wafer = pending[seq]
                if gap and wafer["at"] > now:
                    break  # wafers are folded in sequence
                del pending[seq]
                closed = seq
                series = [np.array(s) for _, s in sorted(wafer["chips"], key=lambda c: c[0])]
                got = tracker.process(series, wafer["pm"], wafer["learn"])
                if got:
                    out.append(dict(zip(GROUP, key, strict=True)) | {"wafer_id": wafer["wafer_id"], "wafer_seq": seq} | got)

        close()
        silent = idle is not None and state.exists and not pending and last + idle <= now
        if silent:
            tracker, closed = GroupTracker(cfg), 0
        for seq, wafer in _wafers(pd.concat(rows)).items() if rows else ():
            if gap and seq <= closed:
                continue  # its wafer was closed before
            held = pending.setdefault(seq, wafer)
            if held is not wafer:
                held["chips"] += wafer["chips"]
                held["pm"], held["at"] = held["pm"] or wafer["pm"], min(held["at"], wafer["at"])
            last = max(last, wafer["at"])
        close()
        if silent and not rows:
            state.remove()
        else:
            state.update((tracker.dump(), json.dumps(pending), closed, last))
            if gap and (pending or idle is not None):
                due = min(w["at"] for w in pending.values()) if pending else last + idle
                state.setTimeoutTimestamp(int(max(due, now + 0.001) * 1000))
        if out:
            yield pd.DataFrame(out, columns=names)

    timeout = GroupStateTimeout.EventTimeTimeout if gap else GroupStateTimeout.NoTimeout
    return chips.groupBy(*GROUP).applyInPandasWithState(step, CHART, "state string, pending string, closed long, last double", "append", timeout)


def chips_of(spark: SparkSession, path: str, schema, files: int | None = None) -> DataFrame:
    """A stream of the chips that land in a folder, at most ``files`` new files to a batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write what is new in the source to Parquet at ``path`` and stop; the checkpoint remembers offsets and states."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
