"""Building, keeping and going on from a baseline: replay of known-good wafers, without events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..schema import GROUP
from ..sources import ingest
from .pipeline import Analysis


def initialize(chips: DataFrame, cfg: Config = Config()) -> DataFrame:
    """States of groups that forget all and replay the wafers of ``chips`` in order; no event is made.

    The first wafer is a cold start, so a tracker holds one sample less than there are wafers.
    """
    return Analysis(chips, cfg, two=False).states()


def routed(history: DataFrame, today: DataFrame, least: int = 5) -> DataFrame:
    """The chips that a baseline is built from, by each group's route, with ``learn`` and ``track``.

    ``full``: the history alone.  ``partial``: the history, and today's wafers for the reference only.  ``today``: today's
    wafers for the reference only.  Both tables number a group's wafers in one sequence.
    """
    wafer = [*GROUP, "wafer_id"]
    routes = ingest.baseline_policy(history.select(*wafer).distinct(), today.select(*wafer).distinct(), least)
    more = today.join(routes.where("route <> 'full'").select(*GROUP), GROUP, "left_semi")
    return history.withColumns({"learn": F.lit(True), "track": F.lit(True)}).unionByName(
        more.withColumns({"learn": F.lit(True), "track": F.lit(False)})
    )


def build(history: DataFrame, today: DataFrame, cfg: Config = Config(), least: int = 5) -> DataFrame:
    """States built from the history and today's wafers by each group's route."""
    return initialize(routed(history, today, least), cfg)


def resume(chips: DataFrame, start: DataFrame, cfg: Config = Config(), **kw) -> Analysis:
    """A run over new wafers that goes on from the states of a loaded baseline document."""
    return Analysis(chips, cfg, two=False, start=start, **kw)
