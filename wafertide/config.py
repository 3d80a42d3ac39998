"""Tunables of every operator with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Reference:
    alpha: float = 0.1
    least_chips: int = 10
    separation: float = 0.15
    on_ragged: str = "error"  # or "drop": chips shorter than the group's length


@dataclass(frozen=True)
class Feature:
    least_points: int = 10


@dataclass(frozen=True)
class Intra:
    k: float = 0.5
    h: float = 4.0
    warmup: int = 10
    least_cv: float = 0.15


@dataclass(frozen=True)
class Inter:
    weight: float = 0.1
    sigma: float = 3.0
    baseline: int = 10


@dataclass(frozen=True)
class Spike:
    sigma: float = 5.0
    rate_sigma: float = 3.0
    least_history: int = 4


@dataclass(frozen=True)
class Coupling:
    sigma: float = 3.0
    baseline: int = 10
    weight: float = 0.2
    least_chips: int = 10
    separation: float = 0.15


@dataclass(frozen=True)
class Multivariate:
    weight: float = 0.2
    alpha: float = 0.01
    baseline: int = 10
    ridge: float = 1e-6


@dataclass(frozen=True)
class Autoencoder:
    length: int = 25
    hidden: int = 16
    bottleneck: int = 4
    baseline: int = 8
    epochs: int = 150
    rate: float = 0.02
    percentile: float = 99.0
    seed: int = 0
    retrain: int = 0


@dataclass(frozen=True)
class Spectrum:
    """The random-matrix chi-square detector."""

    length: int = 25
    baseline: int = 10
    alpha: float = 0.01
    least_rank: int = 2
    retrain: int = 0


@dataclass(frozen=True)
class Config:
    reference: Reference = field(default_factory=Reference)
    feature: Feature = field(default_factory=Feature)
    intra: Intra = field(default_factory=Intra)
    inter: Inter = field(default_factory=Inter)
    spike: Spike = field(default_factory=Spike)
    coupling: Coupling = field(default_factory=Coupling)
    multivariate: Multivariate = field(default_factory=Multivariate)
    autoencoder: Autoencoder = field(default_factory=Autoencoder)
    spectrum: Spectrum = field(default_factory=Spectrum)


@dataclass(frozen=True)
class Lookback:
    least_wafers: int = 5
    days: int = 30
    chunk_days: int = 7
