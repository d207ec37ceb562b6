"""Parameters of the preparation plans."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Windows:
    """``num_windows`` windows of ``window_hours`` hours each."""

    num_windows: int = 6
    window_hours: int = 4

    @property
    def max_hours(self) -> int:
        return self.num_windows * self.window_hours


@dataclass(frozen=True)
class Split:
    train: float = 0.7
    val: float = 0.1
    test: float = 0.2
    seed: int = 42
    exact: bool = False

    def __post_init__(self):
        if abs(self.train + self.val + self.test - 1.0) > 1e-9:
            raise ValueError("train, val and test shares must add up to 1")


@dataclass(frozen=True)
class Labels:
    horizon_hours: float = 240.0
    n_time_bins: int = 10
    scheme: str = "quantiles"
    outcomes: dict = field(default_factory=lambda: {0: "Censored", 1: "Event"})
    competing: bool = False

    @property
    def n_events(self) -> int:
        return sum(1 for code in self.outcomes if code != 0) if self.competing else 1


@dataclass(frozen=True)
class Codes:
    top_n: int = 500
    value: str = "binary"
    fit_on: str = "train"
    mode: str = "history"
    prefix: str = "ICD_"


@dataclass(frozen=True)
class Reports:
    dim: int = 64
    batch_size: int = 32
    #: Weigh the slots of the hashed embedding by how few train reports have them.
    idf: bool = False


@dataclass(frozen=True)
class Preparation:
    windows: Windows = Windows()
    split: Split = Split()
    labels: Labels = Labels()
    codes: Codes = Codes()
    reports: Reports = Reports()
    presence_threshold: float = 0.01
    presence_denominator: str = "rows"
    static_imputation: str = "mean"
    dynamic_imputation: str = "zero"
    scaling: str = "standard"
    fit_on_observed: bool = False
    #: ``dense``: a slot for every feature in every row; ``sparse``: observed cells against the vocabulary table.
    layout: str = "dense"
