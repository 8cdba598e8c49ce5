"""Script-level parameters as frozen dataclasses.

Every threshold an analysis uses lives here with its default, so no operator
hides a literal. Instances validate themselves on construction.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Thresholds, rates and weights of the procurement rule book.
MIN_PRODUCT_LINES = 30
MIN_PAIR_LINES = 10
PRICE_HIGH = 1.05
PRICE_LOW = 0.95
WEAK_ON_TIME = 70.0
STRONG_ON_TIME = 85.0
PARETO_SHARE = 0.80


@dataclass(frozen=True)
class PriceParams:
    """Limits for benchmark coverage and vendor-product comparisons."""

    min_lines: int = MIN_PRODUCT_LINES
    pair_min_lines: int = MIN_PAIR_LINES
    high: float = PRICE_HIGH
    low: float = PRICE_LOW
    tiers: int = 3
    variation_n: int = 15
    candidates_n: int = 20


@dataclass(frozen=True)
class ScoreWeights:
    """Scorecard weights; judgement calls that have to total one."""

    on_time: float = 0.40
    late: float = 0.20
    price: float = 0.30
    concentration: float = 0.10

    def __post_init__(self) -> None:
        if abs(self.total - 1.0) > 1e-9:
            raise ValueError(f"scorecard weights must total 1, got {self.total}")

    @property
    def total(self) -> float:
        return round(self.on_time + self.late + self.price + self.concentration, 9)


@dataclass(frozen=True)
class RecoveryRates:
    """Share of a price gap assumed recoverable per scenario (an assumption)."""

    low: float = 0.25
    base: float = 0.50
    high: float = 0.75

    def items(self) -> tuple[tuple[str, float], ...]:
        return (("Low", self.low), ("Base", self.base), ("High", self.high))


@dataclass(frozen=True)
class OpportunityParams:
    """Everything the opportunity analysis can be tuned with."""

    min_lines: int = MIN_PRODUCT_LINES
    pair_min_lines: int = MIN_PAIR_LINES
    high: float = PRICE_HIGH
    low: float = PRICE_LOW
    weak: float = WEAK_ON_TIME
    strong: float = STRONG_ON_TIME
    tail_share: float = PARETO_SHARE
    rates: RecoveryRates = field(default_factory=RecoveryRates)
    weights: ScoreWeights = field(default_factory=ScoreWeights)
    as_of: date = date(2025, 12, 31)
    top_vendors: int = 10
    top_open_lines: int = 25
    min_vendors: int = 3
    scenario: str = "Base"
    tolerance: float = 1.0

    def __post_init__(self) -> None:
        if self.scenario not in dict(self.rates.items()):
            raise ValueError(f"unknown scenario {self.scenario!r}")


@dataclass(frozen=True)
class ForecastParams:
    """Backtest layout and window lengths of the monthly baselines.

    ``holdback`` counts months back from the end of the series: (12, 6) trains
    twice for a backtest and once on everything. ``origins`` overrides it with
    explicit training ends, the last one being the final forecast.
    """

    holdback: tuple[int, ...] = (12, 6)
    origins: tuple[int, ...] | None = None
    horizon: int = 6
    short_window: int = 3
    long_window: int = 6
    season: int = 12
    selected: str = "ma6"

    def __post_init__(self) -> None:
        if self.horizon > self.season:
            raise ValueError("horizon beyond one season would look into the future")
