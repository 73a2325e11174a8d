"""The feature table: a row for each code and day, from bars, environments and overnight factors.

Bars are shuffled once, by code and day; everything after is a row a day, with windows by code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import daily as D
from . import intraday as I
from . import joins as J

#: Days of the rolling blocks (W9, W10), the spread that is relative weakness (D5).
ROLLING = (3, 5, 10, 20)
WEAKNESS = 0.02


def rolled(parts: I.DayParts) -> tuple[str, ...]:
    """Fixed list (W9): columns with rolling means and deviations, where they are there."""
    early, hour = (f"open{n}" for n in parts.sides)
    of_day = ("intraday_range", "close_vwap_gap", "max_drawdown_intraday", "last_return", "realized_volatility", "amihud_mean", "proxy_ofi_sum", "trend_efficiency_ratio", "directional_consistency")
    of_opening = ("opening_volume_shock", f"{early}_return", *(f"{head}_{x}" for head in (early, hour) for x in ("low_return", "negative_vwap_ratio", "vwap_cross_count")), f"{hour}_vwap_dominant_side_ratio")
    of_regime = ("close_recovery_ratio", "hostile_soft_score")
    spreads = (*(f"stk_{e}_{x}_spread" for x in ("return", "gap", "close_to_ma20") for e in ("idx", "sec")), "idx_sec_return_spread", "idx_sec_gap_spread")
    overnight = tuple(f"overnight_{x}" for x in ("first_return", "second_return", "mean_return", "relative_strength_spread", "gap_risk_bucket"))
    return of_day + of_opening + of_regime + spreads + overnight


#: Fixed list (W10): flags with trailing rates, where they are there.
RATED = (
    "flag_large_vwap_deviation", "flag_large_drawdown", "flag_afternoon_reversal", "flag_strong_tail",
    "flag_deep_selloff", "flag_negative_vwap_persistent", "flag_poor_recovery", "flag_hostile_regime", "flag_reversion_failure",
    "flag_relative_weak_vs_idx", "flag_relative_weak_vs_sec", "flag_gap_up_without_index_confirmation", "flag_gap_up_without_sector_confirmation",
)


def feature_table(bars: DataFrame, index: DataFrame | None = None, sector: DataFrame | None = None, overnight: DataFrame | None = None, parts: I.DayParts = I.DayParts()) -> DataFrame:
    """bars: canonical bars; index and sector: daily open, high, low, close; overnight: factors by date. What is not given has no columns."""
    df = D.averages(D.grid_step(D.returns(I.features(bars, parts))))
    for prefix, environment in (("idx_", index), ("sec_", sector)):
        if environment is not None:
            df = J.with_environment(df, J.environment_features(environment), prefix)
    if overnight is not None:
        df = J.with_environment(df, overnight)
    df = I.regime(J.relative_spreads(df, WEAKNESS), parts)
    df = D.rolling(df, tuple(c for c in rolled(parts) if c in df.columns), ROLLING)
    return D.rates(df, tuple(c for c in RATED if c in df.columns), ROLLING)
