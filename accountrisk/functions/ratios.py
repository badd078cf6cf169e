"""Ratio features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.functions.numeric import at_least, clip, number
from accountrisk.schema import RATIO_FEATURES, RATIO_INPUTS

EPSILON = 1e-5


def seat_utilization() -> Column:
    seats = at_least(number("contracted_seats"), 1.0)
    return clip(at_least(number("active_users_last_30d"), 0.0) / seats, 0.0, 1.5)


def unresolved_ratio(epsilon: float = EPSILON) -> Column:
    tickets = at_least(number("support_tickets_count"), 0.0)
    open_tickets = at_least(number("unresolved_tickets_count"), 0.0)
    return clip(open_tickets / (tickets + F.lit(epsilon)), 0.0, 1.0)


def logins_per_active(epsilon: float = EPSILON) -> Column:
    active = at_least(number("active_users_last_30d"), 0.0)
    return at_least(number("avg_daily_logins"), 0.0) / (active + F.lit(epsilon))


def mrr_per_seat() -> Column:
    seats = at_least(number("contracted_seats"), 1.0)
    return at_least(number("monthly_recurring_revenue"), 0.0) / seats


def ratio_columns(epsilon: float = EPSILON) -> dict[str, Column]:
    return dict(
        zip(
            RATIO_FEATURES,
            [
                seat_utilization(),
                unresolved_ratio(epsilon),
                logins_per_active(epsilon),
                mrr_per_seat(),
            ],
            strict=True,
        )
    )


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def with_ratios(
    df: DataFrame, epsilon: float = EPSILON, drop_intermediates: bool = False
) -> DataFrame:
    """Add the four ratios in one projection; optionally drop their raw inputs."""
    require_columns(df, RATIO_INPUTS)
    out = df.withColumns(ratio_columns(epsilon))
    return out.drop(*RATIO_INPUTS) if drop_intermediates else out


def declared_ratio_columns(epsilon: float = EPSILON) -> dict[str, Column]:
    """Ratios that are declared in configuration but off by default."""
    active = at_least(number("active_users_last_30d"), 0.0)
    tickets = at_least(number("support_tickets_count"), 0.0)
    return {
        "ticket_to_user_ratio": tickets / (active + F.lit(epsilon)),
        "ticket_resolution_rate": F.lit(1.0) - unresolved_ratio(epsilon),
        "mrr_per_active_seat": at_least(number("monthly_recurring_revenue"), 0.0)
        / at_least(active, 1.0),
    }
