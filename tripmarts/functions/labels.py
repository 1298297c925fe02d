"""Text labels derived from numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits (exclusive) and labels of the distance and tip buckets.
DISTANCE_STEPS = ((2, "0-2 mi"), (5, "2-5 mi"), (10, "5-10 mi"), (20, "10-20 mi"))
DISTANCE_REST = "20+ mi"
TIP_STEPS = ((10, "1-10%"), (15, "10-15%"), (20, "15-20%"), (25, "20-25%"))
TIP_REST = "25%+"
TIP_UNKNOWN = "no_tip"
TIP_ZERO = "0%"

# Payment codes.
CARD = 1
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}


def _steps(
    value: Column, steps: Sequence[tuple[float, str]], rest: str, first: Column | None = None
) -> Column:
    """The label of the first limit above the value; `first` has cases that come before."""
    chain = first
    for limit, label in steps:
        below = value < limit
        chain = F.when(below, label) if chain is None else chain.when(below, label)
    return chain.otherwise(rest)


def distance_bucket(distance: Column) -> Column:
    return _steps(distance, DISTANCE_STEPS, DISTANCE_REST)


def tip_percent(tip: Column, fare: Column) -> Column:
    """Tip as a percentage of a positive fare, else null."""
    return F.when(fare > 0, F.try_divide(tip, fare) * 100)


def tip_bucket(percent: Column) -> Column:
    exact = F.when(percent.isNull(), TIP_UNKNOWN).when(percent == 0, TIP_ZERO)
    return _steps(percent, TIP_STEPS, TIP_REST, exact)


def payment_label(code: Column) -> Column:
    """Label of a payment code; null for a code without one."""
    pairs = [F.lit(x) for pair in PAYMENT_LABELS.items() for x in pair]
    return F.create_map(*pairs)[code.try_cast("int")]


def recovery_period(year: Column, month: Column, baseline_year: int) -> Column:
    """Where a month stands relative to the demand shock of the baseline year."""
    # The labels and the months they cover.
    shock = year == baseline_year
    return (
        F.when(shock & month.between(3, 5), "Impact")
        .when(shock & month.between(6, 12), "Early recovery")
        .when(year == baseline_year + 1, "Recovery")
        .when(year > baseline_year + 1, "Post-COVID")
        .otherwise("Pre-COVID")
    )
