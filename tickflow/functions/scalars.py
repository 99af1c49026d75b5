"""Scalar rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABELS = ("DOWN", "STABLE", "UP")
DAY_US, HOUR_US, MINUTE_US = 86_400_000_000, 3_600_000_000, 60_000_000
PSI_SIGNIFICANT, PSI_MODERATE = 0.25, 0.10


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp, with or without a zone (then UTC)."""
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def over(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return a / F.nullif(b, F.lit(0.0))


def ratio_to(value: Column, baseline: Column) -> Column:
    return over(value, baseline) - 1


def forward_return(current: Column, future: Column) -> Column:
    """Null where the current price is not positive: such ticks are diverted before."""
    return F.when(current > 0, (future - current) / current)


def label_of(ret: Column, theta: Column | float) -> Column:
    """UP above theta, DOWN below -theta, else STABLE (the edges too)."""
    theta = theta if isinstance(theta, Column) else F.lit(_non_negative(theta))
    return F.when(ret > theta, "UP").when(ret < -theta, "DOWN").when(ret.isNotNull(), "STABLE")


def _non_negative(theta: float) -> float:
    if theta < 0:
        raise ValueError("theta must not be negative")
    return float(theta)


def label_index(label: Column) -> Column:
    return F.when(label == "DOWN", 0).when(label == "STABLE", 1).when(label == "UP", 2)


def age_seconds(now_us: int | Column, t: Column) -> Column:
    now = now_us if isinstance(now_us, Column) else F.lit(now_us)
    return F.greatest((now - t) / 1e6, F.lit(0.0))


def psi_severity(psi: Column) -> Column:
    """The edges belong to the lower band."""
    return F.when(psi > PSI_SIGNIFICANT, "significant").when(psi > PSI_MODERATE, "moderate").otherwise("stable")


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "significant", 2).when(severity == "moderate", 1).otherwise(0)


def floor_to(t: Column, step_us: int) -> Column:
    """The start of the step that t (microseconds) lies in."""
    return t - F.pmod(t, F.lit(step_us))


def month_ordinal(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts) - 1


def archivable(month: Column, as_of: Column, keep_months: int) -> Column:
    """Whether a month lies more than keep_months before that of as_of."""
    return month_ordinal(month) < month_ordinal(as_of) - keep_months


def probabilities_map(probabilities: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """label -> probability; another number of probabilities is an error."""
    return F.when(F.size(probabilities) == len(labels), F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), probabilities)).otherwise(F.raise_error(F.lit("wrong number of probabilities")))


def argmax_label(probabilities: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """The label of the largest probability, the first of equals."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), F.array_position(probabilities, F.array_max(probabilities)).cast("int"))


def one_hot(label: Column, labels: tuple[str, ...] = LABELS) -> Column:
    return F.array(*[F.when(label == x, 1.0).otherwise(0.0) for x in labels])
