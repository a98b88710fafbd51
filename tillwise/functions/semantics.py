"""Column helpers that pin down results which differ between SQL dialects.

Every helper is a composition of built-in functions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_lit(as_of: date | str) -> Column:
    return F.lit(str(as_of)).cast("date")


# --- dates -----------------------------------------------------------------

def day_of_week(ts: Column | str) -> Column:
    """Day of week counted from Sunday = 0."""
    return F.dayofweek(col(ts)) - F.lit(1)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed between two instants."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def month_steps(start: Column | str, end: Column | str) -> Column:
    """Month boundaries crossed, whatever the day of the month."""
    a, b = col(start), col(end)
    return (F.year(b) - F.year(a)) * F.lit(12) + (F.month(b) - F.month(a))


def days_before(as_of: date | str, days: int) -> Column:
    return F.date_sub(day_lit(as_of), days)


# --- nulls and arithmetic --------------------------------------------------

def _any_null(cols: Sequence[Column]) -> Column:
    test = cols[0].isNull()
    for c in cols[1:]:
        test = test | c.isNull()
    return test


def strict_greatest(*cols: Column) -> Column:
    """``greatest`` that is NULL as soon as one argument is NULL."""
    return F.when(_any_null(cols), None).otherwise(F.greatest(*cols))


def strict_least(*cols: Column) -> Column:
    """``least`` that is NULL as soon as one argument is NULL."""
    return F.when(_any_null(cols), None).otherwise(F.least(*cols))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Quotient as double, NULL for a zero divisor."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def mean(value: Column | str) -> Column:
    """Average as one division of the exact sum by the count.

    Keeping the sum exact makes the result independent of row order and of how
    rows are spread over partitions, which a running double average is not.
    """
    v = col(value)
    return ratio(F.sum(v), F.count(v))


def distinct_if(cond: Column, value: Column | str) -> Column:
    return F.count_distinct(F.when(cond, col(value)))


def ladder(steps: Iterable[tuple[Column, object]], default: object) -> Column:
    """First matching step wins."""
    out = None
    for cond, value in steps:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def at_least(value: Column, steps: Sequence[tuple[float, object]], default: object) -> Column:
    """Descending thresholds: the first one the value reaches decides."""
    return ladder([(value >= F.lit(limit), label) for limit, label in steps], default)


def at_most(value: Column, steps: Sequence[tuple[float, object]], default: object) -> Column:
    """Ascending thresholds: the first one not exceeded decides."""
    return ladder([(value <= F.lit(limit), label) for limit, label in steps], default)


# --- ordering --------------------------------------------------------------

def rank_of(value: Column | str, order: Sequence[object]) -> Column:
    """Position of a value in a fixed list, for sorting labels by meaning."""
    v = col(value)
    return ladder([(v == F.lit(label), i) for i, label in enumerate(order, 1)], len(order) + 1)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                  rank: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per key.

    ``row_number() <= n`` lets Spark put a group limit below the shuffle, so a key
    that owns a large share of the rows sends at most ``n`` rows per map task.
    """
    name = rank or "__rn"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= F.lit(n))
    return out if rank else out.drop(name)


def rounded_ratio(num: Column, den: Column, digits: int) -> Column:
    """Quotient of exact numbers, rounded half away from zero on the exact value."""
    exact = F.try_divide(num.cast("decimal(24,2)"), den.cast("decimal(18,0)"))
    return F.round(exact, digits).cast(f"decimal(24,{digits})")
