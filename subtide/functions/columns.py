"""Column helpers built on Spark's own functions; nothing here runs Python per row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ntz(text: str) -> Column:
    """A zone-free timestamp literal; compares with parquet columns without a cast."""
    return F.lit(text).cast("timestamp_ntz")


def money(value: ColumnLike, precision: int = 10) -> Column:
    return column(value).cast(f"decimal({precision},2)")


def pct(part: ColumnLike, whole: ColumnLike, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half away from zero; NULL when whole is 0 or NULL.

    The quotient is a decimal with 14 fractional digits, so the rounding is
    exact while ``whole`` stays below 10**12 units. The cast to double is last.
    """
    a = column(part).cast("decimal(20,2)")
    b = F.nullif(column(whole).cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    return F.round(F.lit(100).cast("decimal(3,0)") * a / b, digits).cast("double")


def elapsed_seconds(start: ColumnLike, end: ColumnLike) -> Column:
    """Exact seconds between two zone-free timestamps as decimal(18,6)."""
    return (column(end) - column(start)).cast("interval second").cast("decimal(18,6)")


def month_start(ts: ColumnLike) -> Column:
    """First instant of the month. Goes through DATE, so no time zone is involved."""
    return F.trunc(column(ts).cast("date"), "month").cast("timestamp_ntz")


def days(count: ColumnLike | int) -> Column:
    return F.make_dt_interval(_number(count))


def hours(count: ColumnLike | int) -> Column:
    return F.make_dt_interval(F.lit(0), _number(count))


def _number(value: ColumnLike | int) -> Column:
    return F.lit(value) if isinstance(value, int) else column(value).cast("int")


def first_match(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """CASE over (condition, value) pairs; the first condition that is TRUE wins."""
    (condition, value), *rest = cases
    result = F.when(condition, value)
    for condition, value in rest:
        result = result.when(condition, value)
    return result if default is None else result.otherwise(default)


def outside(value: ColumnLike, allowed: Iterable[object]) -> Column:
    """TRUE for NULL and for anything not in the list."""
    value = column(value)
    return value.isNull() | ~value.isin(*allowed)


def passes(check: Column) -> Column:
    """Constraint semantics: a row fails only when the check is FALSE, never on NULL."""
    return F.coalesce(check, F.lit(True))


def sort_keys(*keys: str) -> list[Column]:
    """Report order: ``"x"`` ascending with NULL last, ``"-x"`` descending with NULL first."""
    return [
        F.col(key[1:]).desc_nulls_first() if key.startswith("-") else F.col(key).asc_nulls_last()
        for key in keys
    ]
