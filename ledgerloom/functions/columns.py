"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"
US_DATE = "M/d/yyyy"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """'' or whitespace-only text becomes NULL (the stage's encoding of missing)."""
    c = col(c)
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def parse_date(c: str | Column) -> Column:
    """Text to DATE; blanks and unparseable text become NULL instead of failing."""
    return F.try_to_date(blank_to_null(c))


def parse_date_us(c: str | Column) -> Column:
    """Strict month/day/year text (the source CSV format)."""
    return F.try_to_date(blank_to_null(c), US_DATE)


def parse_date_lenient(c: str | Column, formats: Sequence[str] = (
        ISO_DATE, US_DATE, "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")) -> Column:
    """First format that parses wins, a time of day is dropped; garbage becomes
    NULL (coerce semantics)."""
    c = blank_to_null(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def format_date(c: str | Column) -> Column:
    return F.date_format(col(c), ISO_DATE)


def effective_from(valid_from: str | Column, order_date: str | Column) -> Column:
    """Version start: the stage's valid_from when present, else the order date."""
    return F.coalesce(parse_date(valid_from), parse_date(order_date))


def distinct_from_any(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """OR of null-safe inequalities (IS DISTINCT FROM)."""
    out = None
    for a, b in pairs:
        term = ~a.eqNullSafe(b)
        out = term if out is None else (out | term)
    return out


def not_distinct_all(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """AND of null-safe equalities (IS NOT DISTINCT FROM)."""
    out = None
    for a, b in pairs:
        term = a.eqNullSafe(b)
        out = term if out is None else (out & term)
    return out


def repair_quantity(q: str | Column) -> Column:
    """Load-script repair: a zero quantity becomes 1."""
    q = col(q)
    return F.when(q == 0, F.lit(1)).otherwise(q)


def repair_quantity_strict(q: str | Column) -> Column:
    """Notebook repair: any non-positive quantity becomes 1."""
    q = col(q)
    return F.when(q <= 0, F.lit(1)).otherwise(q)


def repair_ship_date(ship: str | Column, order: str | Column) -> Column:
    """A shipment can not precede its order; GREATEST ignores NULLs."""
    return F.greatest(col(ship), col(order))


def safe_divide(num: str | Column, den: str | Column, alternate: float = 0.0) -> Column:
    """DIVIDE(a, b, alt): alt when the denominator is NULL or zero, a/b otherwise.

    Both sides are cast to double so the ratio is engine-independent.
    """
    n = col(num).cast("double")
    d = col(den).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(alternate)).otherwise(n / d)


def md5_bucket(c: str | Column, buckets: int = 100) -> Column:
    """Deterministic 0..buckets-1 bucket from the md5 of a text key."""
    return F.conv(F.substring(F.md5(col(c).cast("string")), 1, 4), 16, 10).cast("int") % buckets


def line_amount(price: str | Column, qty: str | Column, discount: str | Column) -> Column:
    """price * quantity * (1 - discount), rounded to cents."""
    return F.round(col(price) * col(qty) * (F.lit(1) - col(discount)), 2).cast("decimal(10,2)")


def asc_last(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def desc_last(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]
