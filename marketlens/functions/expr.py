"""Column expressions shared by the conversion jobs and the reports.

Everything here returns a ``Column`` built from Spark's own functions. All but the
array products (``dot``, ``norm``: lambdas) stay inside whole-stage code
generation.

Rounding. ``ROUND(AVG(x), n)`` over doubles depends on summation order and on
how an engine rounds a binary fraction (``1.005`` is ``1.00499…`` in binary).
The reports therefore keep sums exact (money as ``decimal(28,8)``, counts as
longs), never round a row, and round a ratio of two exact numbers with integer division, half away
from zero. The result is the correctly rounded value of the true ratio, the
same on every engine and every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StructType

# Money values of a row keep eight decimals; their sums are exact in decimal.
MONEY = "decimal(28,8)"
MONEY_SCALE = 8


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact decimal view of a money column."""
    return _c(c).cast(MONEY)


def money_total(c) -> Column:
    """An exact money sum, rounded once to cents, as double."""
    return F.round(_c(c), 2).cast("double")


def round_ratio(num: str, den: str, digits: int, num_scale: int = 0) -> Column:
    """``round(num / den, digits)`` half away from zero, computed exactly.

    ``num`` and ``den`` are SQL expressions (column names or arithmetic on
    them): ``num`` an exact number with ``num_scale`` fraction digits (a long, or
    a decimal such as a money sum), ``den`` a non-negative integer. NULL when
    ``den`` is 0 or either side is NULL. Returned as double.
    """
    n, d = f"({num})", f"({den})"
    big_n = f"CAST({n} * {10 ** num_scale} AS DECIMAL(38,0))"
    big_d = f"CAST(CAST({d} AS DECIMAL(38,0)) * {10 ** num_scale} AS DECIMAL(38,0))"
    twice = f"CAST(2 * abs({big_n}) * {10 ** digits} + {big_d} AS DECIMAL(38,0))"
    q = f"({twice} div CAST(2 * {big_d} AS DECIMAL(38,0)))"
    return F.expr(f"CASE WHEN {n} IS NULL OR {d} IS NULL OR {d} = 0 THEN CAST(NULL AS DOUBLE) "
                  f"ELSE CAST((CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * {q} AS DOUBLE) "
                  f"/ {float(10 ** digits)}D END")


def days_between(start, end) -> Column:
    """Whole 24-hour days from ``start`` to ``end``, truncated toward zero.

    ``23:00 → 01:00`` next day is 0 days; negative spans are negative.
    """
    return F.timestamp_diff("DAY", _c(start), _c(end))


def trunc_ntz(unit: str, c) -> Column:
    """Truncate a ``timestamp_ntz`` to month or quarter, staying time-zone free."""
    if unit not in ("month", "quarter", "year"):
        raise ValueError(f"unsupported unit {unit!r}")
    return F.trunc(F.to_date(_c(c)), unit).cast("timestamp_ntz")


def first_non_null_by(value: str, order_cols: list[str]) -> Column:
    """The ``value`` of the row that sorts first on ``order_cols``, skipping
    rows where ``value`` is NULL (deterministic stand-in for "first in file").

    Built as ``min(struct(order..., value))`` so partial aggregation applies.
    """
    # sort columns after the value cannot change which value is first: they are neither held nor moved
    kept = order_cols[:order_cols.index(value) + 1] if value in order_cols else [*order_cols, value]
    return F.min(F.when(F.col(value).isNotNull(), F.struct(*kept))).getField(value)


def nan_to_null(c) -> Column:
    """NaN → NULL for double columns (foreign Parquet files may hold NaN)."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def nan_free(df: DataFrame) -> DataFrame:
    """NaN → NULL in every floating-point column, struct fields included."""
    def clean(col: Column, kind: DataType) -> Column:
        if isinstance(kind, (DoubleType, FloatType)):
            return F.when(~F.isnan(col), col)
        if isinstance(kind, StructType) and any(isinstance(f.dataType, (DoubleType, FloatType, StructType))
                                                for f in kind.fields):
            made = F.struct(*[clean(col[f.name], f.dataType).alias(f.name) for f in kind.fields])
            return F.when(col.isNotNull(), made)
        return col
    return df.select(*[clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def label_or_unknown(c) -> Column:
    """Empty or NULL → 'unknown'."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit("unknown"))


def dot(a: str, b: str) -> Column:
    """Dot product of two equal-length double arrays, summed left to right from 0.0."""
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> x * y), 0D, (s, x) -> s + x)")


def norm(a: str) -> Column:
    """Euclidean norm of a double array."""
    return F.sqrt(dot(a, a))


def cosine_of(dot_product: Column, norm_a, norm_b) -> Column:
    """Cosine from a dot product and two stored norms; 0.0 when a norm is 0."""
    scale = _c(norm_a) * _c(norm_b)
    return F.when(scale > 0, dot_product / scale).otherwise(F.lit(0.0))


def cosine(a: str, b: str) -> Column:
    """Cosine of two equal-length double arrays; 0.0 when a norm is 0."""
    return cosine_of(dot(a, b), norm(a), norm(b))
