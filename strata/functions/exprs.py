"""Column-expression builders (JVM-side, codegen-friendly; no Python UDFs)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den, plus: float = 1.0) -> Column:
    """``num / (den + plus)`` -- the smoothed ratio used by every derived feature.

    ``try_divide`` keeps ANSI mode from raising when the denominator is 0.
    """
    return F.try_divide(col(num).cast("double"), col(den).cast("double") + F.lit(plus))


def clip(c, lo: float = 0.0, hi: float = 1.0) -> Column:
    """``c`` between ``lo`` and ``hi``; a missing value stays missing (``least`` and ``greatest`` would skip it)."""
    x = present(c)
    return F.when(x < F.lit(lo), F.lit(lo)).when(x > F.lit(hi), F.lit(hi)).otherwise(x)


def present(c) -> Column:
    """``c`` as DOUBLE with NaN as NULL (Spark keeps the two apart; the source treats both as missing)."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x), x)


def finite(c) -> Column:
    """``c`` as DOUBLE with NaN and +/-inf as NULL."""
    x = present(c)
    return F.when(F.abs(x) < F.lit(math.inf), x)


def is_missing(c) -> Column:
    c = col(c)
    return c.isNull() | F.isnan(c)


def row_sum(cols: Sequence) -> Column:
    return reduce(add, [col(c) for c in cols])


def right_closed_cut(c, edges: Sequence[float], labels: Sequence | None = None) -> Column:
    """pandas ``cut(right=True)``: value in ``(edges[i], edges[i+1]]`` -> ``labels[i]``.

    Values ``<= edges[0]`` or above the last edge are NULL.  (MLlib's Bucketizer is
    left-closed, hence this builder.)
    """
    c = col(c)
    labels = list(labels) if labels is not None else list(range(1, len(edges)))
    expr = F.lit(None)
    for i in range(len(edges) - 2, -1, -1):
        lo, hi = edges[i], edges[i + 1]
        cond = c > F.lit(lo)
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(labels[i])).otherwise(expr)
    return expr


def shares(cols: Sequence, eps: float = 1e-8) -> list[Column]:
    """``(k_i + eps) / sum_j (k_j + eps)`` for a family of count columns."""
    parts = [col(c).cast("double") + F.lit(eps) for c in cols]
    total = reduce(add, parts)
    return [p / total for p in parts]


def entropy_log2(cols: Sequence, eps: float = 1e-8) -> Column:
    """Shannon entropy (bits) of the family shares, unrolled -- one codegen'd expression."""
    return -reduce(add, [p * F.log2(p) for p in shares(cols, eps)])


def max_share(cols: Sequence, eps: float = 1e-8) -> Column:
    return F.greatest(*shares(cols, eps))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Schema walk for numeric columns (pandas ``select_dtypes(np.number)``)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def family(df_or_cols, token: str) -> list[str]:
    """Column-family match by substring, resolved at plan-build time."""
    cols = df_or_cols.columns if isinstance(df_or_cols, DataFrame) else list(df_or_cols)
    return [c for c in cols if token in c]


def rounded(df: DataFrame, digits: int = 6, exclude: Sequence[str] = ()) -> DataFrame:
    """Round every floating column (stable comparison output)."""
    ex = set(exclude)
    out = []
    for f in df.schema.fields:
        if f.name not in ex and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
