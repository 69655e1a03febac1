"""Seeded, engine-independent randomness from md5(key:seed:i).

Every random draw is a pure function of the row key, so results are the same
on every run, every partitioning and every engine (DuckDB spells the same
uniform ``('0x' || substr(md5(k || ':' || seed || ':' || i), 1, 8))::BIGINT / 4294967296``).
No shuffle, no driver state.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_uniform(key, seed: int = 42, i: int | str = 0) -> Column:
    """Uniform in [0, 1) from the first 32 bits of md5("key:seed:i")."""
    token = F.concat(_col(key).cast("string"), F.lit(f":{seed}:{i}"))
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def md5_int(key, seed: int = 42, i: int | str = 0) -> Column:
    """The same 32-bit draw as an integer in [0, 2^32)."""
    token = F.concat(_col(key).cast("string"), F.lit(f":{seed}:{i}"))
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")


def beta_2_5(key, seed: int = 42) -> Column:
    """Beta(2, 5) draw: the 2nd smallest of six independent uniforms (order statistic)."""
    us = [md5_uniform(key, seed, i) for i in range(1, 7)]
    return F.sort_array(F.array(*us)).getItem(1)


def bernoulli(key, p: float, seed: int = 42, i: int | str = 0) -> Column:
    return (md5_uniform(key, seed, i) < F.lit(p)).cast("int")
