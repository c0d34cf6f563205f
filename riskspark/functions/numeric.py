"""Rounding, safe division and a hash-based uniform number that any SQL engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper ends of the Poisson(1) distribution function for k = 0, 1, 2, ..., as far as numbers of 20 bits reach (fixed values).
POISSON_ONE_CDF = (
    0.36787944117144233,
    0.7357588823428847,
    0.9196986029286058,
    0.9810118431238462,
    0.9963401531726563,
    0.9994058151824183,
    0.999916758850712,
    0.9999897508033253,
    0.999998874797402,
)


def rounded(x: Column, digits: int = 6) -> Column:
    """Round half up. ``F.round`` and other engines' ``round`` differ on ties, this form does not."""
    scale = F.lit(10.0**digits)
    return F.floor(x * scale + F.lit(0.5)).cast("double") / scale


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0 where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def hashed(seed: str, *keys: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *[k.cast("string") for k in keys]))


def hex_to_unit(digest: Column, start: int = 1, digits: int = 8) -> Column:
    """``digits`` hex digits of a digest, from 1-based ``start``, as a number in [0, 1)."""
    part = F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")
    return part.cast("double") / F.lit(float(16**digits))


def hash_uniform(seed: str, *keys: Column, digits: int = 8) -> Column:
    """A uniform number in [0, 1) that depends only on the seed and the keys."""
    return hex_to_unit(hashed(seed, *keys), 1, digits)
