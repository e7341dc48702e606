"""Seeded, engine-independent randomness: everything derives from md5 of seed and key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_md5(seed: int | str, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def leading_int(digest: Column, digits: int = 8) -> Column:
    """The first hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def hashed_int(seed: int | str, *parts: Column) -> Column:
    """Uniform integer in [0, 2^32)."""
    return leading_int(keyed_md5(seed, *parts))


def hashed_uniform(seed: int | str, *parts: Column) -> Column:
    """Uniform double in [0, 1)."""
    return hashed_int(seed, *parts) / F.lit(4294967296.0)


def shuffle_key(seed: int | str, key: Column) -> Column:
    """A text whose order is a seeded shuffle of unique keys; ties are impossible."""
    return F.concat_ws(":", keyed_md5(seed, key), key.cast("string"))


def poisson_weight(u: Column, top: int = 12) -> Column:
    """Poisson(1) draw from a uniform by inverting the distribution function."""
    import math

    total, rungs = 0.0, []
    for k in range(top):
        total += math.exp(-1.0) / math.factorial(k)
        rungs.append(total)
    return sum(((u >= F.lit(r)).cast("int") for r in rungs[1:]), (u >= F.lit(rungs[0])).cast("int"))
