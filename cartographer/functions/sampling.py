"""Deterministic, partition-independent sampling and splitting by key hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10000


def key_hash(*keys: Column, seed: int = 42) -> Column:
    """32-bit hash of the keys: the first hex digits of an md5, which any engine can repeat."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(*keys: Column, seed: int = 42) -> Column:
    return F.pmod(key_hash(*keys, seed=seed), F.lit(BUCKETS))


def in_fraction(frac: float, *keys: Column, seed: int = 42) -> Column:
    return hash_bucket(*keys, seed=seed) < F.lit(round(frac * BUCKETS))
