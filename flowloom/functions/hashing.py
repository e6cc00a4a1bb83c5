"""Seeded, engine-independent order: md5 of an explicit string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(seed: int, *keys: str) -> Column:
    """``md5('<seed>:<key>[:<key>…]')``; the same text in any SQL engine gives the same order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
