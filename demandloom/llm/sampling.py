"""Bounded samples for training, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPARE = 2  # times the rows wanted that pass the bound on the hash


def smallest_hashes(df: DataFrame, columns: list[str], most: int) -> DataFrame:
    """At most ``most`` distinct rows, those whose hash of ``columns`` is smallest.

    The number of rows tells below which hash about twice as many lie, so tasks sort and
    send no more than those, however many there are. Where many rows are copies of each
    other fewer than ``most`` may be found.
    """
    rows = df.count()
    share = min(1.0, SPARE * most / max(rows, 1))
    hashed = F.xxhash64(*columns)
    bound = min(2**63 - 1, int(-(2**63) + share * 2**64))
    few = df.where(hashed <= F.lit(bound)).distinct()
    return few.orderBy(hashed, *columns).limit(most)
