"""Q2: sample size and a repeatable sample of exactly n rows chosen by key hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's defaults when the config gives none.
DEFAULT_SAMPLE_PERCENTAGE = 0.1
DEFAULT_MIN_SAMPLE = 100
DEFAULT_MAX_SAMPLE = 1_000_000


def sample_size(total: int, percentage: float = DEFAULT_SAMPLE_PERCENTAGE,
                min_sample: int = DEFAULT_MIN_SAMPLE, max_sample: int = DEFAULT_MAX_SAMPLE) -> int:
    """``min(total, max(min_sample, min(int(total * percentage), max_sample)))``."""
    return min(total, max(min_sample, min(int(total * percentage), max_sample)))


def _rank_key(keys: list[str]):
    """Hash of the key text: MD5, whose first 8 hex digits also give a uniform fraction."""
    text = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys])
    return F.md5(text)


def sample_rows(df: DataFrame, keys: list[str], n: int, total: int | None = None) -> DataFrame:
    """Exactly ``min(n, total)`` rows: those with the smallest (md5(key), key).

    A histogram of the first four hex digits (at most 65,536 counts) gives the digits at which the
    n-th row lies. Rows below it are taken as they are; only the rows of that one cell, about a
    65,536th of the table, are sorted for the rest.
    """
    if n <= 0:
        return df.limit(0)
    ranked = df.withColumn("__h", _rank_key(keys)).withColumn("__p", F.substring("__h", 1, 4))
    before = 0
    for row in ranked.groupBy("__p").count().orderBy("__p").collect():
        if before + row["count"] >= n:
            cell = ranked.where(F.col("__p") == row["__p"]).orderBy("__h", *keys).limit(n - before)
            return ranked.where(F.col("__p") < row["__p"]).unionByName(cell).drop("__h", "__p")
        before += row["count"]
    return df
