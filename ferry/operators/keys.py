"""Key rules as data checks (K5 primary key, K6 unique index, K7 foreign key).

All three are aggregations with map-side partial aggregation, so a key value holding a third of
the rows is reduced to one row per map task before any shuffle. Nothing pairs rows with rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cols(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def pk_violations(df: DataFrame, keys) -> DataFrame:
    """K5: key values held by more than one row, and key values with a NULL part.

    Output: the key columns, ``row_count``, ``violation`` (``DUPLICATE`` or ``NULL_KEY``).
    """
    keys = _cols(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
    return g.where(any_null | (F.col("row_count") > 1)).select(
        *keys, "row_count", F.when(any_null, "NULL_KEY").otherwise("DUPLICATE").alias("violation"))


def unique_violations(df: DataFrame, keys) -> DataFrame:
    """K6: duplicates that a unique index would refuse. Keys that are NULL in every part are
    exempt (they are not indexed); partly NULL keys repeat only with equal non-NULL parts."""
    keys = _cols(keys)
    all_null = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    return df.where(~all_null).groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("row_count")) \
        .where(F.col("row_count") > 1)


def fk_orphans(child: DataFrame, fk, parent: DataFrame, ref) -> DataFrame:
    """K7: child foreign-key values (not NULL) that no parent row has, with their row counts.

    The child side is aggregated per key value first, then anti-joined with the distinct parent
    keys; AQE turns the join into a broadcast when the parent keys turn out small.
    """
    fk, ref = _cols(fk), _cols(ref)
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk])
    counted = child.where(not_null).groupBy(*fk).agg(F.count(F.lit(1)).cast("bigint").alias("orphan_rows"))
    parent_keys = parent.select(*[F.col(r).alias(f) for r, f in zip(ref, fk)]).distinct()
    return counted.join(parent_keys, on=fk, how="left_anti")
