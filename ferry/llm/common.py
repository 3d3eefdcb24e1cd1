"""Helpers shared by the training-data operators: whole-table reads, words, written intermediates."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ferry
from ferry.session import run_dir

# Fixed values of the contracts: a word is a run of anything but space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the Python workers of every executor this package, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_ferry_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(ferry.__file__)))
    folder = tempfile.mkdtemp(prefix="ferry-zip-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "ferry"), "zip", root, "ferry"))
    sc._ferry_shipped = True


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of recomputing the plan) and lets
    several consumers share one computation. The schema is carried over, so an empty frame works.
    Spark deletes the shuffle files of the write as soon as it has ended.
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(df: DataFrame) -> None:
    """Delete an intermediate made by ``written`` that no frame reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer referenced.

    Its cleaner does so when the driver's garbage is collected, which on an idle driver heap may
    be long after the intermediate has been written; a collection here frees that disk now. Python drops its
    references to the driver's objects from a thread that looks once a second, so the collection waits for it.
    """
    gc.collect()
    time.sleep(1.5)
    spark.sparkContext._jvm.System.gc()


def smallest(hashed: DataFrame, count: int) -> list:
    """The ``count`` rows with the smallest ``h`` (a uniform 64-bit hash), as a bounded sample.

    Only hashes below a bound that holds about four times the count are looked at first, so each task
    sends its share of a fixed total instead of ``count`` rows; if too few lie below it, all rows are.
    """
    total = hashed.count()
    order = ["h", *[c for c in hashed.columns if c != "h"]]
    if total > 8 * count:
        bound = -(1 << 63) + int((1 << 64) * (4 * count / total))
        got = hashed.where(F.col("h") < F.lit(bound)).orderBy(*order).limit(count).collect()
        if len(got) == count:
            return got
    return hashed.orderBy(*order).limit(count).collect()


def words_of(text: Column) -> Column:
    """Array of the words of a text (empty for a null or blank text)."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def row_key(*cols: str) -> Column:
    """Key of a row within the rows of one doc_id: equal rows share it, so it survives retries."""
    return F.xxhash64(*[F.col(c) for c in cols])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def char_codes(text: Column) -> Column:
    """Code points of an ASCII string (an empty array for an empty one)."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def prefix_sums(numbers: Column, block: int = 256) -> Column:
    """Sum of the numbers before each place, in two levels so that long arrays stay far from quadratic."""
    zero = F.lit(0).cast("bigint")

    def build(xs: Column) -> Column:
        n = F.size(xs)
        blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / block).cast("int") - 1))
        sums = F.transform(blocks, lambda b: F.aggregate(F.slice(xs, b * block + 1, F.lit(block)), zero,
                                                         lambda a, x: a + x))
        before = F.aggregate(sums, F.array(zero), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        at = F.sequence(F.lit(0), n - 1)
        one = lambda base: F.transform(at, lambda i: F.get(base, F.floor(i / block).cast("int")) + F.aggregate(
            F.slice(xs, F.floor(i / block).cast("int") * block + 1, F.pmod(i, F.lit(block))), zero, lambda a, x: a + x))
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(let(before, one))

    return let(numbers, build)


def matches_with_starts(text: Column, pattern: str) -> Column:
    """array<struct<start, end, text>> of the leftmost non-overlapping matches, in code points."""
    def place(parts: Column) -> Column:
        gaps, found = parts["gaps"], parts["found"]
        sizes = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(gaps, i + 1)))
        first = F.length(F.get(gaps, F.lit(0)))
        return let(prefix_sums(F.transform(sizes, lambda s: s.cast("bigint"))), lambda before: F.transform(
            found, lambda m, i: F.struct((F.get(before, i) + first).alias("start"),
                                         (F.get(before, i) + first + F.length(m)).alias("end"), m.alias("text"))))
    both = F.struct(F.split(text, pattern, -1).alias("gaps"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return let(both, place)
