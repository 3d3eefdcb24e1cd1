"""Column profiles: per-column statistics in one pass per question, never one scan per column.

``column_stats`` (Q3, Q4, Q7) answers count, null count, exact distinct count, string min/max,
average length and the boolean-like flag for every column of an all-text frame in two passes:

* one global aggregate (one row per task is shuffled) for counts, lengths, min and max;
* the distinct counts and the boolean test: ``unpivot`` to (column, 128-bit hash of the value) and
  ``groupBy`` of the hashes with map-side partial aggregation. Hot values collapse before the shuffle,
  text of any length travels as 16 bytes, and both levels are hash aggregates.

On the source side the few columns that turn out boolean-like are read once more for their min, max
and length after boolean normalisation.

``profile_columns`` (S5, P5) is the source-type / max-length / nullable profile the target
schema is built from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions import text as X
from ferry.functions.names import column_mapping, quote_identifier
from ferry.functions.normalise import bool_normalise, is_blank, py_strip
from ferry.session import shared_dir

STATS_COLUMNS = ["column_name", "position", "row_count", "non_null_count", "null_count",
                 "distinct_count", "min_value", "max_value", "avg_length", "is_boolean_like"]


def _col(name: str):
    return F.col(f"`{name}`")


def _edge_space(c):
    """First or last character is Python whitespace (only then can a strip change the value)."""
    spaces = F.lit(X.PY_WHITESPACE)
    return (F.length(c) > 0) & (spaces.contains(F.substring(c, 1, 1)) | spaces.contains(F.substring(c, -1, 1)))


def _boolish(v):
    """Blank, or a boolean word once stripped and lower-cased (the Q3 value test). The strip and
    ``lower`` only run for values short enough to be a word or with whitespace at an end."""
    longest = max(len(w) for w in X.BOOL_LIKE)
    return F.when(_edge_space(v), F.lower(py_strip(v)).isin(*X.BOOL_LIKE) | is_blank(v)) \
        .when(F.length(v) <= longest, (F.length(v) == 0) | F.lower(v).isin(*X.BOOL_LIKE)) \
        .otherwise(F.lit(False))


def maybe_boolish(v):
    """True for every value that passes ``_boolish``, and for few others: only its first and last character are
    looked at, as code points."""
    def points(chars):
        return sorted({ord(c) for c in chars} | {ord(c) for c in X.PY_WHITESPACE})
    first = {c for w in X.BOOL_LIKE for c in (w[0], w[0].upper())}
    last = {c for w in X.BOOL_LIKE for c in (w[-1], w[-1].upper())}
    return (v == "") | (F.ascii(v).isin(*points(first)) & F.ascii(F.right(v, F.lit(1))).isin(*points(last)))


def _bool_word(v):
    """1 for a true word, 2 for a false word, else 0. The lower-casing sees one character more than the
    longest word has, so long values cost nothing and never match."""
    low = F.lower(F.substring(v, 1, max(len(w) for w in X.BOOL_TRUE + X.BOOL_FALSE) + 1))
    return F.when(low.isin(*X.BOOL_TRUE), 1).when(low.isin(*X.BOOL_FALSE), 2).otherwise(0)


def hash128(v):
    """Two 64-bit hashes of a text under different seeds (the constant goes first, so neither is a
    function of the other)."""
    return F.xxhash64(F.lit("a"), v), F.xxhash64(F.lit("b"), v)


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column_name, distinct_non_null, b_distinct, all_boolish): distinct non-null values of every
    column, the same after Q4 normalisation (the values '1' and '0', plus every other value), and
    whether every value passes the boolean test."""
    v = F.col("v")
    one, two = hash128(v)
    rows = df.unpivot([], df.columns, "column_name", "v").where(v.isNotNull())
    values = rows.select("column_name", one.alias("h1"), two.alias("h2"),
                         F.when(maybe_boolish(v), _bool_word(v)).otherwise(0).alias("word"),
                         F.when(maybe_boolish(v) & _boolish(v), 1).otherwise(0).alias("boolish")) \
        .groupBy("column_name", "h1", "h2").agg(F.max("word").alias("word"), F.min("boolish").alias("boolish"))
    return values.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_non_null"),
        (F.max(F.when(F.col("word") == 1, 1).otherwise(0)) + F.max(F.when(F.col("word") == 2, 1).otherwise(0))
         + F.count_if(F.col("word") == 0)).alias("b_distinct"),
        (F.min("boolish") == 1).alias("all_boolish"))


def _whole_column(df: DataFrame) -> DataFrame:
    """One row per column from one global aggregate: counts, total length, min and max."""
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, c in enumerate(df.columns):
        v = _col(c)
        aggs += [F.count(v).alias(f"c{i}"), F.sum(F.length(v)).alias(f"l{i}"), F.min(v).alias(f"m{i}"), F.max(v).alias(f"x{i}")]
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.col("n").alias("row_count"),
            F.col(f"c{i}").alias("non_null_count"), F.col(f"l{i}").alias("sum_len"), F.col(f"m{i}").alias("min_value"),
            F.col(f"x{i}").alias("max_value")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _normalised_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Min, max and total length after Q4 normalisation of the named columns (usually few or none)."""
    aggs, rows = [], []
    for i, c in enumerate(columns):
        b = bool_normalise(_col(c))
        aggs += [F.min(b).alias(f"m{i}"), F.max(b).alias(f"x{i}"), F.sum(F.length(b)).alias(f"l{i}")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("b_min"), F.col(f"x{i}").alias("b_max"),
                             F.col(f"l{i}").alias("b_len")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _is_boolean_like():
    return (F.col("distinct_non_null") > 0) & (F.col("distinct_non_null") <= X.BOOL_LIKE_MAX_DISTINCT) & F.col("all_boolish")


def column_stats(df: DataFrame, normalise_booleans: bool = False) -> DataFrame:
    """Q7 statistics of every column of an all-text frame, one row per column.

    ``distinct_count`` counts NULL as one value when present. ``min_value``/``max_value`` are
    string min/max over non-null values, ``avg_length`` the mean length in characters of
    non-null values. With ``normalise_booleans`` (source side), boolean-like columns are
    profiled after Q4 normalisation. Distinct values are told apart by 128-bit hashes.
    """
    # all frames joined here hold one row per column; an empty table still gives one per column
    distincts = distinct_counts(df)
    like_columns: list[str] = []
    if normalise_booleans:
        shared_dir(df.sparkSession)
        distincts = distincts.checkpoint(eager=True)
        like_columns = [r[0] for r in distincts.where(_is_boolean_like()).select("column_name").collect()]
    out = _whole_column(df).join(F.broadcast(distincts), "column_name", "left")
    distinct = F.coalesce("distinct_non_null", F.lit(0))
    like = F.coalesce(_is_boolean_like(), F.lit(False))
    mn, mx, sl = F.col("min_value"), F.col("max_value"), F.col("sum_len")
    if like_columns:
        out = out.join(F.broadcast(_normalised_stats(df, like_columns)), "column_name", "left")
        distinct = F.when(like, F.col("b_distinct")).otherwise(distinct)
        mn, mx = F.when(like, F.col("b_min")).otherwise(mn), F.when(like, F.col("b_max")).otherwise(mx)
        sl = F.when(like, F.col("b_len")).otherwise(sl)
    nn = F.col("non_null_count")
    null_count = F.col("row_count") - nn
    return out.select(
        "column_name", F.col("position").cast("int").alias("position"), F.col("row_count").cast("bigint").alias("row_count"),
        nn.cast("bigint").alias("non_null_count"), null_count.cast("bigint").alias("null_count"),
        (distinct + F.when(null_count > 0, 1).otherwise(0)).cast("bigint").alias("distinct_count"),
        mn.alias("min_value"), mx.alias("max_value"),
        F.when(nn > 0, sl.cast("double") / nn).alias("avg_length"), like.alias("is_boolean_like"))


def bool_like_columns(df: DataFrame) -> DataFrame:
    """Q3 only: (column_name, distinct_non_null, is_boolean_like)."""
    return distinct_counts(df).select("column_name", F.col("distinct_non_null").cast("bigint"),
                                      _is_boolean_like().alias("is_boolean_like"))


# ---------------------------------------------------------------------------------------------
# The profile the target schema is made from
# ---------------------------------------------------------------------------------------------

def _type_parts(dtype: T.DataType) -> tuple[str, int | None, int | None]:
    if isinstance(dtype, T.DecimalType):
        return dtype.simpleString(), dtype.precision, dtype.scale
    return dtype.simpleString(), None, None


def profile_columns(source: DataFrame, text: DataFrame) -> DataFrame:
    """Per column: position, source type, precision/scale, target name, max text length
    (255 when there are no non-null values), nullable (a NULL is present).

    ``source`` gives the types, ``text`` (its read-stage form) the lengths; one global aggregate.
    """
    mapping = column_mapping(source.columns)
    aggs = []
    for i, c in enumerate(text.columns):
        aggs += [F.max(F.length(_col(c))).alias(f"ml{i}"), F.count_if(_col(c).isNull()).alias(f"nl{i}")]
    wide = text.agg(*aggs)
    rows = []
    for i, f in enumerate(source.schema.fields):
        tname, prec, scale = _type_parts(f.dataType)
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("position"),
            F.lit(tname).alias("source_type"),
            F.lit(prec).cast("int").alias("precision"), F.lit(scale).cast("int").alias("scale"),
            F.lit(mapping[f.name]).alias("target_name"),
            F.lit(quote_identifier(mapping[f.name])).alias("target_identifier"),
            F.coalesce(F.col(f"ml{i}"), F.lit(255)).cast("int").alias("max_length"),
            (F.col(f"nl{i}") > 0).alias("nullable")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
