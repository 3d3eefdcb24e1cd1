"""Value rules as Spark column expressions.

Three stages, each one ``select`` over all columns:

* ``read``  - what happens while the source is fetched: binary to hex, date/time to millisecond
  text, padding trim and Unicode NFC of text, everything else cast to string.
* ``load``  - the cleaning applied before the insert: blank text kept, null tokens to NULL,
  ``true``/``false`` to ``1``/``0``, timestamp text cut to milliseconds, truncation to the column
  length.  First matching rule wins.
* ``check`` - the alternative rule set used when comparing: blank to NULL, a wider boolean
  vocabulary, no truncation.

NFC has no Spark built-in; it calls ICU (shipped with Spark 4) inside the JVM, and only for
text that is not pure ASCII. That call is reflection, so a projection with text columns is not in
whole-stage code generation; every other rule is a built-in expression. An Arrow UDF over the
non-ASCII values is the fallback.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions import text as X


# ---------------------------------------------------------------------------------------------
# single rules
# ---------------------------------------------------------------------------------------------

def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: drop the whole Unicode whitespace set from both ends."""
    return F.btrim(c, F.lit(X.PY_WHITESPACE))


def is_blank(c: Column) -> Column:
    """Empty or whitespace-only (Python ``v.strip() == ''``); the strip only runs for values whose
    first character is whitespace."""
    first_space = F.lit(X.PY_WHITESPACE).contains(F.substring(c, 1, 1))
    return (F.length(c) == 0) | (first_space & (py_strip(c) == F.lit("")))


def _short_lower(c: Column, longest: int) -> Column:
    """lower(c) for values of at most ``longest`` characters, NULL otherwise (cheap token tests)."""
    return F.when(F.length(c) <= longest, F.lower(c))


def stringify(c: Column) -> Column:
    """Any value to text (decimals keep their scale, booleans become true/false)."""
    return c.cast("string")


def binary_hex(c: Column) -> Column:
    """Bytes to lower-case hex; zero bytes give ''."""
    return F.lower(F.hex(c))


def bytes_decode(c: Column) -> Column:
    """Bytes to text as UTF-8 when valid, otherwise as Latin-1 (never fails)."""
    return F.when(F.is_valid_utf8(c.cast("string")), F.decode(c, "UTF-8")) \
        .otherwise(F.decode(c, "ISO-8859-1"))


def datetime_ms(c: Column) -> Column:
    """date/time value to ``yyyy-MM-dd HH:mm:ss.SSS`` (truncated, never rounded)."""
    return F.date_format(c, X.DATETIME_FORMAT)


def date_only(c: Column) -> Column:
    """N4 option: a pure date as ``yyyy-MM-dd``."""
    return F.date_format(c, X.DATE_FORMAT)


def pad_trim(c: Column) -> Column:
    """Trim fixed-width padding off identifier-like text.

    Applies only when the text ends in a space and, stripped of all whitespace at both ends and
    with ``/ - _`` removed, is a non-empty run of letters and digits.
    """
    stripped = py_strip(c)
    ident = F.regexp_replace(stripped, X.ID_SEPARATORS, "").rlike(X.ALNUM_ONLY)
    return F.when(c.endswith(" ") & ident, stripped).otherwise(c)


def _nfc_values(values: pa.Array) -> pa.Array:
    out = []
    for v in values.to_pylist():
        if v is None or unicodedata.is_normalized("NFC", v):
            out.append(v)
        else:
            out.append(unicodedata.normalize("NFC", v))
    return pa.array(out, type=pa.string())


_nfc_udf = F.arrow_udf(_nfc_values, T.StringType())

# ICU4J ships with Spark 4 (collation support); its static compose(text, false) is NFC.
ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"


def nfc(c: Column, engine: str = "jvm") -> Column:
    """Unicode NFC, only evaluated for text that is not pure ASCII (length != byte length).

    ``engine='jvm'`` calls ICU inside the executor JVM; ``'python'`` uses an Arrow UDF that is
    handed the non-ASCII values only (for a Spark build without ICU).
    """
    non_ascii = F.length(c) != F.octet_length(c)
    if engine == "python":
        return F.coalesce(_nfc_udf(F.when(non_ascii, c)), c)
    return F.when(non_ascii, F.java_method(F.lit(ICU_NORMALIZER), F.lit("compose"), c, F.lit(False))).otherwise(c)


def datetime_text(c: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS.ffffff...`` text to millisecond text; the rest is dropped.

    Cheap position tests guard the regex so ordinary text never pays for it.
    """
    shaped = (F.length(c) >= 26) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 11, 1) == " ") \
        & (F.substring(c, 20, 1) == ".")
    return F.when(shaped, F.regexp_replace(c, X.DATETIME_TEXT, "$1.$2")).otherwise(c)


def truncate(c: Column, max_chars: int = X.TARGET_TEXT_CHARS) -> Column:
    """Keep the first ``max_chars`` characters (code points, not bytes)."""
    return F.left(c, F.lit(max_chars))


def null_token(c: Column) -> Column:
    """N8 test: ``null`` or ``<null>`` in any case."""
    return F.lower(c).isin(*X.NULL_TOKENS)


# ---------------------------------------------------------------------------------------------
# rule chains for one value
# ---------------------------------------------------------------------------------------------

def read_value(c: Column, dtype: T.DataType, *, binary: str = "hex", date_style: str = "timestamp",
               trim_padding: bool = True, unicode_nfc: bool = True, nfc_engine: str = "jvm") -> Column:
    """Read-stage rules for one column of the given Spark type."""
    if isinstance(dtype, T.BinaryType):
        return binary_hex(c) if binary == "hex" else bytes_decode(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return datetime_ms(c)
    if isinstance(dtype, T.TimeType):
        return F.concat(F.lit(X.BARE_TIME_DATE + " "), F.substring(F.rpad(c.cast("string"), 15, ".000000"), 1, 12))
    if isinstance(dtype, T.DateType):
        return date_only(c) if date_style == "date" else datetime_ms(c)
    if isinstance(dtype, T.StringType):
        out = pad_trim(c) if trim_padding else c
        return nfc(out, nfc_engine) if unicode_nfc else out
    return stringify(c)


def load_value(c: Column, max_chars: int | None = X.TARGET_TEXT_CHARS) -> Column:
    """Load-stage rules (N10, N8, N9, N5, N12) for one text column; first match wins."""
    low = _short_lower(c, max(len(t) for t in X.NULL_TOKENS + (X.LOAD_TRUE, X.LOAD_FALSE)))
    rest = datetime_text(c)
    if max_chars is not None:
        rest = truncate(rest, max_chars)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(is_blank(c), c)
            .when(low.isin(*X.NULL_TOKENS), F.lit(None).cast("string"))
            .when(low == X.LOAD_TRUE, F.lit("1"))
            .when(low == X.LOAD_FALSE, F.lit("0"))
            .otherwise(rest))


def check_value(c: Column) -> Column:
    """Check-stage rules (N15) for one text column."""
    low = _short_lower(c, max(len(t) for t in X.NULL_TOKENS + X.CHECK_BOOL_WORDS))
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(is_blank(c), F.lit(None).cast("string"))
            .when(low.isin(*X.NULL_TOKENS), F.lit(None).cast("string"))
            .when(low.isin(*X.CHECK_TRUE), F.lit("1"))
            .when(low.isin(*X.CHECK_FALSE), F.lit("0"))
            .otherwise(datetime_text(c)))


def load_rules_can_apply(dtype: T.DataType, binary: str = "hex") -> str:
    """Which load rules can change the read-stage text of a column of this source type.

    ``none``: numbers, dates and timestamps render as short text that is never blank, a null
    token, boolean text, timestamp text with six fraction digits, or longer than the limit.
    ``truncate``: hex of bytes only needs the length limit. ``all`` otherwise.
    """
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                          T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "none"
    if isinstance(dtype, T.BinaryType) and binary == "hex":
        return "truncate"
    return "all"


def bool_normalise(c: Column) -> Column:
    """Q4: value of a boolean-like column; lower-cased but *not* stripped before the match."""
    low = F.lower(c)
    return F.when(low.isin(*X.BOOL_TRUE), F.lit("1")).when(low.isin(*X.BOOL_FALSE), F.lit("0")) \
        .otherwise(c)


def bool_normalise_single(c: Column) -> Column:
    """Q5: one value, lower-cased and stripped; non-boolean text comes back lower-cased, stripped."""
    v = F.lower(py_strip(c))
    return F.when(v.isin(*X.BOOL_TRUE), F.lit("1")).when(v.isin(*X.BOOL_FALSE), F.lit("0")).otherwise(v)


# ---------------------------------------------------------------------------------------------
# whole frames
# ---------------------------------------------------------------------------------------------

def read_stage(df: DataFrame, **options) -> DataFrame:
    """Every column to text under the read rules, names unchanged."""
    return df.select([read_value(F.col(f"`{f.name}`"), f.dataType, **options).alias(f.name)
                      for f in df.schema.fields])


def normalise(df: DataFrame, stage: str = "load", max_chars: int | None = X.TARGET_TEXT_CHARS,
              **read_options) -> DataFrame:
    """Source frame to the text the target receives (``load``) or to the check form (``check``).

    Two projections: the read rules give every column one text, and the load or check rules
    refer to that column, so no read rule is repeated in their branches. Load rules are only
    attached where the source type lets them change anything (``load_rules_can_apply``). Filter
    before normalising: a filter above a frame with text columns stays above the NFC call.
    """
    if stage not in ("read", "load", "check"):
        raise ValueError(f"unknown stage {stage!r}")
    text = read_stage(df, **read_options)
    if stage == "read":
        return text
    cols = []
    for f in df.schema.fields:
        v = F.col(f"`{f.name}`")
        if stage == "check":
            v = check_value(v)
        else:
            scope = load_rules_can_apply(f.dataType, read_options.get("binary", "hex"))
            if scope == "all":
                v = load_value(v, max_chars)
            elif scope == "truncate" and max_chars is not None:
                v = truncate(v, max_chars)
        cols.append(v.alias(f.name))
    return text.select(cols)


def truncation_report(df: DataFrame, max_chars: int = X.TARGET_TEXT_CHARS) -> DataFrame:
    """Per column, how many values the load stage cuts, and how long / how many lines.

    Input is the read-stage frame. Blank values are never cut, so they are left out, as are
    values that become NULL or 1/0. One global aggregate: a single row per partition is shuffled.
    Line count follows the reference: ``count('\\n') + count('\\r\\n') + 1``.
    """
    aggs = []
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        low = F.lower(v)
        cut_text = datetime_text(v)
        eligible = v.isNotNull() & ~is_blank(v) & ~low.isin(*X.NULL_TOKENS) \
            & ~low.isin(X.LOAD_TRUE, X.LOAD_FALSE)
        long_value = eligible & (F.length(cut_text) > max_chars)
        lf = F.length(cut_text) - F.length(F.replace(cut_text, F.lit("\n"), F.lit("")))
        crlf = (F.length(cut_text) - F.length(F.replace(cut_text, F.lit("\r\n"), F.lit("")))) / 2
        multi = cut_text.contains("\n") | cut_text.contains("\r")
        aggs += [
            F.count_if(long_value).alias(f"t{i}"),
            F.count_if(long_value & multi).alias(f"m{i}"),
            F.max(F.when(long_value, F.length(cut_text))).alias(f"x{i}"),
            F.max(F.when(long_value & multi, lf + crlf + 1)).cast("bigint").alias(f"l{i}"),
        ]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"t{i}").alias("truncated_rows"),
                 F.col(f"m{i}").alias("multiline_truncated_rows"),
                 F.col(f"x{i}").cast("bigint").alias("max_original_chars"),
                 F.col(f"l{i}").alias("max_line_count"))
        for i, c in enumerate(df.columns)]))
    return wide.select(rows.alias("r")).select("r.*").withColumn("limit_chars", F.lit(max_chars))
