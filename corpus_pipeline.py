"""The corpus pipeline: stages that each apply one training-data operator to what the last one kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame. All but
the last return the columns of ``documents``. ``run`` writes every stage as Parquet and reads it back.

Nulls, empty and repeated rows: a null text has no letter, so language ID rejects the row; equal
rows of one doc_id are one document of a group and the near-duplicate stage keeps one of them; an empty
table passes through every stage as an empty table. Columns beyond those of ``documents`` are dropped
by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm import jaccard, langid, mixing, packing, pii
from ferry.llm.common import read, row_key, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A document whose pooled language probability is below this is in no learned language.
MIN_SCORE = 0.4
# Stands for a null id in the key of a row.
NO_ID = jaccard.NO_ID


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter or in no learned language go; ``lang`` is the prediction."""
    docs = docs.select(*COLUMNS)
    found = langid.with_language(docs, langid.fit(docs))
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def _with_key(docs: DataFrame) -> DataFrame:
    """The columns of documents and a non-null key of the row: its id and the hash of its text."""
    return docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("key_id"),
                       row_key("text").alias("key_text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join at five words and 0.8: of each group the smallest doc_id stays, with one of its texts
    if several are in the group. A null id comes last; rows of one id, or without one, that are not linked all stay."""
    rows = jaccard.classes(docs, n=5, num=80, den=100) \
        .select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key_id"), F.col("row_key").alias("key_text"), "class_id")
    # a text without words has no class and is a group of its own
    group = F.coalesce("class_id", F.concat_ws("|", "key_id", "key_text"))
    first = rows.groupBy(group.alias("group")).agg(F.min(F.struct("key_id", "key_text")).alias("first")).select("first.*")
    # one shuffle of the texts: join and distinct use the same key
    kept = _with_key(docs).join(first, ["key_id", "key_text"], "left_semi").dropDuplicates(["key_id", "key_text"])
    return kept.select(*COLUMNS)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text become keyed pseudonyms of the same format."""
    return docs.withColumn("text", pii.pseudonymised(F.col("text"))) \
        .withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a document appears as often as the mix takes it."""
    taken = mixing.mix(docs).groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("key_id"), F.col("row_key").alias("key_text")) \
        .agg(F.sum("copies").cast("int").alias("copies")).where(F.col("copies") > 0)
    joined = _with_key(docs).join(taken, ["key_id", "key_text"]).dropDuplicates(["key_id", "key_text"])
    return joined.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces: where each piece of each document lies in which window."""
    return packing.pack(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language ID", identify),
    ("near copies", drop_near_copies),
    ("pseudonyms", pseudonymise),
    ("source mix", mix_sources),
    ("packing", pack),
]

# The network, the sampling and the token ids have no SQL form; tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back."""
    docs = read(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{at}")
    return docs
