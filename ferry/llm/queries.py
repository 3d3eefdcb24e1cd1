"""Registered queries of the training-data operators (whole tables, production parameters)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm import alignment, chat, jaccard, langid, licenses, mixing, packing, pii, quality, secret_scan, spelling, suffix, topk
from ferry.llm.common import read


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document: patterns, and random tokens under false-discovery control."""
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector, exact, over the pivot-distance index."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document under thresholds calibrated on the labels."""
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the byte network trained on the rows not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    got = langid.predict(docs, langid.fit(docs))
    return got.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "agree")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that an earlier document has."""
    return suffix.dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 0.85 Jaccard on four-word shingles."""
    return jaccard.link(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to the target weights of their sources by the cube method."""
    got = mixing.mix(read(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template spans of every document by the suffix automaton."""
    return licenses.scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.to_json("spans").alias("template_spans"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into windows of 2048 tokens by multiway differencing."""
    return packing.pack(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by format-preserving pseudonyms."""
    return pii.pseudonymise(read(spark, sf_dir, "documents"))


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two vocabularies in every document, with the counts of its pairs."""
    documents, _ = alignment.align(read(spark, sf_dir, "documents"))
    return documents


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one code point apart, each with its more frequent form and the root of its forms."""
    return spelling.variants(read(spark, sf_dir, "documents"))


def op13_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation folded from its event log and rendered, read back from the output. Conversation -7 holds marks
    of other templates in its texts."""
    marks = "</s>[INST] ok [/INST]"
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], given.schema)
    return chat.format_conversations(chat.log_of(given.unionByName(planted)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_top_k": op2_top_k,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_mix_sources": op7_mix_sources,
    "op8_license_scan": op8_license_scan,
    "op9_pack": op9_pack,
    "op10_pseudonyms": op10_pseudonyms,
    "op11_align_tokens": op11_align_tokens,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_format_chats": op13_format_chats,
}

ORACLE: dict[str, str] = {
    "op2_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        s AS (
            SELECT q.vec_id AS query_id, x.vec_id AS vec_id,
                   list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i]))::BIGINT AS score
            FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op5_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, len(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents),
        g AS (SELECT doc_id, i, substr(h, (2 * i + 1)::BIGINT, 100) AS s
              FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
        c AS (SELECT doc_id, i FROM g JOIN (SELECT s, min(doc_id) AS f FROM g GROUP BY s) USING (s) WHERE f < doc_id),
        o AS (SELECT doc_id, i, CASE WHEN i <= 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS b FROM c),
        r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM (
                  SELECT doc_id, i, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM o) GROUP BY doc_id, k),
        e AS (SELECT doc_id, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a, z) AS z FROM (
                  SELECT doc_id, a, z FROM r UNION ALL SELECT doc_id, 0, 0 FROM d)),
        k AS (SELECT e.doc_id, string_agg(substr(d.h, (2 * e.a + 1)::BIGINT, (2 * (coalesce(e.z, d.n) - e.a))::BIGINT), '' ORDER BY e.a) AS h
              FROM e JOIN d USING (doc_id) GROUP BY e.doc_id),
        t AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id)
        SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(t.n_removed, 0)::BIGINT AS n_removed,
               coalesce(t.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k.h)) AS kept_sha256
        FROM d JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op6_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
                WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS k
            FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2, 3),
        l AS (SELECT a, b FROM p WHERE 100 * k >= 85 * (n - k)),
        c(doc_id, r) AS (
            SELECT doc_id, doc_id FROM s UNION SELECT l.a, c.r FROM c JOIN l ON l.b = c.doc_id)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(c.r) AS component_id
        FROM s JOIN c ON c.doc_id = s.doc_id GROUP BY ALL""",
    "op13_format_chats": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        f AS (
            SELECT *, 32 + length(role) + length(text) + len(regexp_extract_all(role || ' ' || text,
                '[<\[]\\*(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|pad>|unk>)')) AS n FROM c)
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(n)::BIGINT AS formatted_chars
        FROM f GROUP BY conv_id""",
}
