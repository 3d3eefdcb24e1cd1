"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Every distinct prefix of the vocabulary is a node of the forward trie and every distinct suffix a node of the
reversed one; both get integers. A word cut at a place is then a pair (prefix node, suffix node):

* skipping the code point between them, so that words which share the pair differ in that one place;
* with nothing between them, so that a word with one code point more meets it in the pair where it skips that one.

Two words are near exactly if they meet in such a pair. Of a run of equal code points only the last is skipped
against a shorter word, so each pair of near words meets once. Words that skip at one pair are different in one
code point, so a pair holds at most one word per code point of the alphabet; it is summed up (how many words,
the best and the second best) and each word reads what it needs from the sum, without listing pairs of words.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import discard, ship, written

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
# Every 97th occurrence hash loses a code point (fixed value of the contract).
DAMAGE = 97
# Fixed value of the contract: letters of a run, after A-Z have become a-z.
_RUNS = re.compile("[a-zÀ-ÿ]+").findall
FLUSH_WORDS = 300_000
# A node of at most so many letters is numbered by them (90 letters, seven bits each); deeper ones by a table.
PACKED = 9
# Deeper nodes are told apart by the string itself up to this length and by a 256-bit digest beyond it.
SPELLED = 40


def lowered(text: str) -> str:
    """A-Z become a-z; all other characters stay."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def damaged(run: str, h: int) -> str:
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counted(damage: int):
    """Partial counts of the words of each task, sent on whenever ``FLUSH_WORDS`` are held."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                if not text:
                    continue
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in Counter(_RUNS(lowered(text))).items():
                    if damage:
                        h = zlib.crc32(word.encode(), start)
                        if h % damage == 0:
                            word = damaged(word, h)
                    held[word] += n
                if len(held) > FLUSH_WORDS:
                    yield _held(held)
                    held.clear()
        yield _held(held)
    return run


def _held(counts: Counter) -> pd.DataFrame:
    return pd.DataFrame({"word": pd.Series(list(counts), dtype=object), "n": pd.Series(list(counts.values()), dtype="int64")})


def node_keys(word: str) -> list[tuple[int | None, str | None]]:
    """(number, key) of every prefix of the word, from the empty one on: a number for a shallow node, else a key."""
    out: list[tuple[int | None, str | None]] = []
    number, digest = 0, hashlib.sha256()
    for depth in range(len(word) + 1):
        out.append((number, None) if depth <= PACKED else (None, word[:depth] if depth <= SPELLED else "#" + digest.hexdigest()))
        if depth < len(word):
            letter = word[depth]
            number = number << 7 | (ord(letter) - 96 if letter <= "z" else ord(letter) - 165)
            digest.update(letter.encode())
    return out


CUTS = "rank bigint, kind int, p bigint, p_key string, s bigint, s_key string"
SKIPS, LAST_OF_RUN, WHOLE = 0, 1, 2


def _cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every word cut at every place: one code point skipped (``kind`` tells whether it ends a run), or none."""
    rows: list[tuple] = []
    for pdf in batches:
        for rank, word in zip(pdf["rank"].tolist(), pdf["word"].tolist()):
            before, behind = node_keys(word), node_keys(word[::-1])[::-1]
            for i in range(len(word) + 1):
                rows.append((rank, WHOLE, *before[i], *behind[i]))
                if i < len(word):
                    rows.append((rank, SKIPS if word[i:i + 1] == word[i + 1:i + 2] else LAST_OF_RUN, *before[i], *behind[i + 1]))
            if len(rows) > 50_000:
                yield _frame(rows)
                rows = []
    yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = list(zip(*rows)) or [()] * 6
    kinds = ("int64", "int32", "Int64", object, "Int64", object)
    return pd.DataFrame({name: pd.array(list(values), dtype=kind) if kind != object else pd.Series(list(values), dtype=object)
                         for name, values, kind in zip(("rank", "kind", "p", "p_key", "s", "s_key"), columns, kinds)})


def _numbered(cuts: DataFrame, number: str, key: str) -> DataFrame:
    """``number`` filled in for the deeper nodes, from a table of all of them."""
    deep = cuts.where(F.col(key).isNotNull())
    nodes = written(deep.select(key).distinct().withColumn("no", -F.monotonically_increasing_id() - 1), "spelling-nodes")
    filled = deep.join(nodes, key).withColumn(number, F.col("no"))
    return cuts.where(F.col(key).isNull()).drop(key).unionByName(filled.drop(key, "no"))


def words_of(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n): the runs of letters of all texts, lower-cased, with the contract's deletions (``damage`` 0: none)."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counted = rows.mapInPandas(_counted(damage), "word string, n bigint")
    return counted.where(F.char_length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= min_count)


def neighbours(words: DataFrame) -> DataFrame:
    """(rank, n_near, best) of each ranked word that has near words; ``best`` is the smallest rank of them."""
    cuts = written(words.select("rank", "word").mapInPandas(_cuts, CUTS), "spelling-cuts")
    numbered = _numbered(_numbered(cuts, "p", "p_key"), "s", "s_key")
    kind, rank = F.col("kind"), F.col("rank")
    # one word per code point of the alphabet skips at a pair, and at most one is whole there
    pairs = numbered.groupBy("p", "s").agg(
        F.array_sort(F.collect_list(F.when(kind != WHOLE, rank))).alias("skip"),
        F.array_sort(F.collect_list(F.when(kind == LAST_OF_RUN, rank))).alias("longer"),
        F.max(F.when(kind == WHOLE, rank)).alias("whole"))
    pairs = pairs.where((F.size("skip") > 1) | (F.col("whole").isNotNull() & (F.size("longer") > 0)))
    none = F.lit(None).cast("bigint")

    def member(r):
        meets = F.col("whole").isNotNull() & F.array_contains("longer", r)
        other = F.when(F.get("skip", F.lit(0)) != r, F.get("skip", F.lit(0))).otherwise(F.get("skip", F.lit(1)))
        return F.struct(r.alias("rank"), (F.size("skip") - 1 + meets.cast("int")).cast("bigint").alias("n_near"),
                        F.least(other, F.when(meets, F.col("whole"))).alias("best"))

    of_whole = F.struct(F.col("whole").alias("rank"), F.size("longer").cast("bigint").alias("n_near"),
                        F.when(F.size("longer") > 0, F.get("longer", F.lit(0))).otherwise(none).alias("best"))
    seen = F.concat(F.transform("skip", member), F.when(F.col("whole").isNotNull(), F.array(of_whole)).otherwise(
        F.array().cast("array<struct<rank:bigint,n_near:bigint,best:bigint>>")))
    return pairs.select(F.explode(seen).alias("m")).select("m.*").groupBy("rank") \
        .agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(rank, root) for ``forms(rank, form)``: forms followed to the last, twice as far in every round.

    A form has at least ``RATIO`` times the count of its word, so chains are at most 63 long: seven rounds.
    """
    state = written(forms.select("rank", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = state.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        further = written(state.join(ahead, "root", "left").select("rank", F.coalesce("next", "root").alias("root"),
                                                                   F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(state)
        state = further.drop("moved")
        state._written_to = further._written_to
        if further.where("moved").isEmpty():
            return state


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
             damage: int = DAMAGE) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Input needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text holds no run; a null
    doc_id is an empty one in the hash; repeated rows each count. Words are near if one inserted, deleted or
    replaced code point makes them equal; the form is the near word of the largest n (ties: smallest in code-point order)
    if that is at least ``ratio`` times the word's n, else null; the root is where forms end, the word
    itself without a form. An empty table gives an empty result.
    """
    # ranks grow along the sorted partitions: the smallest rank is the largest n, then the smallest word
    ranked = words_of(docs, min_length, min_count, damage).orderBy(F.desc("n"), "word")
    words = written(ranked.withColumn("rank", F.monotonically_increasing_id()), "spelling-words")
    near = written(neighbours(words), "spelling-near")
    named = lambda name: words.select(F.col("rank").alias(name), F.col("word").alias(f"{name}_word"), F.col("n").alias(f"{name}_n"))
    found = words.join(near, "rank", "left").join(named("best"), "best", "left") \
        .withColumn("has", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False)))
    found = written(found, "spelling-found")
    ends = roots(found.where("has").select("rank", F.col("best").alias("form"))).join(named("root"), "root")
    return found.join(ends.select("rank", "root_word"), "rank", "left").select(
        "word", F.when(F.col("has"), F.col("best_word")).alias("form"), F.coalesce("root_word", "word").alias("root"),
        "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(F.col("has"), F.col("best_n")).alias("form_n"))
