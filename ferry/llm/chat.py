"""Chat formatting from event logs.

A log holds what a chat service writes down: (conv_id, turn, message_id, seq, kind, role, text). ``seq`` orders the
events of a conversation, ``turn`` places a message in it and ``message_id`` names the message at that turn:

* ``start``: the message begins, with its role; text may come with it.
* ``delta``: text is added at its end (streaming).
* ``edit``: its text is replaced.
* ``regenerate``: its text so far is void, and so is every earlier event of later turns.

Fold: the log is partitioned by conversation and block of turns and sorted by message and sequence; a task reads
it as a stream and holds one message at a time. What a ``regenerate`` of an earlier block voids is carried in by a
small table of the last one per block, so a conversation of any length is folded in pieces of ``BLOCK`` turns by
different tasks. Rendering and reading back are expressions on single messages.

Only the digest of a conversation must see it in order: SHA-256 can't be put together from parts. Conversations
of one block are digested where they were folded; the longer ones are sorted once more and read as a stream, with
a constant amount held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import ship, written

BLOCK = 1024
DELTA_CHARS = 256
HELD_CHARS = 1_000_000
LEARNED = "assistant"

# Stand for a null conv_id and a null turn inside the operator; they sort first.
NO_CONV = NO_TURN = -(1 << 63)
FOLDED = "conv_key bigint, turn_key bigint, message_id string, role string, text string, alone boolean"
LOG = "conv_id bigint, turn bigint, message_id string, seq bigint, kind string, role string, text string"
DIGEST = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


@dataclass(frozen=True)
class Template:
    """Marks around a turn. ``controls`` are all strings that a model reads as marks; each is one of "<" and "[" and
    letters, digits or punctuation without those two.

    Escape: a backslash goes in behind the first character of a control string, and one more where backslashes stand
    there already, so no control string is left and taking one out everywhere gives the text back.
    """

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
                                 "<pad>", "<unk>")

    def _pattern(self, marks: str) -> str:
        tails = "|".join(re.escape(c[1:]) for c in self.controls)
        return rf"([<\[])({marks})({tails})"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\*"), r"$1\\$2$3")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\+").replace(r"(\\+)", r"\\(\\*)"), "$1$2$3")

    def turn(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.start), self.escape(role), F.lit(self.middle), self.escape(text), F.lit(self.end))

    def parts(self, formatted: Column) -> Column:
        """Escaped role and text of a formatted turn."""
        inner = F.substring(formatted, len(self.start) + 1, 0x7FFFFFFF)
        return F.split(F.left(inner, F.char_length(inner) - len(self.end)), re.escape(self.middle), 2)


def log_of(conversations: DataFrame) -> DataFrame:
    """The log in which a service would have written down these finished messages.

    Every text is streamed in deltas of ``DELTA_CHARS``. By a checksum of conversation and turn a third of the messages
    is first streamed in reverse order of its pieces and then regenerated, and a third loses its last piece, which an edit
    puts right. Turns are below 2^43. Rows of one turn are messages of their own, ordered by role and a hash of the text; a null text is
    empty and a null role too; a null turn comes first; rows without conv_id are one conversation.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    name = F.concat_ws("|", "role", F.hex(F.xxhash64("text")), F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    count = F.ceil(F.char_length("text") / DELTA_CHARS).cast("int")
    pieces = F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(
        F.col("text"), (i - 1) * DELTA_CHARS + 1, F.lit(DELTA_CHARS)))).otherwise(F.array().cast("array<string>"))
    way = F.when(count > 0, F.pmod(F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary")), F.lit(3)))
    rows = rows.withColumn("message_id", name).withColumn("pieces", pieces).withColumn("way", way)
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    deltas = lambda texts: F.transform(texts, lambda t: event("delta", t))
    nothing = F.lit(None).cast("string")
    streamed = deltas(F.col("pieces"))
    events = F.concat(F.array(event("start", nothing)),
                      F.when(F.col("way") == 1, F.concat(deltas(F.reverse("pieces")), F.array(event("regenerate", nothing)), streamed))
                      .when(F.col("way") == 2, F.concat(deltas(F.slice("pieces", 1, F.size("pieces") - 1)),
                                                        F.array(event("edit", F.col("text")))))
                      .otherwise(streamed))
    placed = rows.select("conv_id", "turn", "message_id", "role", F.posexplode(events).alias("at", "e"))
    return placed.select("conv_id", "turn", "message_id", (F.coalesce(F.col("turn") * (1 << 20), F.lit(-(1 << 62))) + F.col("at")).alias("seq"),
                         "e.kind", F.when(F.col("e.kind") == "start", F.col("role")).alias("role"), "e.text")


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Events sorted by conversation, turn, message and sequence to final messages, one message held at a time."""
    head, events, out, held = None, [], [], 0
    alone, turn_now, void, void_here = False, None, NO_TURN, NO_TURN

    def finish() -> int:
        """The events of one message in order; those before a ``regenerate`` of an earlier turn are void."""
        role, text, live = None, [], False
        for seq, kind, r, t in events:
            if seq < void:
                continue
            if kind == "start":
                role, live = r, True
                text = [t] if t else []
            elif kind == "delta":
                text.append(t or "")
            elif kind == "edit":
                text = [t or ""]
            elif kind == "regenerate":
                text = []
        if not live:
            return 0
        out.append((*head, role or "", "".join(text), alone))
        return len(out[-1][4])

    for pdf in batches:
        for conv, turn, message, seq, kind, role, text, mark, whole in zip(
                *(pdf[c].tolist() for c in ("conv_key", "turn_key", "message_id", "seq", "kind", "role", "text", "mark", "alone"))):
            if mark or (conv, turn, message) != head:
                if head:
                    held += finish()
                head, events = None, []
            if mark:
                alone, turn_now, void, void_here = whole, None, seq, seq
                continue
            if turn != turn_now:
                turn_now, void = turn, void_here
            head = (conv, turn, message)
            events.append((seq, kind, role, text))
            if kind == "regenerate":
                void_here = max(void_here, seq)
            if held > HELD_CHARS:
                yield _messages(out)
                out, held = [], 0
    if head:
        finish()
    yield _messages(out)


def _messages(rows: list[tuple]) -> pd.DataFrame:
    columns = list(zip(*rows)) or [()] * 6
    kinds = {"conv_key": "int64", "turn_key": "int64", "message_id": object, "role": object, "text": object, "alone": bool}
    return pd.DataFrame({name: pd.Series(list(values), dtype=kind) for (name, kind), values in zip(kinds.items(), columns)})


def reconstruct(log: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per final message, in runs of conversation, turn and message_id within each task: conv_key, turn_key,
    message_id, role, text, alone (whether this task has the whole conversation).

    conv_key and turn_key are conv_id and turn, with the smallest long for null. Events of a message without a live
    ``start`` make no message; a null seq comes first; null texts are empty; unknown kinds change nothing;
    equal events are applied once each. An empty log gives an empty result.
    """
    ship(log.sparkSession)
    keyed = log.select(F.coalesce(F.col("conv_id").cast("bigint"), F.lit(NO_CONV)).alias("conv_key"),
                       F.coalesce(F.col("turn").cast("bigint"), F.lit(NO_TURN)).alias("turn_key"),
                       F.coalesce(F.col("message_id").cast("string"), F.lit("")).alias("message_id"),
                       F.coalesce(F.col("seq").cast("bigint"), F.lit(NO_TURN)).alias("seq"), "kind", "role", "text") \
        .withColumn("block", F.floor(F.col("turn_key") / block))
    # the last regeneration of each block, and of the blocks before it: a mark in front of the events of the block
    heads = keyed.groupBy("conv_key", "block").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("last"))
    before = Window.partitionBy("conv_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    absent = F.lit(None).cast("string")
    marks = heads.select("conv_key", F.lit(NO_TURN).alias("turn_key"), F.lit("").alias("message_id"),
                         F.coalesce(F.max("last").over(before), F.lit(NO_TURN)).alias("seq"), absent.alias("kind"), absent.alias("role"),
                         absent.alias("text"), "block", F.lit(True).alias("mark"),
                         (F.count(F.lit(1)).over(Window.partitionBy("conv_key")) == 1).alias("alone"))
    events = keyed.withColumn("mark", F.lit(False)).withColumn("alone", F.lit(False)).unionByName(marks)
    order = ["conv_key", "block", F.desc("mark"), "turn_key", "message_id", "seq", "kind", "role", "text"]
    return events.repartition("conv_key", "block").sortWithinPartitions(*order).mapInPandas(_fold, FOLDED)


def render(messages: DataFrame, template: Template = Template(), learned: str = LEARNED) -> DataFrame:
    """Messages with ``formatted`` and the loss mask as the span ``loss_start`` to ``loss_end`` of it (code points, end
    exclusive; empty unless the role is ``learned``): the text of the turn, without its marks."""
    head = F.lit(len(template.start) + len(template.middle)) + F.char_length(template.escape(F.col("role")))
    formatted = messages.withColumn("formatted", template.turn(F.col("role"), F.col("text"))).withColumn("loss_start", head)
    size = F.when(F.col("role") == learned, F.char_length(template.escape(F.col("text")))).otherwise(0)
    return formatted.withColumn("loss_end", F.col("loss_start") + size).drop("role", "text")


def read_back(rendered: DataFrame, template: Template = Template()) -> DataFrame:
    """Role and text of each turn and the text under its mask, from ``formatted`` and the mask alone."""
    parts = template.parts(F.col("formatted"))
    masked = F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return rendered.withColumn("parts", parts).select(
        *[c for c in rendered.columns if c not in ("formatted", "loss_start", "loss_end")],
        template.unescape(F.get("parts", F.lit(0))).alias("role"), template.unescape(F.get("parts", F.lit(1))).alias("text"),
        template.unescape(masked).alias("loss"), F.char_length("formatted").cast("bigint").alias("chars"))


class Digest:
    """Running digests of one conversation."""

    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, role: str, text: str, loss: str, chars: int) -> None:
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.loss.update(loss.encode("utf-8", "surrogatepass"))
        self.n, self.loss_chars, self.chars = self.n + 1, self.loss_chars + len(loss), self.chars + chars

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


PASSED_ON = f"conv_key bigint, done boolean, {DIGEST}, turn_key bigint, message_id string, role string, text string, loss string, chars bigint"
_COLUMNS = [tuple(c.split()) for c in PASSED_ON.split(", ")]


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of conversations that a task has whole; the messages of the others are passed on."""
    conv, digest, out = None, None, []
    for pdf in batches:
        for key, turn, message, alone, role, text, loss, chars in zip(
                *(pdf[c].tolist() for c in ("conv_key", "turn_key", "message_id", "alone", "role", "text", "loss", "chars"))):
            if not alone:
                out.append((key, False, None, None, None, None, None, turn, message, role, text, loss, chars))
                continue
            if key != conv:
                if digest:
                    out.append((conv, True, *digest.row(), None, None, None, None, None, None))
                conv, digest = key, Digest()
            digest.add(role, text, loss, chars)
        yield _passed(out)
        out = []
    if digest:
        out.append((conv, True, *digest.row(), None, None, None, None, None, None))
    yield _passed(out)


def _passed(rows: list[tuple]) -> pd.DataFrame:
    columns = list(zip(*rows)) or [()] * len(_COLUMNS)
    kinds = {"bigint": "Int64", "boolean": "bool"}
    return pd.DataFrame({name: pd.array(list(values), dtype=kinds[kind]) if kind in kinds else pd.Series(list(values), dtype=object)
                         for (name, kind), values in zip(_COLUMNS, columns)})


def format_conversations(log: DataFrame, template: Template = Template(), block: int = BLOCK) -> DataFrame:
    """One row per conversation of the log, read back from its rendered turns: conv_id, n_turns, turns_sha256 (role, line
    feed, text, line feed of each turn), loss_chars, loss_sha256 (texts under the mask), formatted_chars.

    Turns stand in the order of turn (null first), then message_id. A null conv_id is a conversation. A conversation
    whose messages are all void has no row. An empty log gives an empty result.
    """
    messages = reconstruct(log, block)
    back = read_back(render(messages, template), template)
    found = written(back.mapInPandas(_digested, PASSED_ON), "chat-digests")
    open_ones = found.where(~F.col("done")).select("conv_key", "turn_key", "message_id", F.lit(True).alias("alone"), "role", "text", "loss", "chars")
    streamed = open_ones.repartition("conv_key").sortWithinPartitions("conv_key", "turn_key", "message_id") \
        .mapInPandas(_digested, PASSED_ON)
    digest = [c.split()[0] for c in DIGEST.split(", ")]
    real = F.when(F.col("conv_key") != NO_CONV, F.col("conv_key")).alias("conv_id")
    return found.where("done").unionByName(streamed).select(real, *digest)
