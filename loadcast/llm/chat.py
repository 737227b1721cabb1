r"""Chat formatting from an event log.

An event is (conv_id, seq, msg, kind, role, text).  ``msg`` is the place of a
message in its conversation; kinds:

message     a whole message: opens ``msg``, or replaces what it was
delta       text streamed onto the end of ``msg`` (which it opens, if need be)
edit        new text of ``msg``; what later messages were until then is dropped
regenerate  ``msg`` starts anew with this text; later messages are dropped likewise

The log is partitioned by conversation and sorted by ``seq``.  The last cut above each
message is found among one small row per message, without the texts; then the log
is dealt by message, its own last beginning found, and what came since put
together, so a long conversation is folded by its messages and its texts are never in one task.  Rendered messages are chunks that follow each
other; the reader streams over them with a hash and a few counters per
conversation.

Template: ``<|im_start|>role\n`` text ``<|im_end|>\n`` per turn, and a loss mask
over the assistants' texts.  A control string inside a text gets a backslash
after its first character (one more, if it already has some), which is undone
on reading; in roles, backslashes and line breaks are escaped as well.

Defined results: a null text, role or kind is empty, empty and "message"; a null
seq sorts first and a null msg is message 0; a null conv_id is a conversation;
events equal in seq are ordered by msg, kind, role and text, so repeated events
count as often as they are there; an empty log gives no conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadcast.operators.sequence import with_sequence

from .common import shuffle_partitions

# Control strings of the template and of other common ones.
CONTROLS = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
START, END = CONTROLS[0], CONTROLS[1]
REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_PLAIN = rf"([<\[])(\\*)(?={REST})"
_ESCAPED = rf"([<\[])\\(\\*)(?={REST})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2")


def unescape(text: str) -> str:
    return re.sub(_ESCAPED, r"\1\2", text)


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def turns_as_events(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log of whole messages, in order of turn (null first), role, text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select(
        "conv_id", F.row_number().over(order).cast("long").alias("seq"), F.row_number().over(order).cast("long").alias("msg"),
        F.lit("message").alias("kind"), "role", "text",
    )


def turns_as_streams(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as the log of a conversation that was streamed and corrected.

    Every turn is opened by a draft (the first half of its text), answered too early, then edited (a
    user's; others are regenerated), which voids both, and streamed again in three pieces.  Turns are
    numbered in order of turn (null first), role, text, over ranges of all rows, so a hot
    conversation's texts are spread.
    """
    wanted = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    numbered = with_sequence(wanted, ["turn", "role", "text"], ["conv_id"], rn_col="msg")
    n = F.length("text")
    third, place = F.floor(n / 3).cast("int"), F.col("msg") * 5
    again = F.when(F.col("role") == "user", F.lit("edit")).otherwise(F.lit("regenerate"))

    def event(step: int, kind: Column, text: Column, msg: Column = F.col("msg")) -> Column:
        return F.struct((place + step).alias("seq"), msg.alias("msg"), kind.alias("kind"), F.col("role").alias("role"), text.alias("text"))

    steps = F.array(
        event(0, F.lit("message"), F.substring("text", F.lit(1), F.floor(n / 2).cast("int"))),
        event(1, F.lit("message"), F.lit("too early"), F.col("msg") + 1),
        event(2, again, F.substring("text", F.lit(1), third)),
        event(3, F.lit("delta"), F.substring("text", third + 1, third)),
        event(4, F.lit("delta"), F.substring("text", 2 * third + 1, n)),
    )
    return numbered.select("conv_id", F.explode(steps).alias("e")).select("conv_id", "e.*")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: (conv_id, msg, role, text)."""
    log = events.select(
        "conv_id",
        F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 62))).alias("seq"),
        F.coalesce(F.col("msg").cast("long"), F.lit(0)).alias("msg"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # what a message was before the last edit or regeneration of an earlier one is void
    cut = F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))
    above = Window.partitionBy("conv").orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    per_message = log.groupBy(F.col("conv_id").alias("conv"), F.col("msg").alias("m")).agg(F.max(cut).alias("own"))
    cuts = per_message.select("conv", "m", F.max("own").over(above).alias("cut")).where(F.col("cut").isNotNull())
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("msg") == F.col("m"))
    alive = log.join(cuts, same, "left").where(F.col("cut").isNull() | (F.col("seq") > F.col("cut"))).drop("conv", "m", "cut")
    # and so is what precedes its own last beginning
    began = F.col("kind") != "delta"
    turn = Window.partitionBy("conv_id", "msg").orderBy("seq", "kind", "role", "text")
    numbered = alive.withColumn("version", F.sum(began.cast("int")).over(turn)).withColumn("place", F.row_number().over(turn))
    versions = numbered.groupBy("conv_id", "msg", "version").agg(
        F.max_by("role", F.struct((F.col("role") != ""), -F.col("place"))).alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "").alias("text"),
    )
    last = versions.groupBy("conv_id", "msg").agg(F.max(F.struct("version", "role", "text")).alias("last"))
    return last.select("conv_id", "msg", F.col("last.role").alias("role"), F.col("last.text").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, msg, chunk, loss_start, loss_end): the conversation's text is its chunks, one after
    the other by msg; the loss mask is a range of code points of the chunk (empty but for assistants)."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    chunk = F.concat(head, body, F.lit(END), F.lit("\n"))
    start = F.when(F.col("role") == "assistant", F.length(head)).otherwise(0)
    end = F.when(F.col("role") == "assistant", F.length(head) + F.length(body)).otherwise(0)
    return messages.select("conv_id", "msg", chunk.alias("chunk"), start.alias("loss_start"), end.alias("loss_end"))


def format_conversations(events: DataFrame) -> DataFrame:
    """The formatted chunks of a log; see ``render``."""
    return render(fold(events))


class _Reader:
    """Reads one conversation back from its chunks."""

    TURN = re.compile(re.escape(START) + "([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0

    def add(self, chunk: str, loss_start: int, loss_end: int) -> None:
        self.formatted += len(chunk)
        for m in self.TURN.finditer(chunk):
            self.n_turns += 1
            self.turns.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
        masked = unescape(chunk[loss_start:loss_end])
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted


def digests(chunks: DataFrame) -> DataFrame:
    """Per conversation, read back from the chunks: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader = None, None
        for batch in batches:
            done = []
            for conv, chunk, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reader is None or conv != at:
                    if reader is not None:
                        done.append((at, *reader.row()))
                    at, reader = conv, _Reader()
                reader.add(chunk, start, end)
            if done:
                yield batch_of(done)
        if reader is not None:
            yield batch_of([(at, *reader.row())])

    ordered = chunks.repartition(shuffle_partitions(chunks.sparkSession), "conv_id").sortWithinPartitions("conv_id", "msg")
    return ordered.select(F.col("conv_id").cast("long"), "chunk", "loss_start", "loss_end").mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
