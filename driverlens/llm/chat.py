r"""Chat formatting from an event log.

A log row is an event of a message: conv_id, turn, message (tells messages of a turn apart), seq,
kind, role, text. ``start`` opens a message, ``delta`` appends to it, ``edit`` replaces what is
there, ``regenerate`` throws it away. Events of a message are put in order and folded into its final text. Messages
are folded apart from each other, so a conversation that holds a third of the log is spread over tasks.

A message is rendered as ``<s>[role]``, a new line, its text and ``</s>`` with a new line. In texts and roles
``\ < [ ]`` are written ``\s \l \o \c``, so no control string can appear in them and the way
back is exact. The loss mask is the span of the text of an assistant's message.

Null text and null role count as empty. Null conversations are one conversation, a null turn
comes first; messages of equal turn are ordered by role, text, then message. Repeated rows are messages of their
own. Unknown kinds raise an error. An empty log gives no rows; extra columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))  # the backslash first
LOSS_ROLE = "assistant"
TURN = re.compile(r"<s>\[([^\]]*)\]\n([^<]*)</s>\n")
SUMMARY = "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, formatted_chars BIGINT"


def escaped(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: str) -> str:
    for plain, coded in reversed(ESCAPES):
        text = text.replace(coded, plain)
    return text


def fold(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, message, role, text) of an event log."""
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    events = log.groupBy("conv_id", "turn", "message").agg(F.sort_array(F.collect_list(event)).alias("events"))
    resets = F.filter("events", lambda e: e["kind"] != "delta")
    known = F.forall("events", lambda e: e["kind"].isin("start", "delta", "edit", "regenerate"))
    last = F.coalesce(F.element_at(F.filter("events", lambda e: e["kind"] != "delta")["seq"], F.lit(-1)), F.lit(-(1 << 62)))
    kept = F.filter("events", lambda e: (e["seq"] >= F.col("last")) & e["kind"].isin("delta", "edit"))
    role = F.coalesce(F.get(F.filter("events", lambda e: e["kind"] == "start")["role"], F.lit(0)), F.lit(""))
    events = events.withColumn("last", F.when(F.size(resets) > 0, last).otherwise(F.lit(-(1 << 62))))
    text = F.when(known, F.array_join(F.transform(kept, lambda e: e["text"]), "")).otherwise(F.raise_error(F.lit("unknown event kind")))
    return events.select("conv_id", "turn", "message", role.alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, message, role, text, piece, loss_start, loss_end): the loss span in code points of the piece, null for none."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head, body = F.concat(F.lit("<s>["), escaped(role), F.lit("]\n")), escaped(text)
    start = F.length(head).cast("bigint")
    learned = role == LOSS_ROLE
    return messages.select(
        "conv_id",
        "turn",
        "message",
        role.alias("role"),
        text.alias("text"),
        F.concat(head, body, F.lit("</s>\n")).alias("piece"),
        F.when(learned, start).alias("loss_start"),
        F.when(learned, start + F.length(body)).alias("loss_end"),
    )


def format_chats(log: DataFrame) -> DataFrame:
    """Fold a log and render its messages."""
    return render(fold(log))


def read_back(pieces: DataFrame) -> DataFrame:
    """One row of ``SUMMARY`` per conversation, from pieces and loss spans alone.

    A conversation's pieces are sorted and pass through one task as a stream: a digest has to see
    them in order. The task holds a hash state and one Arrow batch, not the conversation.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SUMMARY.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        here, state = None, None

        def row():
            conv_id, (turns, n, loss, loss_chars, chars) = here[0], state
            values = [conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                conv_id, piece, start, end = (batch.column(n)[i].as_py() for n in ("conv_id", "piece", "loss_start", "loss_end"))
                if here != (conv_id,):
                    if here:
                        yield row()
                    here, state = (conv_id,), [hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text = map(unescape, TURN.fullmatch(piece).groups())
                state[0].update(f"{role}\n{text}\n".encode())
                state[1] += 1
                if start is not None:
                    learned = unescape(piece[start:end])
                    state[2].update(learned.encode())
                    state[3] += len(learned)
                state[4] += len(piece)
        if here:
            yield row()

    placed = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "message")
    return placed.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(digest, SUMMARY)


def logged(conversations: DataFrame, chunk: int = 256) -> DataFrame:
    """An event log that leads to the given (conv_id, turn, role, text) rows.

    Assistants stream half of an answer, regenerate, and stream it whole; the others send a
    draft and edit it. The number of a row in its scan tells messages apart.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", "turn", "role", text.alias("text"), F.monotonically_increasing_id().alias("message"))
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / chunk).cast("int")), lambda i: F.substring("text", i * chunk + 1, F.lit(chunk)))

    def event(kind, text):
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    start, deltas = F.array(event("start", F.lit(""))), F.transform(pieces, lambda p: event("delta", p))
    draft = event("delta", F.expr("substring(text, 1, cast(length(text) / 2 as int))"))
    streamed = F.concat(start, F.array(draft, event("regenerate", F.lit(""))), deltas)
    edited = F.concat(start, F.array(draft, event("edit", F.col("text"))))
    events = rows.select("conv_id", "turn", "message", "role", F.posexplode(F.when(F.col("role") == LOSS_ROLE, streamed).otherwise(edited)).alias("seq", "event"))
    return events.select("conv_id", "turn", "message", F.col("seq").cast("bigint").alias("seq"), "event.kind", "role", "event.text")
