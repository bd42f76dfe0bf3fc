"""Chat formatting from event logs: folded messages, a reversible template, and the loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"

#: The kinds of events. open starts a message and names its role; delta appends; edit replaces what
#: is there; regenerate throws it away.
KINDS = ("open", "delta", "edit", "regenerate")

_CONTROL = r"<(\\*)\|"
_ESCAPED = r"<\\(\\*)\|"


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, copy, role, text) of an event log
    (conv_id, turn, copy, seq, kind, role, text).

    A message is a turn of a conversation, and ``copy`` tells turns with one number apart. Events
    are dealt by message, so a long conversation is folded by many tasks, and sorted by ``seq``;
    events with one ``seq`` go in the order of KINDS, then role and text. Null texts and roles are
    empty. Events of a message without an open have an empty role. An empty log has no messages.
    Other columns are left out.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.coalesce("kind", F.lit("")))
    log = events.select(
        "conv_id", "turn", "copy", "seq", rank.alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = log.repartition("conv_id", "turn", "copy").sortWithinPartitions(
        "conv_id", "turn", "copy", "seq", "kind", "role", "text"
    )

    def messages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, role, parts = None, "", []
        for frame in frames:
            out = []
            for conv, turn, copy, _, kind, who, text in frame.astype(object).where(frame.notna(), None).itertuples(index=False):
                if (conv, turn, copy) != key:
                    if key is not None:
                        out.append((*key, role, "".join(parts)))
                    key, role, parts = (conv, turn, copy), "", []
                if kind == 1:
                    role, parts = who, []
                elif kind == 2:
                    parts.append(text)
                elif kind == 3:
                    parts = [text]
                elif kind == 4:
                    parts = []
            if out:
                yield table(out)
        if key is not None:
            yield table([(*key, role, "".join(parts))])

    def table(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["conv_id", "turn", "copy", "role", "text"], dtype=object)
        return frame.astype({"conv_id": "Int64", "turn": "Int64", "copy": "Int64"})

    return dealt.mapInPandas(messages, "conv_id long, turn long, copy long, role string, text string")


def escaped(text: Column) -> Column:
    """``text`` without control strings: ``<|`` gets a backslash inside, and so does each ``<`` with
    backslashes before a bar, so that ``unescaped`` finds the text again."""
    return F.regexp_replace(text, _CONTROL, r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """A role on one line: backslashes doubled, line feeds as backslash n."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped(text: str) -> str:
    return re.sub(_ESCAPED, r"<\1|", text)


def unescaped_role(text: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescaped(text))


def rendered(messages: DataFrame, learned: str = LEARNED) -> DataFrame:
    """Each message as its piece of the formatted conversation, with the span (code points, within
    the piece) whose text is learned; null where the role isn't ``learned``. The pieces of a
    conversation in the order of (turn, copy) are its formatted text; kept apart, no conversation
    has to fit in one row. Null roles and texts are empty; no messages, no pieces."""
    head = F.concat(F.lit(START), escaped_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    pieces = messages.select(
        "conv_id", "turn", "copy", "role", head.alias("head"), escaped(F.coalesce("text", F.lit(""))).alias("body")
    )
    taught = F.col("role") == learned
    start = F.char_length("head").cast("long")
    return pieces.select(
        "conv_id", "turn", "copy",
        F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
        F.when(taught, start).alias("loss_start"),
        F.when(taught, start + F.char_length("body")).alias("loss_end"),
    )


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n", re.S)


def read_back(piece: str) -> tuple[str, str]:
    """Role and text of a formatted piece."""
    found = _TURN.fullmatch(piece)
    if not found or START in found[2] or END in found[2] or START in found[1] or END in found[1]:
        raise ValueError("not one turn of the template")
    return unescaped_role(found[1]), unescaped(found[2])


def digests(pieces: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from the pieces: one row per conversation.

    A digest reads its conversation in order, so a conversation is one task's; its pieces stream
    through with a few numbers of state, and none of them is held."""
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "copy", "piece")

    def table(rows: list[tuple]) -> pd.DataFrame:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pd.DataFrame(rows, columns=names, dtype=object).astype({"conv_id": "Int64"})

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        began, key = False, None
        for frame in frames:
            out = []
            ids = frame["conv_id"].astype(object).where(frame["conv_id"].notna(), None)
            for conv, piece, start, end in zip(ids, frame["piece"], frame["loss_start"], frame["loss_end"], strict=True):
                if not began or conv != key:
                    if began:
                        out.append((key, n, turns.hexdigest(), learned, loss.hexdigest(), chars))
                    began, key, n, learned, chars = True, conv, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                role, text = read_back(piece)
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                n, chars = n + 1, chars + len(piece)
                if not pd.isna(start):
                    said = unescaped(piece[int(start) : int(end)])
                    learned += len(said)
                    loss.update(said.encode("utf-8", "surrogatepass"))
            if out:
                yield table(out)
        if began:
            yield table([(key, n, turns.hexdigest(), learned, loss.hexdigest(), chars)])

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return dealt.mapInPandas(read, kinds)


def events_of(rows: DataFrame) -> DataFrame:
    """An event log that folds to ``rows`` (conv_id, turn, role, text): each text streams in two
    deltas; every third message is regenerated once, every fifth typed wrongly and then edited.
    Rows with one conversation and turn get their own ``copy``, in the order of role and text."""
    from pyspark.sql import Window

    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("copy", F.row_number().over(same).cast("long"))
    half = F.expr("char_length(text) div 2")
    first, second = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.char_length("text"))
    deal = F.pmod(F.xxhash64("conv_id", "turn", "copy"), F.lit(15))
    none = F.lit(None).cast("string")

    def event(seq: int, kind: str, role: Column, text: Column) -> Column:
        return F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    opened = [event(0, "open", F.col("role"), none)]
    streamed = [event(8, "delta", none, first), event(9, "delta", none, second)]
    again = [event(3, "delta", none, second), event(4, "regenerate", none, none)]
    wrong = [event(8, "delta", none, F.concat(second, first)), event(9, "edit", none, F.col("text"))]
    events = (
        F.when(deal % 5 == 0, F.array(*opened, *wrong))
        .when(deal % 3 == 0, F.array(*opened, *again, *streamed))
        .otherwise(F.array(*opened, *streamed))
    )
    return rows.select("conv_id", "turn", "copy", F.inline(events))
