"""Chat formatting with a grammar round trip.

A turn is written as ``### <role>: <text> </turn>`` and a line end.  The parser
is deterministic: a role ends at the first bare ``: ``, a text at the first bare
`` </turn>``; a backslash makes one of ``\\ # < :`` after it an ordinary
character.  A turn is first written as it is; the text is parsed again and
compared with its source, and where they differ the conflicting content is
escaped, first the control strings alone, then every character that can take
part in one, until source and parse are identical.  The end of each turn is
bare, so turns that round-trip alone do so one after the other.

Rendering is per turn and needs no shuffle.  Reading back sorts each
conversation's turns (Spark's sort spills) and streams them through running
hashes, so a conversation of any length takes bounded memory.

Defined results: null text or role is empty; turns sort by turn (nulls first),
then role, then text, so ties and repeated rows have one order; a null
``conv_id`` is one conversation; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import ship

OPEN, SEP, CLOSE = "### ", ": ", " </turn>\n"
_BARE = re.compile(r"\\[\\#<:]|" + "(" + re.escape(SEP) + "|" + re.escape(CLOSE) + ")", re.S)
_ESCAPED = re.compile(r"\\([\\#<:])")
_CONTROL = re.compile(r"### |: |</turn>")


class GrammarError(ValueError):
    """The text is no sequence of turns."""


def _until(text: str, mark: str, at: int) -> int:
    """Where the first bare ``mark`` from ``at`` on begins."""
    for m in _BARE.finditer(text, at):
        if m[1] == mark:
            return m.start()
    raise GrammarError(f"no {mark!r} after {at}")


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end are where the escaped text stands."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise GrammarError(f"no turn at {at}")
        colon = _until(text, SEP, at + len(OPEN))
        start = colon + len(SEP)
        end = _until(text, CLOSE, start)
        turns.append((unescape(text[at + len(OPEN):colon]), unescape(text[start:end]), start, end))
        at = end + len(CLOSE)
    return turns


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _escape(text: str, level: int) -> str:
    if level == 1:  # the control strings alone
        return _CONTROL.sub(lambda m: "\\" + m[0], text)
    return re.sub(r"[\\#<:]", lambda m: "\\" + m[0], text) if level == 2 else text


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and where its text stands; escapes only as far as the round trip asks."""
    for level in range(3):
        head = f"{OPEN}{_escape(role, level)}{SEP}"
        written = head + _escape(text, level) + CLOSE
        span = (len(head), len(written) - len(CLOSE))
        try:
            if parse(written) == [(role, text, *span)]:
                return written, *span
        except GrammarError:
            pass
    raise GrammarError("a fully escaped turn did not round-trip")


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, formatted, loss_start, loss_end) per turn; the loss mask covers assistant texts.

    Offsets are code points within ``formatted``; a turn without loss has start = end.
    A conversation's formatted text is its turns' ``formatted``, by turn, with nothing between.
    """
    ship(conversations.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in conversations.schema}

    def run(batches):
        for batch in batches:
            rows = []
            for conv, turn, role, text in zip(batch["conv_id"], batch["turn"], batch["role"], batch["text"]):
                written, start, end = render(role, text)
                rows.append((conv, turn, role, text, written, start, end if role == "assistant" else start))
            yield pd.DataFrame(rows, columns=names).astype({"conv_id": object, "turn": object})

    names = ["conv_id", "turn", "role", "text", "formatted", "loss_start", "loss_end"]
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    # ids go as text: pandas has no null for whole numbers
    keyed = conversations.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), empty("role"), empty("text"))
    made = keyed.mapInPandas(run, "conv_id string, turn string, role string, text string, formatted string, loss_start int, loss_end int")
    return made.withColumns({c: F.col(c).cast(types[c]) for c in ("conv_id", "turn")})


def read_back(formatted: DataFrame) -> DataFrame:
    """Parses the formatted conversations again: a row of digests per conversation.

    ``turns_sha256`` is over role, newline, text, newline of each turn; ``loss_sha256``
    and ``loss_chars`` over the unescaped text under the loss mask.
    """
    ship(formatted.sparkSession)
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        now, state = None, None

        def row():
            return (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            rows = []
            for conv, text, start, end in zip(batch["conv_id"], batch["formatted"], batch["loss_start"], batch["loss_end"]):
                conv = conv if isinstance(conv, str) else None
                if now is None or now[0] != conv:
                    if now is not None:
                        rows.append(row())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                loss = unescape(text[start:end])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(text)
            yield pd.DataFrame(rows, columns=names)
        if now is not None:
            yield pd.DataFrame([row()], columns=names)

    together = (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
                .select(F.col("conv_id").cast("string"), "formatted", "loss_start", "loss_end"))
    read = together.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return read.withColumn("conv_id", F.col("conv_id").cast(id_type))
