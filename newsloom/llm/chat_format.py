"""Training texts from conversations, with the place of each turn found from outside.

The template is a black box from a list of turns to a text. Successive prefixes
of a conversation are rendered; what a longer prefix adds is its last turn's
piece. If the longer output does not begin with the shorter one, the template
rewrites history. Two renderings with different one-character texts in the last
turn agree up to where its text begins and from where it ends.

Every prefix begins with the conversation, whatever the template says of itself: a
conversation's turns are held and rendered anew for each turn, so its time grows
with the square of its length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters for private use: no template treats them in a special way.
PROBES = ("\ue000", "\ue001")

HEAD, MIDDLE, TAIL = "### ", ": ", " </turn>\n"
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
LEARNED_ROLE = "assistant"

Turns = list[tuple[str, str]]


def escape(text: str) -> str:
    """No ``#`` stands alone and no ``</`` is left, so no marker of the template can arise."""
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def template(turns: Turns) -> str:
    return "".join([f"{HEAD}{escape(role).replace(':', '\\:')}{MIDDLE}{escape(text)}{TAIL}" for role, text in turns])


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def located(render: Callable[[Turns], str], turns: Turns) -> tuple[str, int, int, int]:
    """Piece that the last turn adds, where its text begins and ends in it, characters of history rewritten."""
    return _located(render, turns, render(turns[:-1]), render(turns))


def _located(render: Callable[[Turns], str], turns: Turns, before: str, now: str) -> tuple[str, int, int, int]:
    kept = _shared(before, now)
    role = turns[-1][0]
    first, second = (render([*turns[:-1], (role, p)]) for p in PROBES)
    begin = _shared(first, second)
    tail = len(first) - begin - 1
    piece = now[kept:]
    start = max(0, begin - kept)
    return piece, start, max(start, len(piece) - tail), len(before) - kept


def formatted(conversations: DataFrame, render: Callable[[Turns], str] = template) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per turn: its piece of the conversation's text.

    Columns: conv_id, place (0 up), piece, begin and end of the turn's text in the
    piece, learned (loss is taken on the text: turns of the assistant), rewritten
    (characters of earlier output that this turn changed; 0 for a sound template).

    Turns go by (turn, role, text); null turns come first; null roles and texts
    are empty; rows with a null conv_id are one conversation; repeated rows are
    turns of their own. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, history, place, before = object(), [], 0, ""
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != current:
                    current, history, place, before = conv_id, [], 0, render([])
                history.append((role or "", text or ""))
                now = render(history)
                rows.append((conv_id, place, *_located(render, history, before, now), role == LEARNED_ROLE))
                before = now
                place += 1
            names = ["conv_id", "place", "piece", "begin", "end", "rewritten", "learned"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(
            run,
            "conv_id long, place long, piece string, begin long, end long, rewritten long, learned boolean",
        )
    )


def read_back(pieces: DataFrame) -> DataFrame:
    """Pieces of ``formatted`` by the template -> one row per conversation, from the output alone.

    Columns: conv_id, n_turns, turns_sha256 (role, line break, text, line break
    of each turn), loss_chars and loss_sha256 (texts under the loss mask,
    unescaped), formatted_chars, rewritten.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        state: dict | None = None

        def row() -> list:
            return [
                state["id"], state["n"], state["turns"].hexdigest(), state["chars"],
                state["loss"].hexdigest(), state["all"], state["rewritten"],
            ]

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            done = []
            for p in batch.to_pylist():
                if state is None or state["id"] != p["conv_id"]:
                    if state is not None:
                        done.append(row())
                    state = {
                        "id": p["conv_id"], "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(),
                        "chars": 0, "all": 0, "rewritten": 0,
                    }
                head = p["piece"][: p["begin"]]
                role = unescape(head[head.rindex(HEAD) + len(HEAD) : -len(MIDDLE)])
                text = unescape(p["piece"][p["begin"] : p["end"]])
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                if p["learned"]:
                    state["loss"].update(text.encode())
                    state["chars"] += len(text)
                state["all"] += len(p["piece"]) - p["rewritten"]
                state["rewritten"] += p["rewritten"]
            yield batch_of(done)
        if state is not None:
            yield batch_of([row()])

    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        pieces.repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", "place")
        .mapInArrow(
            run,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long, rewritten long",
        )
    )
