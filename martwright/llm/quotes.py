"""Conversations from quoting messages: quotation linking.

Lines that begin with quote marks are parsed into levels of quotation. Runs of quoted lines, and the
lines themselves, are normalised and hashed, and so are the passages and lines every message wrote
itself. A quoted passage belongs to the earliest message of the conversation that wrote it; a message
replies to the message most of its outermost quotes come from. Replies are followed to the message
their thread began with, by jumping, and messages are put in order thread by thread, quotes removed.

Joining with the earliest holder only keeps a passage that thousands of messages quote, or wrote, at
one match per quote.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, numbered

MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)(.*)$")
ATTRIBUTION = re.compile(r"^[ \t]*On .+ wrote:[ \t]*$")
BLANKS = re.compile(r"[\x20\x09-\x0D]+")

PARSED = (
    "conv_id long, turn long, role string, own_text string, quotes int, "
    "pieces array<struct<level:int,hash:long>>"
)


def parse(text: str | None) -> list[tuple[int, str]]:
    """(level, line) of a text, without its quote marks; level 0 is the message's own. A line that
    only says who wrote the quote below it is left out."""
    lines = []
    for line in (text or "").split("\n"):
        marks = MARKS.match(line)
        lines.append((marks.group(1).count(">"), marks.group(2)) if marks else (0, line))
    return [
        (level, line)
        for i, (level, line) in enumerate(lines)
        if not (level == 0 and ATTRIBUTION.match(line) and i + 1 < len(lines) and lines[i + 1][0])
    ]


def normalised(text: str) -> str:
    """One blank between words, none around, lower case."""
    return BLANKS.sub(" ", text).strip(" ").lower()


def passages(lines: list[tuple[int, str]]) -> list[tuple[int, list[str]]]:
    """Runs of normalised lines of one level; an empty line ends a run."""
    runs: list[tuple[int, list[str]]] = []
    open_level = None
    for level, line in lines:
        plain = normalised(line)
        if not plain:
            open_level = None
            continue
        if level != open_level:
            runs.append((level, []))
            open_level = level
        runs[-1][1].append(plain)
    return runs


def _hash(text: str) -> int:
    value = xxhash.xxh3_64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


def pieces(lines: list[tuple[int, str]]) -> tuple[list[tuple[int, int]], int]:
    """(level, hash) of every passage and of every line in it, each once; the number of quoted
    passages."""
    runs = passages(lines)
    found = {}
    for level, run in runs:
        for text in (" ".join(run), *run):
            found[level, _hash(text)] = None
    own = [line for level, run in runs if level == 0 for line in run]
    if own:
        found[0, _hash(" ".join(own))] = None
    return list(found), sum(level > 0 for level, _ in runs)


def own_text(lines: list[tuple[int, str]]) -> str:
    """The lines of level 0, without the empty lines that the quotes leave at the ends."""
    return "\n".join(line for level, line in lines if level == 0).strip("\n")


def _parse(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))
    for batch in source:
        texts, counts, lists = [], [], []
        for text in batch.column("text").to_pylist():
            lines = parse(text)
            found, quotes = pieces(lines)
            # A text without quotes stays exactly as it is.
            texts.append(own_text(lines) if quotes else text)
            counts.append(quotes)
            lists.append([{"level": level, "hash": value} for level, value in found])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv_id", "turn", "role")),
                pa.array(texts, pa.string()),
                pa.array(counts, pa.int32()),
                pa.array(lists, kind),
            ],
            ["conv_id", "turn", "role", "own_text", "quotes", "pieces"],
        )


def reply_links(parsed: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_turn, linked``: of every message that quotes an earlier one, the
    message it replies to and the number of messages it quotes.

    The outermost quotes decide; then the message that most passages come from, then the later one.
    """
    found = parsed.select("conv_id", "turn", F.explode("pieces").alias("piece")).select(
        "conv_id", "turn", "piece.level", "piece.hash"
    )
    originals = (
        found.filter(F.col("level") == 0)
        .groupBy("conv_id", "hash")
        .agg(F.min("turn").alias("first_turn"))
        .select(F.col("conv_id").alias("c"), F.col("hash").alias("h"), "first_turn")
    )
    votes = (
        found.filter(F.col("level") > 0)
        .join(
            originals,
            (F.col("conv_id") == F.col("c"))
            & (F.col("hash") == F.col("h"))
            & (F.col("first_turn") < F.col("turn")),
        )
        .groupBy("conv_id", "turn", "level", "first_turn")
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    preference = F.struct("level", -F.col("votes"), -F.col("first_turn"))
    return (
        votes.groupBy("conv_id", "turn")
        .agg(
            F.min_by("first_turn", preference).alias("parent_turn"),
            F.count_distinct("first_turn").alias("linked"),
        )
    )


def threads(links: DataFrame) -> DataFrame:
    """``conv_id, turn, root_turn, depth`` of every linked message. Each round doubles the distance
    that is known, so a thread of n replies takes log n rounds."""
    state = keep(
        links.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth")),
        "threads",
    )
    known = state.agg(F.sum("depth")).first()[0]
    while known is not None:
        above = state.select(
            F.col("conv_id").alias("c"),
            F.col("turn").alias("t"),
            F.col("root_turn").alias("next"),
            F.col("depth").alias("more"),
        )
        state = keep(
            state.join(
                above, (F.col("conv_id") == F.col("c")) & (F.col("root_turn") == F.col("t")), "left"
            ).select(
                "conv_id",
                "turn",
                F.coalesce("next", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "threads",
        )
        now = state.agg(F.sum("depth")).first()[0]
        if now == known:
            break
        known = now
    return state


def link_conversations(
    messages: DataFrame,
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row per message: ``conv_id, position, turn, role, parent_turn, root_turn, depth, quotes,
    linked, text``.

    ``position`` counts a conversation's messages from 0, thread by thread in the order the threads
    began, inside a thread by turn; without quotes that is the order of the turns. ``parent_turn`` is
    null and ``depth`` 0 for a message that replies to nothing. ``quotes`` counts quoted passages,
    ``linked`` the messages they come from. A null text stays null; messages without a conversation
    or a turn are never linked and come first. Rows that repeat a turn share its links and follow
    each other in the order of role and text; an empty table gives an empty result.
    """
    parsed = keep(
        messages.select(
            F.col(conversation_column).cast("long").alias("conv_id"),
            F.col(turn_column).cast("long").alias("turn"),
            F.col(role_column).cast("string").alias("role"),
            F.col(text_column).cast("string").alias("text"),
        ).mapInArrow(_parse, PARSED),
        "parsed",
    )
    links = keep(reply_links(parsed), "links")
    linked = links.join(threads(links), ["conv_id", "turn"]).select(
        F.col("conv_id").alias("c"),
        F.col("turn").alias("t"),
        "parent_turn",
        "linked",
        "root_turn",
        "depth",
    )
    rows = (
        parsed.drop("pieces")
        .join(linked, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
        .select(
            "conv_id",
            "turn",
            "role",
            F.col("own_text").alias("text"),
            "quotes",
            F.coalesce("linked", F.lit(0)).cast("long").alias("linked"),
            "parent_turn",
            F.coalesce("root_turn", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        )
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "root_turn", "turn", "role", "text")]
    placed = numbered(rows, order, "messages", "place")
    starts = placed.groupBy(F.col("conv_id").alias("c")).agg(F.min("place").alias("start"))
    return placed.join(starts, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id",
        (F.col("place") - F.col("start")).alias("position"),
        *("turn", "role", "parent_turn", "root_turn", "depth", "quotes", "linked", "text"),
    )


def as_chat(role: Column, text: Column) -> Column:
    """A message in the common chat markup; a null role is the user."""
    return F.concat(
        F.lit("<|im_start|>"),
        F.coalesce(role, F.lit("user")),
        F.lit("\n"),
        F.coalesce(text, F.lit("")),
        F.lit("<|im_end|>\n"),
    )
