"""Chat formatting by quotation linking: quotes become reply links, conversations stand in reply order without them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stage

_MARKS = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
_ATTRIBUTION = re.compile(r".*\bwrote:[ \t]*$")

_PARSED = (
    "conv_id long, turn long, text_key long, role string, text string, own array<binary>, "
    "quoted array<struct<passage: int, level: int, unit: binary, words: int>>, passages int"
)
_UNIT = pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("unit", pa.binary()), ("words", pa.int32())])


def split_quotes(text: str) -> tuple[list[str], list[tuple[int, list[str]]]]:
    """The message's own lines, and its quoted passages as (level, lines).

    A line's level is the number of > marks before it; a passage is a run of lines of one level. A line
    "... wrote:" right before a quote belongs to the quote.
    """
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    running = 0
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks.group(1).count(">") if marks else 0
        if not level:
            own.append(line)
        elif level == running:
            passages[-1][1].append(line[marks.end() :])
        else:
            if not running and own and _ATTRIBUTION.match(own[-1]):
                own.pop()
            passages.append((level, [line[marks.end() :]]))
        running = level
    return own, passages


def units(lines: list[str]) -> dict[bytes, int]:
    """Hash and words of the lines as a whole, of each paragraph and of each line; case and spacing are ignored."""
    paragraphs: list[list[str]] = [[]]
    for line in lines:
        if line.strip():
            paragraphs[-1].append(line)
        elif paragraphs[-1]:
            paragraphs.append([])
    out = {}
    for part in (lines, *paragraphs, *([x] for x in lines)):
        words = " ".join(part).lower().split()
        if words:
            out[xxhash.xxh3_128_digest(" ".join(words))] = len(words)
    return out


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, own_units, quoted, passages = [], [], [], []
        for text in batch.column("text").to_pylist():
            own, quotes = split_quotes(text or "")
            texts.append(text if not quotes else "\n".join(own).strip("\n"))
            own_units.append(list(units(own)))
            quoted.append(
                [{"passage": i, "level": level, "unit": u, "words": n} for i, (level, lines) in enumerate(quotes) for u, n in units(lines).items()]
            )
            passages.append(len(quotes))
        columns = [batch.column(c) for c in ("conv_id", "turn", "text_key", "role")]
        columns += [pa.array(texts, pa.string()), pa.array(own_units, pa.list_(pa.binary())), pa.array(quoted, pa.list_(_UNIT)), pa.array(passages, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "text_key", "role", "text", "own", "quoted", "passages"])


def _parsed(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key"),
        F.col("text").cast("string").alias("text"),
        F.col("role").cast("string").alias("role"),
    ).mapInArrow(_parse, _PARSED)


def quote_links(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, text_key, passage, level, origin_conv, origin_turn, words): the original of each quoted passage.

    A unit's original is the earliest message before the quoting one in its conversation that has the unit in
    its own words, else the earliest message of any other conversation. The original of most words in a passage
    is the passage's; ties go to the message's own conversation, then to the smallest conv_id and turn.
    """
    known = parsed.filter("conv_id is not null and turn is not null")
    own = known.select("conv_id", "turn", F.explode("own").alias("unit"))
    here = stage(own.groupBy("conv_id", "unit").agg(F.min("turn").alias("turn")), "first-here")
    # the two earliest conversations of a unit: one of them is not the quoting message's
    place = F.struct("conv_id", "turn")
    first = here.groupBy("unit").agg(F.min(place).alias("first"))
    second = here.join(first, "unit").filter(F.col("conv_id") != F.col("first.conv_id")).groupBy("unit").agg(F.min(place).alias("second"))
    anywhere = stage(first.join(second, "unit", "left"), "first-anywhere")
    quoted = known.select("conv_id", "turn", "text_key", F.explode("quoted").alias("q")).select("conv_id", "turn", "text_key", "q.*")
    quoted = stage(quoted, "quoted")
    near = here.withColumnRenamed("turn", "origin_turn")
    inside = quoted.join(near, ["conv_id", "unit"], "left").withColumn(
        "here", F.when(F.col("origin_turn") < F.col("turn"), F.struct(F.col("conv_id"), F.col("origin_turn").alias("turn")))
    )
    met = inside.join(anywhere, "unit", "left")
    other = F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).otherwise(F.col("second"))
    met = met.withColumn("origin", F.coalesce("here", other)).filter("origin is not null")
    keys = ["conv_id", "turn", "text_key", "passage", "level"]
    weighed = met.groupBy(*keys, "origin").agg(F.sum("words").alias("words"))
    foreign = F.col("origin.conv_id") != F.col("conv_id")
    best = weighed.groupBy(*keys).agg(F.min(F.struct((-F.col("words")).alias("less"), foreign.alias("foreign"), "origin")).alias("best"))
    return best.select(
        *keys, F.col("best.origin.conv_id").alias("origin_conv"), F.col("best.origin.turn").alias("origin_turn"), (-F.col("best.less")).alias("words")
    )


def threads(parents: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(conv_id, turn, thread, depth) from (conv_id, turn, parent): each message's first ancestor and its distance.

    Every round doubles the distance looked back; a parent stands before its reply, so there is no cycle.
    """
    state = stage(parents.select("conv_id", "turn", F.col("parent").alias("thread"), F.lit(1).alias("depth")), "threads")
    for _ in range(max_rounds):
        up = state.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"), F.col("depth").alias("more"))
        state = stage(
            state.join(up, ["conv_id", "thread"], "left").select(
                "conv_id", "turn", F.coalesce("next", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "threads",
        )
        if state.filter("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")
    raise RuntimeError(f"reply chains are longer than 2^{max_rounds}")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, in reply order.

    (conv_id, turn, role, text, parent, thread, depth, n_quotes, n_linked, origins), ordered by conv_id, thread,
    depth, turn: a thread starts with a message that quotes none of its conversation, each reply stands after
    its parent. The parent is the original, in the same conversation, of most quoted words at level 1 (ties:
    the earliest). origins lists the originals of all passages, nested ones too, as (passage, level, conv_id,
    turn); passages without one count in n_quotes only.

    Messages that share conv_id and turn are one place in the order (the earliest of their parents counts) and
    rows of their own; repeated rows stay. A message with null conv_id or turn neither quotes nor is quoted; null
    texts stay null; roles and extra columns play no part. An empty table gives an empty result.
    """
    parsed = stage(_parsed(messages), "messages")
    links = stage(quote_links(parsed), "quote-links")
    row = ["conv_id", "turn", "text_key"]
    inside = links.filter((F.col("level") == 1) & (F.col("origin_conv") == F.col("conv_id")))
    weighed = inside.groupBy(*row, "origin_turn").agg(F.sum("words").alias("words"))
    parent = weighed.groupBy(*row).agg(F.min(F.struct((-F.col("words")).alias("less"), "origin_turn"))["origin_turn"].alias("parent"))
    parent = stage(parent, "parents")
    found = stage(threads(parent.groupBy("conv_id", "turn").agg(F.min("parent").alias("parent"))), "thread-table")
    origin = F.struct("passage", "level", F.col("origin_conv").alias("conv_id"), F.col("origin_turn").alias("turn"))
    origins = stage(links.groupBy(*row).agg(F.sort_array(F.collect_list(origin)).alias("origins")), "origins")  # of one message
    out = parsed.join(parent, row, "left").join(origins, row, "left").join(found, ["conv_id", "turn"], "left")
    out = out.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "parent",
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.col("passages").alias("n_quotes"),
        F.coalesce(F.size("origins"), F.lit(0)).alias("n_linked"),
        "origins",
    )
    return out.orderBy("conv_id", "thread", "depth", "turn", "role", "text")
