"""Conversation prefix trie by burst tries.

Every different conversation is a string of turn ids, cut into windows of a bounded number of turns. A container holds
the suffixes below one trie head that begin with the same turn. Containers with too many suffixes burst: the turns that
all members share become a new head, and its members go to new containers by their next turn. The other
containers are sorted and swept into nodes, many in one task; their sums go up the heads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stage
from creditloom.operators.ordering import with_total_before

#: Suffixes that a container holds at most when it is swept.
CONTAINER = 1024
#: Turns of a conversation that stand in one row.
WINDOW = 128
#: conv_ids joined to one text.
IDS = 1024
#: crc32(conv_id) mod HEADS turns come from the conversation whose id is the next lower multiple of SHARED.
HEADS = 9
SHARED = 5

_NOTHING = hashlib.sha256(b"").hexdigest()
_TURN = "struct<id: binary, size: bigint>"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, size): the turns of every conversation in order, from 0; ``id`` stands for role and text.

    Null turns come first; turns of one number are ordered by id. Places come from range slices, so a
    conversation with any number of turns is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
    )
    placed = with_total_before(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("id")], F.lit(1), "pos")
    return stage(placed.select("conv_id", F.col("pos").cast("long").alias("pos"), "id", "size"), "turns")


def rebuilt_turns(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, pos, id, size): the first turns of the shared conversation, then a conversation's own after as many."""
    n_heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = convs.select("conv_id", n_heads, (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base"))
    plan = plan.join(bases, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"))
    plan = stage(plan, "plan")
    own = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "size")
    heads = turns.filter(F.col("pos") < HEADS - 1).withColumnRenamed("conv_id", "base")
    heads = heads.join(plan.select("conv_id", "base", "taken"), "base").filter("pos < taken")
    return stage(own.union(heads.select("conv_id", "pos", "id", "size")), "rebuilt")


def _windows(turns: DataFrame, window: int) -> DataFrame:
    """(conv_id, win, seq, x, y, n, total): up to ``window`` turns in a row, with two hashes of turns at their places."""
    at = turns.withColumn("win", F.floor(F.col("pos") / window))
    rows = at.groupBy("conv_id", "win").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "size"))).alias("seq"),
        F.bit_xor(F.xxhash64(F.lit(1), "pos", "id")).alias("x"),
        F.bit_xor(F.xxhash64("id", "pos", F.lit(2))).alias("y"),
        F.count(F.lit(1)).alias("n"),
    )
    seq = F.transform("seq", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size")))
    return stage(rows.withColumn("seq", seq), "windows")


def _classes(convs: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal conversations as one: (rep, copies, n), and (conv_id, rep) of those that are not alone."""
    whole = windows.groupBy("conv_id").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    whole = convs.select("conv_id").join(whole, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("x", "y", "n")])
    whole = stage(whole, "wholes")
    same = stage(whole.groupBy("x", "y", "n").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    several = whole.join(same.filter("copies > 1"), ["x", "y", "n"]).select("conv_id", "rep")
    return same.select("rep", "copies", "n"), several


def _texts(frames: Iterator[pd.DataFrame], ids: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rep, conv = frame["rep"].to_numpy(), frame["conv_id"].to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], rep[1:] != rep[:-1]))) if len(rep) else []
        out = []
        for start, end in zip(cuts, [*cuts[1:], len(rep)]):
            for at in range(start, end, ids):
                part = conv[at : min(end, at + ids)]
                out.append((rep[start], part[0], ",".join(map(str, part.tolist()))))
        yield pd.DataFrame(out, columns=["rep", "first", "ids"])


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, digest = None, None
    for frame in frames:
        out = []
        for rep, ids in zip(frame["rep"].tolist(), frame["ids"]):
            if rep != held:
                if digest:
                    out.append((held, digest.hexdigest()))
                held, digest = rep, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["rep", "sha"])
    if digest:
        yield pd.DataFrame([(held, digest.hexdigest())], columns=["rep", "sha"])


def member_digests(several: DataFrame, ids: int = IDS) -> DataFrame:
    """(rep, sha): the hash of the sorted conv_ids of each class. All tasks join ids to texts of ``ids`` numbers; a hash,
    which knows no parts, then runs over so many fewer rows, one text in memory at a time."""
    sorted_ = several.repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id")
    texts = stage(sorted_.mapInPandas(partial(_texts, ids=ids), "rep long, first long, ids string"), "ids")
    return texts.repartition("rep").sortWithinPartitions("rep", "first").mapInPandas(_digests, "rep long, sha string")


_NODE = [
    ("kind", pa.int32()),
    ("conv_id", pa.int64()),
    ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved", pa.int64()),
    ("end_rep", pa.int64()),
    ("end_copies", pa.int64()),
]
_NODE_SCHEMA = "kind int, " + ", ".join(f"{n} long" for n, _ in _NODE[1:])
#: A node; the sums that a container adds to its head (conv_id, depth).
NODE, TO_HEAD = 0, 1


def _nodes(**columns: np.ndarray) -> pa.RecordBatch:
    n = len(columns["conv_id"])
    arrays = []
    for name, kind in _NODE:
        values = columns.get(name)
        if values is None:
            arrays.append(pa.nulls(n, kind))
        elif name.startswith("end_"):
            arrays.append(pa.array(values, kind, mask=values < 0 if name == "end_copies" else columns["end_copies"] < 0))
        else:
            arrays.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in _NODE])


def sweep(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The nodes of whole containers, whose rows are sorted by (head, suffix), and their sums for the heads."""
    head_conv, head_depth = table["head_conv"].to_numpy(), table["head_depth"].to_numpy()
    rep, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
    seq = table["seq"].combine_chunks()
    turns = seq.flatten()
    ids = np.frombuffer(b"".join(turns.field("id").to_pylist()), np.dtype([("a", "<u8"), ("b", "<u8")]))
    sizes = turns.field("size").to_numpy(zero_copy_only=False)
    lengths = np.diff(seq.offsets.to_numpy())
    offsets = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    # node of each row at the depth reached; at first its head
    node = np.cumsum(np.concatenate(([True], (head_conv[1:] != head_conv[:-1]) | (head_depth[1:] != head_depth[:-1])))) - 1
    firsts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    heads = {"conv_id": head_conv[firsts], "depth": head_depth[firsts]}
    levels, above, depth = [], heads, 0
    while len(alive := np.flatnonzero(lengths > depth)):
        turn, parent = ids[offsets[alive] + depth], node[alive]
        new = np.concatenate(([True], (parent[1:] != parent[:-1]) | (turn[1:] != turn[:-1])))
        starts = np.flatnonzero(new)
        mine = np.cumsum(new) - 1
        level = {
            "parent": parent[starts],
            "conv_id": np.minimum.reduceat(rep[alive], starts),
            "n_convs": np.add.reduceat(copies[alive], starts),
            "size": sizes[offsets[alive[starts]] + depth],
            "end_rep": np.full(len(starts), -1),
            "end_copies": np.full(len(starts), -1),
        }
        level["depth"] = above["depth"][level["parent"]] + 1
        level["parent_conv_id"] = above["conv_id"][level["parent"]]
        ends = np.flatnonzero(lengths[alive] == depth + 1)
        level["end_rep"][mine[ends]], level["end_copies"][mine[ends]] = rep[alive[ends]], copies[alive[ends]]
        node = np.full(len(lengths), -1)
        node[alive] = mine
        levels.append(level)
        above, depth = level, depth + 1
    below = None
    for level in [*reversed(levels), heads]:
        n = len(level["conv_id"])
        sums = {c: np.zeros(n, np.int64) for c in ("n_children", "n_leaves", "saved")}
        if below is not None:
            np.add.at(sums["n_children"], below["parent"], 1)
            np.add.at(sums["n_leaves"], below["parent"], below["n_leaves"])
            np.add.at(sums["saved"], below["parent"], below["saved"])
        if level is heads:
            yield _nodes(kind=np.full(n, TO_HEAD), **heads, **sums)
            break
        sums["n_leaves"][sums["n_children"] == 0] = 1
        sums["saved"] += (level["n_convs"] - 1) * level["size"]
        level |= sums
        shown = {k: level[k] for k, _ in _NODE[1:]}
        yield _nodes(kind=np.full(n, NODE), **shown)
        below = level


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole containers at a time: the last one of a batch waits for the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        first = table["first"].to_pylist()
        conv, depth = table["head_conv"].to_numpy(), table["head_depth"].to_numpy()
        at = len(first)
        while at and first[at - 1] == first[-1] and conv[at - 1] == conv[-1] and depth[at - 1] == depth[-1]:
            at -= 1
        if at:
            yield from sweep(table.slice(0, at))
        held = table.slice(at)
    if held is not None and held.num_rows:
        yield from sweep(held)


def _common(low: Column, high: Column) -> Column:
    """Number of turns at which the smallest and the largest sequence, and so all between, agree."""
    n = F.least(F.size(low), F.size(high))
    differ = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at(low, i)["id"] != F.element_at(high, i)["id"])
    return F.when(F.size(differ) > 0, F.element_at(differ, 1) - 1).otherwise(n).cast("int")


def _tails(tails: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of suffixes that are alone in their container and longer than a window, and their sums for the heads."""
    rows = turns.join(tails.select(F.col("rep").alias("conv_id"), "copies", "done", "n", "head_conv", "head_depth"), "conv_id")
    rows = rows.filter("pos >= done")
    summed = with_total_before(rows, ["conv_id"], [F.col("pos")], F.col("size"), "before", "whole")
    nodes = summed.select(
        F.lit(NODE).alias("kind"),
        "conv_id",
        (F.col("pos") + 1).alias("depth"),
        F.when(F.col("pos") == F.col("done"), F.col("head_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("copies").alias("n_convs"),
        (F.col("pos") + 1 < F.col("n")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("copies") - 1) * (F.col("whole") - F.col("before"))).cast("long").alias("saved"),
        F.when(F.col("pos") + 1 == F.col("n"), F.col("conv_id")).alias("end_rep"),
        F.when(F.col("pos") + 1 == F.col("n"), F.col("copies")).alias("end_copies"),
        "done",
        "head_conv",
        "head_depth",
    )
    nodes = stage(nodes, "tails")
    up = nodes.filter("depth = done + 1").selectExpr(
        "head_conv as conv_id", "head_depth as depth", "1L as n_children", "n_leaves", "saved"
    )
    return nodes.drop("done", "head_conv", "head_depth"), up


def _zero() -> Column:
    return F.lit(0).cast("long")


class _Trie:
    """What the rounds of bursting leave: heads and their ends by round, containers to sweep, chains."""

    def __init__(self):
        self.heads: list[DataFrame] = []
        self.ends: list[DataFrame] = []
        self.sweeps: list[DataFrame] = []
        self.tails: list[DataFrame] = []


_CONTAINER = ["head_conv", "head_depth", "first"]
_MEMBER = ["rep", "copies", "n", "done", "seq", "head_conv", "head_depth"]


def _members(rows: DataFrame) -> DataFrame:
    """Suffixes with the turn that names their container; ``seq`` is what a window has of them."""
    return stage(rows.select(*_MEMBER, F.col("seq")[0]["id"].alias("first")), "members")


def _grown(classes: DataFrame, windows: DataFrame, container: int, window: int) -> _Trie:
    """Burst containers, round by round, until none is too large."""
    trie = _Trie()
    root, copies = classes.agg(F.min("rep"), F.sum("copies")).first()
    at_root = [F.lit(root).cast("long").alias("head_conv"), _zero().alias("head_depth")]
    blocks = windows.select(F.col("conv_id").alias("rep"), "win", "seq")
    first = classes.filter("n > 0").join(blocks.filter("win = 0").drop("win"), "rep")
    members = _members(first.select("rep", "copies", "n", _zero().alias("done"), "seq", *at_root))
    row = classes.filter(F.col("rep") == root).select(
        F.col("rep").alias("conv_id"), _zero().alias("depth"), F.lit(None).cast("long").alias("up_conv"),
        F.lit(None).cast("long").alias("up_depth"), F.lit(copies).cast("long").alias("n_convs"), F.array().cast("array<long>").alias("chain"),
    )
    trie.heads.append(row)
    trie.ends.append(classes.filter("n = 0").select(*at_root, F.col("rep").alias("end_rep"), F.col("copies").alias("end_copies")))
    while True:
        held = members.groupBy(*_CONTAINER).agg(
            F.count(F.lit(1)).alias("k"),
            F.max(F.col("n") - F.col("done") > F.size("seq")).alias("long"),
            F.min("rep").alias("conv"),
            F.sum("copies").alias("n_convs"),
            F.min("seq").alias("low"),
            F.max("seq").alias("high"),
        )
        how = F.when(F.col("long") & (F.col("k") == 1), "tail").when(F.col("long") | (F.col("k") > container), "burst")
        held = stage(held.withColumn("how", how.otherwise("sweep")), "containers")
        kinds = {r["how"] for r in held.select("how").distinct().collect()}  # three names at most
        for kind, found in (("sweep", trie.sweeps), ("tail", trie.tails)):
            if kind in kinds:
                mine = held.filter(F.col("how") == kind).select(*_CONTAINER)
                found.append(members if kinds == {kind} else members.join(mine, _CONTAINER, "left_semi").select(*members.columns))
        if "burst" not in kinds:
            return trie
        # the turns that all members share are nodes of one child each but for the last, the new head
        shared = held.filter("how = 'burst'").withColumn("shared", _common(F.col("low"), F.col("high")))
        chain = F.transform(F.slice("low", 1, F.col("shared")), lambda t: t["size"])
        shared = stage(shared.select(*_CONTAINER, "conv", "n_convs", "shared", chain.alias("chain")), "heads")
        trie.heads.append(
            shared.selectExpr(
                "conv as conv_id", "head_depth + shared as depth", "head_conv as up_conv", "head_depth as up_depth", "n_convs", "chain"
            )
        )
        moved = members.join(shared.select(*_CONTAINER, "conv", "shared"), _CONTAINER).selectExpr(
            "rep", "copies", "n", "done + shared as done", f"slice(seq, shared + 1, {window}) as seq",
            "conv as head_conv", "head_depth + shared as head_depth",
        )
        moved = stage(moved, "moved")
        trie.ends.append(moved.filter("done = n").selectExpr("head_conv", "head_depth", "rep as end_rep", "copies as end_copies"))
        going = moved.filter("done < n")
        next_window = going.filter(F.size("seq") == 0).drop("seq").withColumn("win", F.floor(F.col("done") / window))
        next_window = next_window.join(blocks, ["rep", "win"]).select(*_MEMBER)
        members = _members(going.filter(F.size("seq") > 0).select(*_MEMBER).union(next_window))


_SUMS = ["n_children", "n_leaves", "saved"]


def _head_nodes(trie: _Trie, sums: DataFrame) -> list[DataFrame]:
    """The nodes of the heads, from the last round to the root: what lies below a head is summed before it."""
    key = ["conv_id", "depth"]
    out = []
    for heads, ends in reversed(list(zip(trie.heads, trie.ends))):
        below = sums.groupBy(*key).agg(*[F.sum(c).alias(c) for c in _SUMS])
        ends = ends.withColumnsRenamed({"head_conv": "conv_id", "head_depth": "depth"})
        closed = heads.join(below, key, "left").join(ends, key, "left").withColumns({c: F.coalesce(c, _zero()) for c in _SUMS})
        closed = stage(closed.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves"))), "closed")
        saved = "aggregate(slice(chain, {}, size(chain)), 0L, (a, x) -> a + x * (n_convs - 1))"
        up = closed.filter("up_depth is not null").selectExpr(
            "up_conv as conv_id", "up_depth as depth", "1L as n_children", "n_leaves", f"saved + {saved.format(1)} as saved"
        )
        sums = stage(sums.select(*key, *_SUMS).union(up), "sums")
        places = closed.withColumn("j", F.explode(F.when(F.size("chain") == 0, F.array(F.lit(0))).otherwise(F.expr("sequence(1, size(chain))"))))
        last = "j = size(chain)"
        out.append(
            places.selectExpr(
                f"{NODE} as kind", "conv_id", "depth - size(chain) + j as depth", "if(j > 1, conv_id, up_conv) as parent_conv_id",
                "n_convs", f"if({last}, n_children, 1L) as n_children", "n_leaves",
                f"saved + if(j = 0, 0L, {saved.format('greatest(j, 1)')}) as saved",
                f"if({last}, end_rep, null) as end_rep", f"if({last}, end_copies, null) as end_copies",
            )
        )
    return out


def prefix_trie(conversations: DataFrame, container: int = CONTAINER, window: int = WINDOW, ids: int = IDS) -> DataFrame:
    """The trie of rebuilt conversations, one row a node.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); a node is named by its smallest
    member and its depth. Null roles and texts are empty; a null turn comes first, turns with one number are
    ordered by a hash of role and text, repeated rows are turns of their own; rows without a conv_id take no part.
    conv_id % 5 has the sign of conv_id. A conversation without turns is a member of the root. An empty table gives
    an empty result: without members there is no root. Extra columns are ignored.

    A suffix that is alone in its container and longer than a window is a chain, taken from the rows with running
    sums, so a conversation of any length is spread over tasks. Other containers with a suffix longer than a
    window burst, whatever their number of suffixes.
    """
    turns = numbered_turns(conversations)
    convs = stage(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "convs")
    rebuilt = rebuilt_turns(turns, convs)
    windows = _windows(rebuilt, window)
    classes, several = _classes(convs, windows)
    columns = ["kind", "conv_id", "depth", "parent_conv_id", "n_convs", *_SUMS, "end_rep", "end_copies"]
    nodes = conversations.sparkSession.createDataFrame([], _NODE_SCHEMA).select(*columns)
    if not classes.isEmpty():
        trie = _grown(classes, windows, container, window)
        sums = []
        if trie.sweeps:
            sorted_ = reduce(DataFrame.union, trie.sweeps).repartition(*_CONTAINER).sortWithinPartitions("head_conv", "head_depth", "seq")
            swept = stage(sorted_.mapInArrow(_swept, _NODE_SCHEMA), "swept")
            nodes = nodes.union(swept.filter(F.col("kind") == NODE).select(*columns))
            sums.append(swept.filter(F.col("kind") == TO_HEAD).select("conv_id", "depth", *_SUMS))
        if trie.tails:
            chains, up = _tails(reduce(DataFrame.union, trie.tails), rebuilt)
            nodes = nodes.union(chains.select(*columns))
            sums.append(up.select("conv_id", "depth", *_SUMS))
        none = nodes.select("conv_id", "depth", *_SUMS).limit(0)
        nodes = reduce(DataFrame.union, [nodes, *[n.select(*columns) for n in _head_nodes(trie, reduce(DataFrame.union, sums, none))]])
    of_several = member_digests(several, ids).withColumnRenamed("rep", "end_rep")
    alone = F.sha2(F.when(F.col("end_copies") == 1, F.col("end_rep").cast("string")).otherwise("").cast("binary"), 256)
    nodes = stage(nodes, "nodes")
    with_ends = nodes.filter("end_copies is null or end_copies = 1").withColumn("sha", alone).select(*columns, "sha")
    with_ends = with_ends.union(nodes.filter("end_copies > 1").join(of_several, "end_rep").select(*columns, "sha"))
    return with_ends.select(*columns[1:-3], F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))


def prefix_trie_sql() -> str:
    """DuckDB SQL for the rows of ``prefix_trie`` where (conv_id, turn) is a key."""
    polynomial = 0xEDB88320
    crc = (
        "xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(conv_id::varchar, ''), "
        "lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        f"lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, (a & 1) * {polynomial}) end), 4294967295)"
    )
    return f"""
with turns as materialized (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first) as pos,
      md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id, strlen(coalesce(text, '')) as size
    from conversations where conv_id is not null),
  convs as (select conv_id, {crc} % {HEADS} as h, conv_id - conv_id % {SHARED} as base from (select distinct conv_id from turns)),
  rebuilt as (
    select c.conv_id, 0 as part, t.pos, t.id, t.size from convs c join turns t on t.conv_id = c.base and t.pos <= c.h
    union all
    select c.conv_id, 1, t.pos, t.id, t.size from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h),
  lists as (
    select c.conv_id, coalesce(r.ids, []) as ids, coalesce(r.sizes, []) as sizes
    from convs c left join (
      select conv_id, list(id order by part, pos) as ids, list(size order by part, pos) as sizes from rebuilt group by conv_id) r
      on r.conv_id = c.conv_id),
  path as materialized (
    select conv_id, depth, md5(array_to_string(ids[1:depth], ',')) as prefix, depth = len(ids) as last,
      case when depth = 0 then 0 else sizes[depth] end as size
    from (select *, unnest(range(len(ids) + 1)) as depth from lists)),
  nodes as materialized (
    select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as own,
      sha256(coalesce(string_agg(case when last then conv_id::varchar end, ',' order by conv_id), '')) as ends_sha256
    from path group by depth, prefix),
  edges as (
    select c.depth, c.prefix, p.prefix as parent_prefix, n.conv_id as parent_conv_id
    from nodes c join path p on p.conv_id = c.conv_id and p.depth = c.depth - 1 join nodes n on n.depth = p.depth and n.prefix = p.prefix),
  children as (select depth - 1 as depth, parent_prefix as prefix, count(*) as n_children from edges group by all),
  counted as (
    select n.*, e.parent_conv_id, coalesce(k.n_children, 0) as n_children
    from nodes n left join edges e on e.depth = n.depth and e.prefix = n.prefix left join children k on k.depth = n.depth and k.prefix = n.prefix),
  below as (
    select a.depth, a.prefix, sum(c.own) as saved_tokens, count(*) filter (c.n_children = 0) as n_leaves
    from counted c join path a on a.conv_id = c.conv_id and a.depth <= c.depth group by a.depth, a.prefix)
select c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, b.n_leaves, b.saved_tokens::bigint as saved_tokens, c.ends_sha256
from counted c join below b on b.depth = c.depth and b.prefix = c.prefix"""
