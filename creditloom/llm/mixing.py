"""Mixing sources to target weights: token blocks, multinomial source counts per shard, index permutations. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import md5_order, running_total, stage, whole_text

#: A word, for sizes.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 512
SHARD_WORDS = 1 << 20
SEED = "mix-1"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_key, size in words) of every row; a null text has size 0."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.xxhash64(whole_text()).alias("text_key"),
        F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, sid, source_size, target): one row per source.

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes by weight.
    No target exceeds ``max_repeats`` times its source's size; what is over is shared again by weight. In
    order of size over weight, the sources that are held at their limit come first, so the share of the
    first that is not held is everyone's share for a unit of weight.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source, summed before
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("sid") - 1, F.lit(len(weights))).cast("int") + 1)
    numbered = totals.withColumn("sid", F.row_number().over(by_name).cast("long")).withColumn("weight", weight)
    limit = F.col("source_size") * max_repeats
    whole = Window.partitionBy()
    rank = F.struct((limit.cast("double") / F.col("weight")).alias("ratio"), "sid")
    ranked = numbered.withColumns({"limit": limit, "rank": rank})
    by_rank = Window.orderBy("rank")
    held = F.coalesce(F.sum("limit").over(by_rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(by_rank.rowsBetween(0, Window.unboundedFollowing))
    shared = ranked.withColumn("share", (F.sum("source_size").over(whole) - held).cast("double") / weight_left)
    # the first source that is not held at its limit, with its share
    first = F.min(F.when(F.col("rank.ratio") > F.col("share"), F.struct("rank", "share"))).over(whole)
    shared = shared.withColumn("first", first)
    is_held = F.col("first").isNull() | (F.col("rank") < F.col("first.rank"))
    target = F.when(is_held, F.col("limit").cast("double")).otherwise(F.col("first.share") * F.col("weight"))
    return shared.select("source", "sid", "source_size", target.alias("target"))


def place(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """The targets, and every row with the place of its first word in its source's row of words.

    Rows of a source stand in a fixed pseudorandom order, by md5 of doc_id. Both tables are written.
    """
    sized = stage(sizes(docs), "sizes")
    shares = stage(targets(sized, weights, max_repeats), "targets")
    right = shares.select(F.col("source").alias("__source"), "sid", "source_size", "target")
    known = sized.join(right, sized["source"].eqNullSafe(right["__source"])).drop("__source")
    ordered = known.withColumn("__order", md5_order("doc_id"))
    return shares, stage(running_total(ordered, ["sid"], "__order", ["doc_id", "size"], "size", "start").drop("__order"), "placed")


def pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """One row for each block that a document has words in: block, offset (in the block), first_word, n_words."""
    at = F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)))
    cut = placed.filter("size > 0").withColumn("block", at)
    begin = F.col("block") * block_words
    n = F.least(F.col("start") + F.col("size"), begin + block_words) - F.greatest("start", begin)
    return cut.withColumns(
        {
            "offset": F.greatest(F.col("start") - begin, F.lit(0).cast("long")),
            "first_word": F.greatest(begin - F.col("start"), F.lit(0).cast("long")),
            "n_words": n,
        }
    )


def _draw(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), *[p.cast("string") for p in parts]))


def slots(parts: DataFrame) -> DataFrame:
    """(sid, block, epoch, draw, words): how often the mix takes each block, and how many of its words.

    A source's slots go through its blocks epoch by epoch, each in its own pseudorandom permutation; a block's
    index in it is its rank by md5 of seed, source, epoch and block. The last epoch stops at the target, in the
    middle of a block if need be, so a source's words are its target to half a word.
    """
    blocks = parts.groupBy("sid", "block").agg(
        F.sum("n_words").alias("words"), F.max("source_size").alias("all"), F.floor(F.max("target") + 0.5).alias("quota")
    )
    rest = F.pmod("quota", "all")
    known = blocks.withColumns({"rest": rest, "epochs": ((F.col("quota") - rest) / F.col("all")).cast("long")})
    whole = known.filter("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    whole = whole.select("sid", "block", "epoch", _draw(F.col("sid"), F.col("epoch"), F.col("block")).alias("draw"), "words")
    last = known.filter("rest > 0").withColumn("draw", _draw(F.col("sid"), F.col("epochs"), F.col("block")))
    last = running_total(last, ["sid"], "draw", ["block"], "words", "before").filter("before < rest")
    taken = F.least(F.col("words"), F.col("rest") - F.col("before"))
    return whole.union(last.select("sid", "block", F.col("epochs").alias("epoch"), "draw", taken.alias("words")))


def dealt(parts: DataFrame, shard_slots: int) -> DataFrame:
    """The slots with their output shard, by multinomial source counts per shard.

    The mix has as many places as slots, ``shard_slots`` to a shard. Every place draws a source, with the sources'
    slots as weights: a place draws the number of a slot, and the source is the one which has that slot. So a shard's
    source counts are multinomial, and the draws are an equi-join however many sources there are. Shard by shard a
    source's count is then taken from its row of slots (epoch by epoch, each in its permutation). A source whose draws
    are more than its slots has no more than these, so no text is taken beyond its target; the places this leaves
    vacant go, in their order, to the slots that were not drawn. So a source's slots are all in the mix, once each.
    """
    rows = slots(parts).withColumn("one", F.lit(1))
    ranked = running_total(rows, ["sid", "epoch"], "draw", ["block"], "one", "rank").drop("one")
    epochs = rows.groupBy("sid", "epoch").agg(F.count(F.lit(1)).alias("n"))  # a few rows a source
    before = lambda order: order.rowsBetween(Window.unboundedPreceding, -1)
    total = lambda name, order: F.coalesce(F.sum(name).over(before(order)), F.lit(0)).cast("long")
    epochs = epochs.select("sid", "epoch", total("n", Window.orderBy("sid", "epoch")).alias("first"))
    placed = stage(ranked.join(epochs, ["sid", "epoch"]).withColumn("place", F.col("first") + F.col("rank")).drop("first", "rank"), "slots")
    sources = placed.groupBy("sid").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))

    n_places = placed.agg(F.count(F.lit(1))).scalar()
    hit = F.pmod(F.conv(F.substring(_draw(F.lit("place"), F.col("place")), 1, 15), 16, 10).cast("long"), n_places)
    draws = placed.select(F.floor(F.col("place") / shard_slots).alias("shard"), hit.alias("place"))
    counts = draws.join(placed.select("place", "sid"), "place").groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("drawn"))
    counts = counts.join(sources, "sid").withColumn("from", total("drawn", Window.partitionBy("sid").orderBy("shard")))
    given = F.greatest(F.least("drawn", F.col("n") - F.col("from")), F.lit(0).cast("long"))
    counts = stage(counts.withColumn("given", given), "shard-counts")

    spread = lambda start, n, name: F.explode(F.sequence(start, start + n - 1)).alias(name)
    drawn = counts.filter("given > 0").select("shard", spread(F.col("first") + F.col("from"), F.col("given"), "place"))
    vacant = counts.groupBy("shard").agg(F.sum(F.col("drawn") - F.col("given")).alias("n")).filter("n > 0")
    vacant = vacant.withColumn("start", total("n", Window.orderBy("shard")))
    used = counts.groupBy(F.col("sid").alias("__sid")).agg(F.sum("given").alias("used"))
    left = sources.join(used, F.col("sid") == F.col("__sid"), "left").withColumn("used", F.coalesce("used", F.lit(0).cast("long")))
    left = left.select("sid", (F.col("first") + F.col("used")).alias("next"), (F.col("n") - F.col("used")).alias("n")).filter("n > 0")
    left = left.withColumn("start", total("n", Window.orderBy("sid")))
    left = left.select(F.col("start").alias("from"), "next", spread(F.col("start"), F.col("n"), "turn"))
    rest = vacant.select("shard", spread(F.col("start"), F.col("n"), "turn")).join(left, "turn")
    shards = drawn.union(rest.select("shard", F.col("next") + F.col("turn") - F.col("from")))
    return placed.join(shards, "place")


def _shard_slots(shard_words: int, block_words: int) -> int:
    return max(1, shard_words // block_words)


def taken(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for each row: the words of it that the mix's shards take.

    Null and empty texts have size 0 and nothing is taken of them; a null source is a source, the last one;
    repeated rows are rows of their own; extra columns are ignored; an empty table gives an empty result.
    Reruns agree: all draws are md5 of fixed values.
    """
    _, placed = place(docs, weights, max_repeats)
    parts = pieces(placed, block_words)
    used = dealt(parts, _shard_slots(shard_words, block_words)).groupBy("sid", "block").agg(F.collect_list("words").alias("takes"))  # a few epochs each
    of = F.aggregate(
        "takes", F.lit(0).cast("long"),
        lambda total, w: total + F.least(F.greatest(w - F.col("offset"), F.lit(0).cast("long")), F.col("n_words")),
    )
    rows = ["doc_id", "source", "sid", "start", "size", "source_size", "target"]
    some = parts.join(used, ["sid", "block"], "left").withColumn("of", F.coalesce(of, F.lit(0).cast("long")))
    out = ["doc_id", "source", "size", "source_size", "target", "taken"]
    some = some.groupBy(*rows).agg(F.sum("of").alias("taken")).select(*out)
    return some.union(placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*out))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The mixed corpus: one row for each piece of a document in each slot.

    (shard, slot, offset, doc_id, source, first_word, n_words, text). A shard has about ``shard_words`` words, by
    multinomial source counts (``dealt``). In a shard, slots stand in draw order, and pieces in a slot by offset. A
    text is the piece's words, with single spaces.
    """
    _, placed = place(docs, weights, max_repeats)
    parts = pieces(placed, block_words)
    drawn = dealt(parts, _shard_slots(shard_words, block_words))
    drawn = drawn.withColumn("slot", F.row_number().over(Window.partitionBy("shard").orderBy("draw", "sid", "block", "epoch")))
    wanted = parts.join(drawn, ["sid", "block"]).filter("offset < words")
    n = F.least(F.col("n_words"), F.col("words") - F.col("offset"))
    wanted = wanted.select(
        F.struct("doc_id", "text_key").alias("__row"), "shard", "slot", "offset", "doc_id", "source", "first_word", n.alias("n_words")
    )
    texts = docs.select(
        F.struct("doc_id", F.xxhash64(whole_text()).alias("text_key")).alias("__row"), whole_text().alias("text")
    ).dropDuplicates(["__row"])
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.col("first_word").cast("int") + 1, F.col("n_words").cast("int"))
    return wanted.join(texts, "__row").withColumn("text", F.array_join(words, " ")).drop("__row")


def taken_sql(table: str = "documents", weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, block: int = BLOCK_WORDS) -> str:
    """The rows of ``taken`` (without source) in DuckDB SQL."""
    case = " ".join(f"when {i} then {w}" for i, w in enumerate(weights))
    return f"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size from {table}
), t as (
  select source, cast(sum(size) as bigint) as n, row_number() over (order by source nulls last) as sid from d group by source
), w as (
  select *, case (sid - 1) % {len(weights)} {case} end as w, {max_repeats} * n as lim from t
), x as (
  select *, cast(lim as double) / w as ratio, cast((sum(n) over ()) - coalesce(sum(lim) over (order by cast(lim as double) / w, sid
      rows between unbounded preceding and 1 preceding), 0) as double)
    / sum(w) over (order by cast(lim as double) / w, sid rows between current row and unbounded following) as share from w
), f as (
  select ratio as fr, sid as fs, share as unit from x where ratio > share order by ratio, sid limit 1
), s as (
  select x.sid, x.source, x.n, case when f.unit is null or x.ratio < f.fr or (x.ratio = f.fr and x.sid < f.fs) then cast(lim as double)
    else f.unit * w end as target from x left join f on true
), q as (
  select *, cast(floor(target + 0.5) as bigint) // n as epochs, cast(floor(target + 0.5) as bigint) % n as rest from s where n > 0
), p as (
  select d.doc_id, d.size, s.sid, s.n, s.target, cast(coalesce(sum(d.size) over (partition by s.sid
    order by md5(coalesce(cast(d.doc_id as varchar), '')), d.doc_id nulls first, d.size
    rows between unbounded preceding and 1 preceding), 0) as bigint) as start
  from d join s on d.source is not distinct from s.source
), c as (
  select *, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) as block from p where size > 0
), e as (
  select *, greatest(start - block * {block}, 0) as off,
    least(start + size, (block + 1) * {block}) - greatest(start, block * {block}) as n_words from c
), b as (
  select sid, block, sum(n_words) as words from e group by sid, block
), l as (
  select b.sid, b.block, q.epochs, q.rest, coalesce(sum(b.words) over (partition by b.sid
    order by md5('{SEED}:' || b.sid || ':' || q.epochs || ':' || b.block), b.block
    rows between unbounded preceding and 1 preceding), 0) as before from b join q using (sid)
), k as (
  select e.doc_id, e.sid, e.start, e.size, e.n, e.target,
    sum(l.epochs * e.n_words + least(greatest(l.rest - l.before - e.off, 0), e.n_words)) as taken
  from e join l on e.sid = l.sid and e.block = l.block group by all
)
select doc_id, size, n as source_size, target, cast(taken as bigint) as taken from k
union all
select doc_id, size, n, target, cast(0 as bigint) from p where size = 0
"""
