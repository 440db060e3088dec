"""Mixing sources to target weights by weighted fair queueing.

Within its source a document stands at a shuffled place. The words of its source
up to and including it, divided by the source's target, are its virtual finish
time; further rounds through the source continue the count. Sorting all copies by
finish time interleaves the sources in proportion to their targets, and the mix
ends where the running total reaches the budget: a source offers its target rounded
up to whole words, and the global order decides whose last words are still taken.

Running totals over a whole source, or over everything, never sit in one task.
Rows fall into ranges of the sort key, ranges are summed first, and a window only
covers one range. Shuffled places are hashes and virtual time advances evenly
with the words, so the ranges are even whatever the sizes of the sources.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.llm.alike import sized
from weatherloom.llm.scratch import materialise

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_RANGE = 2_000
LEAST_RANGES = 1_024
PLACE_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], repeats: int, budget: int | None = None
) -> DataFrame:
    """Targets of sources, from (source, source_size).

    Sources by code point, null last, take ``weights`` in turn. A target stops at
    ``repeats`` times the source's size; what is over goes to the others by weight
    until none is above. Filling up from the source that stops first, that is one
    level for all sources that do not stop. There is one row for each source.
    """
    every = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(every) - 1) % len(weights)
    ranked = sizes.withColumn("rank", F.row_number().over(every)).withColumn(
        "weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    )
    ranked = ranked.withColumn("cap", F.lit(repeats) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "rank")
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) if budget is None else F.lit(budget).cast("long")
    filled = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    leveled = ranked.withColumn("total", total).withColumn(
        "level", (F.col("total") - filled).cast("double") / open_weight
    )
    stopped = F.col("level") * F.col("weight") > F.col("cap")
    order = F.col("cap").cast("double") / F.col("weight")
    level = F.min(F.when(~stopped, F.struct(order.alias("order"), "rank", "level"))).over(whole)["level"]
    target = F.when(stopped, F.col("cap").cast("double")).otherwise(
        F.coalesce(level, F.lit(0.0)) * F.col("weight")
    )
    return leveled.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3), repeats: int = 3, budget: int | None = None, seed: str = "mix",
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken, position.

    ``size`` is the number of words, ``taken`` the words of the row that the mix
    has, whole rounds and a cut copy at the end of each source. All taken words are
    exactly ``budget`` (by default the words of all sources; fewer only where every
    source is used up), and each source stays within one word of its target.
    ``position`` is the number of words in the mix before the row's first copy, null
    if it has none.

    Null and empty texts have size 0 and are never taken. A null source is a source
    of its own. The order depends on ``seed`` and the id (the text where the id is
    null), so reruns agree; repeated rows are separate rows next to each other and
    which of them is which cannot be told. Other columns are not looked at.
    """
    rows = _sized(docs, id_col, text_col, source_col, seed, False)
    mixed = _queue(rows, weights, repeats, budget).groupBy("row", "id", "size", "source_size", "target")
    mixed = mixed.agg(
        F.sum("words").alias("taken"), F.min(F.when(F.col("words") > 0, F.col("position"))).alias("position")
    )
    return mixed.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "position")


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3), repeats: int = 3, budget: int | None = None, seed: str = "mix",
) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix has it, in its order.

    Texts stay whole: a cut copy counts when at least half of it is in the mix. Files
    are written in the order of the queue, sources interleaved by their targets. The
    places of the copies are broadcast up to ``BROADCAST_ROWS``.
    """
    docs_sized = _sized(docs, id_col, text_col, source_col, seed, True)
    queue = _queue(docs_sized, weights, repeats, budget)
    copies = materialise(queue.where("words > 0 and 2 * words >= size").select("row", "position"), "copies")
    rows = docs_sized.select("row", "record").join(sized(copies), "row")
    return rows.orderBy("position").select("record.*")


def _sized(docs, id_col, text_col, source_col, seed, whole):
    of = F.coalesce(F.col(id_col).cast("string"), F.xxhash64(text_col).cast("string"))
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), of)), 1, PLACE_BITS // 4), 16, 10)
    columns = [
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        place.cast("long").alias("place"),
    ]
    if whole:
        columns.append(F.struct("*").alias("record"))
    return materialise(docs.select(*columns), "sized")


def _queue(docs: DataFrame, weights, repeats, budget) -> DataFrame:
    """One row for each copy: row, id, size, source_size, target, words taken, position."""
    of_source = [F.col("source").isNull().alias("unnamed"), F.coalesce("source", F.lit("")).alias("name")]
    rows = docs.select("row", "id", "size", "place", *of_source)
    sums = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sums = materialise(sums, "sources")
    whole = sums.agg(F.sum("n").alias("n"), F.sum("source_size").alias("words")).first()
    n, total = whole.n or 0, (whole.words or 0) if budget is None else budget
    targets = source_targets(sums.select("source", "source_size"), weights, repeats, budget)
    bits = max(LEAST_RANGES, math.ceil(n / ROWS_PER_RANGE)).bit_length()

    rows = rows.withColumn("range", F.shiftright("place", PLACE_BITS - bits))
    before = _before(rows, ["unnamed", "name"], "size", bits).join(
        targets.select(*of_source, "source_size", "target"), ["unnamed", "name"]
    )
    keys = ["unnamed", "name", "range"]
    inside = Window.partitionBy(*keys).orderBy("place", "id", "size", "row")
    stands = rows.join(before, keys).withColumn(
        "upto", F.col("before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )

    goal = F.ceil("target")
    copies = stands.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    copies = copies.withColumn("start", F.col("round") * F.col("source_size") + F.col("upto") - F.col("size"))
    copies = copies.where((F.col("round") == 0) | (F.col("start") < goal))
    words = F.greatest(F.lit(0), F.least("size", goal - F.col("start")))
    copies = copies.withColumn("words", words)
    finish = F.try_divide(F.col("start") + F.col("words"), F.col("target"))
    copies = copies.withColumn("finish", finish)
    # up to 1 virtual time advances with the words; only the last copy of a source ends later
    late = 1 - F.try_divide(F.lit(0.5), F.col("finish"))
    time = F.when(F.col("finish") <= 1, F.col("finish") / 2).otherwise(late)
    bits += 1
    # what is not offered adds nothing to any total and may stand anywhere
    spread = F.pmod(F.xxhash64("row"), F.lit(1 << bits))
    at = F.when(F.col("words") > 0, F.least(F.floor(time * (1 << bits)), F.lit((1 << bits) - 1)))
    copies = copies.withColumn("range", F.coalesce(at, spread).cast("long")).drop("before", "upto", "place")
    ahead = _before(copies, [], "words", bits)
    inside = Window.partitionBy("range").orderBy("finish", "unnamed", "name", "row", "round")
    running = F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    queue = copies.join(ahead, "range").withColumn("position", F.col("before") + running - F.col("words"))
    left = F.greatest(F.lit(0), F.least("words", F.lit(total) - F.col("position")))
    return queue.withColumn("words", left).select(
        "row", "id", "size", "source_size", "target", "words", "position"
    )


def _before(rows: DataFrame, group: list[str], value: str, bits: int) -> DataFrame:
    """(group, range, before): the sum of ``value`` in all earlier ranges of the group.

    In two steps, so that a window covers about the square root of the ranges.
    """
    half = bits // 2
    sums = rows.groupBy(*group, "range").agg(F.sum(value).alias("sum"))
    sums = materialise(sums.withColumn("block", F.shiftright("range", half)), "ranges")
    past = (Window.unboundedPreceding, -1)
    blocks = sums.groupBy(*group, "block").agg(F.sum("sum").alias("block_sum"))
    earlier = F.sum("block_sum").over(Window.partitionBy(*group).orderBy("block").rowsBetween(*past))
    blocks = blocks.select(*group, "block", F.coalesce(earlier, F.lit(0)).alias("blocks_before"))
    within = F.sum("sum").over(Window.partitionBy(*group, "block").orderBy("range").rowsBetween(*past))
    return (
        sums.withColumn("within", F.coalesce(within, F.lit(0)))
        .join(blocks, [*group, "block"])
        .select(*group, "range", (F.col("blocks_before") + F.col("within")).alias("before"))
    )


# the same result as running sums over whole sources and over all copies
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || md5('mix|' || doc_id)[1:15])::BIGINT AS place
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sources
), weighed AS (
  SELECT *, ((rank - 1) % 3 + 1)::DOUBLE AS weight, 3 * source_size AS cap,
         sum(source_size) OVER ()::BIGINT AS total
  FROM ranked
), leveled AS (
  SELECT *, (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / weight, rank)
), lowest AS (
  SELECT level FROM leveled WHERE NOT level * weight > cap ORDER BY cap::DOUBLE / weight, rank LIMIT 1
), targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN l.level * l.weight > l.cap THEN l.cap::DOUBLE ELSE m.level * l.weight END AS target
  FROM leveled l, lowest m
), stands AS (
  SELECT doc_id, size, d.source, source_size, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - size AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, round * source_size + before AS start,
         greatest(0, least(size, ceil(target)::BIGINT - round * source_size - before)) AS words
  FROM stands CROSS JOIN (SELECT unnest([0, 1, 2]) AS round)
), queue AS (
  SELECT *, sum(words) OVER (ORDER BY (start + words) / target, source NULLS LAST, round, before
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - words AS position
  FROM copies WHERE words > 0
), taken AS (
  SELECT doc_id, sum(greatest(0, least(words, total - position)))::BIGINT AS taken,
         min(position) FILTER (position < total) AS position
  FROM queue CROSS JOIN (SELECT sum(size)::BIGINT AS total FROM sized) GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, position
FROM stands LEFT JOIN taken USING (doc_id)
"""
