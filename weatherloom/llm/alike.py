"""From buckets of sets to components of alike sets, without pairs of all members.

Whatever puts sets into common buckets (signatures, bands of hashes), the rest is the
same: one star of candidate edges for each bucket, confirmed on whole sets; then every
bucket whose members are not one component is completed exactly, in tiles of bounded
size, by parity sketches that never reject an alike pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.components import connected_components
from weatherloom.llm.scratch import Scratch
from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import Words, distinct_in_runs, mix, shingle_sets, slices

# bits of a sketch for each element that may differ
SKETCH_BITS = 16
# members of a bucket that are compared with as many others in one step
TILE = 2_048
# rows of a few numbers whose hash relation a small driver can build several of
BROADCAST_ROWS = 500_000


class Sets(NamedTuple):
    """Distinct shingles of texts: those of text i are ``value[offset[i]:offset[i + 1]]``.

    ``key1`` and ``key2`` are hashes of the whole set.
    """

    value: np.ndarray
    offset: np.ndarray
    size: np.ndarray
    key1: np.ndarray
    key2: np.ndarray


def sets_of(texts: pa.Array, width: int) -> Sets:
    doc, value = shingle_sets(Words(texts, lower=True), width)
    size = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    offset = np.concatenate([[0], np.cumsum(size)])
    keys = []
    for salt in (0x2545F491, 0x4F6CDD1D):
        total = np.zeros(len(texts), dtype=np.uint64)
        np.add.at(total, doc, mix(value ^ mix(np.array([salt], dtype=np.uint64))))
        keys.append(total.view(np.int64))
    return Sets(value, offset, size, *keys)


def differing(size_sum, percent: int):
    """The most elements in only one of two alike sets."""
    return size_sum * (100 - percent) // (100 + percent)


def runs(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, place) of all places of runs that begin at ``begin``."""
    run = np.repeat(np.arange(len(length)), length)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begin, length)


def sized(rows: DataFrame) -> DataFrame:
    """For a join: broadcast if there are at most ``BROADCAST_ROWS``."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def alike_roots(
    members: DataFrame,
    texts_of: Callable[[DataFrame], DataFrame],
    percent: int,
    width: int,
    scratch: Scratch,
) -> DataFrame:
    """(node, root) of all nodes that are linked with another one.

    ``members`` (bucket, node, n) is stored, has each pair of bucket and node once, and
    ``n`` is the size of the node's set. ``texts_of`` gives (node, text) of a frame of
    nodes. Two nodes of a common bucket are linked when 100 * |A and B| >= ``percent``
    * |A or B| for their sets of ``width``-word shingles; roots are what links reach.
    """
    # the centre of a bucket is the member that shares most buckets with others: the
    # original of a family of copies rather than one of them
    held = members.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = scratch.keep(members.join(sized(scratch.keep(held, "shared")), "bucket"), "members")
    common = scratch.keep(shared.groupBy("node").agg(F.count("*").alias("common")), "common")
    known = shared.join(sized(common), "node")
    best = F.max(F.struct("common", (-F.col("node")).alias("less"), "n")).alias("best")
    stars = known.groupBy("bucket").agg(best)
    stars = stars.select("bucket", (-F.col("best.less")).alias("centre"), F.col("best.n").alias("m"))
    stars = scratch.keep(stars, "stars")
    possible = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    pairs = shared.join(sized(stars), "bucket").where((F.col("node") != F.col("centre")) & possible)
    pairs = scratch.keep(pairs.select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "pairs")
    texts = scratch.keep(texts_of(common.select("node")), "texts")
    links = scratch.keep(confirmed(pairs, texts, percent, width), "links")
    roots = connected_components(links, scratch)
    rest = _split(shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), scratch)
    if rest.isEmpty():
        return roots
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    fresh = _tiled(_sketched(rest, texts, percent, width), percent).join(tried, ["a", "b"], "left_anti")
    more = scratch.keep(confirmed(scratch.keep(fresh, "pairs"), texts, percent, width), "links")
    return roots if more.isEmpty() else _contracted(roots, more, scratch)


def _split(apart: DataFrame, scratch: Scratch) -> DataFrame:
    """The members of buckets that hold several roots, of equal buckets one.

    In a bucket of two members the pair has been compared.
    """
    split = apart.groupBy("bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"),
        F.min("node").alias("first"), F.max("node").alias("last"),
        *(F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in range(2)),
    )
    split = split.where("low <> high and members > 2").groupBy("members", "first", "last", "x0", "x1")
    split = scratch.keep(split.agg(F.min("bucket").alias("bucket")).select("bucket", "members"), "split")
    return scratch.keep(apart.drop("members").join(sized(split), "bucket"), "rest")


def _contracted(roots: DataFrame, more: DataFrame, scratch: Scratch) -> DataFrame:
    """``roots`` after further links: only these are followed, between the roots so far."""
    single = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots, "node", "left_anti")
    of = scratch.keep(roots.union(single.select("node", F.col("node").alias("root"))), "roots")
    edges = more.join(of.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
    edges = edges.join(of.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
    merged = connected_components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")), scratch)
    merged = merged.select(F.col("node").alias("root"), F.col("root").alias("into"))
    return of.join(merged, "root", "left").select("node", F.coalesce("into", "root").alias("root"))


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their whole sets."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text_a")):
                part = batch.slice(begin, end - begin)
                one, two = (_each_once(part.column(c), part.column(f"text_{c}"), width) for c in "ab")
                union = union_sizes(one, two)
                linked = 100 * (one.size + two.size - union) >= percent * union
                yield part.select(["a", "b"]).filter(pa.array(linked))

    return map_arrow(both, confirm, "a long, b long")


class Chosen(NamedTuple):
    """The set of row i is ``value[begin[i]:begin[i] + size[i]]``."""

    value: np.ndarray
    begin: np.ndarray
    size: np.ndarray


def _each_once(nodes: pa.Array, texts: pa.Array, width: int) -> Chosen:
    """The sets of all rows; the text of a node that repeats is cut once."""
    _, first, row = np.unique(nodes.to_numpy(), return_index=True, return_inverse=True)
    sets = sets_of(texts.take(pa.array(first)), width)
    return Chosen(sets.value, sets.offset[row], sets.size[row])


def union_sizes(one: Chosen, two: Chosen) -> np.ndarray:
    """Elements in any of the two sets of each row."""
    size = one.size + two.size
    start = np.cumsum(size) - size
    value = np.zeros(int(size.sum()), dtype=np.uint64)
    for side, begin in ((one, start), (two, start + one.size)):
        value[runs(begin, side.size)[1]] = side.value[runs(side.begin, side.size)[1]]
    return np.bincount(distinct_in_runs(np.repeat(np.arange(len(size)), size), value)[0], minlength=len(size))


def sketches(sets: Sets, percent: int) -> list[np.ndarray]:
    """For each text the parity of the elements that fall on each bit, as 64-bit words.

    An element in only one of two sets changes one bit, so the bits that differ are at
    most as many as the elements that do. The number of words is a power of two that
    grows with the set; ``folded`` makes sketches of different length comparable.
    """
    words = np.maximum(1, -(-SKETCH_BITS * differing(2 * sets.size, percent) // 64))
    bits = 64 * 2 ** np.ceil(np.log2(words)).astype(np.int64)
    run = np.repeat(np.arange(len(bits)), sets.size)
    bit = (mix(sets.value ^ np.uint64(0x6A09E667F3BCC909)) & (bits - 1).astype(np.uint64)[run]).astype(np.int64)
    first = np.cumsum(bits) - bits
    odd = np.bincount(first[run] + bit, minlength=int(bits.sum())) & 1
    packed = np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)
    return [packed[a // 64 : (a + b) // 64] for a, b in zip(first.tolist(), bits.tolist(), strict=True)]


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch of the same set with fewer words."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _sketched(rest: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """``rest`` with a sketch of each node."""
    wanted = rest.select("node").distinct().join(texts, "node")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                made = [s.tobytes() for s in sketches(sets_of(part.column("text"), width), percent)]
                arrays = [part.column("node"), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "sketch"])

    return rest.join(map_arrow(wanted.select("node", "text"), sketch, "node long, sketch binary"), "node")


def _tiled(rest: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: members of one bucket with different roots that may be alike.

    The members of a bucket are dealt into blocks, and every two blocks, or a block
    with itself, are one tile. Only pairs whose sketches allow a link come out.
    """
    blocks = F.ceil(F.col("members") / TILE).cast("int")
    dealt = rest.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = dealt.select("bucket", "node", "root", "n", "sketch", "own", other)
    ends = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    tiles = tiles.select("bucket", *ends, "own", "node", "root", "n", "sketch")
    tile_of = ["bucket", "i", "j"]
    tiles = tiles.repartition(*tile_of).sortWithinPartitions(*tile_of, "own", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, tile_of):
            a, b = compared(tile, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return map_arrow(tiles, compare, "a long, b long").distinct()


def groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal ``by``, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in by]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(int(c[begin]) for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def compared(tile: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a tile that can be linked, by root, size and sketch."""
    node, root, n, own = (tile.column(c).to_numpy() for c in ("node", "root", "n", "own"))
    i, j = tile.column("i")[0].as_py(), tile.column("j")[0].as_py()
    sketch = [np.frombuffer(s, dtype=np.uint64) for s in tile.column("sketch").to_pylist()]
    words = np.array([len(s) for s in sketch])
    # one matrix for each length, of all sketches that are at least as long
    short = {w: np.stack([folded(s, w) if len(s) >= w else np.zeros(w, np.uint64) for s in sketch]) for w in set(words.tolist())}
    found = [np.zeros((0, 2), np.int64)]
    across = np.flatnonzero(own == j)
    for at in np.flatnonzero(own == i).tolist():
        others = across if i != j else across[across > at]
        others = others[
            (root[others] != root[at])
            & (100 * np.minimum(n[others], n[at]) >= percent * np.maximum(n[others], n[at]))
        ]
        length = np.minimum(words[others], words[at])
        for w in np.unique(length).tolist():
            some = others[length == w]
            apart = np.bitwise_count(short[w][some] ^ short[w][at]).sum(axis=1, dtype=np.int64)
            some = some[apart <= differing(n[some] + n[at], percent)]
            found.append(np.stack([np.full(len(some), node[at]), node[some]], axis=1))
    pairs = np.concatenate(found)
    return pairs.min(axis=1), pairs.max(axis=1)
