"""N-gram Jaccard join of documents by PartEnum signatures.

Two sets of similar size are alike exactly when few elements are in only one of them.
Sizes are cut into bands, each with the largest number k of such elements that a pair
may have. The domain of all shingles is cut by a hash into parts of a few cells: where
k elements differ, some part has at most one of them, so of its cells all but one agree.
Every choice of all but one cell of a part is a signature, and alike sets share one.

A set also signs the band above its own if a partner may be there. Empty cells say
nothing, so they make no signatures; a set that has too many parts with empty choices
to be sure of a shared one signs again with another cut of the domain.

Every holder of a signature is compared in full with one of them; holders that are
still apart after that are compared with each other (see ``alike``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm.alike import Sets, alike_roots, differing, runs, sets_of, sized
from weatherloom.llm.scratch import Scratch, materialise
from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import mix, slices
from weatherloom.operators.joins import sized_join

WIDTH = 5
PERCENT = 80
# up to this number of signatures a set has longer ones, of two cells of three
LONG_UP_TO = 96
# parts that differ little, over those expected to have an empty choice
MARGIN = 1.6
# sets that a task remembers to sign copies once; it forgets them all beyond
REMEMBERED = 100_000
# bits of the filter of shared signatures that every task gets: at most 16 MB
FILTER_BITS = 1 << 27
# in-memory bytes of a set's key with the name of its component, generous
OWNER_ROW_BYTES = 128
KEY = ["n", "key1", "key2"]


class Band(NamedTuple):
    """Sizes ``low`` to ``high``; pairs whose larger set is in them differ in at most ``k``."""

    number: int
    low: int
    high: int
    k: int
    parts: int
    cells: int


@lru_cache(maxsize=8)
def spare_parts(percent: int) -> float:
    """Parts beyond those that k needs, as a share of them.

    Enough that most sets have more parts that differ little than parts with an empty
    choice. Below about 75 percent cells hold too few elements for that.
    """
    for spare in np.arange(1, 41) / 40:
        held = (100 + percent) / (2 * (100 - percent)) / (1 + spare) if percent < 100 else np.inf
        if spare / (1 + spare) >= MARGIN * (1 - (1 - np.exp(-held)) ** 2):
            return float(spare)
    raise ValueError(f"similarity of {percent} percent is too low for signatures of cells")


@lru_cache(maxsize=8)
def bands_to(most: int, percent: int) -> tuple[Band, ...]:
    """The bands of sizes 1 to ``most`` and the one above."""
    out, low, spare = [], 1, spare_parts(percent)
    while not out or out[-2:][0].high < most or len(out) < 2:
        high = low * 100 // percent
        k = differing(2 * high, percent)
        parts = k // 2 + 1 + int(np.ceil(spare * (k // 2)))
        out.append(Band(len(out), low, high, k, parts, 3 if 3 * parts <= LONG_UP_TO else 2))
        low = high + 1
    return tuple(out)


def band_members(sets: Sets, bands: tuple[Band, ...], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, band): the own band, and the next one where a partner's size may be in it."""
    low = np.array([b.low for b in bands])
    own = np.searchsorted(low, sets.size, "right") - 1
    some = np.flatnonzero(sets.size > 0)
    above = some[100 * sets.size[some] >= percent * low[own[some] + 1]]
    text, band = np.concatenate([some, above]), np.concatenate([own[some], own[above] + 1])
    different = np.array([b.k for b in bands])[band] > 0  # else only equal sets are alike
    return text[different], band[different]


def signatures(sets: Sets, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, band, signature) of all texts."""
    bands = bands_to(int(sets.size.max(initial=1)), percent)
    text, band = band_members(sets, bands, percent)
    found = [[], [], []]
    for cells in (2, 3):
        of = np.array([b.cells == cells for b in bands])[band]
        left, turn = (text[of], band[of]), 0
        while len(left[0]):
            at, signature, unsure = _sign(sets, *left, bands, cells, turn, percent)
            for column, values in zip(found, (left[0][at], left[1][at], signature), strict=True):
                column.append(values)
            left, turn = (left[0][unsure], left[1][unsure]), turn + 1
    return tuple(np.concatenate([np.zeros(0, t), *c]) for c, t in zip(found, (int, int, np.uint64), strict=True))


def _sign(sets, text, band, bands, cells, turn, percent):
    """Signatures by the ``turn``-th cut of the domain, and who cannot be sure of a shared one."""
    parts = np.array([b.parts for b in bands])[band]
    run, place = runs(sets.offset[text], sets.size[text])
    drawn = mix(sets.value[place] + mix(np.array([turn + 1], dtype=np.uint64)))
    cell = ((drawn >> np.uint64(32)) * (parts * cells).astype(np.uint64)[run]) >> np.uint64(32)
    first = np.cumsum(parts) - parts
    at = (first * cells)[run] + cell.astype(np.int64)
    n = int(parts.sum())
    total = np.zeros(n * cells, dtype=np.uint64)
    np.add.at(total, at, mix(~drawn))
    filled = np.bincount(at, minlength=n * cells).reshape(n, cells) > 0
    total = total.reshape(n, cells)
    owner, part = runs(np.zeros(len(parts), np.int64), parts)
    label = mix((band[owner] << 8).astype(np.uint64) + np.uint64(turn))
    label = mix(label + part.astype(np.uint64))
    at, signature, empty = [], [], np.zeros(n, dtype=bool)
    for number, chosen in enumerate(combinations(range(cells), cells - 1)):
        value = mix(label + np.uint64(number + 1))
        for c in chosen:
            value = mix(value + total[:, c])
        some = filled[:, list(chosen)].any(axis=1)
        empty |= ~some
        at.append(owner[some])
        signature.append(value[some])
    # parts that differ in one element at most, for any partner; some must be without empty choices
    high = np.array([b.high for b in bands])[band]
    size = sets.size[text]
    alike = parts - differing(size + np.minimum(high, size * 100 // percent), percent) // 2
    unsure = np.bincount(owner[empty], minlength=len(parts)) >= alike
    return np.concatenate(at), np.concatenate(signature), unsure


def alike_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    width: int = WIDTH,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Two texts are linked when 100 * |A and B| >= ``percent`` * |A or B| for their sets
    of ``width``-word shingles (A-Z in lower case); a shorter text is one shingle. A
    component is what links reach, named by its smallest id. No link is lost: the
    signatures cover every pair, and holders of one that stay apart are all compared.

    Null or empty texts and texts without words have n_shingles 0 and are linked with
    nothing. ``percent`` is 75 or more (ValueError below). Equal sets are one node, so a
    group of copies has no pairs; repeated rows come out as often as they went in. A null
    id names no component: the id is null where no other one is reachable. Other columns
    are not looked at. ``docs`` is read four times; store it first if it is expensive or
    not the same each time.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    hashed = source.select("id", "text", F.xxhash64(F.lit(1), text).alias("t1"), F.xxhash64(F.lit(2), text).alias("t2"))
    keys = materialise(_keys(hashed, width), "set-keys")
    with Scratch(spark) as scratch:
        # equal sets are one node from here on
        classes = keys.where("n > 0").groupBy(*KEY).agg(
            F.min("id").alias("least"), F.count("*").alias("rows"), F.min(F.struct("t1", "t2")).alias("t")
        )
        classes = scratch.keep(
            classes.select(F.monotonically_increasing_id().alias("node"), *KEY, "least", "rows", "t.*"), "classes"
        )
        members = scratch.keep(_members(source, classes, percent, width, scratch), "members")
        roots = alike_roots(members, lambda nodes: _texts(nodes, classes, hashed, scratch), percent, width, scratch)
        linked = classes.join(roots, "node", "left")
        least = linked.where("root is not null").groupBy("root").agg(F.min("least").alias("component"))
        owners = linked.where("root is not null or rows > 1").join(least, "root", "left")
        owners = materialise(
            owners.select(F.struct(*KEY).alias("key"), F.coalesce("component", "least").alias("component")), "owners"
        )
    rows = keys.select("id", "n", F.struct(*KEY).alias("key"))
    named = sized_join(rows, owners, "key", "left", OWNER_ROW_BYTES)
    return named.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def _keys(hashed: DataFrame, width: int) -> DataFrame:
    """(id, t1, t2) with the size of each row's set and two hashes of it."""
    schema = StructType([hashed.schema["id"], *StructType.fromDDL("t1 long, t2 long, n long, key1 long, key2 long")])

    def hash_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                sets = sets_of(part.column("text"), width)
                arrays = [part.column(c) for c in ("id", "t1", "t2")]
                arrays += [pa.array(a) for a in (sets.size, sets.key1, sets.key2)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_arrow(hashed, hash_sets, schema)


def filter_places(signature: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of a filter of ``bits`` bits (a power of two) that a signature sets."""
    mask = np.uint64(bits - 1)
    return [mix(signature + mix(np.array([k], dtype=np.uint64))) & mask for k in (1, 2)]


def signature_filter(shared: DataFrame, most: int) -> np.ndarray:
    """A filter of up to ``most`` bits, as 64-bit words, that lets all of ``shared`` pass.

    Its size is bounded whatever the number of signatures; with many it lets more of
    the others pass, which costs rows and loses none. Tasks find the bits, and equal
    words are put together before they reach the driver.
    """
    bits = 1 << min(max(16 * shared.count(), 64).bit_length(), most.bit_length() - 1)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(filter_places(batch.column("sig").to_numpy().view(np.uint64), bits))
            one = np.uint64(1) << (at & np.uint64(63))
            arrays = [pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(one.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["word", "value"])

    words = map_arrow(shared.select("sig"), places, "word long, value long").groupBy("word")
    found = words.agg(F.bit_or("value").alias("value")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("value").to_numpy().view(np.uint64)
    return out


def passes(words: np.ndarray, signature: np.ndarray) -> np.ndarray:
    """Signatures that may be among those the filter was made of."""
    found = np.ones(len(signature), dtype=bool)
    for at in filter_places(signature, 64 * len(words)):
        found &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) > 0
    return found


def _signed(source: DataFrame, percent: int, width: int, allowed=None) -> DataFrame:
    """One row for each signature of each set, most copies in a task once.

    With a short hash of key and signature that tells whether two holders are
    different; or, given a broadcast filter ``allowed``, the signatures that pass it
    with the set's key.
    """
    whole = allowed is not None
    schema = "sig long, n long, key1 long, key2 long" if whole else "sig long, mark int"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                sets = sets_of(batch.column("text").slice(begin, end - begin), width)
                text, _, signature = signatures(sets, percent)
                fresh = np.zeros(len(sets.size), dtype=bool)
                for i, key in enumerate(zip(sets.key1.tolist(), sets.key2.tolist(), strict=True)):
                    fresh[i] = key not in seen
                    seen.add(key)
                if len(seen) > REMEMBERED:
                    seen.clear()
                chosen = fresh[text]
                if whole:
                    chosen &= passes(allowed.value, signature)
                text, signature = text[chosen], signature[chosen]
                if whole:
                    arrays = [pa.array(a[text]) for a in (sets.size, sets.key1, sets.key2)]
                else:
                    mark = mix(sets.key1[text].view(np.uint64) ^ mix(signature)) >> np.uint64(32)
                    arrays = [pa.array(mark.astype(np.uint32).view(np.int32))]
                arrays.insert(0, pa.array(signature.view(np.int64)))
                names = ["sig", *KEY] if whole else ["sig", "mark"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_arrow(source.select("text"), sign, schema)


def _members(source, classes, percent, width, scratch):
    """(bucket, node, n): the holders of each signature that different sets share.

    Most signatures have one holder. The first pass finds the others and moves twelve
    bytes for each signature, the second only fetches the holders. The few signatures
    that pass its filter by chance have one holder, which makes no pair.
    """
    held = _signed(source, percent, width).groupBy("sig")
    held = held.agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    shared = scratch.keep(held.where("low <> high").select("sig"), "shared")
    allowed = source.sparkSession.sparkContext.broadcast(signature_filter(shared, FILTER_BITS))
    holders = _signed(source, percent, width, allowed).distinct()
    return holders.join(classes.select("node", *KEY), KEY).select(F.col("sig").alias("bucket"), "node", "n")


def _texts(nodes, classes, hashed, scratch):
    """One text of each node, found again by two hashes of the text."""
    wanted = scratch.keep(nodes.join(classes, "node").select("node", "t1", "t2"), "wanted")
    found = hashed.select("text", "t1", "t2").join(sized(wanted), ["t1", "t2"])
    return found.groupBy("node").agg(F.first("text").alias("text"))


# all pairs that share a shingle, and all that links reach; for small tables
ORACLE = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < {WIDTH} THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - {WIDTH - 2}), lambda i: array_to_string(w[i:i + {WIDTH - 1}], ' '))
         END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.doc_id
), roots AS (
  SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM roots LEFT JOIN sizes USING (doc_id)
"""
