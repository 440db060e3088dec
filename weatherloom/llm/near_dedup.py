"""Near-duplicate documents by one-permutation MinHash.

Every distinct shingle is hashed once; its bin takes the smallest value. Empty
bins copy a full bin picked by a hash of the bin and the attempt alone (optimal
densification), so two texts pick alike. Bands of bins make buckets. A bucket of
any size gives one candidate edge for each member, to its centre, and every
candidate is confirmed on the full shingle sets. A star can miss two members that
are alike but both unlike the centre, so buckets whose members are not in one
component after that are completed exactly (see ``alike``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm.alike import Sets, alike_roots, sets_of, sized
from weatherloom.llm.scratch import Scratch, materialise
from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import mix, slices

WIDTH = 5
PERCENT = 85
BANDS = 24
ROWS = 5


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    width: int = WIDTH,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept, first.

    Two texts are linked when 100 * |A and B| >= ``percent`` * |A or B| for their
    sets of ``width``-word shingles (A-Z in lower case); a shorter text is one
    shingle. A component is what links reach, named by its smallest id. ``kept``
    is id = component_id; ``first`` marks one row of each component, which differs
    from ``kept`` only where ids repeat or are null.

    Null or empty texts and texts without words have n_shingles 0, are linked with
    nothing and kept. Repeated rows come out as often as they went in. A null id
    does not name a component: it is null where no other id is reachable, and then
    the row is kept. Other columns are not looked at.
    """
    signed = materialise(_signed(docs, id_col, text_col, width, bands, rows, False), "signed")
    return _decided(signed, percent, width).select(
        F.col("id").alias(id_col), "n_shingles", "component_id", "kept", "first"
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    width: int = WIDTH,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each component stays."""
    signed = materialise(_signed(docs, id_col, text_col, width, bands, rows, True), "signed")
    texts = signed.withColumn("text", F.col("record")[text_col])
    goes = materialise(_decided(texts, percent, width).where("not first").select("row"), "dropped")
    return signed.join(sized(goes), "row", "left_anti").select("record.*")


def _signed(docs, id_col, text_col, width, bands, rows, whole):
    columns = [
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.struct("*").alias("record") if whole else F.col(text_col).alias("text"),
    ]
    source = docs.select(*columns)
    place = docs.columns.index(text_col)
    added = StructType.fromDDL("n_shingles long, key1 long, key2 long, buckets array<long>")
    schema = StructType([*source.schema, *added])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("record").field(place) if whole else batch.column("text")
            for begin, end in slices(texts):
                sets = sets_of(texts.slice(begin, end - begin), width)
                yield _add_signature(batch.slice(begin, end - begin), sets, bands, rows)

    return map_arrow(source, sign, schema)


def _add_signature(part, sets: Sets, bands, rows):
    n = part.num_rows
    doc = np.repeat(np.arange(n), sets.size)
    buckets = band_hashes(minhash(doc, sets.value, n, bands * rows), bands)
    full = sets.size > 0
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(np.where(full, bands, 0), out=offsets[1:])
    arrays = [
        pa.array(sets.size),
        pa.array(sets.key1),
        pa.array(sets.key2),
        pa.ListArray.from_arrays(offsets, pa.array(buckets[full].ravel().view(np.int64))),
    ]
    names = [*part.schema.names, "n_shingles", "key1", "key2", "buckets"]
    return pa.RecordBatch.from_arrays([*part.columns, *arrays], names=names)


def minhash(doc: np.ndarray, value: np.ndarray, n: int, bins: int) -> np.ndarray:
    """Densified one-permutation signatures, one line of ``bins`` values per text."""
    place = ((value >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    at = doc * bins + place.astype(np.int64)
    weight = mix(value)
    order = np.lexsort((weight, at))
    at, weight = at[order], weight[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1]
    out = np.zeros(n * bins, dtype=np.uint64)
    filled = np.zeros(n * bins, dtype=bool)
    out[at[new]], filled[at[new]] = weight[new], True
    out, filled = out.reshape(n, bins), filled.reshape(n, bins)
    source = out.copy()
    row, empty = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 1
    while len(row):
        tried = mix(empty.astype(np.uint64) * np.uint64(2654435761) + np.uint64(attempt << 20)) % np.uint64(bins)
        tried = tried.astype(np.int64)
        hit = filled[row, tried]
        out[row[hit], empty[hit]] = source[row[hit], tried[hit]]
        row, empty = row[~hit], empty[~hit]
        attempt += 1
    return out


def band_hashes(signatures: np.ndarray, bands: int) -> np.ndarray:
    cut = signatures.reshape(len(signatures), bands, -1)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for k in range(cut.shape[2]):
        total = mix(total + cut[:, :, k])
    return total


def _decided(signed, percent, width):
    key = ["n_shingles", "key1", "key2"]
    # equal sets are one node from here on, so a group of copies has no edges
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    nodes = materialise(
        signed.where("n_shingles > 0")
        .groupBy(*key)
        .agg(F.min("row").alias("node"), F.min(order).alias("least")),
        "nodes",
    )
    with Scratch(signed.sparkSession) as scratch:
        own = signed.select(F.col("row").alias("node"), F.col("n_shingles").alias("n"), "buckets")
        buckets = scratch.keep(
            own.join(nodes.select("node"), "node").select("node", "n", F.explode("buckets").alias("bucket")), "buckets"
        )
        texts = signed.select(F.col("row").alias("node"), "text")
        roots = alike_roots(buckets, lambda wanted: texts.join(sized(wanted), "node"), percent, width, scratch)
        roots = materialise(roots, "roots")
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("first"))
    owner = named.join(least, "root").select(
        *(F.col(k).alias(f"of_{k}") for k in key), F.col("first")
    )
    same = [F.col(k) == F.col(f"of_{k}") for k in key]
    joined = signed.select("row", "id", *key).join(owner, same, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("first.id")).otherwise(F.col("id"))
    first = (F.col("n_shingles") == 0) | (F.col("row") == F.col("first.row"))
    return joined.select(
        "row", "id", "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
        first.alias("first"),
    )


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
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM roots LEFT JOIN sizes USING (doc_id)
"""
