"""Vectors as short codes: a codebook for each part, fitted by exact k-means in integers.

Every part of a vector keeps an upper bound of the distance to its entry and a lower
bound for each other entry, every bound with the round it was measured in. The
codebooks of all rounds are kept, so a bound of round T is corrected by how far its
entry really is from where it was in T (the norm of the sum of its moves), which is
never more than the sum of the moves that a running correction would take off. Only
entries whose bound does not settle the matter are measured again, exactly.
Rounds are passes of Spark over a stored table; a round brings back one sum and count
for each entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm.shipping import map_arrow
from weatherloom.operators.joins import sized_join
from weatherloom.llm.scratch import materialise
from weatherloom.session import remove, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# components from here on could overflow the sums of squares in a long
REACH = 1 << 24
# in-memory bytes of a label with its sum, generous
LABEL_ROW_BYTES = 128
STATE = ("near", "upper", "upper_at", "lower", "lower_at")


class VectorCodes(NamedTuple):
    """``codes``: id, label, codes (a byte for each part), error; ``codebooks[part][entry]``."""

    codes: DataFrame
    codebooks: np.ndarray

    def sha256(self) -> str:
        """Hash of all entries' components by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def pack(rows: np.ndarray) -> pa.Array:
    """One binary value for each line of a matrix."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * (rows.size // max(len(rows), 1))
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def unpack(column: pa.Array, dtype, *shape: int) -> np.ndarray:
    """The matrix that ``pack`` made a column of; may be written to."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    part = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return part.view(dtype).reshape(len(column), *shape).copy()


def whole_numbers(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows whose vectors take part, and their components as floor(scale * x).

    Null and empty vectors and those with a null, a component that is not finite or
    one of ``REACH`` and more after scaling take no part.
    """
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(all="ignore"):
        scaled = np.floor(values * float(scale))
        bad = ~(np.abs(scaled) < REACH)
    end = np.cumsum(lengths)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    kept = np.flatnonzero((lengths > 0) & (wrong[end] == wrong[end - lengths]))
    return kept, [scaled[end[i] - lengths[i] : end[i]].astype("<i4") for i in kept]


def _down(x: np.ndarray) -> np.ndarray:
    """float16, never above ``x``."""
    with np.errstate(over="ignore"):
        half = x.astype(np.float16)
    return np.where(half > x, np.nextafter(half, np.float16(0)), half)


def _up(x: np.ndarray) -> np.ndarray:
    """float32, never below ``x``."""
    single = x.astype(np.float32)
    return np.where(single < x, np.nextafter(single, np.float32(np.inf)), single)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.einsum("...i,...i->...", difference, difference)


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """[T, part, entry]: how far each entry is now from where it was in round T."""
    return np.sqrt(np.stack([_squares(history[-1], old) for old in history]).astype(np.float64))


class Bounds:
    """Nearest entries and bounds of a block of vectors, line by line for each part."""

    def __init__(self, x: np.ndarray, state: dict[str, np.ndarray] | None, entries: int):
        n, parts, _ = x.shape
        self.x, self.fresh = x, state is None
        self.near = np.zeros((n, parts), np.uint8) if state is None else state["near"]
        self.upper = np.zeros((n, parts), np.float32) if state is None else state["upper"]
        self.upper_at = np.zeros((n, parts), np.uint8) if state is None else state["upper_at"]
        self.lower = np.zeros((n, parts, entries), np.float16) if state is None else state["lower"]
        self.lower_at = np.zeros((n, parts, entries), np.uint8) if state is None else state["lower_at"]
        self.measured = 0

    def advance(self, history: list[np.ndarray], moved: np.ndarray) -> None:
        """Nearest entries of the last codebook; ties go to the lower index."""
        for part in range(self.x.shape[1]):
            if self.fresh:
                self._measure_all(part, history[-1][part], len(history) - 1)
            else:
                self._settle(part, history[-1][part], len(history) - 1, moved[:, part])
        self.fresh = False

    def _measure_all(self, part, book, now):
        squares = _squares(self.x[:, part, None, :], book[None])
        self.measured += squares.size
        near = squares.argmin(axis=1)
        lengths = np.sqrt(squares.astype(np.float64))
        self.near[:, part] = near
        self.upper[:, part] = _up(lengths[np.arange(len(near)), near])
        self.lower[:, part] = _down(lengths)
        self.upper_at[:, part] = self.lower_at[:, part] = now

    def _settle(self, part, book, now, moved):
        near = self.near[:, part].astype(np.int64)
        upper = self.upper[:, part] + moved[self.upper_at[:, part], near]
        lower = self.lower[:, part] - moved[self.lower_at[:, part], np.arange(book.shape[0])]
        rows = np.flatnonzero(_open(lower, upper, near).any(axis=1))
        if not len(rows):
            return
        # the distance to the own entry settles many of them
        x, near = self.x[rows, part], near[rows]
        own = _squares(x, book[near])
        length = np.sqrt(own.astype(np.float64))
        self.measured += len(rows)
        self.upper[rows, part], self.upper_at[rows, part] = _up(length), now
        self.lower[rows, part, near], self.lower_at[rows, part, near] = _down(length), now
        at, entry = np.nonzero(_open(lower[rows], length, near))
        if not len(at):
            return
        squares = _squares(x[at], book[entry])
        self.measured += len(at)
        lengths = np.sqrt(squares.astype(np.float64))
        self.lower[rows[at], part, entry], self.lower_at[rows[at], part, entry] = _down(lengths), now
        best = np.full((len(rows), book.shape[0]), np.iinfo(np.int64).max)
        best[np.arange(len(rows)), near] = own
        best[at, entry] = squares
        chosen = best.argmin(axis=1)
        new = np.flatnonzero(chosen != near)
        self.near[rows[new], part] = chosen[new]
        self.upper[rows[new], part] = _up(np.sqrt(best[new, chosen[new]].astype(np.float64)))

    def errors(self, book: np.ndarray) -> np.ndarray:
        """Squared distances to the chosen entries, summed over the parts."""
        chosen = book[np.arange(book.shape[0])[None], self.near]
        return _squares(self.x, chosen).sum(axis=1)


def _open(lower, upper, near):
    """Entries that may be as near as the own one; a margin covers all rounding."""
    upper = np.asarray(upper, dtype=np.float64)
    found = lower <= (upper + 1e-6 * (1 + upper))[:, None]
    found[np.arange(len(near)), near] = False
    return found


def _totals(x, near, entries, sign=1):
    """Counts and sums by part, entry: [part, entry, 1 + width]."""
    parts, width = x.shape[1:]
    out = np.zeros((parts, entries, 1 + width), np.int64)
    for part in range(parts):
        out[part, :, 0] = np.bincount(near[:, part], minlength=entries)
        np.add.at(out[part, :, 1:], near[:, part], x[:, part])
    return sign * out


def fit_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> VectorCodes:
    """Codebooks and codes of all vectors.

    Components become floor(scale * x), vectors ``parts`` equal consecutive parts. A
    part's codebook starts as that part of the vectors of the ``entries`` smallest ids
    and is improved in ``rounds`` rounds of exact k-means: nearest entry by squared
    distance, ties to the lower index, then floor(sum / count) of each component; an
    entry without parts stays. Then the parts are assigned once more.

    Rows whose vector is null or empty, has a null, a component that is not finite or
    one of 2^24 and more after scaling are left out, and so are those whose vector is
    not as long as that of the smallest id. A length that ``parts`` does not divide
    is filled up with zeros. Rows with a null id are coded but start no entry; an id
    that repeats starts one, from the row whose numbers come first; with fewer ids
    there are fewer entries. Without any id, or without rows, codebooks and codes are
    empty. Every repeated row counts; other columns are not looked at.
    """
    spark = vectors.sparkSession
    source = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    columns = StructType([source.schema["id"], source.schema["label"]])

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = whole_numbers(batch.column("vector"), scale)
            arrays = [batch.column(c).take(pa.array(kept)) for c in ("id", "label")]
            arrays.append(pa.array([r.tobytes() for r in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "x"])

    plain = StructType([*columns, *StructType.fromDDL("x binary")])
    table, path = stored(map_arrow(source, numbers, plain), "vectors")
    try:
        length, first = _starts(table, entries)
        width = -(-length // parts)
        book = np.zeros((parts, len(first), width), np.int64)
        for k, x in enumerate(first):
            line = np.zeros(parts * width, np.int64)
            line[:length] = np.frombuffer(x, "<i4")
            book[:, k] = line.reshape(parts, width)
        history = [book]
        totals = np.zeros((parts, len(first), 1 + width), np.int64)
        for _ in range(rounds if length else 0):
            step = _pass(table, plain, columns, history, length, False)
            table, new = stored(step, "round")
            remove(spark, path)
            path = new
            cells = table.where("totals is not null").select(F.posexplode("totals").alias("cell", "value"))
            for row in cells.groupBy("cell").agg(F.sum("value").alias("value")).collect():
                totals.ravel()[row.cell] += row.value
            count = totals[:, :, :1]
            history.append(np.where(count > 0, totals[:, :, 1:] // np.maximum(count, 1), history[-1]))
        codes = materialise(_pass(table, plain, columns, history, length, True), "codes")
    finally:
        remove(spark, path)
    return VectorCodes(codes, history[-1])


def _starts(table: DataFrame, entries: int) -> tuple[int, list[bytes]]:
    """Length of the vectors, and those of the smallest ids, one for each id.

    Every task keeps the smallest ids of each length only.
    """

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        kind = pa.int64()
        for batch in batches:
            kind = batch.column("id").type
            for key, x in zip(batch.column("id").to_pylist(), batch.column("x").to_pylist(), strict=True):
                group = held.setdefault(len(x), {})
                group[key] = min(x, group.get(key, x))
                if len(group) > 4 * entries:
                    held[len(x)] = {k: group[k] for k in sorted(group)[:entries]}
        for group in held.values():
            keys = sorted(group)[:entries]
            arrays = [pa.array(keys, kind), pa.array([group[k] for k in keys], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "x"])

    named = table.where("id is not null").select("id", "x")
    each = map_arrow(named, smallest, named.schema).groupBy("id", F.length("x").alias("length"))
    each = each.agg(F.min("x").alias("x"))
    lead = each.orderBy("id", "length").limit(1).collect()
    if not lead:
        return 0, []
    found = each.where(F.col("length") == lead[0].length).orderBy("id").limit(entries).collect()
    return lead[0].length // 4, [bytes(row.x) for row in found]


def _pass(table, plain, columns, history, length, last):
    """One round over all vectors: new state and, per task, changed totals; or the codes."""
    parts, entries, width = history[0].shape
    fresh = "near" not in table.columns
    moved = displacements(history)
    if last:
        schema = StructType([*columns, *StructType.fromDDL("codes binary, error long")])
    else:
        state = ", ".join(f"{name} binary" for name in STATE)
        schema = StructType([*plain, *StructType.fromDDL(f"{state}, totals array<long>")])
    shapes = {
        "near": (np.uint8, parts), "upper": (np.float32, parts), "upper_at": (np.uint8, parts),
        "lower": (np.float16, parts, entries), "lower_at": (np.uint8, parts, entries),
    }

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, 1 + width), np.int64)
        arrow = None
        for batch in batches:
            if fresh:
                lengths = np.array([len(x) for x in batch.column("x").to_pylist()], dtype=np.int64)
                batch = batch.take(pa.array(np.flatnonzero(lengths == 4 * length)))
            if not batch.num_rows:
                continue
            arrow = batch.schema
            given = unpack(batch.column("x"), "<i4", length if fresh else parts * width)
            x = np.zeros((len(given), parts * width), np.int64)
            x[:, : given.shape[1]] = given
            x = x.reshape(len(x), parts, width)
            before = None if fresh else {k: unpack(batch.column(k), *shape) for k, shape in shapes.items()}
            bounds = Bounds(x, before, entries)
            old = bounds.near.copy()
            bounds.advance(history, moved)
            if last:
                arrays = [batch.column("id"), batch.column("label"), pack(bounds.near), pa.array(bounds.errors(history[-1]))]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                continue
            changed = np.arange(len(x)) if fresh else np.flatnonzero((old != bounds.near).any(axis=1))
            totals += _totals(x[changed], bounds.near[changed], entries)
            if not fresh:
                totals += _totals(x[changed], old[changed], entries, -1)
            arrays = [batch.column("id"), batch.column("label"), pack(x.reshape(len(x), -1).astype("<i4"))]
            arrays += [pack(getattr(bounds, name)) for name in STATE]
            arrays.append(pa.nulls(len(x), pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        if arrow is not None and not last:
            arrays = [pa.nulls(1, arrow.field(c).type) for c in ("id", "label")]
            arrays += [pa.nulls(1, pa.binary())] * (1 + len(STATE))
            arrays.append(pa.array([totals.ravel().tolist()], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    rows = table if fresh else table.where("totals is null").drop("totals")
    return map_arrow(rows, advance, schema)


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the error summed over equal labels; nulls are one label."""
    keyed = codes.withColumn("key", F.struct("label"))
    sums = keyed.groupBy("key").agg(F.sum("error").alias("label_error"))
    return sized_join(keyed, sums, "key", "inner", LABEL_ROW_BYTES).drop("key")


def decoded(codes: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``codes`` with the vector that each code stands for (the middle of each unit)."""
    schema = StructType([*codes.schema, *StructType.fromDDL("vector array<double>")])
    parts = codebooks.shape[0]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = unpack(batch.column("codes"), np.uint8, parts)
            lines = (codebooks[np.arange(parts)[None], near] + 0.5).reshape(len(near), -1) / scale
            arrays = [*batch.columns, pa.array(list(lines), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_arrow(codes, decode, schema)


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The rounds as SQL, one after the other, for small tables of one vector length."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
         list_transform(embedding, lambda x: CAST(floor({scale}.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, label, r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
  FROM kept, range({parts}) AS t(p)
), book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM cut WHERE r <= {entries})"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (
  SELECT vec_id, label, p, x, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT r, vec_id, label, cut.p, x, e,
           list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM cut JOIN book{k} AS b ON b.p = cut.p)
  GROUP BY r, vec_id, label, p, x)"""
        )
        if k < rounds:
            steps.append(
                f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(new, c) AS c FROM book{k} LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS new FROM (
      SELECT p, best.e AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
      FROM near{k}, range(1, len(x) + 1) AS t(i) GROUP BY ALL)
    GROUP BY p, e) USING (p, e))"""
            )
    return f"""
WITH {', '.join(steps)}, coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code,
         CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id, label
), hashed AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       h AS codebooks_sha256
FROM coded, hashed
"""


ORACLE = _oracle()
