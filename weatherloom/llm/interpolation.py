"""Language-model scores by deleted interpolation.

A token's probability mixes the maximum-likelihood bigram, the unigram and the
uniform estimate, and with ``order`` 3 the trigram with that mixture. The weights
depend on how often the context occurs (one bucket for each power of two) and are
learned by expectation-maximisation on counts held out from the training rows:
estimates come from one part of them, the mixture is fitted to another. The scores
then use the counts of both.

Counts of a large corpus do not fit one machine. Texts are packed into blocks. A
block sends each n-gram once, as a 64-bit hash with its count in the block, to
the part of the hash range that owns it; the part sums them and returns the
totals in the order in which they came. So a frequent n-gram costs one entry for
each block, not for each place, and no part holds more than its range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm.shipping import map_arrow, ship
from weatherloom.llm.tokens import Words, mix
from weatherloom.llm.scratch import materialise

BLOCK_BYTES = 4 << 20
PART_ENTRIES = 1_000_000
# of the count; beyond that several parts of the hash range share a task
MOST_TASKS = 20_000
BUCKETS = 48
FINEST = 60  # estimates below 2 ** -30 share a cell
END = np.uint64(0x2545F4914F6CDD1D)
ORDER = 3
# the last bits of a hash tell words, bigrams and trigrams
KIND = np.uint64(3)
# bits of a bigram's or trigram's hash beyond those that number all of them: one in a
# sixty thousand shares its hash with another one, in a corpus of any size
SPARE_BITS = 16


def fold_of(id_col: Column, folds: int) -> Column:
    return F.crc32(id_col.cast("string")) % folds


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out: Column | None = None,
    deleted: Column | None = None,
    block_bytes: int = BLOCK_BYTES,
    order: int = ORDER,
) -> DataFrame:
    """Scores of every row, by a model of the rows that are not ``held_out``.

    ``order`` is 2 for bigrams or 3 for trigrams. The first token of a text has no
    trigram. Bigrams and trigrams are counted by hashes (see ``SPARE_BITS``), words by
    hashes of 62 bits.

    Of the training rows, ``deleted`` ones fit the mixture. Defaults: crc32 of the
    id as text, modulo 10, is 0 and 1; a row with a null id is held out.

    Returns id, held_out, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (log10, unigram counts plus 0.1) and score
    (log10 of the model). Null and empty texts are a lone end. Repeated rows count
    as often as they occur. Without training rows all tokens are unknown and
    equally likely. Other columns are not looked at.
    """
    fold = fold_of(F.col(id_col), 10)
    held_out = fold == 0 if held_out is None else held_out
    deleted = fold == 1 if deleted is None else deleted
    role = F.when(F.coalesce(held_out, F.lit(True)), 0).when(deleted, 1).otherwise(2)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), role.alias("role"))
    blocks = _blocks(source, block_bytes)
    sums = blocks.agg(
        F.sum("n_fit").alias("fit"), F.sum("n_deleted").alias("deleted"), F.sum("n_tokens").alias("all")
    ).first()
    n_fit, n_deleted, n_all = (int(x or 0) for x in sums)
    entries = n_all * (order - 1)
    cut = Cut(order, min(62, math.ceil(math.log2(max(entries, 2))) + SPARE_BITS))
    parts = max(
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(entries / PART_ENTRIES)
    )
    counts = _counts(blocks, parts, cut)
    types = int(counts.where("block < 0").agg(F.sum("types")).first()[0] or 0)
    model = Mixture(types, _weights(blocks, counts, n_fit, types, cut), None)
    if order > 2:
        model = model._replace(upper=_upper_weights(blocks, counts, n_fit, model, cut))
    scored = _scores(blocks, counts, source, model, n_fit + n_deleted, cut)
    return scored.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
        F.lit(n_fit + n_deleted).cast("long").alias("train_tokens"), "base_score", "score",
    )


def _blocks(source: DataFrame, block_bytes: int) -> DataFrame:
    """Texts as word codes, one row for each block of texts. Deleted rows are apart."""
    kind = source.schema["id"].dataType.simpleString()
    schema = StructType.fromDDL(
        f"block long, apart boolean, n_fit long, n_deleted long, n_tokens long,"
        f" ids array<{kind}>, roles binary, sizes binary, words binary, codes binary"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        waiting: dict[bool, list[pa.RecordBatch]] = {True: [], False: []}
        for batch in batches:
            for apart in (True, False):
                mask = np.equal(batch.column("role").to_numpy(), 1) == apart
                waiting[apart].append(batch.filter(pa.array(mask)))
                if sum(x.nbytes for x in waiting[apart]) >= block_bytes:
                    for block in _cut(waiting[apart], block_bytes):
                        yield _packed(block, base + made, apart, schema)
                        made += 1
                    waiting[apart] = []
                    pa.default_memory_pool().release_unused()
        for apart in (True, False):
            for block in _cut(waiting[apart], block_bytes):
                yield _packed(block, base + made, apart, schema)
                made += 1

    return materialise(map_arrow(source, pack, schema), "blocks")


def _cut(batches: list[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    from weatherloom.llm.tokens import slices

    if batches and sum(b.num_rows for b in batches):
        whole = pa.Table.from_batches(batches).combine_chunks().to_batches()
        for batch in whole:
            for begin, end in slices(batch.column("text"), most, rows=1 << 16):
                yield batch.slice(begin, end - begin)


def _packed(batch: pa.RecordBatch, block: int, apart: bool, schema) -> pa.RecordBatch:
    words = Words(batch.column("text"), lower=True)
    known, code = np.unique(words.hashes(), return_inverse=True)
    n, roles = batch.num_rows, batch.column("role").to_numpy().astype(np.uint8)
    codes = np.zeros(len(code) + n, dtype=np.uint32)  # 0 is the end
    codes[np.arange(len(code)) + words.doc] = code + 1
    sizes = (words.counts + 1).astype(np.uint32)
    total = [int(sizes[roles == r].sum()) for r in (2, 1)]
    ids = batch.column("id")
    row = [
        pa.array([block]), pa.array([apart]), pa.array([total[0]]), pa.array([total[1]]),
        pa.array([int(sizes.sum())]),
        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids),
        *(pa.array([x.tobytes()], pa.binary()) for x in (roles, sizes, np.r_[END, known])),
        pa.array([packed(codes)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(row, names=schema.names)


class Cut(NamedTuple):
    """The longest n-grams and the bits of their hashes that count."""

    order: int
    bits: int


class Ngrams(NamedTuple):
    """The n-grams of a block: sorted hashes, and the place in them of each word, pair and
    triple. ``pair`` and ``triple`` number those of each token, ``context`` is the pair
    before it; -1 where there is none. ``before`` is the word before it."""

    hashes: np.ndarray
    word_at: np.ndarray
    pair_at: np.ndarray
    triple_at: np.ndarray
    before: np.ndarray
    pair: np.ndarray
    context: np.ndarray
    triple: np.ndarray


def _ngrams(words: np.ndarray, codes: np.ndarray, cut: Cut) -> Ngrams:
    """A text begins after the end of the text before it, and has no pair before that."""
    before = np.zeros_like(codes)
    before[1:] = codes[:-1]
    pairs, pair = np.unique(before.astype(np.uint64) << np.uint64(32) | codes, return_inverse=True)
    left, right = words[pairs >> np.uint64(32)], words[pairs & np.uint64(0xFFFFFFFF)]
    both = mix(mix(left) + right)
    mask = ~np.uint64((1 << (64 - cut.bits)) - 1)
    kinds = [words & ~KIND, both & mask | np.uint64(1)]
    context = np.full(len(codes), -1, dtype=np.int64)
    triple = context.copy()
    if cut.order > 2:
        inner = np.flatnonzero(before)
        context[inner] = pair[inner - 1]
        key = context[inner].astype(np.uint64) << np.uint64(32) | codes[inner]
        triples, triple[inner] = np.unique(key, return_inverse=True)
        three = mix(mix(both[triples >> np.uint64(32)]) + words[triples & np.uint64(0xFFFFFFFF)])
        kinds.append(three & mask | KIND)
    hashes = np.concatenate(kinds)
    sort = np.argsort(hashes)
    place = np.empty(len(sort), dtype=np.int64)
    place[sort] = np.arange(len(sort))
    ends = np.cumsum([len(words), len(pairs)])
    return Ngrams(hashes[sort], *np.split(place, ends), before, pair, context, triple)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    kinds = (("roles", np.uint8), ("sizes", np.uint32), ("words", np.uint64))
    plain = (np.frombuffer(row[name], dtype=kind) for name, kind in kinds)
    return (*plain, unpacked(row["codes"]).astype(np.uint32))


def _counts(blocks: DataFrame, parts: int, cut: Cut) -> DataFrame:
    """(block, part, fit, every): the totals of the block's n-grams in a part.

    ``fit`` leaves out the deleted rows, and is there for their blocks only. Hashes travel as gaps between sorted values.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                roles, sizes, words, codes = _opened(row)
                grams = _ngrams(words, codes, cut)
                hashes, learned = grams.hashes, np.repeat(roles > 0, sizes)
                count = np.zeros(len(hashes), dtype=np.int64)
                count[grams.word_at] = np.bincount(codes[learned], minlength=len(words))
                count[grams.pair_at] = np.bincount(grams.pair[learned], minlength=len(grams.pair_at))
                three = grams.triple[learned & (grams.triple >= 0)]
                count[grams.triple_at] = np.bincount(three, minlength=len(grams.triple_at))
                part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                ends = np.r_[start[1:], len(part)]
                k = len(start)
                gaps = hashes.copy()
                gaps[1:] -= hashes[:-1]
                gaps[start] = hashes[start]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[start]),
                        pa.array(np.full(k, row["block"], dtype=np.int64)),
                        pa.array(np.full(k, row["apart"], dtype=bool)),
                        _cells(gaps, start, ends),
                        _cells(count, start, ends),
                    ],
                    names=["part", "block", "apart", "hashes", "counts"],
                )

    def total(table: pa.Table) -> pa.Table:
        cells = [unpacked(x) for x in table.column("hashes").to_pylist()]
        sizes = np.array([len(x) for x in cells], dtype=np.int64)
        hashes = np.concatenate([np.cumsum(x, dtype=np.uint64) for x in cells])
        counts = np.concatenate([unpacked(x) for x in table.column("counts").to_pylist()])
        apart = np.repeat(table.column("apart").to_numpy(), sizes)
        known, of = np.unique(hashes, return_inverse=True)
        fit = np.bincount(of, weights=np.where(apart, 0, counts), minlength=len(known)).astype(np.uint64)
        every = np.bincount(of, weights=counts, minlength=len(known)).astype(np.uint64)
        types = int(np.sum((every > 0) & (known & KIND == 0)))
        ends = np.cumsum(sizes)
        # only the mixture needs the counts without the deleted rows, for these rows
        some = table.column("apart").to_numpy()
        deleted = np.flatnonzero(some)
        part_fit = np.full(len(sizes), None, dtype=object)
        part_fit[deleted] = [packed(fit[of[ends[i] - sizes[i] : ends[i]]]) for i in deleted]
        back = pa.table(
            {
                "block": table.column("block").combine_chunks(),
                "part": table.column("part").combine_chunks(),
                "types": pa.nulls(len(sizes), pa.int64()),
                "fit": pa.array(part_fit, pa.binary()),
                "every": _cells(every[of], ends - sizes, ends),
            }
        )
        own = pa.table({"block": [-1], "part": [-1], "types": [types], "fit": [b""], "every": [b""]})
        return pa.concat_tables([back, own.cast(back.schema)])

    sent = map_arrow(
        blocks.select("block", "apart", "roles", "sizes", "words", "codes"), send,
        "part long, block long, apart boolean, hashes binary, counts binary",
    )
    found = sent.repartition(min(parts, MOST_TASKS), "part").groupBy("part").applyInArrow(
        total, "block long, part long, types long, fit binary, every binary"
    )
    return materialise(found, "counts")


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of equal bytes; high bytes that are zero cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    used = 8 - int(np.argmax(planes[::-1].any(axis=1))) if planes.any() else 0
    return len(values).to_bytes(7, "little") + bytes([used]) + zstandard.compress(planes[:used].tobytes(), 1)


def unpacked(cell: bytes) -> np.ndarray:
    n, used = int.from_bytes(cell[:7], "little"), cell[7]
    planes = np.zeros((8, n), dtype=np.uint8)
    planes[:used] = np.frombuffer(zstandard.decompress(cell[8:]), dtype=np.uint8).reshape(used, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _cells(values: np.ndarray, start: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ranges of ``values`` as binary cells."""
    return pa.array([packed(values[a:b]) for a, b in zip(start, ends, strict=True)], pa.binary())


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _returned(table: pa.Table, name: str) -> np.ndarray:
    cells = table.sort_by("part").column(name).to_pylist()
    return np.concatenate([unpacked(x) for x in cells]).astype(np.int64)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one bucket for each power of two."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


class Mixture(NamedTuple):
    """``lower``: weights of bigram, unigram and uniform by bucket of the word before;
    ``upper``: of the trigram and of all that by bucket of the pair before, or None."""

    types: int
    lower: np.ndarray
    upper: np.ndarray | None

    def estimates(self, seen: np.ndarray, grams: Ngrams, codes: np.ndarray, n: int):
        """Count of the pair before each token, its trigram's share of it, and the mixture of
        the lower orders, by the counts ``seen`` of the block's n-grams."""
        context, own = seen[grams.word_at[grams.before]], seen[grams.word_at[codes]]
        weight = self.lower[bucket_of(context)]
        lower = weight[:, 0] * seen[grams.pair_at[grams.pair]] / np.maximum(context, 1)
        lower += weight[:, 1] * own / max(n, 1) + weight[:, 2] / (self.types + 1)
        pair, share = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes))
        some = grams.triple >= 0
        pair[some] = seen[grams.pair_at[grams.context[some]]]
        share[some] = seen[grams.triple_at[grams.triple[some]]] / np.maximum(pair[some], 1)
        return pair, share, lower

    def probability(self, seen: np.ndarray, grams: Ngrams, codes: np.ndarray, n: int) -> np.ndarray:
        pair, share, lower = self.estimates(seen, grams, codes, n)
        if self.upper is None:
            return lower
        weight = self.upper[bucket_of(pair)]
        # a pair never seen leaves everything to the lower orders
        return np.where(pair > 0, weight[:, 0] * share + weight[:, 1] * lower, lower)


def _deleted_cells(blocks: DataFrame, counts: DataFrame, cells) -> tuple[np.ndarray, np.ndarray]:
    """(cell, tokens) over the deleted rows; ``cells`` numbers the cell of each token.

    What reaches the driver has a fixed size while every deleted token is in it.
    """

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        out = np.zeros((0, 2), dtype=np.int64)
        if left.num_rows:
            _, _, words, codes = _opened(next(_rows(left.combine_chunks().to_batches()[0])))
            out = np.stack(np.unique(cells(_returned(right, "fit"), words, codes), return_counts=True), axis=1)
        return pa.table({"cell": out[:, 0], "n": out[:, 1]})

    apart = blocks.where("apart").select("block", "roles", "sizes", "words", "codes")
    back = counts.where("block >= 0").join(apart.select("block"), "block", "left_semi")
    back = back.select("block", "part", "fit")
    grouped = apart.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(count, "cell long, n long")
    found = grouped.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    return found["cell"].to_numpy(np.int64), found["n"].to_numpy(np.float64)


def _weights(blocks: DataFrame, counts: DataFrame, n_fit: int, types: int, cut: Cut) -> np.ndarray:
    """Mixture weights by bucket, from a histogram of the deleted rows' estimates.

    The cells are half octaves of both estimates.
    """
    side = FINEST + 2

    def cells(fit, words, codes):
        grams = _ngrams(words, codes, cut)
        context, both = fit[grams.word_at[grams.before]], fit[grams.pair_at[grams.pair]]
        with np.errstate(divide="ignore", invalid="ignore"):
            bigram = _cell(both / context)
            unigram = _cell(fit[grams.word_at[codes]] / max(n_fit, 1))
        return (bucket_of(context) * side + bigram) * side + unigram

    cell, n = _deleted_cells(blocks, counts, cells)
    estimates = np.stack(
        [_middle(cell // side % side), _middle(cell % side), np.full(len(cell), 1 / (types + 1))], axis=1
    )
    return fit_weights(cell // side**2, estimates, n)


def _upper_weights(blocks: DataFrame, counts: DataFrame, n_fit: int, model: Mixture, cut: Cut) -> np.ndarray:
    """Weights of the trigram and the lower mixture by bucket, from tokens whose pair before
    occurs in the other rows."""
    side = FINEST + 2

    def cells(fit, words, codes):
        grams = _ngrams(words, codes, cut)
        pair, share, lower = model.estimates(fit, grams, codes, n_fit)
        some = pair > 0
        return (bucket_of(pair[some]) * side + _cell(share[some])) * side + _cell(lower[some])

    cell, n = _deleted_cells(blocks, counts, cells)
    estimates = np.stack([_middle(cell // side % side), _middle(cell % side)], axis=1)
    return fit_weights(cell // side**2, estimates, n)


def _cell(p: np.ndarray) -> np.ndarray:
    """0 for no mass, else 1 plus the half octaves below 1."""
    seen = np.isfinite(p) & (p > 0)
    octaves = np.zeros(len(p), dtype=np.int64)
    octaves[seen] = np.minimum(np.rint(-2 * np.log2(np.minimum(p[seen], 1.0))), FINEST)
    return np.where(seen, octaves + 1, 0)


def _middle(cell: np.ndarray) -> np.ndarray:
    return np.where(cell > 0, 2.0 ** (-(cell - 1) / 2), 0.0)


def fit_weights(bucket: np.ndarray, estimates: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Expectation-maximisation of the mixture weights of each bucket.

    One count for each estimate is added, so no weight becomes zero; a bucket
    without held-out counts takes the weights of all buckets together.
    """

    def learn(estimates, n):
        weights = np.full(estimates.shape[1], 1 / estimates.shape[1])
        for _ in range(rounds):
            share = estimates * weights
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            weights = (share * n[:, None]).sum(axis=0) + 1
            weights /= weights.sum()
        return weights

    out = np.tile(learn(estimates, n), (BUCKETS, 1))
    for b in np.unique(bucket):
        out[b] = learn(estimates[bucket == b], n[bucket == b])
    return out


def _scores(blocks, counts, source, model, n_train, cut):
    schema = source.select("id", F.lit(True).alias("held_out")).schema
    more = StructType.fromDDL("n_tokens long, n_known long, base_score double, score double")
    schema = StructType([*schema, *more])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = next(_rows(left.select(["roles", "sizes", "words", "codes"]).combine_chunks().to_batches()[0]))
        roles, sizes, words, codes = _opened(row)
        grams = _ngrams(words, codes, cut)
        seen = _returned(right, "every")
        own = seen[grams.word_at[codes]]
        p = model.probability(seen, grams, codes, n_train)
        base = np.log10((own + 0.1) / (n_train + 0.1 * (model.types + 1)))
        start = np.cumsum(sizes, dtype=np.int64) - sizes
        return pa.table(
            {
                "id": left.column("ids").combine_chunks().flatten(),
                "held_out": roles == 0,
                "n_tokens": sizes.astype(np.int64),
                "n_known": np.add.reduceat((own > 0).astype(np.int64), start),
                "base_score": np.add.reduceat(base, start),
                "score": np.add.reduceat(np.log10(p), start),
            }
        )

    ship(source.sparkSession)
    left = blocks.select("block", "ids", "roles", "sizes", "words", "codes")
    right = counts.where("block >= 0").select("block", "part", "every")
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(score, schema)
