"""Document quality by histogram gradient-boosted trees.

Statistics of the text alone are the inputs. Trees are complete binary trees of
one depth; all of them lie in three arrays (feature, threshold, leaf value), and a
batch of documents walks each level with one numpy gather.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm.labelled import labelled_sample
from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import Words, distinct_in_group, slices, windows

FEATURES = (
    "log_words", "mean_word", "sd_word", "short_words", "long_words", "symbols", "digits", "capitals",
    "not_ascii", "full_stops", "commas", "bars", "lines_per_word", "words_per_line", "distinct_words",
    "repeated_pairs", "word_share", "symbol_words",
)
SAMPLE = 20_000
SEED = 7


def _flags(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters.encode())] = True
    return table


_SETS = {
    "symbols": _flags("#*$%&|<>{}[]=_~^\\@"),
    "digits": _flags("0123456789"),
    "capitals": _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "not_ascii": np.arange(256) >= 128,
    "full_stops": _flags(".!?"),
    "commas": _flags(",;:"),
    "bars": _flags("|"),
}


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of true bytes in each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """One line of ``FEATURES`` for each text; all zero for a text without words."""
    words = Words(texts, lower=False)
    n, doc = words.n_docs, words.doc
    size = np.maximum(np.diff(words.bounds), 1)
    many = np.maximum(words.counts, 1)
    length = (words.end - words.start).astype(np.float64)
    sums = np.bincount(doc, length, n)
    squares = np.bincount(doc, length**2, n)
    mean = sums / many
    hashes = words.hashes()
    pair, at = windows(hashes, doc, 2)
    different = np.bincount(distinct_in_group(doc, hashes)[0], minlength=n)
    pairs = np.bincount(distinct_in_group(doc[at], pair)[0], minlength=n)
    lines = per_text(words.data == 10, words.bounds) + 1
    marked = np.concatenate([[0], np.cumsum(_SETS["symbols"][words.data], dtype=np.int64)])
    marked = (marked[words.end] - marked[words.start]) > 0
    out = {
        "log_words": np.log1p(words.counts),
        "mean_word": mean,
        "sd_word": np.sqrt(np.maximum(squares / many - mean**2, 0)),
        "short_words": np.bincount(doc, length <= 3, n) / many,
        "long_words": np.bincount(doc, length >= 12, n) / many,
        "lines_per_word": lines / many,
        "words_per_line": words.counts / lines,
        "distinct_words": different / many,
        "repeated_pairs": 1 - pairs / np.maximum(words.counts - 1, 1),
        "word_share": sums / size,
        "symbol_words": np.bincount(doc, marked, n) / many,
    }
    for name, table in _SETS.items():
        out[name] = per_text(table[words.data], words.bounds) / size
    found = np.stack([out[name] for name in FEATURES], axis=1)
    found[words.counts == 0] = 0
    return found


@dataclass(frozen=True)
class Forest:
    """``feature`` and ``threshold``: (trees, nodes); ``leaf``: (trees, leaves); log-odds."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node[:1].size and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    ridge: float = 1.0, least: float = 5.0,
) -> Forest:
    """Boosting on the logistic loss. Every level takes its splits from one histogram."""
    inner, leaves = 2**depth - 1, 2**depth
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    prior = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        none = np.zeros((0, inner), dtype=np.int64)
        return Forest(prior, none, none.astype(float), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    total = np.full(len(y), prior)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = y - p, p * (1 - p)
        feature = np.zeros(inner, dtype=np.int64)
        threshold = np.full(inner, np.inf)  # everything goes left where no split helps
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            gain = np.zeros(wide)
            for f in range(x.shape[1]):
                key = (node - first) * bins + binned[:, f]
                g = np.bincount(key, slope, wide * bins).reshape(wide, bins)
                h = np.bincount(key, curve, wide * bins).reshape(wide, bins)
                n = np.bincount(key, minlength=wide * bins).reshape(wide, bins)
                gl, hl, nl = (a.cumsum(axis=1)[:, :-1] for a in (g, h, n))
                ga, ha, na = (a.sum(axis=1)[:, None] for a in (g, h, n))
                better = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                better[(nl < least) | (na - nl < least)] = 0
                best = better[:, : len(edges[f])].argmax(axis=1) if len(edges[f]) else np.zeros(wide, int)
                value = better[np.arange(wide), best]
                take = (value > gain + 1e-9) & (best < len(edges[f]))
                gain[take] = value[take]
                feature[first : first + wide][take] = f
                threshold[first : first + wide][take] = edges[f][best[take]] if len(edges[f]) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        leaf = rate * np.bincount(at, slope, leaves) / (np.bincount(at, curve, leaves) + ridge)
        total += leaf[at]
        made.append((feature, threshold, leaf))
    return Forest(prior, *(np.stack(a) for a in zip(*made, strict=True)))


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE, folds: int = 5,
) -> Forest:
    """Fit on at most ``sample`` labelled rows whose crc32 of the id, modulo ``folds``, is not 0.

    Statistics are taken on the executors; the driver gets ``sample`` lines of
    numbers. Without labels the score is 0.5, with one class its share.
    """
    rows = labelled_sample(
        docs, labels, label, sample, id_col, text_col, lambda i: F.crc32(i.cast("string")) % folds != 0
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                x = statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label"),
                        pa.FixedSizeListArray.from_arrays(x.ravel(), x.shape[1]).cast(pa.list_(pa.float64())),
                    ],
                    names=["label", "x"],
                )

    found = map_arrow(rows, measure, "label double, x array<double>").toPandas()
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    y = (found["label"].to_numpy(float) >= 0.5).astype(float)
    # rows come in any order; sums of floats should not depend on it
    order = np.lexsort((y, *x.T))
    return fit_forest(x[order], y[order])


def quality_scores(
    docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score) for each row, in one stage without shuffle.

    The score is the probability of label 1. A null, empty or blank text has
    all-zero statistics and is scored like any other. Rows with a null id and
    repeated rows are scored each. Other columns are not looked at.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _scored(source, "id", lambda batch: batch.column("text"), forest)
    return found.withColumnRenamed("id", id_col)


def good_documents(docs: DataFrame, forest: Forest, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with a score of ``least`` or more."""
    source = docs.select(F.struct("*").alias("record"))
    place = docs.columns.index(text_col)
    found = _scored(source, "record", lambda batch: batch.column("record").field(place), forest)
    return found.where(F.col("score") >= least).select("record.*")


def _scored(source: DataFrame, keep: str, text_of, forest: Forest) -> DataFrame:
    schema = StructType([source.schema[keep]]).add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_of(batch)
            for begin, end in slices(texts):
                values = pa.array(forest.score(statistics(texts.slice(begin, end - begin))))
                kept = batch.column(keep).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([kept, values], names=schema.names)

    return map_arrow(source, score, schema)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Rows that no model has learned from; a null id is one of them."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == 0, F.lit(True))
