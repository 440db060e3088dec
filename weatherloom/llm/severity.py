"""Severity of toxic language by cumulative-link ordinal regression.

A text has one latent score, a weighted sum over its words and their beginnings.
Ordered thresholds cut
the scores into grades: P(grade >= k) = 1 / (1 + exp(threshold_k - score)) with the
same weights for every k. The expected severity is the sum of these over k.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm.labelled import labelled_sample
from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import SPACE, Words, distinct_in_group, slices
from weatherloom.llm.scratch import materialise

SAMPLE = 10_000
WORDS_KEPT = 2_000
LEAST_TEXTS = 3
BEGINNINGS = (4, 5, 6, 7)  # bytes: stems of words that take many endings
GRADES = 3
STRONG_ODDS = 30.0
BETWEEN = SPACE.copy()
BETWEEN[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


@dataclass(frozen=True)
class SeverityModel:
    """``words``: sorted hashes of features, with one of ``weights`` for each, which all
    thresholds share. ``thresholds`` ascend, one for each grade above 0.
    """

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, texts: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., one line for each text."""
        text, place, count = self.counts(texts)
        score = np.bincount(text, np.log1p(count) * self.weights[place], len(texts))
        return 1 / (1 + np.exp(np.clip(self.thresholds - score[:, None], -500, 500)))

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return counted(*matched(texts, self.words), max(len(self.words), 1))


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hash) of all words, then of the words' beginnings of each size."""
    words = Words(texts, lower=True, between=BETWEEN)
    yield words.doc, words.hashes()
    for size in BEGINNINGS:
        longer, hashes = words.prefixes(size)
        yield words.doc[longer], hashes


def matched(texts: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in ``known``) of every feature that is in the sorted hashes ``known``."""
    found = []
    for text, value in features(texts):
        if len(known) and len(value):
            at = np.minimum(np.searchsorted(known, value), len(known) - 1)
            hit = known[at] == value
            found.append((text[hit], at[hit]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def counted(text: np.ndarray, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, count = np.unique(text * width + place, return_counts=True)
    return key // width, key % width, count


def fit_severity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE,
) -> SeverityModel:
    """Fit on at most ``sample`` labelled documents.

    Features are words and beginnings of words, those whose link with the label is
    not chance. Where the labels only say toxic or not, the toxic texts are graded 1
    to ``GRADES`` by how many features they have whose odds in toxic texts are at
    least ``STRONG_ODDS`` times those in others, cut at the thirds. Without toxic or
    without other labels nothing is learned and every severity is near 0.
    """
    rows = labelled_sample(docs, labels, label, sample, id_col, text_col)
    rows = materialise(rows.select("text", (F.col("label") >= 0.5).alias("toxic")), "labelled")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(True, 0), sizes.get(False, 0)
    nothing = SeverityModel(np.zeros(0, dtype=np.uint64), np.zeros(0), np.full(GRADES, 20.0))
    if not n_toxic or not n_other:
        return nothing

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)
                for text, value in features(part.column("text")):
                    text, value = distinct_in_group(text, value)
                    known, of = np.unique(value, return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(known.view(np.int64)),
                            pa.array(np.bincount(of, toxic[text], len(known)).astype(np.int64)),
                            pa.array(np.bincount(of, minlength=len(known)).astype(np.int64)),
                        ],
                        names=["word", "inside", "total"],
                    )

    seen = map_arrow(rows, presence, "word long, inside long, total long").groupBy("word")
    seen = seen.agg(F.sum("inside").alias("inside"), F.sum("total").alias("total"))
    seen = materialise(seen.where(F.col("total") >= LEAST_TEXTS), "features")
    # a likelihood-ratio test at one in a hundred for all features together
    sure = 2 * math.log(100 * max(seen.count(), 1))
    test = association(F.col("inside"), F.col("total"), n_toxic, n_other)
    kept = seen.withColumn("test", test).where(F.col("test") > sure).orderBy(F.desc("test"), "word")
    kept = kept.limit(WORDS_KEPT).toPandas()
    kept["word"] = kept["word"].to_numpy(np.int64).view(np.uint64)
    kept = kept.sort_values("word")
    words = kept["word"].to_numpy(np.uint64)
    inside, outside = kept["inside"].to_numpy(float), (kept["total"] - kept["inside"]).to_numpy(float)
    odds = np.log((inside + 0.5) / (n_toxic - inside + 0.5) * (n_other - outside + 0.5) / (outside + 0.5))

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                text, place, n = counted(*matched(part.column("text"), words), max(len(words), 1))
                bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
                cells = [(place[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("toxic"),
                        pa.array([a for a, _ in cells], pa.binary()), pa.array([b for _, b in cells], pa.binary()),
                    ],
                    names=["toxic", "places", "counts"],
                )

    found = map_arrow(rows, use, "toxic boolean, places binary, counts binary").toPandas()
    found = found.sort_values(["toxic", "places", "counts"], kind="stable")
    places = [np.frombuffer(b, dtype=np.int64) for b in found["places"]]
    row = np.repeat(np.arange(len(places)), [len(p) for p in places])
    place = np.concatenate(places)
    count = np.concatenate([np.frombuffer(b, dtype=np.int64) for b in found["counts"]])
    toxic = found["toxic"].to_numpy(bool)
    strong = odds >= np.log(STRONG_ODDS)
    hits = np.bincount(row, strong[place] * count, len(toxic))
    cuts = np.quantile(hits[toxic], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic, 1 + (hits[:, None] > cuts).sum(axis=1), 0)
    weights, thresholds = fit_cumulative(row, place, np.log1p(count), grade, len(words), GRADES)
    return SeverityModel(words, weights, thresholds)


def association(inside: Column, total: Column, n_inside: int, n_outside: int) -> Column:
    """Twice the log-likelihood ratio of a feature's presence in two groups of texts."""
    n = n_inside + n_outside
    out = F.lit(0.0)
    for seen, all_seen, group in (
        (inside, total, n_inside), (total - inside, total, n_outside),
        (n_inside - inside, n - total, n_inside), (n_outside - total + inside, n - total, n_outside),
    ):
        out += F.when(seen > 0, seen * F.log(seen * n / (all_seen * group))).otherwise(0.0)
    return 2 * out


def fit_cumulative(row, column, value, grade, width, grades, rounds=1500, rate=0.1, ridge=2e-5):
    """Maximum likelihood with a small ridge, by Adam on the sparse triples.

    The gaps between thresholds are exponentials, which keeps them in order.
    """
    n = len(grade)
    theta = np.zeros(width + grades)
    theta[width] = 2.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    ends = np.arange(n)
    for turn in range(1, rounds + 1):
        cuts = np.cumsum(np.r_[theta[width], np.exp(theta[width + 1 :])])
        score = np.bincount(row, value * theta[column], n)
        upper = 1 / (1 + np.exp(np.clip(cuts - score[:, None], -500, 500)))  # P(grade >= k)
        tail = np.concatenate([np.ones((n, 1)), upper, np.zeros((n, 1))], axis=1)
        p = np.maximum(tail[ends, grade] - tail[ends, grade + 1], 1e-12)
        slope = tail * (1 - tail)
        d_score = (slope[ends, grade] - slope[ends, grade + 1]) / p
        d_cut = np.zeros((n, grades + 2))
        d_cut[ends, grade] -= slope[ends, grade] / p
        d_cut[ends, grade + 1] += slope[ends, grade + 1] / p
        d_cuts = d_cut[:, 1:-1].sum(axis=0)
        onward = np.cumsum(d_cuts[::-1])[::-1]  # a gap moves its own and all later thresholds
        step = np.r_[
            np.bincount(column, value * d_score[row], width), onward[:1], onward[1:] * np.exp(theta[width + 1 :])
        ]
        step /= n
        step[:width] -= ridge * theta[:width]
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step**2
        theta += rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return theta[:width], np.cumsum(np.r_[theta[width], np.exp(theta[width + 1 :])])


def severity(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, severity, p_toxic, grade, toxic) for each row, in one stage without shuffle.

    ``severity`` is the expected grade, ``grade`` the highest k with P(grade >= k) of
    at least one half, ``toxic`` whether that is 1 or more. Null and empty texts have
    the score of no words. Repeated rows are judged each.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([source.schema["id"]]).add("severity", "double").add("p_toxic", "double").add("grade", "integer")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                p = model.at_least(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(p.sum(axis=1)), pa.array(p[:, 0]),
                        pa.array((p >= 0.5).sum(axis=1), pa.int32()),
                    ],
                    names=schema.names,
                )

    found = map_arrow(source, judge, schema)
    return found.withColumn("toxic", F.col("grade") >= 1).withColumnRenamed("id", id_col)
