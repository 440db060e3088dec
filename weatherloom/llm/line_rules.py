"""Quality rules and line labels by a linear-chain conditional random field.

Every line with a word is content or boilerplate. Real-valued line features and
the label of the line before score a labelling; Viterbi decoding finds the best
one. A document stays when enough of its words are in content lines and the base
rules (too few words, too many repeated ones) do not fail it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm.labelled import labelled_sample
from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import Words, mix, slices, windows

SAMPLE = 4_000
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
STOPS = np.zeros(256, dtype=bool)
STOPS[list(b".!?;:,")] = True
DIGITS = (np.arange(256) >= 48) & (np.arange(256) < 58)
FEATURES = (
    "bias", "one_to_three_words", "over_eight_words", "symbol_words", "lone_symbols", "short_words",
    "digits", "repeats_earlier_line", "stops", "log_words", "same_words",
)
WINDOW = 8
# longer texts are learned from as several chains of this many lines
CHAIN_LINES = 64


class Lines:
    """Lines with at least one word, of many texts, and the counts of the base rules."""

    def __init__(self, texts: pa.Array):
        self.words = words = Words(texts, lower=False)
        data, bounds = words.data, words.bounds
        breaks = np.flatnonzero(data == 10)
        start = np.unique(np.concatenate([bounds[:-1], breaks + 1]))
        start = start[start < len(data)]
        line_of = np.searchsorted(start, words.start, "right") - 1
        used, self.line_of = np.unique(line_of, return_inverse=True)
        self.n_words = np.bincount(self.line_of, minlength=len(used))
        begin = start[used]
        ends = np.append(start[1:], len(data))[used]
        # neither a line feed nor the text's end is part of the line
        self.ends = ends - ((ends > begin) & (data[ends - 1] == 10)) if len(used) else ends
        self.begin = begin
        self.doc = np.searchsorted(bounds, begin, "right") - 1
        self.word_hash = words.hashes()
        self.repeats = self._repeats()

    def _repeats(self) -> np.ndarray:
        """Lines equal to an earlier line of the same text, byte by byte."""
        hashes = segment_hashes(self.words.data, self.begin, self.ends)
        order = np.lexsort((self.begin, hashes, self.doc))
        again = np.zeros(len(order), dtype=bool)
        same = (hashes[order][1:] == hashes[order][:-1]) & (self.doc[order][1:] == self.doc[order][:-1])
        again[order[1:][same]] = True
        return again

    def base(self) -> dict[str, np.ndarray]:
        words, n = self.words, self.words.n_docs
        whole = (words.data & 0xC0) != 0x80  # the first byte of each code point
        return {
            "n_words": words.counts.astype(np.int64),
            "word_chars": _per_text(words.solid & whole, words.bounds),
            "n_symbols": _per_text(SYMBOLS[words.data], words.bounds),
            "n_dup_lines": np.bincount(self.doc[self.repeats], minlength=n).astype(np.int64),
            "n_repeat_words": self._repeat_words(),
        }

    def _repeat_words(self) -> np.ndarray:
        """Words in some window of eight that its text has more than once."""
        doc = self.words.doc
        window, at = windows(self.word_hash, doc, WINDOW)
        order = np.lexsort((window, doc[at]))
        same = (window[order][1:] == window[order][:-1]) & (doc[at][order][1:] == doc[at][order][:-1])
        often = np.zeros(len(order), dtype=bool)
        often[order[1:][same]] = True
        often[order[:-1][same]] = True
        edge = np.zeros(len(doc) + WINDOW + 1, dtype=np.int64)
        np.add.at(edge, at[often], 1)
        np.add.at(edge, at[often] + WINDOW, -1)
        covered = np.cumsum(edge)[: len(doc)] > 0
        return np.bincount(doc[covered], minlength=self.words.n_docs).astype(np.int64)

    def features(self) -> np.ndarray:
        words, line, k = self.words, self.line_of, len(self.n_words)
        n = np.maximum(self.n_words, 1)
        size = words.end - words.start
        marks = np.concatenate([[0], np.cumsum(SYMBOLS[words.data], dtype=np.int64)])
        marks = marks[words.end] - marks[words.start]
        digits = np.concatenate([[0], np.cumsum(DIGITS[words.data], dtype=np.int64)])
        digits = digits[words.end] - digits[words.start]
        # words that are those of the word two places before: lists and stutter
        same = np.zeros(len(line), dtype=bool)
        same[2:] = (self.word_hash[2:] == self.word_hash[:-2]) & (line[2:] == line[:-2])

        def share(mask):
            return np.bincount(line[mask], minlength=k) / n

        out = {
            "bias": np.ones(k),
            "one_to_three_words": self.n_words <= 3,
            "over_eight_words": self.n_words > 8,
            "symbol_words": share(marks > 0),
            "lone_symbols": share((marks > 0) & (marks == size)),
            "short_words": share(size <= 3),
            "digits": share(digits > 0),
            "repeats_earlier_line": self.repeats,
            "stops": share(STOPS[words.data[words.end - 1]]) if len(line) else np.zeros(k),
            "log_words": np.log1p(self.n_words) / 5,
            "same_words": share(same),
        }
        return np.stack([out[name].astype(np.float64) for name in FEATURES], axis=1).reshape(k, len(FEATURES))


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def segment_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes, by eight-byte steps over all ranges at once."""
    size = end - begin
    total = mix(size.astype(np.uint64) + np.uint64(11))
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    left = np.arange(len(begin))
    done = 0
    while True:
        left = left[size[left] > done]
        if not len(left):
            return total
        at = begin[left] + done
        cell = padded[at[:, None] + np.arange(8)].astype(np.uint64)
        cell[np.arange(8) >= (size[left] - done)[:, None]] = 0
        value = (cell << (np.arange(8, dtype=np.uint64) * np.uint64(8))).sum(axis=1, dtype=np.uint64)
        total[left] = mix(total[left] + mix(value + np.uint64(done + 1)))
        done += 8


@dataclass(frozen=True)
class ChainModel:
    """``emit``: (features, 2); ``move``: (2, 2) from the label before. Label 1 is content."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def decode(self, x: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Viterbi labels of lines in order; texts are decoded side by side."""
        score = x @ self.emit
        first, length = _chains(doc)
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        best = np.zeros((len(first), 2))
        back = np.zeros((len(doc), 2), dtype=np.int8)
        active = len(first)
        last = np.zeros((len(first), 2))
        for t in range(int(length[0]) if len(length) else 0):
            active = int(np.searchsorted(-length, -t, "left"))
            at = first[:active] + t
            if t == 0:
                best[:active] = self.start + score[at]
            else:
                options = best[:active, :, None] + self.move
                back[at] = options.argmax(axis=1)
                best[:active] = options.max(axis=1) + score[at]
            last[:active] = best[:active]
        label = np.zeros(len(doc), dtype=np.int8)
        state = last.argmax(axis=1)
        for t in range(int(length[0]) - 1 if len(length) else -1, -1, -1):
            active = int(np.searchsorted(-length, -t, "left"))
            at = first[:active] + t
            label[at] = state[:active]
            state[:active] = back[at, state[:active]]
        return label


def _chains(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, dtype=np.int64)
    return first, np.diff(np.append(first, len(doc)))


def cut_chains(lengths: np.ndarray, most: int = CHAIN_LINES) -> np.ndarray:
    """The number of the chain of each line, for texts of so many lines, cut after ``most``."""
    chains = -(-lengths // most)
    first = np.cumsum(chains) - chains
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(first, lengths) + place // most


def fit_chain(
    x: np.ndarray, label: np.ndarray, chain: np.ndarray, rounds: int = 200, rate: float = 0.1, ridge: float = 1e-3
) -> ChainModel:
    """Maximum likelihood by Adam; forward and backward sums over all chains at once."""
    first, length = _chains(chain)
    steps = int(length.max()) if len(length) else 0
    at = np.minimum(first[:, None] + np.arange(steps), max(len(x) - 1, 0))
    real = np.arange(steps) < length[:, None]
    inputs, truth = x[at], label[at].astype(np.int64)
    pairs = real[:, 1:]
    wanted_move = np.zeros((2, 2))
    if steps > 1:
        np.add.at(wanted_move, (truth[:, :-1][pairs], truth[:, 1:][pairs]), 1)
    one_hot = (np.arange(2) == truth[..., None]) * real[..., None]
    wanted_emit = np.einsum("dtf,dtk->fk", inputs, one_hot)
    wanted_start = one_hot[:, 0].sum(axis=0) if steps else np.zeros(2)
    sizes = (x.shape[1] * 2, 4, 2)
    theta, m, v = (np.zeros(sum(sizes)) for _ in range(3))

    def parts(theta):
        a, b, c = np.split(theta, np.cumsum(sizes)[:-1])
        return a.reshape(-1, 2), b.reshape(2, 2), c

    for turn in range(1, rounds + 1 if steps else 1):
        emit, move, start = parts(theta)
        score = inputs @ emit
        ahead = np.zeros_like(score)
        ahead[:, 0] = start + score[:, 0]
        for t in range(1, steps):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + move, axis=1) + score[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        behind = np.zeros_like(score)
        expected_move = np.zeros((2, 2))
        for t in range(steps - 2, -1, -1):
            following = score[:, t + 1] + behind[:, t + 1]
            step = np.logaddexp.reduce(move + following[:, None, :], axis=2)
            behind[:, t] = np.where(real[:, t + 1, None], step, 0)
            joint = np.exp(ahead[:, t, :, None] + move + following[:, None, :] - total[:, None, None])
            expected_move += joint[real[:, t + 1]].sum(axis=0)
        share = np.exp(ahead + behind - total[:, None, None]) * real[..., None]
        slope = np.concatenate(
            [
                (wanted_emit - np.einsum("dtf,dtk->fk", inputs, share)).ravel(),
                (wanted_move - expected_move).ravel(),
                wanted_start - share[:, 0].sum(axis=0),
            ]
        )
        slope = slope / len(x) - ridge * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return ChainModel(*parts(theta))


def fit_line_model(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE,
) -> ChainModel:
    """Fit on all lines of at most ``sample`` labelled documents.

    The tables label documents, not lines: lines of good documents count as
    content unless they repeat an earlier line, lines of bad ones as boilerplate.
    A text of more than ``CHAIN_LINES`` lines is several chains. Without labels, or
    without labelled texts, all weights are zero and every line is boilerplate by the
    tie rule, so callers should pass labels. Of documents that repeat an id one is
    learned from (see ``labelled_sample``); other columns are not looked at.
    """
    rows = labelled_sample(docs, labels, label, sample, id_col, text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                lines = Lines(part.column("text"))
                x = lines.features()
                good = part.column("label").to_numpy()[lines.doc] >= 0.5
                y = (good & ~lines.repeats).astype(np.int8)
                for k in np.unique(lines.doc):
                    mine = lines.doc == k
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part.column("id")[int(k)].as_py()], part.column("id").type),
                            pa.array([x[mine].tobytes()], pa.binary()),
                            pa.array([y[mine].tobytes()], pa.binary()),
                        ],
                        names=["id", "x", "y"],
                    )

    schema = StructType([rows.schema["id"]]).add("x", "binary").add("y", "binary")
    found = map_arrow(rows, measure, schema).toPandas().sort_values("id", kind="stable")
    y = [np.frombuffer(b, dtype=np.int8) for b in found["y"]]
    x = [np.frombuffer(b).reshape(-1, len(FEATURES)) for b in found["x"]]
    chain = cut_chains(np.array([len(b) for b in y], dtype=np.int64))
    x = np.concatenate(x) if x else np.zeros((0, len(FEATURES)))
    return fit_chain(x, np.concatenate(y) if y else np.zeros(0, dtype=np.int8), chain)


def line_rules(
    docs: DataFrame, model: ChainModel, id_col: str = "doc_id", text_col: str = "text", share: float = 0.5
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share).

    ``content_share`` is the share of words in content lines, 0 for a text without
    words; ``kept`` needs ``share`` of it. Null and empty texts have zero counts and
    fail the base rules. One stage, no shuffle; repeated rows are judged each, and other
    columns are not looked at.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = StructType([source.schema["id"]])
    for name in counts:
        schema = schema.add(name, "long")
    schema = schema.add("content_share", "double")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                lines = Lines(part.column("text"))
                content = model.decode(lines.features(), lines.doc) == 1
                n = part.num_rows
                inside = np.bincount(lines.doc[content], lines.n_words[content], n)
                base = lines.base()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        *(pa.array(base[name]) for name in counts),
                        pa.array(inside / np.maximum(base["n_words"], 1)),
                    ],
                    names=schema.names,
                )

    found = map_arrow(source, judge, schema)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.select(
        F.col("id").alias(id_col), *counts, failed.alias("base_failed"),
        (~failed & (F.col("content_share") >= share)).alias("kept"), "content_share",
    )
