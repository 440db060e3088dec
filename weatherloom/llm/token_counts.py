"""Token counts of a byte-level BPE vocabulary, merged for many words at once.

Distinct pre-tokens lie one after another in flat numpy arrays. In every round
each sequence merges all places of its own lowest-rank pair, left to right, at
the same time as all other sequences; what cannot merge any more leaves with its
number of symbols. Merging every place of the lowest-rank pair equals merging the
leftmost one again and again, since a merged symbol only occurs in later ranks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import slices, text_bytes

# fixed value: the pre-token pattern of this kind of vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED = 400_000
_NONE = np.int32(2**31 - 1)


class PairRanks:
    """The merge table of a ``tokenizers`` file as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab, merges = content["model"]["vocab"], content["model"]["merges"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        keys = left << 32 | right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.first = np.array([vocab[c] for c in _byte_letters()], dtype=np.int64)
        special = [t["content"] for t in content.get("added_tokens", [])]
        # longest first, as the library prefers; looked for before pre-tokens are cut
        special.sort(key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], _NONE).astype(np.int32)

    def symbols(self, words: list[str]) -> np.ndarray:
        """Number of symbols that each non-empty word ends up with."""
        data = [w.encode() for w in words]
        lengths = np.array([len(d) for d in data], dtype=np.int64)
        symbol = self.first[np.frombuffer(b"".join(data), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        counts = np.zeros(len(words), dtype=np.int64)
        while len(symbol):
            rank = np.full(len(symbol), _NONE, dtype=np.int32)
            pair = np.flatnonzero(word[:-1] == word[1:])
            rank[pair] = self.ranks(symbol[pair], symbol[pair + 1])
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(word)])
            lowest = np.minimum.reduceat(rank, start)
            over = lowest == _NONE
            counts[word[start[over]]] = size[over]
            chosen = (rank == np.repeat(lowest, size)) & (rank != _NONE)
            # "aaa" has the pair at two places that overlap: take every other one
            at = np.flatnonzero(chosen)
            run = np.r_[True, np.diff(at) > 1]
            ahead = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            at = at[ahead % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            stay = np.repeat(~over, size)
            stay[at + 1] = False
            symbol, word = symbol[stay], word[stay]
        return counts

    def count(self, texts: list[str]) -> list[int]:
        cut = [self._words(t) for t in texts]
        fresh = set().union(*(w for w, _ in cut)) - self.known.keys()
        if len(self.known) + len(fresh) > CACHED:
            self.known.clear()
            fresh = set().union(*(w for w, _ in cut))
        if fresh:
            fresh = list(fresh)
            self.known.update(zip(fresh, self.symbols(fresh).tolist(), strict=True))
        of = self.known.__getitem__
        return [sum(map(of, words)) + extra for words, extra in cut]

    def _words(self, text: str) -> tuple[list[str], int]:
        if self.special is None or not self.special.search(text):
            return self.words.findall(text), 0
        parts = self.special.split(text)
        return [w for part in parts for w in self.words.findall(part)], len(parts) - 1


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else from 256 up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


@lru_cache(maxsize=2)
def _loaded(path: str) -> PairRanks:
    return PairRanks(path)


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row, in one stage without shuffle.

    ``vocabulary`` is the path of a byte-level BPE file of the ``tokenizers``
    library, present on every worker. Counts are the library's without added
    special tokens; special strings inside a text count as one token each. A null
    or empty text has no bytes and no tokens. Repeated rows are counted each.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = source.select("id", F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _loaded(vocabulary)
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                texts = part.column("text").fill_null("")
                sizes = np.diff(text_bytes(texts)[1])
                tokens = ranks.count(texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes), pa.array(tokens, pa.int64())],
                    names=["id", "n_bytes", "n_tokens"],
                )

    found = map_arrow(source, count, schema)
    return found.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
