"""SentencePiece encoding and decoding with N-best segmentations.

A text is a lattice whose edges are the pieces of a model. A forward Viterbi pass
gives the best score from the start to every place. These scores are the exact
rest cost of a search that runs backward from the end, so A* takes complete
segmentations off its heap in order of their score.

No piece goes on after a space inside it, so the lattice of a text is a row of
small lattices (units), which repeat and are kept. The N best of a text differ
from the best one in few units: only the N - 1 places with the smallest loss can
take part, and only their units are searched for alternatives. New units of many
texts are segmented together, place by place in numpy.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import slices

SPACE = "▁"  # fixed value: how models write a space
KEPT_UNITS = 400_000  # about 250 bytes each
KEPT_LISTS = 20_000
TOGETHER = 20_000  # units segmented at once
SHORT = 64  # letters; longer units are segmented alone, they are few
SCALE = 1_000_000  # scores are whole numbers, so sums and ties are exact
NO_OTHER = 1 << 62  # the loss where there is no second segmentation
_LOW = -(1 << 62)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Units(dict):
    """Units by name, numbered as they come; a new one is segmented when it is asked for,
    or before, together with others."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model
        self.names: list[str] = []
        self.ids, self.ends = array("i"), array("q", [0])
        self.score, self.loss = array("q"), array("q")

    def __missing__(self, unit: str) -> int:
        ids, score, loss = self.model.segment(unit)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        self.score.append(score)
        self.loss.append(loss)
        self[unit] = code = len(self.names)
        self.names.append(unit)
        return code

    def learn(self, units: Iterable[str]) -> None:
        """Segment the new ones of some units; those that need bytes or are long may stay new."""
        new = [unit for unit in dict.fromkeys(units) if unit not in self]
        for begin in range(0, len(new), TOGETHER):
            part = new[begin : begin + TOGETHER]
            part = list(compress(part, self.model.plain(part)))
            if part:
                ids, size, score, loss = self.model.segment_all(part)
                self.ends.frombytes((len(self.ids) + np.cumsum(size)).tobytes())
                self.ids.frombytes(ids.tobytes())
                self.score.frombytes(score.tobytes())
                self.loss.frombytes(loss.tobytes())
                self.update(zip(part, range(len(self.names), len(self.names) + len(part)), strict=True))
                self.names += part

    def name(self, code: int) -> str:
        return self.names[code]

    def ids_of(self, code: int) -> array:
        return self.ids[self.ends[code] : self.ends[code + 1]]


class PieceModel:
    """Pieces and scores of a .model file.

    ``scores`` is "model" for the scores as they stand (a unigram model's
    log-probabilities) or "rank" for -ln(2 + rank): a merge model's scores are its
    merge ranks, and only a logarithm makes them comparable as sums.
    """

    def __init__(self, path: str, scores: str = "rank"):
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[bytes] = []
        self.bytes = [-1] * 256
        found: dict[str, tuple[int, int]] = {}
        for i in range(reader.get_piece_size()):
            piece = reader.id_to_piece(i)
            if reader.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.pieces.append(bytes([int(piece[3:5], 16)]))
            elif reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i):
                self.pieces.append(b"")
            else:
                value = reader.get_score(i)
                value = -math.log(2 - value) if scores == "rank" else value
                found[piece.replace(SPACE, " ")] = (i, round(value * SCALE))
                self.pieces.append(piece.replace(SPACE, " ").encode())
        if any(" " in piece.lstrip(" ") for piece in found):
            raise ValueError("a piece has a space after its first letters")
        if min(self.bytes) < 0:
            raise ValueError("the model has no byte pieces, so it cannot encode every text")
        # letter -> (letters that go on, id or -1, score): the pieces as a tree
        self.tree: dict[str, tuple] = {}
        for piece in sorted(found):
            node = self.tree
            for letter in piece[:-1]:
                node = node.setdefault(letter, ({}, -1, 0))[0]
            onward = node.get(piece[-1], ({},))[0]
            node[piece[-1]] = (onward, *found[piece])
        self.table = found
        self.byte_score = min(s for _, s in found.values()) - 10 * SCALE
        # a line feed is in no piece, so it can end a unit
        self.units = re.compile(r" +[^ \n]*|[^ \n]+|\n" if not any("\n" in p for p in found) else r" +[^ ]*|[^ ]+")
        self.piece_size = np.array([len(p) for p in self.pieces], dtype=np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(self.pieces) + b"\0", dtype=np.uint8)
        self._number_tree()
        self._clear()

    def _number_tree(self) -> None:
        """The tree as arrays: a hash table from node and letter to the next node."""
        code: dict[str, int] = {}
        keys, piece, value = [], [-1], [0]
        waiting = [(0, self.tree)]
        while waiting:
            parent, letters = waiting.pop()
            for letter, (onward, at, score) in letters.items():
                keys.append((parent, code.setdefault(letter, len(code) + 1)))
                if onward:
                    waiting.append((len(piece), onward))
                piece.append(at)
                value.append(score)
        self.n_codes = len(code) + 1
        self.code = np.zeros(0x110000, dtype=np.int32)  # 0: in no piece
        self.code[[ord(letter) for letter in code]] = list(code.values())
        self.node_piece, self.node_value = np.array(piece, dtype=np.int32), np.array(value, dtype=np.int64)
        self.single = np.zeros(self.n_codes, dtype=bool)
        self.single[[k for (parent, k), at in zip(keys, piece[1:], strict=True) if parent == 0 and at >= 0]] = True
        key = np.array([parent * self.n_codes + k for parent, k in keys], dtype=np.int64)
        # a quarter full at most; the last slots are for those that find theirs taken
        bits = max(4, (4 * len(key)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot_key = np.full((1 << bits) + len(key) + 1, -1, dtype=np.int64)
        self.slot_node = np.full(len(self.slot_key), -1, dtype=np.int32)
        slot, left = self._slot(key), np.arange(len(key))
        while len(left):
            free = left[self.slot_key[slot[left]] < 0]
            self.slot_key[slot[free]] = key[free]
            self.slot_node[slot[free]] = free + 1
            left = left[self.slot_key[slot[left]] != key[left]]
            slot[left] += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def _onward(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The nodes that letters lead to, -1 for none."""
        key = node * np.int64(self.n_codes) + code
        slot = self._slot(key)
        found = self.slot_key[slot]
        out = np.where(found == key, self.slot_node[slot], -1)
        left = np.flatnonzero((found != key) & (found >= 0))
        while len(left):
            slot[left] += 1
            found = self.slot_key[slot[left]]
            hit = found == key[left]
            out[left[hit]] = self.slot_node[slot[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out

    def plain(self, units: list[str]) -> np.ndarray:
        """Which of some units have few letters, all with pieces of their own."""
        size = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        known = self.single[self.code[_letters(units)]]
        return (size <= SHORT) & np.logical_and.reduceat(known, np.cumsum(size) - size)

    def segment_all(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``segment`` of many ``plain`` units: ids of all, how many each has, scores and losses.

        The same lattices and passes, over the first letters of all units, then the second
        ones, and so on. Edges that begin (or end) at one place of a unit differ in their
        other end, so a pass never writes one place twice at a time.
        """
        n = len(units)
        size = np.fromiter(map(len, units), dtype=np.int64, count=n)
        code = self.code[_letters(units)]
        unit = np.repeat(np.arange(n), size)
        first = np.cumsum(size) - size
        behind = (first + size)[unit]
        walker, node = np.arange(len(code)), np.zeros(len(code), dtype=np.int32)
        begins, nodes = [], []
        while len(walker):
            node = self._onward(node, code[walker + len(begins)])
            on = node >= 0
            walker, node = walker[on], node[on]
            whole = self.node_piece[node] >= 0
            begins.append(walker[whole])
            nodes.append(node[whole])
            on = walker + len(begins) < behind[walker]
            walker, node = walker[on], node[on]
        begin, node = np.concatenate(begins), np.concatenate(nodes)
        length = np.repeat(np.arange(1, len(begins) + 1), [len(b) for b in begins])
        order = np.argsort(begin, kind="stable")  # by begin, then end, as ``lattice`` has them
        begin, node, length = begin[order], node[order], length[order]
        value, of = self.node_value[node], unit[begin]
        # a unit has a place more than letters
        i, place = begin + of, begin - first[of]
        j = i + length
        start = first + np.arange(n)
        end = start + size
        best = np.full(len(code) + n, _LOW)
        rest = best.copy()
        best[start], rest[end] = 0, 0
        for at in _places(place):
            best[j[at]] = np.maximum(best[j[at]], best[i[at]] + value[at])
        for at in reversed(_places(place + length)):
            rest[i[at]] = np.maximum(rest[i[at]], value[at] + rest[j[at]])
        lost = best[end][of] - best[i] - value - rest[j]
        free = np.flatnonzero(lost == 0)[::-1]
        way = np.zeros(len(best), dtype=np.int64)
        way[i[free]] = free  # the first edge without loss is written last
        taken, at_end = np.zeros(len(i), dtype=bool), np.zeros(len(best), dtype=bool)
        at_end[end] = True
        here = start
        while len(here):
            taken[way[here]] = True
            here = j[way[here]]
            here = here[~at_end[here]]
        edges = np.searchsorted(begin, first)
        loss = np.minimum.reduceat(np.where(taken, NO_OTHER, lost), edges)
        return self.node_piece[node[taken]], np.add.reduceat(taken.astype(np.int64), edges), best[end], loss

    def _clear(self) -> None:
        self.known = Units(self)
        self.others: dict[int, list[tuple[int, tuple[int, ...]]]] = {}

    def lattice(self, unit: str) -> tuple[list[tuple[int, int, int, int]], list[int]]:
        """Edges (begin, end, score, id), by begin, and the best score to each place.

        An edge over the bytes of one letter has the id -1.
        """
        n, root = len(unit), self.tree
        best = [0] + [_LOW] * n
        edges = []
        add = edges.append
        for i in range(n):
            here = best[i]
            alone = False
            node, j = root, i
            while j < n:
                entry = node.get(unit[j])
                if entry is None:
                    break
                j += 1
                node, piece, value = entry
                if piece >= 0:
                    add((i, j, value, piece))
                    if j == i + 1:
                        alone = True
                    if here + value > best[j]:
                        best[j] = here + value
            if not alone:
                value = self.byte_score * len(unit[i].encode())
                add((i, i + 1, value, -1))
                if here + value > best[i + 1]:
                    best[i + 1] = here + value
        return edges, best

    def letter_bytes(self, letter: str) -> list[int]:
        return [self.bytes[b] for b in letter.encode()]

    def segment(self, unit: str) -> tuple[list[int], int, int]:
        """The best segmentation, its score, and what the second best loses."""
        edges, best = self.lattice(unit)
        rest = [_LOW] * len(unit) + [0]
        for i, j, value, _ in reversed(edges):
            if value + rest[j] > rest[i]:
                rest[i] = value + rest[j]
        total, at, loss = best[-1], 0, NO_OTHER
        ids: list[int] = []
        for i, j, value, piece in edges:
            lost = total - best[i] - value - rest[j]
            if lost == 0 and i == at:
                at = j
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids += self.letter_bytes(unit[i])
            elif lost < loss:
                loss = lost
        return ids, total, loss

    def n_best(self, unit: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The ``n`` best segmentations as (score, ids), best first."""
        edges, best = self.lattice(unit)
        into: list[list] = [[] for _ in range(len(unit) + 1)]
        for i, j, value, piece in edges:
            ids = (piece,) if piece >= 0 else tuple(self.letter_bytes(unit[i]))
            into[j].append((i, ids, value))
        found: list[tuple[int, tuple[int, ...]]] = []
        # minus the best total through here, turn (later ones first), place, own score, path
        heap = [(-best[-1], 0, len(unit), 0, None)]
        turn = 0
        while heap and len(found) < n:
            total, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                found.append((-total, tuple(ids)))
                continue
            for i, ids, value in into[at]:
                turn -= 1
                heapq.heappush(heap, (-(best[i] + value + behind), turn, i, behind + value, (ids, path)))
        return found

    def codes(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the texts' units among the known ones."""
        units = [self.units.findall(" " + text) if text else [] for text in texts]
        self.known.learn(chain.from_iterable(units))
        return [np.fromiter(map(self.known.__getitem__, u), dtype=np.int64, count=len(u)) for u in units]

    def alternatives(self, codes: np.ndarray, n: int) -> list[tuple[int, dict[int, tuple[int, ...]]]]:
        """The ``n`` best of a text: loss against the best, and the ids of changed places."""
        loss = np.frombuffer(self.known.loss, dtype=np.int64)[codes]
        ways: list[tuple[int, int, dict]] = [(0, 0, {})]
        for place in _smallest(loss, n - 1).tolist():
            unit = int(codes[place])
            if loss[place] == NO_OTHER:
                continue
            if len(self.others.get(unit, ())) < n:
                self.others[unit] = self.n_best(self.known.name(unit), n)
            top, first = self.known.score[unit], tuple(self.known.ids_of(unit))
            more = [
                (lost + top - score, place, {**changed, place: ids})
                for lost, _, changed in ways
                for score, ids in self.others[unit]
                if ids != first
            ]
            ways = heapq.nsmallest(n, ways + more, key=lambda w: w[0])
        return [(lost, changed) for lost, _, changed in ways]

    def gathered(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best ids of a row of units, and how many each unit has."""
        ends = np.frombuffer(self.known.ends, dtype=np.int64)
        size = ends[codes + 1] - ends[codes]
        first = np.repeat(ends[codes] - (np.cumsum(size) - size), size)
        return np.frombuffer(self.known.ids, dtype=np.int32)[first + np.arange(len(first))], size

    def encode(self, text: str) -> list[int]:
        return self.gathered(self.codes([text])[0])[0].tolist()

    def encode_n_best(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        codes = self.codes([text])[0]
        top = sum(self.known.score[c] for c in codes)
        ways = self.alternatives(codes, n)
        return [((top - lost) / SCALE, self.changed(codes, way)) for lost, way in ways]

    def changed(self, codes: np.ndarray, way: dict[int, tuple[int, ...]]) -> list[int]:
        return [i for k, c in enumerate(codes) for i in way.get(k, self.known.ids_of(c))]

    def decode(self, ids: list[int]) -> str:
        column = pa.array([ids], pa.list_(pa.int32()))
        return self.decode_all(column)[0].as_py()

    def decode_all(self, column: pa.Array) -> pa.Array:
        """Texts of arrays of ids; null for null. The space put before a text is dropped."""
        n = len(column)
        offsets = column.offsets.to_numpy().astype(np.int64)
        ids = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
        ids, offsets = ids.astype(np.int64), offsets - offsets[0]
        start, size = self.piece_start[ids], self.piece_size[ids]
        # drop the first byte of a text when it is a space
        filled = np.flatnonzero(offsets[1:] > offsets[:-1])
        heads = offsets[filled]
        spaced = (size[heads] > 0) & (self.piece_bytes[start[heads]] == 32)
        start[heads] += spaced
        size[heads] -= spaced
        total = np.concatenate([[0], np.cumsum(size)])
        data = self.piece_bytes[np.repeat(start - total[:-1], size) + np.arange(total[-1])]
        bounds = total[offsets]
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        whole = data.tobytes()
        try:
            whole.decode()
            texts = pa.LargeStringArray.from_buffers(n, pa.py_buffer(bounds.tobytes()), pa.py_buffer(whole))
            texts = texts.cast(pa.string())
        except UnicodeDecodeError:  # ids that no text gives
            cells = [whole[a:b].decode(errors="replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            texts = pa.array(cells, pa.string())
        return texts if valid.all() else pc.if_else(pa.array(valid), texts, None)

    def trim(self) -> None:
        if len(self.others) > KEPT_LISTS:
            self.others.clear()
        if len(self.known) > KEPT_UNITS:
            self._clear()


def _letters(units: list[str]) -> np.ndarray:
    return np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _places(place: np.ndarray) -> list[np.ndarray]:
    """The edges of each place, by place."""
    order = np.argsort(place.astype(np.uint8), kind="stable")
    return np.split(order, np.cumsum(np.bincount(place))[:-1])


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """The places of the ``n`` smallest values, ties in order."""
    if n >= len(values):
        return np.argsort(values, kind="stable")
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    near = np.flatnonzero(values <= np.partition(values, n - 1)[n - 1])
    return near[np.argsort(values[near], kind="stable")][:n]


@lru_cache(maxsize=2)
def load(path: str, scores: str = "rank") -> PieceModel:
    return PieceModel(path, scores)


def encode_pieces(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", n_best: int = 4,
    scores: str = "rank", alternatives: bool = False, decoded: bool = False,
) -> DataFrame:
    """(id, ids, n_pieces, score, n_best_scores[, n_best][, decoded]), one stage, no shuffle.

    ``model`` is the path of a .model file with byte pieces on every worker. ``ids``
    is the best segmentation of the text with one space put before it; letters
    without a piece of their own become bytes, and so does a literal U+2581, which
    keeps decoding exact. ``n_best_scores`` are the scores of the best ``n_best``
    segmentations, fewer where there are fewer; ``n_best`` their ids. ``decoded`` is
    the text that ``ids`` give, decoded in the same pass. Null and empty texts have
    no pieces and the one score 0. Repeated rows are encoded each.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    more = StructType.fromDDL("ids array<int>, n_pieces long, score double, n_best_scores array<double>")
    if alternatives:
        more = more.add("n_best", ArrayType(ArrayType(IntegerType())))
    if decoded:
        more = more.add("decoded", "string")
    schema = StructType([source.schema["id"], *more])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model, scores)
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                yield _encoded(pieces, part, n_best, alternatives, decoded, schema.names)
                pieces.trim()

    found = map_arrow(source, encode, schema)
    return found.withColumnRenamed("id", id_col)


def _encoded(
    pieces: PieceModel, part: pa.RecordBatch, n: int, alternatives: bool, decoded: bool, names
) -> pa.RecordBatch:
    texts = part.column("text").fill_null("").to_pylist()
    codes = pieces.codes(texts)
    ways = [pieces.alternatives(c, n) for c in codes]
    flat = np.concatenate(codes) if codes else np.zeros(0, dtype=np.int64)
    ids, lengths = pieces.gathered(flat)
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])[bounds]
    scores = np.frombuffer(pieces.known.score, dtype=np.int64)[flat]
    top = np.diff(np.concatenate([[0], np.cumsum(scores)])[bounds])
    best = [[(t - lost) / SCALE for lost, _ in w] for t, w in zip(top.tolist(), ways, strict=True)]
    columns = [
        part.column("id"),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
        pa.array(np.diff(offsets)),
        pa.array(top / SCALE),
        pa.array(best, pa.list_(pa.float64())),
    ]
    if alternatives:
        columns.append(_all_ways(ids, np.concatenate([[0], np.cumsum(lengths)]), bounds, ways))
    if decoded:
        columns.append(pieces.decode_all(columns[1]))
    return pa.RecordBatch.from_arrays(columns, names=list(names))


def _all_ways(ids: np.ndarray, ends: np.ndarray, bounds: np.ndarray, ways: list) -> pa.ListArray:
    """The ids of all ways of all texts: rows of the best ids with the changed units put in.

    ``ends`` are the ends of units in ``ids``, ``bounds`` the ends of texts in units.
    """
    parts, sizes = [], []
    for first, last, found in zip(bounds[:-1].tolist(), bounds[1:].tolist(), ways, strict=True):
        for _, changed in found:
            at, size = ends[first], 0
            for place in sorted(changed):
                parts += [ids[at : ends[first + place]], np.array(changed[place], dtype=np.int32)]
                size += len(parts[-2]) + len(parts[-1])
                at = ends[first + place + 1]
            parts.append(ids[at : ends[last]])
            sizes.append(size + len(parts[-1]))
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
    each = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat, pa.int32()))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ways)]), pa.int32()), each)


def decode_pieces(ids: Column, model: str) -> Column:
    """The text of an array of piece ids; null for null. Unknown bytes become U+FFFD."""

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        return load(model).decode_all(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)

    return decode(ids)
