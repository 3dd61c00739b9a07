"""SentencePiece encoding by sampled segmentation, and lossless decoding (operator 2).

A text is cut into units: a run of line breaks, a word with the blank before it, or other blanks. Pieces do not
cross units, so the lattice of a text is a chain of the units' lattices. Each is filtered forwards once per distinct
unit (sums of path weights), and every occurrence is sampled backwards: from the end of the unit, a piece is drawn
with its share of the weight that arrives there, until the start is reached.

Draws are a function of the row's key, the unit's number and the place in the unit, so a row has the same
segmentation in every run and under any partitioning. A piece of rank r weighs (r + RANK_SHIFT) ** -alpha: the
vocabulary holds merge ranks and no probabilities, and frequencies fall about as ranks rise. Small alpha samples
freely, large alpha nearly always takes the best path. A character without a piece is written as its bytes.

No prefix is added and nothing is normalised, so the bytes of the pieces, joined, are the text's. A null text has
null pieces, an empty one none. Texts of any length are worked off in slices of ``SLICE_UNITS`` units. Repeated
rows have equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.5
RANK_SHIFT = 2.7
SLICE_UNITS = 25_000
SLICE_BYTES = 500_000  # about so much text is in work at once
MAX_CACHED_CHARS = 1_000_000  # characters of distinct units whose lattices a task keeps, about 40 bytes each

# Fixed value: the mark that stands for a blank in the vocabulary.
BLANK = "▁"
UNIT = re.compile(r"\n+| ?[^ \n]+| +(?=\n|$)| +(?= [^ \n])")

DRAW_BITS = 24
_GOLDEN, _MIX_A, _MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64


class Vocabulary:
    """The pieces of a model: ids, weights by rank, and the bytes of every id. Small and of fixed size."""

    def __init__(self, path: str = MODEL_PATH):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        self.byte_ids = [0] * 256
        normal = []
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = number
                self.bytes.append(bytes([value]))
            elif model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
                self.bytes.append(b"")
            else:
                text = piece.replace(BLANK, " ")
                self.bytes.append(text.encode())
                normal.append((-model.get_score(number), number, text))
        self.pieces = [(text, number, rank) for rank, (_, number, text) in enumerate(sorted(normal))]


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's output function."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Units(dict):
    """Numbers distinct units as they are met."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.new.append(unit)
        return number


class Sampler:
    """Samples segmentations; keeps the lattices of the units it has met, up to a bounded size."""

    def __init__(self, vocabulary: Vocabulary, alpha: float = ALPHA):
        self.vocabulary = vocabulary
        # For every length, the hashes of all beginnings of pieces, with the piece that ends there or -1.
        beginnings: list[dict[str, tuple[int, float]]] = [{} for _ in range(max(len(text) for text, _, _ in vocabulary.pieces))]
        for text, number, rank in vocabulary.pieces:
            for length in range(1, len(text)):
                beginnings[length - 1].setdefault(text[:length], (-1, 0.0))
            beginnings[len(text) - 1][text] = (number, -alpha * float(np.log(rank + RANK_SHIFT)))
        self.tables = []
        for length, known in enumerate(beginnings, 1):
            codes = np.array([[ord(c) + 1 for c in t] for t in known], dtype=np.uint64).reshape(-1, length)
            hashes = (codes * _powers(_BASE, length)).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes)
            if len(np.unique(hashes)) != len(hashes):
                raise ValueError("two beginnings of pieces have one hash")
            numbers, weights = (np.array([x[k] for x in known.values()]) for k in (0, 1))
            self.tables.append((hashes[order], numbers.astype(np.int32)[order], weights[order]))
        self.byte_weight = -alpha * float(np.log(len(vocabulary.pieces) + RANK_SHIFT))
        self._clear()

    def _clear(self) -> None:
        self.units = _Units()
        self.first = np.zeros(0, dtype=np.int64)  # each unit's first and last node
        self.last = np.zeros(0, dtype=np.int64)
        self.nodes = 0
        self.edges = np.zeros(0, dtype=np.int64)  # each node's first edge; edges are sorted by end node
        self.upto = np.zeros(0, dtype=np.uint32)  # for each edge, the least draw above the share of weight up to it
        self.size = np.zeros(0, dtype=np.uint8 if len(self.tables) < 256 else np.int32)  # how many nodes it goes back
        self.piece = np.zeros(0, dtype=np.int32)  # or -1 minus the code point of a character without a piece

    def _learn(self) -> None:
        """Forward filtering of the new units, all at once."""
        new, self.units.new = self.units.new, []
        if not new:
            return
        lengths = np.array([len(u) for u in new], dtype=np.int64)
        codes = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = len(codes)
        unit = np.repeat(np.arange(len(new)), lengths)
        offset = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = np.repeat(lengths, lengths) - offset
        node = np.arange(n) + unit  # each unit has one node more than characters
        power, inverse = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
        starts, ends, pieces, weights, ends_at = [], [], [], [], []
        at = np.arange(n)
        for length, (hashes, numbers, piece_weights) in enumerate(self.tables, 1):
            at = at[left[at] >= length]
            h = (sums[at + length] - sums[at]) * inverse[at]
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            begins = hashes[place] == h
            hit = begins & (numbers[place] >= 0)
            if length == 1:
                missing = at[~hit]
                starts.append(node[missing])
                ends.append(node[missing] + 1)
                pieces.append(-1 - codes[missing].astype(np.int32))
                size = 1 + (codes[missing] > 0x7F) + (codes[missing] > 0x7FF) + (codes[missing] > 0xFFFF)
                weights.append(self.byte_weight * size)
                ends_at.append(offset[missing] + 1)
            found, place = at[hit], place[hit]
            starts.append(node[found])
            ends.append(node[found] + length)
            pieces.append(numbers[place])
            weights.append(piece_weights[place])
            ends_at.append(offset[found] + length)
            at = at[begins]
        start, end, piece, weight, end_at = (np.concatenate(x) for x in (starts, ends, pieces, weights, ends_at))
        # One number to sort by: end in its unit, end, start. An edge is at most as long as the longest piece.
        longest = len(self.tables) + 1
        by_end = end * longest + longest - 1 - (end - start)
        order = np.argsort(end_at * np.int64((n + len(new) + 1) * longest) + by_end)
        start, end, piece, weight, end_at = (x[order] for x in (start, end, piece, weight, end_at))
        total = np.zeros(n + len(new))
        share = np.empty(len(start))
        bounds = np.flatnonzero(np.diff(end_at, prepend=0, append=-1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            value = total[start[a:b]] + weight[a:b]
            heads = np.flatnonzero(np.diff(end[a:b], prepend=-1))
            counts = np.diff(np.append(heads, b - a))
            top = np.maximum.reduceat(value, heads)
            scaled = np.exp(value - np.repeat(top, counts))
            sums_ = np.add.reduceat(scaled, heads)
            total[end[a:b][heads]] = top + np.log(sums_)
            upto = np.cumsum(scaled)
            before = np.repeat(upto[heads] - scaled[heads], counts)
            share[a:b] = (upto - before) / np.repeat(sums_, counts)
            share[a:b][np.append(heads[1:] - 1, b - a - 1)] = 1.0
        order = np.argsort(end * longest + longest - 1 - (end - start))
        first = self.nodes + np.cumsum(lengths + 1) - lengths - 1
        arriving = np.bincount(end, minlength=n + len(new))
        self.edges = np.concatenate([self.edges, len(self.upto) + np.cumsum(arriving) - arriving])
        self.first, self.last = np.concatenate([self.first, first]), np.concatenate([self.last, first + lengths])
        self.upto = np.concatenate([self.upto, np.ceil(share[order] * 2.0**DRAW_BITS).astype(np.uint32)])
        self.size = np.concatenate([self.size, (end - start)[order].astype(self.size.dtype)])
        self.piece = np.concatenate([self.piece, piece[order]])
        self.nodes += n + len(new)

    def sample(self, units: list[str], seeds: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of units in order, and how many each unit has. ``seeds``: the row's; ``numbers``: the unit's in its row."""
        if self.nodes > MAX_CACHED_CHARS:
            self._clear()
        which = np.fromiter(map(self.units.__getitem__, units), dtype=np.int64, count=len(units))
        self._learn()
        base = _mixed(seeds.astype(np.uint64) + (numbers.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
        at, stop = self.last[which], self.first[which]
        active, steps = np.arange(len(units)), []
        while len(active):
            drawn = _mixed(base[active] + (at - stop).astype(np.uint64) * _GOLDEN) >> np.uint64(64 - DRAW_BITS)
            edge = self.edges[at]
            short = np.flatnonzero(self.upto[edge] <= drawn)
            while len(short):
                edge[short] += 1
                short = short[self.upto[edge[short]] <= drawn[short]]
            steps.append((active, self.piece[edge]))
            at = at - self.size[edge]
            going = at > stop
            active, at, stop = active[going], at[going], stop[going]
        counts = np.zeros(len(units), dtype=np.int64)
        for chosen, _ in steps:
            counts[chosen] += 1
        place = np.cumsum(counts) - 1
        out = np.empty(int(counts.sum()), dtype=np.int32)
        for step, (chosen, pieces) in enumerate(steps):
            out[place[chosen] - step] = pieces
        return self._with_bytes(out, counts)

    def _with_bytes(self, out: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spelled = np.flatnonzero(out < 0)
        if not len(spelled):
            return out, counts
        unit = np.repeat(np.arange(len(counts)), counts)
        encoded = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in out[spelled].tolist()]
        sizes = np.ones(len(out), dtype=np.int64)
        sizes[spelled] = [len(b) for b in encoded]
        longer = np.repeat(out, sizes)
        begin = (np.cumsum(sizes) - sizes)[spelled]
        values = [self.vocabulary.byte_ids[x] for b in encoded for x in b]
        within = np.concatenate([np.arange(len(b)) for b in encoded])
        longer[np.repeat(begin, sizes[spelled]) + within] = values
        return longer, np.bincount(unit, weights=sizes, minlength=len(counts)).astype(np.int64)

    def encode(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of texts in order, and how many each text has."""
        values, sizes = [], np.zeros(len(texts), dtype=np.int64)
        units: list[str] = []
        segments: list[tuple[int, int, int]] = []  # text, units, units before them

        def flush() -> None:
            if not units:
                return
            rows = np.repeat([s[0] for s in segments], [s[1] for s in segments])
            numbers = np.concatenate([np.arange(b, b + c) for _, c, b in segments])
            pieces, counts = self.sample(units, seeds[rows], numbers)
            values.append(pieces)
            np.add.at(sizes, rows, counts)
            units.clear()
            segments.clear()

        for row, text in enumerate(texts):
            short = len(text) <= SLICE_UNITS  # so it has no more units, which can be found at once
            found, before = iter(UNIT.findall(text)) if short else (m[0] for m in UNIT.finditer(text)), 0
            while part := list(islice(found, SLICE_UNITS)):
                units.extend(part)
                segments.append((row, len(part), before))
                before += len(part)
                if len(units) >= SLICE_UNITS:
                    flush()
        flush()
        return np.concatenate(values) if values else np.zeros(0, dtype=np.int32), sizes


class Spelling:
    """The bytes of all pieces in one array, to decode many texts at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.flat = np.frombuffer(b"".join(vocabulary.bytes), dtype=np.uint8)
        self.size = np.array([len(b) for b in vocabulary.bytes], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def same(self, texts: list[str | None], pieces: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For texts with so many pieces each, whether the pieces' bytes are the text's."""
        written = [(t or "").encode() for t in texts]
        sizes = self.size[pieces]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        upto = np.concatenate([[0], np.cumsum(counts)])
        decoded = ends[upto[1:]] - ends[upto[:-1]]
        given = np.array([len(b) for b in written], dtype=np.int64)
        same = decoded == given
        if not same.all():  # texts no longer stand at the same places, so each is compared by itself
            for k in np.flatnonzero(same):
                same[k] = self._spelled(pieces[upto[k] : upto[k + 1]]).tobytes() == written[k]
            return same
        wrong = np.concatenate([[0], np.cumsum(self._spelled(pieces) != np.frombuffer(b"".join(written), dtype=np.uint8))])
        places = np.concatenate([[0], np.cumsum(given)])
        return wrong[places[1:]] == wrong[places[:-1]]

    def _spelled(self, pieces: np.ndarray) -> np.ndarray:
        sizes = self.size[pieces]
        shift = self.begin[pieces] - (np.cumsum(sizes) - sizes)
        return self.flat[np.arange(int(sizes.sum())) + np.repeat(shift, sizes)]


def _encoder(vocabulary, alpha: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary.value, alpha)
        spelling = Spelling(vocabulary.value)
        for batch in batches:
            texts = batch.column("text")
            seeds = batch.column("seed").to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b in _slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                part = texts.slice(a, b - a).to_pylist()
                values, sizes = sampler.encode([t or "" for t in part], seeds[a:b])
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                missing = np.array([t is None for t in part])
                same = spelling.same(part, values, sizes)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32(), mask=np.append(missing, False)), pa.array(values, pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(a, b - a),
                        lists,
                        pa.array(sizes, pa.int64()),
                        pa.array(same, pa.bool_(), mask=missing),
                    ],
                    names=["row", "pieces", "n_pieces", "lossless"],
                )

    return run


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE_BYTES`` of text, so that texts in work and results stay small."""
    first, size = 0, 0
    for at, more in enumerate(sizes):
        size += more
        if size >= SLICE_BYTES:
            yield first, at + 1
            first, size = at + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def encode(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = ("doc_id",),
    alpha: float = ALPHA,
    seed: int = 0,
    model_path: str = MODEL_PATH,
) -> DataFrame:
    """The ``keep`` columns with ``pieces``, ``n_pieces`` and ``lossless``: whether decoding gives the text again.

    The vocabulary is read on the driver and sent to the executors, which need no file.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path))
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.col(text).alias("text"),
        F.xxhash64(F.lit(seed), F.col(key).cast("string")).alias("seed"),
    )
    kind = rows.schema["row"].dataType.simpleString()
    encoded = rows.mapInArrow(_encoder(vocabulary, alpha), f"row {kind}, pieces array<int>, n_pieces long, lossless boolean")
    return encoded.select("row.*", "pieces", "n_pieces", "lossless")


def decode(pieces: Column, vocabulary: Vocabulary) -> Column:
    """The text of an array of pieces; null for null."""
    table = vocabulary.bytes

    @F.pandas_udf("string")
    def joined(column: pd.Series) -> pd.Series:
        return column.map(lambda ids: None if ids is None else b"".join(map(table.__getitem__, ids)).decode())

    return joined(pieces)
