"""Periodic run detection by block convolution (operator 11).

A run is a stretch of words with smallest period q that has at least ``MIN_WORDS`` words and ``MIN_TURNS`` periods and
that no neighbouring word extends. Words are numbered within a batch of texts. At every scale the numbers are cut into
aligned blocks of B = 8, 16, 32 ... words. A run of period B to 2B (the least scale: 1 to 2B) holds a whole block and
its copy one period on. So each block is matched against the window that follows it: squared differences of block and
window are summed for all distances at once by a number-theoretic transform modulo a prime. Values are so small that
no sum reaches the prime, so zeros of the exact sums are the distances without mismatch. They seed runs.

A seed is extended to both sides by comparing hashes of stretches, for all seeds together, and every run is then
compared word by word; should a hash ever have deceived, extents are found by plain comparison instead. A stretch that
is found with several periods has the least of them. Blocks in which some pair of words does not come back at a distance of
the scale cannot match and are not transformed. No distance, block or text is left out otherwise, whatever its length.

Each text is its own; texts are joined in batches of bounded length with separators that equal nothing, and a long
text is a batch of its own. Work grows with n log^2 n of a text's words, memory with its length. A null text and one
without words have no run. Rows with equal texts have equal runs; rows that repeat an id are rows like all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 24
MIN_TURNS = 3
LEAST_BLOCK = 8
BATCH_WORDS = 1 << 17  # words of texts that are worked out together
WORK = 1 << 19  # numbers that are transformed at a time

# A prime 119 * 2^23 + 1 and a generator of its multiplicative group.
PRIME, GENERATOR = 998244353, 3
_P = np.uint64(PRIME)
_ODD = 0x5851F42D4C957F2D


class Transform:
    """The number-theoretic transform of rows of 2^k numbers modulo the prime; results are in no particular order."""

    def __init__(self, size: int):
        self.size = size
        self.forward, self.backward = [], []
        half = size // 2
        while half:
            root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
            self.forward.append(_powers(root, half))
            self.backward.append(_powers(pow(root, -1, PRIME), half))
            half //= 2
        self.scale = np.uint64(pow(size, -1, PRIME))

    def there(self, rows: np.ndarray) -> np.ndarray:
        """Decimation in frequency: natural order in, bit-reversed order out."""
        x = rows
        for turn in self.forward:
            x = x.reshape(-1, 2, len(turn))
            a, b = x[:, 0], x[:, 1]
            out = np.empty_like(x)
            out[:, 0] = _reduced(a + b)
            out[:, 1] = (a + (_P - b)) * turn % _P
            x = out
        return x.reshape(rows.shape)

    def back(self, rows: np.ndarray) -> np.ndarray:
        """Decimation in time: bit-reversed order in, natural order out."""
        x = rows
        for turn in reversed(self.backward):
            x = x.reshape(-1, 2, len(turn))
            a, b = x[:, 0], x[:, 1] * turn % _P
            out = np.empty_like(x)
            out[:, 0] = _reduced(a + b)
            out[:, 1] = _reduced(a + (_P - b))
            x = out
        return x.reshape(rows.shape) * self.scale % _P


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below twice the prime modulo the prime; the subtraction wraps round where it is not needed."""
    return np.minimum(x, x - _P)


def _powers(root: int, count: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), PRIME)) % _P])
    return out[:count]


_TRANSFORMS: dict[int, Transform] = {}


def _transform(size: int) -> Transform:
    if size not in _TRANSFORMS:
        _TRANSFORMS[size] = Transform(size)
    return _TRANSFORMS[size]


class _Pairs:
    """Neighbouring words as one number each, and where every pair stands."""

    def __init__(self, x: np.ndarray):
        width = np.int64(x.max() + 1)
        self.pair = np.unique(x[:-1] * width + x[1:], return_inverse=True)[1].astype(np.int64)
        self.stride = np.int64(len(x) + 1)
        order = np.argsort(self.pair, kind="stable")
        self.keys = self.pair[order] * self.stride + order

    def returning(self, at: np.ndarray, low: int, high: int) -> np.ndarray:
        """Whether the pairs at some places stand again at a distance in [low, high)."""
        base = self.pair[at] * self.stride + at
        found = np.searchsorted(self.keys, base + low)
        return (found < len(self.keys)) & (self.keys[np.minimum(found, len(self.keys) - 1)] < base + high)


def _inside(runs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether some run holds the whole of each stretch."""
    if not len(runs):
        return np.zeros(len(starts), dtype=bool)
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    before = np.searchsorted(runs[:, 0], starts, side="right") - 1
    return (before >= 0) & (reach[np.maximum(before, 0)] >= ends)


def _seeds(x: np.ndarray, pairs: _Pairs, runs: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and the distances, of the scale's periods, at which they occur again without a mismatch.

    Where block and window lie inside a run of a lesser scale, whose period is below the block's length, all
    matches are at multiples of that period, which is no news.
    """
    low, high = (1 if block == LEAST_BLOCK else block), 2 * block
    starts = np.arange(0, len(x) - block - low + 1, block)
    starts = starts[~_inside(runs, starts, starts + 3 * block)]
    probe = 1
    while probe < block and len(starts):  # the block's pairs, ever more of them
        for step in range(0, block - 1, block // probe):
            starts = starts[pairs.returning(starts + step, low, high)]
        probe *= 4
    if not len(starts):
        return starts, starts
    bits = (29 - block.bit_length()) // 2  # block * 2^(2 bits) stays below the prime
    mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD)
    values = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(_ODD) >> np.uint64(64 - bits)
    values = np.concatenate([values, np.zeros(4 * block, dtype=np.uint64)])
    squares = np.concatenate([[np.uint64(0)], np.cumsum(values * values)])
    transform = _transform(4 * block)
    places, distances = [], []
    several = max(1, WORK // (4 * block))
    for at in range(0, len(starts), several):
        some = starts[at : at + several]
        held = np.zeros((len(some), 4 * block), dtype=np.uint64)
        held[:, :block] = values[some[:, None] + np.arange(block)][:, ::-1]
        window = np.zeros_like(held)
        window[:, : 3 * block] = values[some[:, None] + np.arange(3 * block)]
        product = transform.back(transform.there(held) * transform.there(window) % _P)
        shifts = np.arange(low, high)
        cross = product[:, shifts + block - 1]
        own = (squares[some + block] - squares[some])[:, None]
        there = some[:, None] + shifts
        ends = np.minimum(there + block, len(squares) - 1)
        other = squares[ends] - squares[np.minimum(there, len(squares) - 1)]
        row, column = np.nonzero((own + other == np.uint64(2) * cross) & (there + block <= len(x)))
        places.append(some[row])
        distances.append(shifts[column])
    return np.concatenate(places), np.concatenate(distances)


class _Stretches:
    """Hashes of stretches, to tell how far two of them agree."""

    def __init__(self, x: np.ndarray):
        mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        power = np.full(len(x) + 1, np.uint64(_ODD), dtype=np.uint64)
        power[0] = 1
        self.power = np.cumprod(power, dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed * self.power[:-1], dtype=np.uint64)])

    def _same(self, a: np.ndarray, distance: np.ndarray, size: np.ndarray) -> np.ndarray:
        first = (self.sums[a + size] - self.sums[a]) * self.power[distance]
        return first == self.sums[a + distance + size] - self.sums[a + distance]

    def agree(self, a: np.ndarray, distance: np.ndarray, onward: bool) -> np.ndarray:
        """Words from ``a`` on (or before it) that equal those a distance on."""
        room = len(self.sums) - 1 - a - distance if onward else a.copy()
        good, bad = np.zeros(len(a), dtype=np.int64), room + 1
        while True:
            open_ = bad - good > 1
            if not open_.any():
                return good
            middle = np.where(open_, (good + bad) // 2, good)
            same = self._same(a if onward else a - middle, distance, middle)
            good = np.where(same, middle, good)
            bad = np.where(same, bad, middle)


def _extended(x: np.ndarray, place: int, distance: int) -> tuple[int, int]:
    """The stretch around a place whose words equal those a distance on, by plain comparison."""
    differ = np.flatnonzero(x[: len(x) - distance] != x[distance:])
    after = np.searchsorted(differ, place)
    start = differ[after - 1] + 1 if after else 0
    end = differ[after] if after < len(differ) else len(x) - distance
    return int(start), int(end) + distance


def find_runs(x: np.ndarray, longest: int | None = None) -> np.ndarray:
    """The runs of a sequence of numbers, as rows of start, end and smallest period, by start, then period.

    ``longest`` bounds the length of a run, where it is known.
    """
    size = len(x)
    found = [np.empty((0, 3), dtype=np.int64)]
    if size >= MIN_WORDS:
        x = np.unique(x, return_inverse=True)[1].astype(np.int64)
        pairs, stretches, block = _Pairs(x), _Stretches(x), LEAST_BLOCK
        while MIN_TURNS * block <= (longest or size):
            place, distance = _seeds(x, pairs, np.concatenate(found), block)
            if len(place):
                found.append(_from_seeds(x, stretches, place, distance))
            block *= 2
    runs = np.concatenate(found)
    if len(runs):
        # A stretch with several periods comes first with the least of them.
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs


def _long_enough(rows: np.ndarray) -> np.ndarray:
    size = rows[:, 1] - rows[:, 0]
    return rows[size >= np.maximum(MIN_WORDS, MIN_TURNS * rows[:, 2])]


def _from_seeds(x: np.ndarray, stretches: _Stretches, place: np.ndarray, distance: np.ndarray) -> np.ndarray:
    before = stretches.agree(place, distance, False)
    after = stretches.agree(place, distance, True)
    rows = _long_enough(np.unique(np.stack([place - before, place + distance + after, distance], axis=1), axis=0))
    least: dict[tuple[int, int], int] = {}
    for start, end, period in rows.tolist():
        least[start, end] = min(period, least.get((start, end), period))
    if all(np.array_equal(x[s : e - q], x[s + q : e]) for (s, e), q in least.items()):
        return rows
    plain = {(*_extended(x, p, d), d) for p, d in zip(place.tolist(), distance.tolist(), strict=True)}
    return _long_enough(np.array(sorted(plain), dtype=np.int64).reshape(-1, 3))


def _described(words: list[bytes], runs: np.ndarray, offset: int) -> dict:
    """A text's runs, and its words that no run repeats joined by single spaces."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    starts, ends, periods = (runs[:, k] for k in range(3))
    np.add.at(gone, starts + periods - offset, 1)
    np.add.at(gone, ends - offset, -1)
    kept = words if not len(runs) else [w for w, n in zip(words, np.cumsum(gone).tolist(), strict=False) if not n]
    listed = [{"start": int(s - offset), "length": int(e - s), "period": int(q)} for s, e, q in runs]
    return {"runs": listed, "collapsed": b" ".join(kept).decode()}


def _of_texts(texts: list[list[bytes]]) -> Iterator[dict]:
    number: dict[bytes, int] = {}
    parts, offsets, at = [], [], 0
    for k, words in enumerate(texts):
        offsets.append(at)
        parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words)))
        parts.append(np.array([-1 - k], dtype=np.int64))  # a separator
        at += len(words) + 1
    runs = find_runs(np.concatenate(parts), max(map(len, texts))) if parts else np.empty((0, 3), dtype=np.int64)
    cuts = np.searchsorted(runs[:, 0], [*offsets, at])
    for k, words in enumerate(texts):
        yield _described(words, runs[cuts[k] : cuts[k + 1]], offsets[k])


def _worked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out: list[dict] = []
        held, size = [], 0
        for text in batch:
            words = text.encode().split() if text else []  # bytes are split by the six ASCII blanks alone
            if held and size + len(words) > BATCH_WORDS:
                out += _of_texts(held)
                held, size = [], 0
            held.append(words)
            size += len(words) + 1
        out += _of_texts(held)
        yield pd.DataFrame(out, columns=["runs", "collapsed"])


def runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row as ``row`` with its ``runs`` (``start``, ``length`` and ``period`` in words) by start, then period, and
    ``collapsed``: its words without those that a run repeats after its first period, joined by single spaces."""
    kind = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    found = F.pandas_udf(_worked, kind)(F.col(text))
    return docs.select(F.struct("*").alias("row"), found.alias("found")).select("row", "found.runs", "found.collapsed")
