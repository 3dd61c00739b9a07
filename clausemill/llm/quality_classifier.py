"""Quality classifier by hashed word n-grams (operator 13).

A text is a sequence of words: runs of letters, of digits and of other marks, and line ends. Its features are
single words and pairs of neighbours, and runs of one to three word shapes (case and length of letters, length of
digits, the first mark and the number of marks), all hashed into ``2 ** BITS`` places. A place's value is 1 + the
logarithm of its count, and each text's values are scaled to length one, so long texts weigh as much as short ones.

Logistic regression is trained by follow-the-regularised-leader updates, text by text, over ``EPOCHS`` seeded orders
of the labelled rows. At most ``max_examples`` rows take part, those with the smallest digests of their ids; that is the
only bound. They pass through one task in batches, so memory depends on neither their number nor their length.
Scoring is a sparse dot product in the tasks that read the texts, without a shuffle; the weights are 2^18 numbers.

Nothing but the text is an input of a score. A null text counts as empty; empty texts have the score of the bias.
Labels that are null, or belong to no text, teach nothing. Texts with several labels, and rows that repeat an id,
are examples as often as they occur. Without any example every score is one half. Rows with equal texts have equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.llm.common import stored

BITS = 18
MAX_EXAMPLES = 8_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.05, 0.1  # step size, its smoothing, and both penalties
THRESHOLD = 0.3
SLICE = 1 << 20  # bytes of a text that are hashed at a time

_GOLDEN, _MIX_A, _MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64
_SPACE, _LINE, _DIGIT, _MARK, _LETTER = range(5)


def _classes() -> np.ndarray:
    kind = np.full(256, _MARK, dtype=np.uint8)
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _SPACE
    kind[0x0A] = _LINE
    kind[0x30:0x3A] = _DIGIT
    kind[0x41:0x5B] = kind[0x61:0x7B] = kind[0x80:] = _LETTER
    return kind


_KIND = _classes()
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[0x41:0x5B] = 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


class Features:
    """Hashed n-grams of texts."""

    def __init__(self):
        ones = [np.full(SLICE + 1, np.uint64(pow(_BASE, sign, 1 << 64)), dtype=np.uint64) for sign in (1, -1)]
        for x in ones:
            x[0] = 1
        self.power, self.inverse = (np.cumprod(x, dtype=np.uint64) for x in ones)

    def _words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """A hash of every word of a slice, and one of its shape."""
        code = np.frombuffer(raw, dtype=np.uint8)
        kind = _KIND[code]
        starts = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
        ends = np.append(starts[1:], len(code))
        kept = kind[starts] != _SPACE
        starts, ends = starts[kept], ends[kept]
        sums = np.concatenate([[np.uint64(0)], np.cumsum((code.astype(np.uint64) + np.uint64(1)) * self.power[: len(code)])])
        length = ends - starts
        words = _mixed((sums[ends] - sums[starts]) * self.inverse[starts] + length.astype(np.uint64) * _GOLDEN)
        capitals = np.concatenate([[0], np.cumsum(_UPPER[code])])
        upper = capitals[ends] - capitals[starts]
        case = np.where(upper == 0, 0, np.where(upper == length, 3, np.where((upper == 1) & (_UPPER[code[starts]] == 1), 1, 2)))
        kinds = kind[starts].astype(np.int64)
        first = np.where((kinds == _MARK) | (kinds == _LINE), code[starts], case)
        size = np.where(kinds == _LETTER, np.minimum(length, 16) // 4, np.minimum(length, 4))
        return words, _mixed(((kinds * 256 + first) * 16 + size).astype(np.uint64) * _GOLDEN)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The places of a text's n-grams, and their values. Words end where a slice ends."""
        raw = (text or "").encode()
        parts = [self._words(raw[at : at + SLICE]) for at in range(0, len(raw), SLICE)]
        if not parts:
            return np.empty(0, dtype=np.int64), np.empty(0)
        words, shapes = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        grams = [words, _mixed(words[:-1] * _MIX_A + words[1:]), shapes ^ _MIX_A]
        grams.append(_mixed(shapes[:-1] * _MIX_B + shapes[1:]))
        grams.append(_mixed((shapes[:-2] * _MIX_B + shapes[1:-1]) * _MIX_A + shapes[2:]))
        places, counts = np.unique((np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
        values = 1 + np.log(counts)
        return places, values / np.sqrt((values * values).sum()) if len(values) else values


class Leader:
    """The state of follow-the-regularised-leader; the last place is the bias, which no penalty holds down."""

    def __init__(self):
        self.z, self.n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        weight = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, weight)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(places, 2**BITS), np.append(values, 1.0)
        w = self.weights(at)
        gradient = (_chance(float(w @ x)) - label) * x
        before = self.n[at]
        after = before + gradient * gradient
        self.z[at] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
        self.n[at] = after


def _chance(x: float) -> float:
    return 1.0 / (1.0 + float(np.exp(-min(max(x, -30.0), 30.0))))


def _trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    features, leader = Features(), Leader()
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            leader.learn(*features.of(text), int(label))
    yield pd.DataFrame({"weights": [leader.weights(slice(None)).astype(np.float32).tobytes()]})


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    text: str = "text",
    doc_id: str = "doc_id",
    max_examples: int = MAX_EXAMPLES,
) -> DataFrame:
    """One row with the ``weights``, learned from the rows of ``docs`` that ``labels`` marks 0 or 1."""
    marks = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = marks.orderBy(order, "id", "label").limit(max_examples)
    chosen = stored(docs.sparkSession, chosen, "examples")
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    examples = texts.join(chosen, "id").select("id", "label", "text", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))).alias("epoch"))
    ordered = examples.repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", F.col("id").cast("string")), "id", "label", "text")
    return stored(docs.sparkSession, ordered.select("text", "label").mapInPandas(_trained, "weights binary"), "weights")


def score(docs: DataFrame, model: DataFrame, text: str = "text") -> DataFrame:
    """Each row as ``row`` with its ``score``, the chance that it is good."""
    learned = model.first()  # None where there was no example
    trained = np.frombuffer(learned["weights"], dtype=np.float32) if learned else np.zeros(2**BITS + 1, dtype=np.float32)

    @F.pandas_udf("double")
    def chance(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, weights = Features(), trained.astype(np.float64)
        for batch in batches:
            found = (features.of(x) for x in batch)
            yield pd.Series([_chance(float(weights[at] @ x + weights[-1])) for at, x in found], dtype=float)

    return docs.select(F.struct("*").alias("row"), chance(F.col(text)).alias("score"))
