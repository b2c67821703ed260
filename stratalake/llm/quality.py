"""A quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal updates.

A text is cut into runs of letters and digits (lower-cased) and runs of other visible characters. Features are single
words and pairs of neighbours, hashed to ``2**BITS`` places; a word that follows itself is the same pair whatever the
word. Counts are scaled to length one, so a score is a sparse dot product that does not grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import LOWER, U64, Words, handing_back, mix, slices, utf8

BITS = 18
#: The model is fitted to so many labelled rows at most, those with the smallest hash of their id. This bounds the one
#: task that trains and the time it takes; all rows are scored.
TRAINING_ROWS = 12_000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.05, 0.1
_AGAIN = U64(0x5851F42D4C957F2D)
_PAIR = U64(0x2545F4914F6CDD1D)

#: 0 white space and controls, 1 letters, digits and all beyond ASCII, 2 the rest.
_KIND = np.full(256, 1, np.uint8)
_KIND[: 0x21] = 0
_KIND[0x7F] = 0
for _c in range(0x21, 0x7F):
    _KIND[_c] = 1 if chr(_c).isalnum() else 2


@dataclass
class Model:
    """Weights of the n-grams and of the constant."""

    weights: np.ndarray
    constant: float

    def score(self, places: np.ndarray, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        # added up row by row, so that a score does not depend on the rows beside it
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        sums = np.bincount(row, self.weights[places] * values, len(first) - 1)
        return 1 / (1 + np.exp(-(sums + self.constant)))


def features(column: pa.Array, bits: int = BITS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of rows: its range, the places, the values, and where each row's begin."""
    data, offsets = utf8(column)
    for at, to in slices(offsets):
        raw = LOWER[data[offsets[at] : offsets[to]]]
        edge = offsets[at : to + 1] - offsets[at]
        kind = _KIND[raw]
        cut = np.ones(len(raw) + 1, bool)
        cut[1:-1] = kind[1:] != kind[:-1]
        cut[edge] = True
        places = np.flatnonzero(cut)
        starts, ends = places[:-1], places[1:]
        full = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
        starts, ends = starts[full], ends[full]
        words = Words(raw, starts, ends, np.searchsorted(starts, edge))
        h, owner = words.hashes(), words.text_of
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        both = np.where(h[pair] == h[pair + 1], _AGAIN, mix(h[pair] * _PAIR + h[pair + 1]))
        place = np.concatenate([h, both]) >> U64(64 - bits)
        key = np.concatenate([owner, owner[pair]]).astype(np.int64) << bits | place.astype(np.int64)
        key, count = np.unique(key, return_counts=True)
        owner = key >> bits
        length = np.sqrt(np.bincount(owner, count.astype(float) ** 2, minlength=to - at))
        yield at, to, key & ((1 << bits) - 1), count / length[owner], np.searchsorted(owner, np.arange(to - at + 1))


class Ftrl:
    """Follow the regularised leader, with a learning rate per feature."""

    def __init__(self, bits: int):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, places: np.ndarray) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, places: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(places)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = (p - label) * values
        n = self.n[places]
        after = n + g * g
        self.z[places] += g - (np.sqrt(after) - np.sqrt(n)) / ALPHA * w
        self.n[places] = after


def _featurised(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, places, values, first in features(batch.column(2), bits):
                cuts = list(zip(first[:-1], first[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at),
                        batch.column(1).slice(at, to - at),
                        pa.array([places[a:b].astype(np.int32).tobytes() for a, b in cuts], pa.binary()),
                        pa.array([values[a:b].astype(np.float32).tobytes() for a, b in cuts], pa.binary()),
                    ],
                    names=["turn", "label", "places", "values"],
                )

    return run


def _trained(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for label, places, values in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                rows.append((np.frombuffer(places, np.int32), np.frombuffer(values, np.float32), float(label)))
        ftrl = Ftrl(bits)
        for _ in range(EPOCHS):
            for places, values, label in rows:
                # the constant is a feature of its own, always one
                ftrl.update(np.append(places, 1 << bits), np.append(values.astype(float), 1.0), label)
        weights = ftrl.weights(np.arange((1 << bits) + 1))
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: one id in five, by checksum."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = TRAINING_ROWS,
    bits: int = BITS,
) -> Model:
    """Fit to at most ``rows`` labelled documents that are not held out.

    Labels over 0.5 count as one; of several labels for an id their mean counts. Null labels and ids and
    labels without a document are no examples; null texts are empty ones. Without examples all scores are 0.5.
    """
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg((F.avg(F.col(label_col).cast("double")) > 0.5).cast("double").alias("label"))
        .where(~held_out(F.col("id")))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = (
        texts.join(F.broadcast(chosen), "id")
        .select(F.xxhash64("id", "text").alias("turn"), "label", "text")
        .mapInArrow(handing_back(_featurised(bits)), "turn long, label double, places binary, values binary")
    )
    made = found.repartition(1).sortWithinPartitions("turn").mapInArrow(handing_back(_trained(bits)), "weights binary").collect()
    weights = np.frombuffer(made[0][0]) if made else np.zeros((1 << bits) + 1)
    return Model(weights[:-1], float(weights[-1]))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col`` (double from 0 to 1, higher for better), which must be new.

    Only the text counts; a null text scores as an empty one. Rows, repeated ones too, and other columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.constant))
    at_text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            for at, to, places, values, first in features(batch.column(at_text)):
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(model.score(places, values, first))],
                    names=[*batch.schema.names, score_col],
                )

    return docs.mapInArrow(handing_back(run), T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))
