"""Text quality by compression: which of two dictionaries makes a text smaller.

One zstandard dictionary is trained on texts labelled good and one on texts labelled
bad.  A text is cut into even pieces, so that a long text does not become its own
dictionary, and all its pieces are compressed with either; the difference of the
two sizes over their sum is its quality difference.  A logistic curve, fitted to
labelled texts that no dictionary has seen, turns it into the probability of label 1.

Learning takes at most ``sample`` texts of each label, a third of them for the curve:
those of the smallest text hash, whole, each distinct text once, none longer than
``longest`` characters.  That bounds what the driver holds, whatever the corpus; the curve
is weighted to the labels' true shares, which are counted over all labelled rows.
Scoring is one pass over all texts without an exchange.

Odd rows.  A null text is empty and gets the score of difference 0.  An id with both
labels, or with neither 0 nor 1, is not learnt from, nor is a text that has both.  With
labels of one kind, or none, every text gets the share of label 1, 0.5 for none.
Repeated rows are scored each.  A row without an id is never held out and has no label.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 3000
LONGEST = 32_768
PIECE_BYTES = 1024
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the curve; ``prior`` alone where there was nothing to tell apart."""

    good: bytes
    bad: bytes
    slope: float
    offset: float
    prior: float | None = None


def held_out(id: str = "doc_id", folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Whether labels of this id are kept back from learning."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % folds == fold, F.lit(False))


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_AUTO  # trained, or plain content where there was too little to train on
    own = zstandard.ZstdCompressionDict(dictionary, dict_type=kind)
    own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """All of ``data`` in pieces of nearly equal length; empty data is one empty piece."""
    count = max(1, -(-len(data) // size))
    width = max(1, -(-len(data) // count))
    return (data[i : i + width] for i in range(0, max(1, len(data)), width))


def difference(data: bytes, good: bytes, bad: bytes) -> float:
    """(bad - good) / (bad + good) of the compressed sizes: above 0 where the good dictionary helps more."""
    by_good, by_bad = _compressor(good), _compressor(bad)
    a = b = 0
    for piece in pieces(data):
        a += len(by_good.compress(piece))
        b += len(by_bad.compress(piece))
    return (b - a) / (b + a)


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of at most ``size`` bytes; the texts' own ends where they are too few to train on."""
    samples = [piece for text in texts for piece in pieces(text) if piece]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        return (b"\n".join(texts) or b"\n")[-size:]


def curve(differences: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the weighted logistic curve, by Newton steps with a slight pull to 0."""
    scale = max(float(np.abs(differences).max(initial=0)), 1e-9)
    x = np.column_stack([differences / scale, np.ones(len(differences))])
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ at)))
        slope = x.T @ (weights * (labels - p)) - 1e-3 * at
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0] / scale), float(at[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    longest: int = LONGEST,
) -> Model:
    """A model of ``labels`` over the ids that are not held out."""
    own = (
        labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id))
        .groupBy(F.col(id).alias("id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .filter("label = other")
    )
    shares = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    if len(shares) < 2:
        return Model(b"", b"", 0.0, 0.0, prior=float(next(iter(shares), 0.5)))
    # Some texts are too long, repeated or missing: twice as many ids as texts are looked at.
    by_label = [
        own.filter(F.col("label") == kind).orderBy(F.xxhash64(F.col("id")), "id").limit(2 * sample) for kind in (0, 1)
    ]
    asked = F.broadcast(by_label[0].unionByName(by_label[1]).select("id", "label"))
    texts = (
        docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
        .join(asked, "id")
        .filter(F.length("text") <= longest)
        .groupBy("text")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
    )
    taken = {
        kind: [
            r["text"].encode()
            for r in texts.filter(F.col("label") == kind).orderBy(F.xxhash64("text"), "text").limit(sample).collect()
        ]
        for kind in (0, 1)
    }
    return learn(taken, shares)


def learn(texts: dict[int, list[bytes]], shares: dict[int, int]) -> Model:
    """A model of some texts by label, whose labels have ``shares`` among all."""
    seen = {kind: [t for i, t in enumerate(own) if i % 3 or len(own) < 3] for kind, own in texts.items()}
    fresh = {kind: own[::3] for kind, own in texts.items()}
    if not all(fresh.values()):
        return Model(b"", b"", 0.0, 0.0, prior=shares[1] / sum(shares.values()))
    good, bad = dictionary(seen[1]), dictionary(seen[0])
    found = [(difference(t, good, bad), kind) for kind, own in fresh.items() for t in own]
    x, y = (np.array(c, float) for c in zip(*found, strict=True))
    weights = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum()) * len(y) / sum(shares.values())
    slope, offset = curve(x, y, weights)
    return Model(good, bad, slope, offset)


def score(data: bytes, model: Model) -> float:
    if model.prior is not None:
        return model.prior
    return float(1 / (1 + np.exp(-np.clip(model.slope * difference(data, model.good, model.bad) + model.offset, -30, 30))))


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None, *, text: str = "text") -> DataFrame:
    """(row, score, predicted): every row's kept columns as a struct, and its score from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([score((t.as_py() or "").encode(), sent.value) for t in batch.column(1)], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=["row", "score", "predicted"],
            )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, score double, predicted int")
