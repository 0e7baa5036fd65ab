"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words (ASCII letters in lower case; a
shorter text is one shingle), weighted by their count in the text times an
inverse document frequency between 1 and 2: ``1 + log(N / df) / log(N)`` with
the frequencies of all documents, counted by hash cell in a table of fixed
size.  Improved consistent weighted sampling draws ``SAMPLES`` samples a
text; two texts agree on a sample with a probability equal to their weighted
Jaccard similarity.  Bands are sets of samples; texts that agree on a band
meet, and their similarity is computed on the whole texts before it counts.

Equal texts are one text throughout.  Within a band's bucket each text is
compared with the bucket's hub.  Texts that are then outside their hub's class
go through an exact prefix join with the texts of such buckets.  So a group of
thousands of copies costs a comparison each, no pairs of a bucket are listed,
and no link between texts of a bucket is left out unless its ends are in one
class already.

Defined results: a null text is empty; texts without words are alike only if
equal; rows are told apart by ``doc_id`` and text, and repeated rows get the
same class; an empty table gives an empty result; other columns are kept by
``one_of_each``, whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import sketches
from seriesmill.llm.text import blocks, lowered, mixed, span_hashes, text_bytes, word_spans
from seriesmill.llm.storage import written

WORDS = 5
THRESHOLD = 0.8
SAMPLES = 36
BANDS = 30
ROWS = 5
#: Texts of similarity 0.8 agree on fewer samples than this once in ten million times.
LEAST_AGREEMENT = 16
COUNT_BITS = 20
_STEPS = 1 << 16


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every shingle; a text of fewer words is one shingle, one without words none."""
    starts, ends, rows = word_spans(data, offsets)
    hashes = span_hashes(lowered(data), starts, ends)
    count = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    number = np.maximum(count - words + 1, (count > 0).astype(np.int64))
    row = np.repeat(np.arange(len(count)), number)
    at = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + first[row]
    end = first[row] + count[row]
    total = np.zeros(len(row), np.uint64)
    for i in range(words):
        there = at + i < end
        own = hashes[np.minimum(at + i, max(0, len(hashes) - 1))] if len(hashes) else total
        total = mixed(total * np.uint64(3) + np.where(there, own, np.uint64(0)))
    return total, row


def features(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted distinct shingle hashes, counts) of every row."""
    hashes, row = shingles(data, offsets, words)
    cuts = np.searchsorted(row, np.arange(len(offsets)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield np.unique(hashes[a:b], return_counts=True)


def document_counts(given: DataFrame, words: int, bits: int) -> np.ndarray:
    """How many documents hold a shingle of each hash cell."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << bits, np.uint32)
        for block in blocks(batches, "text"):
            for every, _ in features(*text_bytes(block.column("text")), words):
                np.add.at(cells, every >> np.uint64(64 - bits), 1)
        yield from sketches.sliced(cells)

    rows = given.select("text").mapInArrow(count, sketches.SCHEMA)
    return sketches.collected(rows, 1 << bits, "u4", np.add)


def inverse_frequencies(counts: np.ndarray, documents: int) -> np.ndarray:
    share = np.log(max(2, documents) / np.clip(counts, 1, max(2, documents)))
    return (1 + share / np.log(max(2, documents))).astype(np.float32)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1), their logarithms, and of the uniform distribution."""
    u = (np.arange(_STEPS) + 0.5) / _STEPS
    low, high = np.zeros(_STEPS), np.full(_STEPS, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < u
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    gamma = ((low + high) / 2).astype(np.float32)
    return gamma, np.log(gamma).astype(np.float32), u.astype(np.float32)


@lru_cache(maxsize=4)
def _multipliers(samples: int) -> np.ndarray:
    draw = random.Random(20)
    return np.array([draw.getrandbits(64) | 1 for _ in range(samples)], np.uint64)


def weighted_samples(hashes: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """The text's samples: for each, a hash of the chosen shingle and its level.

    For sample k and shingle s with weight S: r and c follow Gamma(2, 1), b is
    uniform, all three fixed by (k, s); t = floor(ln S / r + b); the shingle with
    the least ln c - r (t - b + 1) is chosen, and (s, t) is the sample.
    """
    gamma, log_gamma, uniform = _tables()
    by = _multipliers(samples)
    best = np.full(samples, np.inf, np.float32)
    out = np.zeros(samples, np.uint64)
    step = 4096  # shingles at once
    for low in range(0, len(hashes), step):
        part = hashes[low : low + step]
        # Three fields of 16 bits of one product pick the three quantiles.
        drawn = part[:, None] * by[None, :]
        r = gamma[(drawn >> np.uint64(48)).astype(np.int32)]
        log_c = log_gamma[((drawn >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int32)]
        b = uniform[((drawn >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int32)]
        t = np.floor(np.log(weights[low : low + step])[:, None] / r + b)
        key = log_c - r * (t - b + 1)
        at = np.argmin(key, axis=0)
        columns = np.arange(samples)
        least = key[at, columns]
        better = least < best
        best = np.where(better, least, best)
        level = t[at, columns].astype(np.int64).astype(np.uint64)
        out = np.where(better, mixed(part[at] + mixed(level)), out)
    return out


@lru_cache(maxsize=4)
def band_members(samples: int, bands: int, rows: int) -> np.ndarray:
    """The samples of each band; every sample is in about as many bands as any other."""
    draw = random.Random(36)
    out: list[list[int]] = []
    deck: list[int] = []
    while len(out) < bands:
        if len(deck) < rows:
            rest = [i for i in range(samples) if i not in deck]
            draw.shuffle(rest)
            deck += rest
        out.append(sorted(deck[:rows]))
        deck = deck[rows:]
    return np.array(out)


SIGNED = "doc_id long, tkey binary, empty boolean, bands array<long>, signature binary"


def signed(given: DataFrame, idf: np.ndarray, words: int) -> DataFrame:
    """Every row with its samples and band keys."""
    sent = given.sparkSession.sparkContext.broadcast(idf)
    bits = len(idf).bit_length() - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = band_members(SAMPLES, BANDS, ROWS)
        salt = mixed(np.arange(BANDS, dtype=np.uint64))
        for block in blocks(batches, "text"):
            rows = []
            for hashes, n in features(*text_bytes(block.column("text")), words):
                if not len(hashes):
                    rows.append((True, None, None))
                    continue
                weights = n * sent.value[hashes >> np.uint64(64 - bits)]
                drawn = weighted_samples(hashes, weights, SAMPLES)
                key = salt
                for i in range(ROWS):
                    key = mixed(key + drawn[members[:, i]])
                short = (drawn >> np.uint64(32)).astype("<u4")
                rows.append((False, key.view(np.int64), short.tobytes()))
            empty, bands, signature = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"), block.column("tkey"), pa.array(empty, pa.bool_()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(signature, pa.binary()),
                ],
                names=["doc_id", "tkey", "empty", "bands", "signature"],
            )

    return given.mapInArrow(run, SIGNED)


def agreeing(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b, a_signature, b_signature) that agree on enough samples."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1)
                for c in ("a_signature", "b_signature")
            )
            yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= least))

    return pairs.select("a", "b", "a_signature", "b_signature").mapInArrow(run, "a binary, b binary")


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts' shingles."""
    bits = len(idf).bit_length() - 1
    _, at, to = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    own = idf[x[0] >> np.uint64(64 - bits)].astype(np.float64)
    least = (np.minimum(x[1][at], y[1][to]) * own[at]).sum()
    total = (x[1] * own).sum() + (y[1] * idf[y[0] >> np.uint64(64 - bits)].astype(np.float64)).sum()
    return float(least / (total - least)) if total > least else 1.0


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar; pairs of one ``a`` lie together and share its shingles."""
    sent = pairs.sparkSession.sparkContext.broadcast(idf)
    a = texts.select(F.col("tkey").alias("a"), F.col("text").alias("a_text"))
    b = texts.select(F.col("tkey").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(b, "b").join(a, "a")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for block in blocks(batches, "b_text"):
            keys = block.column("a").to_pylist()
            firsts = block.column("a_text")
            good = []
            for i, y in enumerate(features(*text_bytes(block.column("b_text")), words)):
                if keys[i] != last:
                    last, own = keys[i], next(features(*text_bytes(firsts.slice(i, 1)), words))
                good.append(similarity(own, y, sent.value) >= threshold)
            yield block.select(["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(run, "a binary, b binary")


def meeting(near: DataFrame, idf: np.ndarray, words: int, threshold: float) -> DataFrame:
    """Pairs (a, b) of texts of different classes, one of them ``out``, that can be similar.

    An exact prefix join: shingles in one order, the rarest first; two texts of
    similarity t share a shingle in the first 1 - t of their weights, and what
    follows that shingle must be heavy enough in both.
    """
    sent = near.sparkSession.sparkContext.broadcast(idf)
    bits = len(idf).bit_length() - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            of, hashes, left, total = [], [], [], []
            for i, (every, n) in enumerate(features(*text_bytes(block.column("text")), words)):
                own = sent.value[every >> np.uint64(64 - bits)]
                order = np.lexsort((every, -own))
                weight = (n * own)[order].astype(np.float64)
                after = weight.sum() - np.cumsum(weight) + weight
                used = after >= threshold * weight.sum() * (1 - 1e-9)
                of.append(np.full(int(used.sum()), i))
                hashes.append(every[order][used])
                left.append(after[used])
                total.append(np.full(int(used.sum()), weight.sum()))
            at = pa.array(np.concatenate(of))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(hashes).view(np.int64)),
                    *(block.column(c).take(at) for c in ("tkey", "class", "out")),
                    pa.array(np.concatenate(left)),
                    pa.array(np.concatenate(total)),
                ],
                names=["shingle", "tkey", "class", "out", "rest", "total"],
            )

    entries = near.select("tkey", "class", "out", "text").mapInArrow(
        run, "shingle long, tkey binary, class binary, out boolean, rest double, total double"
    )
    x, y = (
        entries.select("shingle", *(F.col(c).alias(f"{side}_{c}") for c in ("tkey", "class", "out", "rest", "total")))
        for side in "xy"
    )
    heavy = F.least("x_rest", "y_rest") >= threshold / (1 + threshold) * (1 - 1e-9) * (F.col("x_total") + F.col("y_total"))
    return (
        x.join(y, "shingle")
        .filter((F.col("x_tkey") < F.col("y_tkey")) & (F.col("x_class") != F.col("y_class")))
        .filter((F.col("x_out") | F.col("y_out")) & heavy)
        .select(F.col("x_tkey").alias("a"), F.col("y_tkey").alias("b"))
        .distinct()
    )


def classes(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(tkey, class): ``labels`` with the classes that ``links`` of (a, b) join made one.

    Each round takes the least class among a text's neighbours and then the
    class of that class, so the rounds grow with the logarithm of the longest
    chain.  Rounds work on classes that a link crosses alone, and are stored.
    """
    spark = links.sparkSession
    ends = links.join(labels.select(F.col("tkey").alias("a"), F.col("class").alias("x")), "a").join(
        labels.select(F.col("tkey").alias("b"), F.col("class").alias("y")), "b"
    )
    edges = written(ends.filter("x <> y").select("x", "y").distinct(), "class-links")
    both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    state = written(both.groupBy(F.col("x").alias("old")).agg(F.least(F.first("x"), F.min("y")).alias("new")), "class-round")
    while True:
        near = both.join(state.select(F.col("old").alias("y"), F.col("new").alias("of_y")), "y")
        least = near.groupBy(F.col("x").alias("old")).agg(F.min("of_y").alias("near"))
        step = state.join(least, "old").select("old", F.least("new", "near").alias("new"), F.col("new").alias("was"))
        jump = step.select(F.col("old").alias("new"), F.col("new").alias("beyond"))
        step = step.join(jump, "new", "left").select("old", F.least("new", "beyond").alias("new"), "was")
        step = written(step, "class-round")
        if step.filter("new <> was").isEmpty():
            break
        state = step.select("old", "new")
    return written(
        labels.join(state.select(F.col("old").alias("class"), "new"), "class", "left").select(
            "tkey", F.coalesce("new", "class").alias("class")
        ),
        "classes",
    )


def text_classes(
    given: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, bits: int = COUNT_BITS
) -> tuple[DataFrame, DataFrame]:
    """((doc_id, tkey) of all rows, (tkey, class) of the texts that have a link).

    ``given`` holds doc_id, tkey (a digest of the text) and text.
    """
    idf = inverse_frequencies(document_counts(given, words, bits), given.count())
    rows = written(signed(given, idf, words), "signed")
    texts = rows.filter("not empty").groupBy("tkey").agg(
        F.first("bands").alias("bands"), F.first("signature").alias("signature")
    )
    entries = texts.select("tkey", F.posexplode("bands").alias("band", "key"))
    sizes = entries.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(entries.join(sizes, ["band", "key"]).select("band", "key", "tkey", "n"), "buckets")
    # A bucket's hub is the text that meets most others over all bands: of a group of copies
    # that is one near its middle, which nearly all of them are like.
    met = members.groupBy("tkey").agg(F.struct(F.sum("n").alias("met"), F.first("tkey").alias("tkey")).alias("rank"))
    hubs = members.join(met, "tkey").groupBy("band", "key").agg(F.max("rank").alias("hub"))
    members = written(
        members.join(hubs, ["band", "key"]).select("band", "key", "tkey", F.col("hub.tkey").alias("hub")), "buckets"
    )
    signatures = written(
        texts.select("tkey", "signature").join(members.select("tkey").distinct(), "tkey"), "signatures"
    )
    wanted = written(
        given.select("tkey", "text").join(signatures.select("tkey"), "tkey").groupBy("tkey").agg(F.first("text").alias("text")),
        "near-texts",
    )

    def compared(pairs: DataFrame) -> DataFrame:
        a = signatures.select(F.col("tkey").alias("a"), F.col("signature").alias("a_signature"))
        b = signatures.select(F.col("tkey").alias("b"), F.col("signature").alias("b_signature"))
        close = written(agreeing(pairs.distinct().join(b, "b").join(a, "a"), LEAST_AGREEMENT), "near-pairs")
        return written(verified(close, wanted, idf, words, threshold), "links")

    first = compared(
        members.filter("tkey <> hub").select(
            F.least("tkey", "hub").alias("a"), F.greatest("tkey", "hub").alias("b")
        )
    )
    labels = classes(first, signatures.select("tkey", F.col("tkey").alias("class")))
    # What is left: texts outside their hub's class, against the texts of buckets with such texts.
    labelled = members.join(labels, "tkey").join(
        labels.select(F.col("tkey").alias("hub"), F.col("class").alias("hub_class")), "hub"
    )
    outside = written(labelled.filter("class <> hub_class").select("band", "key", "tkey", "class"), "outside")
    partners = members.join(outside.select("band", "key").distinct(), ["band", "key"], "left_semi").select("tkey").distinct()
    near = written(
        partners.join(labels, "tkey")
        .join(outside.select("tkey", F.lit(True).alias("out")).distinct(), "tkey", "left")
        .join(wanted, "tkey"),
        "partners",
    )
    rest = meeting(near, idf, words, threshold)
    labels = classes(compared(rest), labels)
    return rows.select("doc_id", "tkey"), labels


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """(doc_id, class_id) of every row: the least ``doc_id`` of the rows that links join."""
    given = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("tkey"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows, labels = text_classes(given, **options)
    rows = rows.join(labels, "tkey", "left").withColumn("class", F.coalesce("class", "tkey"))
    rows = written(rows.select("doc_id", "tkey", "class"), "classed")
    least = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(least, "class").select("doc_id", "class_id", "class_size", "tkey")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The document of the least ``doc_id`` of every class, with its own columns."""
    found = near_duplicates(docs, text, key, **options)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id", "tkey", "class_id")
    # Of rows with one doc_id the one with the least digest stays.
    kept = kept.groupBy("class_id").agg(F.min(F.struct("doc_id", "tkey")).alias("one")).select("one.*")
    given = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("k"),
        F.col(key).isNull().alias("none"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("tkey"),
    )
    kept = kept.select(F.coalesce("doc_id", F.lit(0)).alias("k"), F.col("doc_id").isNull().alias("none"), "tkey").distinct()
    return given.join(kept, ["k", "none", "tkey"], "left_semi").select("row.*")
