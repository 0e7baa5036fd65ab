"""Quality rules: counts of a text, and perplexity under an n-gram model of its language.

The model is counted from all documents of a language over the bytes of their
normalised texts (small ASCII letters, single spaces), smoothed by interpolated
modified Kneser-Ney, and kept as sorted arrays of n-gram keys.  A key is the
n-gram itself, its bytes packed into one number, so no two n-grams share a key.
A document is rejected where its base counts fail, or where its perplexity
lies outside the band of its language: more than ``lower`` quartile distances
below the first or ``upper`` above the third quartile of the log perplexities of
the texts of that language that passed the base rules.  The band is that of a
model in which each distinct text counts once, and in the quartiles it counts once
too: a large group of copies neither sets the band nor falls out of it for being
well known.  The quartile distance is taken as ``LEAST_APART`` at least, so a
language of few different texts has a band of some width.  ``log_perplexity`` is
under the model of all documents, copies counted each time.

Log probabilities are added up as whole multiples of ``2 ** -24``: equal texts of a
language have the same score, whatever stands beside them.

Defined results: a null text is empty and fails the base rules; a null language
is a language of its own; repeated rows count each time in ``log_perplexity``; in an
empty table there is nothing to count; input columns of any name are carried in a
struct.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.sketches import bit_filter, in_filter
from seriesmill.llm.text import (
    _SPACE,
    blocks,
    line_spans,
    lowered,
    mixed,
    span_hashes,
    sums,
    text_bytes,
    word_spans,
)
from seriesmill.llm.storage import written
from seriesmill.llm.tokens import forget

ORDER = 4
EDGE = 10  # stands before and after a text; white space inside is always a space
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
LOWER_WIDTH = 3.0
UPPER_WIDTH = 4.0
#: The least quartile distance that a band is made of, in nats a byte; the given tables have 0.022 to 0.035 at sf0.1.
LEAST_APART = 0.02
#: Log probabilities are added up in steps of this part, so that sums are exact.
_STEP = 2.0**-24
#: Rows of the models that one scoring pass sends to the tasks, 16 bytes each in each of two models.
MODEL_ROWS = 4_000_000
#: Bits of the set of repeated texts, as a power of two; a fuller set sends more texts through an exchange.
REPEATED_BITS = 24
#: Bands, one a language, that are broadcast to all tasks; more are joined by a shuffle.
BROADCAST_BANDS = 10_000
#: Distinct n-grams a task gathers before it hands them on.
GATHERED = 1_000_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def symbols(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all n-grams, n + 1 offsets of the rows in them); one n-gram a symbol and one for the end."""
    data = lowered(data)
    space = _SPACE[data]
    again = np.zeros(len(data), bool)
    again[1:] = space[1:] & space[:-1]
    again[offsets[:-1][offsets[:-1] < len(data)]] = False
    kept = np.where(space, np.uint8(32), data)[~again]
    lengths = sums(~again, offsets)
    firsts = np.concatenate([[0], np.cumsum(lengths + order)])
    padded = np.full(firsts[-1], EDGE, np.uint8)
    shift = firsts[:-1] + order - 1 - (np.cumsum(lengths) - lengths)
    padded[np.arange(len(kept)) + np.repeat(shift, lengths)] = kept
    keys = np.zeros(max(0, len(padded) - order + 1), np.uint64)
    for i in range(order):
        keys <<= np.uint64(8)
        keys |= padded[i : len(padded) - order + 1 + i]
    ends = np.concatenate([[0], np.cumsum(lengths + 1)])
    at = np.arange(ends[-1]) + np.repeat(firsts[:-1] - ends[:-1], lengths + 1)
    return keys[at], ends


def language(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def _merged(grams: list[np.ndarray], *counts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    every, inverse = np.unique(np.concatenate(grams), return_inverse=True)
    return every, *(np.bincount(inverse, np.concatenate(c)).astype(np.int64) for c in counts)


def gram_counts(docs: DataFrame, order: int, without: Broadcast | None = None) -> DataFrame:
    """(lang, gram, n, once) over all documents; tasks add up their own documents first.

    ``n`` counts a row as often as its column ``copies`` says, if there is one; ``once`` counts
    it once.  Rows whose column ``key`` shows in the set of bits ``without`` are left to others.
    """
    repeats = "copies" in docs.columns

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        gathered: dict[str, tuple[list, list, list]] = {}
        size = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, own in gathered.items():
                every, n, once = _merged(*own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(every)), pa.array(every.astype(np.int64)), pa.array(n), pa.array(once)],
                    names=["lang", "gram", "n", "once"],
                )
            gathered.clear()

        for block in blocks(batches, "text"):
            if without is not None:
                block = block.filter(pa.array(~in_filter(without.value, _keys(block))))
            keys, ends = symbols(*text_bytes(block.column("text")), order)
            langs = np.array(language(block.column("lang")), object)
            owner = np.repeat(langs, np.diff(ends)) if len(set(langs)) > 1 else None
            more = np.zeros(len(keys), np.int64)
            if repeats:
                more = np.repeat(block.column("copies").to_numpy() - 1, np.diff(ends))
            for lang in sorted(set(langs)):
                at = slice(None) if owner is None else owner == lang
                grams, once = np.unique(keys[at], return_counts=True)
                n, again = once, more[at] > 0
                if again.any():
                    n = once + np.bincount(
                        np.searchsorted(grams, keys[at][again]), more[at][again], len(grams)
                    ).astype(np.int64)
                for x, new in zip(gathered.setdefault(lang, ([], [], [])), (grams, n, once)):
                    x.append(new)
                size += len(grams)
            if size > GATHERED:
                for lang, own in gathered.items():
                    gathered[lang] = tuple([x] for x in _merged(*own))
                size = sum(len(g[0][0]) for g in gathered.values())
                if size > GATHERED // 2:
                    yield from handed_on()
                    size = 0
        yield from handed_on()

    rows = docs.mapInArrow(count, "lang string, gram long, n long, once long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("once").alias("once"))


def _number(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def kneser_ney(counts: DataFrame, order: int) -> DataFrame:
    """(lang, size, gram, logp, logb): interpolated modified Kneser-Ney of all orders.

    ``logp`` belongs to the n-gram of ``size`` bytes; ``logb`` is the weight that
    the next lower order gets where this n-gram is the context, null where it
    never is one.  Lower orders count the different n-grams that end in theirs.
    """
    tables = {order: counts}
    for size in range(order - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1))
        shorter = tables[size + 1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n"))
        # Each order is stored: else every plan below holds all longer orders again, more than a small driver has room for.
        tables[size] = written(shorter, f"grams-{size}")
    below, levels, weights = None, {}, {}
    for size in range(1, order + 1):
        of = [_number(F.col("n") == i).alias(f"t{i}") for i in (1, 2, 3, 4)]
        y = F.try_divide("t1", F.col("t1") + 2 * F.col("t2"))
        found = tables[size].groupBy("lang").agg(*of)

        def discount(i: int) -> Column:
            more = i - (i + 1) * y * F.try_divide(f"t{i + 1}", f"t{i}")
            return F.coalesce(F.when((more > 0) & (more < i), more), F.lit(0.5 * i)).alias(f"d{i}")

        rows = tables[size].join(found.select("lang", *(discount(i) for i in (1, 2, 3))), "lang")
        rows = rows.withColumn("context", F.shiftright("gram", 8)).withColumn(
            "d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        )
        contexts = written(
            rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("b")),
            f"contexts-{size}",
        )
        rows = rows.join(contexts, ["lang", "context"])
        own = (F.col("n") - F.col("d")) / F.col("total")
        if below is None:
            level = rows.select("lang", "gram", (own + F.col("b") / 256).alias("p"))
        else:
            lower = F.col("gram").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1))
            level = rows.withColumn("lower", lower).join(
                below.select("lang", F.col("gram").alias("lower"), F.col("p").alias("q")), ["lang", "lower"]
            ).select("lang", "gram", (own + F.col("b") * F.col("q")).alias("p"))
        below = levels[size] = written(level, f"model-{size}")
        weights[size - 1] = contexts.select("lang", F.col("context").alias("gram"), "b")
    out = None
    for size in range(order + 1):
        rows = levels.get(size)
        if rows is None:
            rows = weights[0].select("lang", "gram", F.lit(1 / 256).alias("p"), "b")
        elif size in weights:
            rows = rows.join(weights[size], ["lang", "gram"], "full")
        else:
            rows = rows.withColumn("b", F.lit(None).cast("double"))
        rows = rows.select(
            "lang", F.lit(size).alias("size"), "gram",
            F.log("p").cast("float").alias("logp"), F.log("b").cast("float").alias("logb"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


class Model:
    """Sorted key arrays of one language."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels
        self.order = len(levels) - 1

    def _find(self, keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        grams = self.levels[size][0]
        at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
        return at, grams[at] == keys

    def log_probability(self, keys: np.ndarray, size: int | None = None) -> np.ndarray:
        """Of each n-gram's last symbol after the others; unseen ones back off."""
        size = self.order if size is None else size
        if size == 0:
            return np.full(len(keys), np.log(1 / 256))
        at, there = self._find(keys, size)
        out = np.where(there, self.levels[size][1][at], 0).astype(np.float64)
        there &= ~np.isnan(out)
        if not there.all():
            rest = keys[~there]
            mask = np.uint64((1 << 8 * (size - 1)) - 1)
            lower = self.log_probability(rest & mask, size - 1)
            context = rest >> np.uint64(8) if size > 1 else np.zeros(len(rest), np.uint64)
            at, seen = self._find(context, size - 1)
            weight = np.where(seen, self.levels[size - 1][2][at], 0)
            out[~there] = lower + np.where(np.isnan(weight), 0, weight)
        return out


def log_probabilities(models: tuple[Model, ...], keys: np.ndarray) -> list[np.ndarray]:
    """Of each n-gram under models of the same n-grams."""
    order = models[0].order
    at, there = models[0]._find(keys, order)
    if there.all():
        return [m.levels[order][1][at].astype(np.float64) for m in models]
    return [m.log_probability(keys) for m in models]


def gather(model: DataFrame, langs: list[str], order: int) -> dict[str, Model]:
    """The models of some languages on the driver; the caller has checked their size."""
    table = model.filter(F.col("lang").isin(langs)).orderBy("lang", "size", "gram").toArrow()
    names = np.array(table.column("lang").to_pylist(), object)
    sizes, grams = table.column("size").to_numpy(), table.column("gram").to_numpy().astype(np.uint64)
    logp, logb = (table.column(c).to_numpy().astype(np.float32) for c in ("logp", "logb"))
    out = {}
    for lang in langs:
        own = names == lang
        levels = [own & (sizes == size) for size in range(order + 1)]
        out[lang] = Model([(grams[m], logp[m], logb[m]) for m in levels])
    return out


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of every row of a block."""
    rows_in = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets)
    inside = ~_SPACE[data]
    letter = (data & 0xC0) != 0x80
    hashes = span_hashes(data, starts, ends)
    repeated = np.zeros(len(rows), bool)
    if len(rows) > 2:
        whole = np.flatnonzero(rows[:-2] == rows[2:])
        threes = mixed(hashes[whole] + mixed(hashes[whole + 1] + mixed(hashes[whole + 2])))
        threes = mixed(threes + rows[whole].astype(np.uint64))
        _, inverse, times = np.unique(threes, return_inverse=True, return_counts=True)
        for i in range(3):
            repeated[whole[times[inverse] > 1] + i] = True
    words = np.concatenate([[0], np.cumsum(inside)])
    first, last, owner = line_spans(data, offsets)
    full = words[last] > words[first]
    first, last, owner = first[full], last[full], owner[full]
    lines = mixed(span_hashes(data, first, last) + mixed(owner.astype(np.uint64)))
    _, at = np.unique(lines, return_index=True)
    later = np.ones(len(lines), bool)
    later[at] = False
    symbol = np.isin(data, np.frombuffer(SYMBOLS, np.uint8))
    return {
        "n_words": np.bincount(rows, minlength=rows_in),
        "word_chars": sums(inside & letter, offsets),
        "n_symbols": sums(symbol, offsets),
        "n_dup_lines": np.bincount(owner[later], minlength=rows_in),
        "n_repeat_words": np.bincount(rows[repeated], minlength=rows_in),
    }


def scored(texts: DataFrame, models: dict[str, tuple[Model, Model]], order: int) -> DataFrame:
    """``row``, ``lang`` and ``tkey`` with the counts, the n-grams scored and their log probability under both models.

    The models of a language hold the same n-grams, so one search serves both.  Equal
    texts get equal scores wherever they lie, since sums are sums of whole steps.
    """
    sent = texts.sparkSession.sparkContext.broadcast(models)
    kept = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in ("row", "lang", "tkey"))
    schema = kept + ", " + ", ".join(f"{c} long" for c in [*COUNTS, "n_grams"])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            data, offsets = text_bytes(block.column("text"))
            counts = text_counts(data, offsets)
            keys, ends = symbols(data, offsets, order)
            langs = np.array(language(block.column("lang")), object)
            steps = np.zeros((2, len(keys)), np.int64)
            owner = np.repeat(langs, np.diff(ends)) if len(set(langs)) > 1 else None
            for lang in set(langs):
                own = slice(None) if owner is None else owner == lang
                for i, logp in enumerate(log_probabilities(sent.value[lang], keys[own])):
                    steps[i, own] = np.rint(logp / _STEP)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("row"),
                    pa.array(langs.tolist(), pa.string()),
                    block.column("tkey"),
                    *(pa.array(counts[c].astype(np.int64)) for c in COUNTS),
                    pa.array(np.diff(ends).astype(np.int64)),
                    *(pa.array(sums(x, ends) * _STEP) for x in steps),
                ],
                names=["row", "lang", "tkey", *COUNTS, "n_grams", "logp", "logp_once"],
            )

    return texts.select("row", "lang", "tkey", "text").mapInArrow(score, f"{schema}, logp double, logp_once double")


def quality(
    docs: DataFrame,
    columns: list[str] | None = None,
    text: str = "text",
    lang: str = "lang",
    order: int = ORDER,
    lower: float = LOWER_WIDTH,
    upper: float = UPPER_WIDTH,
) -> DataFrame:
    """(row, counts, log_perplexity, base_failed, kept); ``row`` holds the input's columns.

    Every text is counted and scored where it lies.  Only texts that occur several
    times are brought together, to be counted as one with its copies, and digests, to
    place the bands by distinct texts.  Languages are scored together as long as
    their models stay below ``MODEL_ROWS`` rows, and in further passes beyond that.
    """
    given = docs.select(
        F.struct(*[F.col(c) for c in columns or docs.columns]).alias("row"),
        F.col(text).alias("text"),
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("tkey"),
    )
    counts = written(_all_grams(given, order), "gram-counts")
    model = written(kneser_ney(counts, order), "model")
    once = written(kneser_ney(counts.select("lang", "gram", F.col("once").alias("n")), order), "model-once")
    passes: list[list[str]] = []
    room = 0
    for r in model.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").toLocalIterator():
        if not passes or r["n"] > room:
            passes.append([])
            room = MODEL_ROWS
        passes[-1].append(r["lang"])
        room -= r["n"]
    parts = []
    for langs in passes:
        all_rows, each_once = gather(model, langs, order), gather(once, langs, order)
        own = given.filter(F.col("lang").isin(langs)) if len(passes) > 1 else given
        parts.append(scored(own, {x: (all_rows[x], each_once[x]) for x in langs}, order))
    every = reduce(DataFrame.unionByName, parts or [scored(given, {}, order)])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    every = written(
        every.withColumn("log_perplexity", -F.col("logp") / F.col("n_grams"))
        .withColumn("once", -F.col("logp_once") / F.col("n_grams"))
        .withColumn("base_failed", failed),
        "scored",
    )
    quartiles = F.percentile_approx("once", [0.25, 0.75], 10_000)
    distinct = every.filter(~F.col("base_failed")).select("lang", "tkey", "once").distinct()
    bands = distinct.groupBy("lang").agg(quartiles.alias("q"))
    apart = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST_APART))
    bands = written(
        bands.select(
            "lang", (F.col("q")[0] - lower * apart).alias("lower"), (F.col("q")[1] + upper * apart).alias("upper")
        ),
        "bands",
    )
    few = bands.limit(BROADCAST_BANDS + 1).count() <= BROADCAST_BANDS
    inside = F.col("once").between(F.col("lower"), F.col("upper"))
    return every.join(F.broadcast(bands) if few else bands, "lang", "left").select(
        "row", *COUNTS, "log_perplexity", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def _keys(block: pa.RecordBatch) -> np.ndarray:
    return block.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _all_grams(given: DataFrame, order: int) -> DataFrame:
    """``gram_counts`` of all texts, where each distinct text of a language counts once in ``once``.

    A set of bits tells which digests may occur again: texts that certainly occur once
    are counted where they lie, the others meet by digest first.
    """
    keyed = given.select("text", "lang", "tkey", F.xxhash64("lang", "tkey").alias("key"))
    again = keyed.groupBy("lang", "tkey", "key").agg(F.count("*").alias("n")).filter("n > 1")
    sent = given.sparkSession.sparkContext.broadcast(bit_filter(again, "key", REPEATED_BITS))

    def repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for block in blocks(batches, "text"):
            yield block.filter(pa.array(in_filter(sent.value, _keys(block))))

    met = (
        keyed.mapInArrow(repeated, keyed.schema)
        .groupBy("lang", "tkey")
        .agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    )
    each = gram_counts(keyed, order, sent).unionByName(gram_counts(met, order))
    return each.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("once").alias("once"))


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their own columns."""
    return quality(docs, **options).filter("kept").select("row.*")
