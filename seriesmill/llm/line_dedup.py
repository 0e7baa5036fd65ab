"""Line dedup by an exact set-similarity join.

A line is the set of its words (ASCII letters in lower case).  The words of every
line are put in one order for the whole corpus, rarest first; two lines of
Jaccard similarity ``threshold`` or more then share a word in their prefixes.
Lines meet on prefix words, pass the length and positional filters and a bitmap
bound on the words they don't share, and are verified on their whole sets.  A
line goes if an earlier line is as similar; earlier is by ``doc_id``, then by
line.  Similarity is judged on the input, not on what is left.

Equal sets are joined once for all their copies, so a line that half the corpus
repeats is one row in the join.  Rarity comes from a table of counts by word
hash, of fixed size; two words in one cell only make the order less sharp,
never the result less exact.

Lines of very few words meet no other set but their own; their copies go by digest,
without the join.

Defined results: a null text has no lines and stays null; lines without a word, or of
fewer than ``min_words`` words if asked for, stay; rows with equal ``doc_id`` and text count as one
document, and those with equal ``doc_id`` and other texts follow each other by
a hash of the text; null ``doc_id`` comes first; an empty table stays empty;
every other column is kept, whatever its name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm import sketches
from seriesmill.llm.text import blocks, line_spans, lowered, mixed, span_hashes, text_bytes, word_spans
from seriesmill.llm.storage import release, written
from seriesmill.session import remove, written_at

THRESHOLD = 0.8
MIN_WORDS = 1
#: Cells of the count table: 2 ** 22, four megabytes when sent to the tasks.
COUNT_BITS = 22
FILTER_BITS = 26
#: Longs in the wide bitmap of a set, which tells sets of some hundred words apart.
WIDE = 8
LINES = "doc_id long, tkey long, line int, s1 long, s2 long"
#: Longs in the bitmap that goes with every prefix word of a set.
NARROW = 2
ENTRIES = ", ".join(["token int, s1 long", *(f"v{i} long" for i in range(NARROW)), "n int, at int, before int"])


_LINE_BITS = 20


def _order(line: np.ndarray, level: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """The order by line, level (a byte) and hash; ``line`` does not descend.

    One number holds line, level and the upper bits of the hash; where two
    different hashes tie on it, and where lines are too many, all keys are used.
    """
    if len(line) and line[-1] < 1 << _LINE_BITS:
        key = hashes >> np.uint64(_LINE_BITS)
        if level is not None:
            key = (key >> np.uint64(8)) | (level.astype(np.uint64) << np.uint64(56 - _LINE_BITS))
        key |= line.astype(np.uint64) << np.uint64(64 - _LINE_BITS)
        order = np.argsort(key)
        key, own = key[order], hashes[order]
        if not ((key[1:] == key[:-1]) & (own[1:] != own[:-1])).any():
            return order
    return np.lexsort((hashes, line) if level is None else (hashes, level, line))


class LineSets:
    """The distinct words of every line of a block, sorted by line and hash.

    ``line`` numbers the lines of the block, ``first`` cuts ``token`` by line.
    """

    def __init__(self, block: pa.RecordBatch, min_words: int):
        data, offsets = text_bytes(block.column("text"))
        starts, ends, rows = word_spans(data, offsets)
        hashes = span_hashes(lowered(data), starts, ends)
        self.starts, _, self.rows = line_spans(data, offsets)
        self.lines_of = np.bincount(self.rows, minlength=block.num_rows)
        # The last line that starts at or before a word is its line.
        line = np.searchsorted(self.starts, starts, "right") - 1
        words = np.bincount(line, minlength=len(self.starts))
        kept = words[line] >= min_words
        line, hashes = line[kept], hashes[kept]
        order = _order(line, None, hashes)
        line, hashes = line[order], hashes[order]
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])
        self.token, of = hashes[new], line[new]
        self.line, self.first, self.n = np.unique(of, return_index=True, return_counts=True)
        self.of = np.repeat(np.arange(len(self.line)), self.n)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each set."""
        out = []
        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
            scrambled = mixed(self.token ^ np.uint64(salt))
            out.append(np.add.reduceat(scrambled, self.first) if len(self.first) else scrambled)
        return out[0], out[1]

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, number in its text) of each line that has a set."""
        row = self.rows[self.line]
        return row, self.line - (np.cumsum(self.lines_of) - self.lines_of)[row]


def bitmaps(token: np.ndarray, first: np.ndarray, longs: int) -> list[np.ndarray]:
    """Sets, which ``first`` cuts from ``token``, as ``64 * longs`` bits: whether a bit's words are odd in number.

    A bit in which two sets differ stands for a word that only one of them has.  It says
    as much about long sets as about short ones, while a bit that tells whether there
    is any word is set in nearly all long ones.
    """
    place = mixed(token ^ np.uint64(0x9FB21C651E98DF25))
    part = (place >> np.uint64(6)) % np.uint64(longs)
    bit = np.uint64(1) << (place & np.uint64(63))
    out = [np.where(part == i, bit, np.uint64(0)) for i in range(longs)]
    return [np.bitwise_xor.reduceat(x, first) if len(first) else x for x in out]


def _apart(longs: list[str]) -> Column:
    """Words that two sets ``a`` and ``b`` do not share, at the least, by their bitmaps."""
    return sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in longs), F.lit(0))


def _needed(n: np.ndarray, threshold: float) -> np.ndarray:
    """Words that a set of n must share with any set as similar."""
    return np.ceil(threshold * n - 1e-9).astype(np.int64)


def counted_lines(given: DataFrame, min_words: int, bits: int) -> tuple[np.ndarray, DataFrame]:
    """(how many lines hold a word of each hash cell, one row a line with the digests of its set).

    Both come from one read of the texts; a task's counts stand in rows of their own.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << bits, np.uint32)
        names = [f.name for f in kinds]
        for block in blocks(batches, "text"):
            sets = LineSets(block, min_words)
            every, n = np.unique(sets.token >> np.uint64(64 - bits), return_counts=True)
            cells[every] += n.astype(np.uint32)
            row, number = sets.numbers()
            none = pa.nulls(len(row))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(row)),
                    block.column("tkey").take(pa.array(row)),
                    pa.array(number.astype(np.int32)),
                    *(pa.array(x.view(np.int64)) for x in sets.digests()),
                    none.cast(pa.int32()), none.cast(pa.binary()),
                ],
                names=names,
            )
        for part in sketches.sliced(cells):
            none = pa.nulls(part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(none.cast(f.type) for f in kinds[:5]), *part.columns], names=names
            )

    kinds = [
        pa.field("doc_id", pa.int64()), pa.field("tkey", pa.int64()), pa.field("line", pa.int32()),
        pa.field("s1", pa.int64()), pa.field("s2", pa.int64()), pa.field("slice", pa.int32()), pa.field("payload", pa.binary()),
    ]
    both = written(given.mapInArrow(run, f"{LINES}, {sketches.SCHEMA}"), "lines")
    counts = sketches.collected(both.filter("slice is not null").select("slice", "payload"), 1 << bits, "u4", np.add)
    return counts, both.filter("slice is null").drop("slice", "payload")


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte each, in the same order: exact to 128, then in steps of a sixteenth power of two."""
    high = 128 + np.log2(np.maximum(counts, 128) / 128) * 5
    return np.where(counts < 128, counts, np.minimum(high, 255)).astype(np.uint8)


def document_key(doc_id: Column, tkey: Column) -> Column:
    return tkey.bitwiseXOR(F.shiftleft(F.coalesce(doc_id, F.lit(0)), 20))


def place_key(place: str) -> Column:
    """A number for the place of a line, for filters."""
    doc_id, tkey, line = (F.col(f"{place}.{c}") for c in ("doc_id", "tkey", "line"))
    return document_key(doc_id, tkey).bitwiseXOR(F.shiftleft(line.cast("long"), 40))


def prefix_entries(
    given: DataFrame, places: np.ndarray, rarity: np.ndarray, threshold: float, min_words: int
) -> DataFrame:
    """The prefix words of the sets whose first lines are in a filter of ``place_key``.

    Words in whose cell the corpus has one line are left out: no other line can
    meet there.  Words are cut to 32 bits here; one more meeting does no harm.
    ``before`` is the prefix word before, null for a set's first that is not left out.
    """
    sent = given.sparkSession.sparkContext.broadcast((places, rarity))
    bits = len(rarity).bit_length() - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            sets = LineSets(block, min_words)
            row, number = sets.numbers()
            ids = pc.fill_null(block.column("doc_id"), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            tkey = block.column("tkey").to_numpy(zero_copy_only=False).astype(np.int64)
            key = tkey[row] ^ (number.astype(np.int64) << 40) ^ (ids[row] << 20)
            first = sketches.in_filter(sent.value[0], key.view(np.uint64))
            level = sent.value[1][sets.token >> np.uint64(64 - bits)]
            order = _order(sets.of, level, sets.token)
            token, level = sets.token[order], level[order]
            at = np.arange(len(token)) - np.repeat(sets.first, sets.n)
            # A set of few words is as similar to equal sets alone, and those are one set already.
            meets = first & (sets.n >= threshold * (sets.n + 1) - 1e-9)
            prefix = np.where(meets, sets.n - _needed(sets.n, threshold) + 1, 0)
            used = (at < np.repeat(prefix, sets.n)) & (level > 1)
            of = sets.of[used]
            narrow = bitmaps(sets.token, sets.first, NARROW)
            cut = (token[used] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            start = np.ones(len(of), bool)
            start[1:] = of[1:] != of[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cut),
                    pa.array(sets.digests()[0][of].view(np.int64)),
                    *(pa.array(x[of].view(np.int64)) for x in narrow),
                    pa.array(sets.n[of].astype(np.int32)),
                    pa.array(at[used].astype(np.int32)),
                    pa.array(np.roll(cut, 1), mask=start),
                ],
                names=[f.split()[0] for f in ENTRIES.split(", ")],
            )

    return given.mapInArrow(run, ENTRIES)


def meetings(entries: DataFrame, threshold: float) -> DataFrame:
    """(a_s1, b_s1) of different sets that pass every filter; ``a`` is not the larger one.

    A pair comes once for each run of prefix words that follow each other in both: where the
    words before are one, both have met there, at earlier places, which pass where later ones do.
    """
    narrow = [f"v{i}" for i in range(NARROW)]
    a, b = (
        entries.select("token", *(F.col(c).alias(f"{side}_{c}") for c in ["s1", *narrow, "n", "at", "before"])) for side in "ab"
    )
    both = F.col("a_n") + F.col("b_n")
    shared = F.ceil(F.lit(threshold / (1 + threshold)) * both - F.lit(1e-9))
    smaller = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_s1") < F.col("b_s1")))
    length = F.col("a_n") >= F.lit(threshold) * F.col("b_n") - F.lit(1e-9)
    position = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at")) >= shared
    apart = _apart(narrow) <= both - 2 * shared
    new = F.coalesce(F.col("a_before") != F.col("b_before"), F.lit(True))
    return a.join(b, "token").filter(smaller & length & new & position & apart).select("a_s1", "b_s1")


def candidates(entries: DataFrame, threshold: float) -> DataFrame:
    """The pairs that meet, each once."""
    return meetings(entries, threshold).distinct()


def set_tokens(given: DataFrame, wanted: np.ndarray, min_words: int) -> DataFrame:
    """(s1, n, w0, w1, ..., tokens) of the lines whose digest is in the filter ``wanted``; the w are a wide bitmap."""
    sent = given.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            sets = LineSets(block, min_words)
            s1, _ = sets.digests()
            _, one = np.unique(s1, return_index=True)
            one = one[sketches.in_filter(sent.value, s1[one])]
            flag = np.zeros(len(s1), bool)
            flag[one] = True
            cuts = np.concatenate([[0], np.cumsum(sets.n[flag])])
            words = sets.token[np.repeat(flag, sets.n)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(s1[flag].view(np.int64)),
                    pa.array(sets.n[flag].astype(np.int32)),
                    *(pa.array(x.view(np.int64)) for x in bitmaps(words, cuts[:-1], WIDE)),
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(words.view(np.int64))),
                ],
                names=["s1", "n", *wide, "tokens"],
            )

    wide = [f"w{i}" for i in range(WIDE)]
    kinds = ", ".join(["s1 long", "n int", *(f"{w} long" for w in wide), "tokens array<long>"])
    return given.select("text").mapInArrow(run, kinds).groupBy("s1").agg(
        *(F.first(c).alias(c) for c in ["n", *wide, "tokens"])
    )


def close(pairs: DataFrame, tokens: DataFrame, threshold: float) -> DataFrame:
    """The pairs (early, late) that their wide bitmaps allow to be as similar; all similar ones are among them.

    Most pairs that share a rare word are not similar.  A bitmap is a tenth of a
    long line's words, so these pairs go without the words ever crossing an exchange.
    """
    wide = [f"w{i}" for i in range(WIDE)]
    a, b = (
        tokens.select(F.col("s1").alias(end), *(F.col(c).alias(f"{side}_{c}") for c in ["n", *wide]))
        for end, side in (("early", "a"), ("late", "b"))
    )
    both = F.col("a_n") + F.col("b_n")
    shared = F.ceil(F.lit(threshold / (1 + threshold)) * both - F.lit(1e-9))
    return pairs.join(b, "late").join(a, "early").filter(_apart(wide) <= both - 2 * shared).select("early", "late")


def similar(pairs: DataFrame, tokens: DataFrame, threshold: float) -> DataFrame:
    """The pairs (early, late) whose sets have Jaccard ``threshold`` or more."""
    a = tokens.select(F.col("s1").alias("early"), F.col("tokens").alias("a_tokens"))
    b = tokens.select(F.col("s1").alias("late"), F.col("tokens").alias("b_tokens"))
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    every = F.size("a_tokens") + F.size("b_tokens") - shared
    alike = shared >= F.lit(threshold) * every - F.lit(1e-9)
    return pairs.join(b, "late").join(a, "early").filter(alike).select("early", "late")


def with_earlier_match(
    given: DataFrame, sets: DataFrame, entries: DataFrame, threshold: float, min_words: int
) -> DataFrame:
    """(s1) of the sets that a different set with an earlier first line matches.

    Of a set's earlier candidates the earliest is verified first; only sets that
    it does not match go on to all their others.  In a group of copies nearly
    all sets are through with the first.  What is done with is removed at once.
    """
    spark = given.sparkSession
    pairs, unplaced = written_at(candidates(entries, threshold), "line-pairs")
    release(spark)
    numbers = sets.select("s1", "number")
    placed = pairs.join(numbers.select(F.col("s1").alias("a_s1"), F.col("number").alias("a_number")), "a_s1").join(
        numbers.select(F.col("s1").alias("b_s1"), F.col("number").alias("b_number")), "b_s1"
    )
    first = F.col("a_number") < F.col("b_number")
    placed, placed_at = written_at(
        placed.select(
            F.when(first, F.col("a_s1")).otherwise(F.col("b_s1")).alias("early"),
            F.when(first, F.col("b_s1")).otherwise(F.col("a_s1")).alias("late"),
            F.least("a_number", "b_number").alias("number"),
        ),
        "line-pairs",
    )
    remove(spark, unplaced)
    release(spark)
    ends = placed.select(F.explode(F.array("early", "late")).alias("s1"))
    wanted = sketches.bit_filter(ends, "s1", FILTER_BITS)
    tokens, tokens_at = written_at(set_tokens(given, wanted, min_words), "line-tokens")
    release(spark)
    earliest = placed.groupBy("late").agg(F.min_by("early", "number").alias("early"))
    found = written(similar(earliest, tokens, threshold).select(F.col("late").alias("s1")), "line-matches")
    rest = placed.select("early", "late").join(found.select(F.col("s1").alias("late")), "late", "left_anti")
    rest = written(close(rest, tokens, threshold), "line-pairs")
    more = written(similar(rest, tokens, threshold).select(F.col("late").alias("s1")).distinct(), "line-matches")
    for path in (placed_at, tokens_at):
        remove(spark, path)
    return found.unionByName(more)


def removed_lines(
    given: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, bits: int = COUNT_BITS
) -> DataFrame:
    """(doc_id, tkey, lines): the numbers of the lines that an earlier one matches.

    ``given`` holds doc_id, tkey (a hash of the text) and text.
    """
    counts, lines = counted_lines(given, min_words, bits)
    place = F.struct("doc_id", "tkey", "line")
    sets = lines.groupBy("s1", "s2").agg(F.min(place).alias("place"), F.max(place).alias("last"))
    # Stored in order of their first lines and numbered so: a pair then carries one number for a place.
    ordered = sets.repartitionByRange("place").sortWithinPartitions("place")
    sets = written(ordered.withColumn("number", F.monotonically_increasing_id()), "line-sets")
    firsts = sketches.bit_filter(sets.select(place_key("place").alias("key")), "key", FILTER_BITS)
    entries = prefix_entries(given, firsts, levels(counts), threshold, min_words)
    matched = with_earlier_match(given, sets, entries, threshold, min_words).withColumn("all", F.lit(True))
    # All lines of a matched set go, and of any other all but the first.
    fates = sets.join(matched, "s1", "left").filter("all or last > place").select("s1", "s2", "place", "all")
    gone = lines.join(fates.withColumnRenamed("place", "kept"), ["s1", "s2"]).filter(
        F.col("all") | (place > F.col("kept"))
    )
    return gone.select("doc_id", "tkey", "line").distinct().groupBy("doc_id", "tkey").agg(
        F.collect_list("line").alias("lines")
    )


def dedup_lines(
    docs: DataFrame,
    columns: list[str] | None = None,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLD,
    min_words: int = MIN_WORDS,
    bits: int = COUNT_BITS,
) -> DataFrame:
    """(row, text, n_lines, n_removed): every document with the lines that are left.

    ``row`` holds the input's ``columns``; a document keeps its row even if no
    line is left.
    """
    given = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("tkey"), F.col(text).alias("text")
    )
    gone = written(removed_lines(given, threshold, min_words, bits), "lines-gone")
    own = document_key(F.col(key).cast("long"), F.xxhash64(F.col(text)))
    rows = docs.select(
        F.struct(*(columns or docs.columns)).alias("row"),
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("k"),
        F.col(key).isNull().alias("none"),
        F.xxhash64(F.col(text)).alias("tkey"),
        own.alias("own"),
        F.col(text).alias("text"),
    )
    # Texts that lose no line don't go through an exchange.
    touched = sketches.bit_filter(gone.select(document_key(F.col("doc_id"), F.col("tkey")).alias("own")), "own", FILTER_BITS)
    rows = rows.withColumn("touched", sketches.shows(rows, touched, F.col("own")))
    gone = gone.select(
        F.coalesce("doc_id", F.lit(0)).alias("k"), F.col("doc_id").isNull().alias("none"), "tkey", "lines"
    )
    joined = (
        rows.filter("touched").join(gone, ["k", "none", "tkey"], "left").select("row", "text", "lines")
    ).unionByName(
        rows.filter("not touched").select("row", "text", F.lit(None).cast("array<int>").alias("lines"))
    )
    kind = joined.schema["row"].dataType.simpleString()

    def rest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts, totals, numbers = [], [], []
            for own, gone_here in zip(block.column("text").to_pylist(), block.column("lines").to_pylist()):
                lines = [] if own is None else own.split("\n")
                out = set(gone_here or ())
                if out:
                    own = "\n".join(x for i, x in enumerate(lines) if i not in out)
                texts.append(own)
                totals.append(len(lines))
                numbers.append(len(out))
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(numbers, pa.int64())],
                names=["row", "text", "n_lines", "n_removed"],
            )

    return joined.mapInArrow(rest, f"row {kind}, text string, n_lines long, n_removed long")
