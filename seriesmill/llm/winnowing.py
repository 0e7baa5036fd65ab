"""Document fingerprints by winnowing, in column expressions alone.

A text's words are hashed; a rolling hash over ``gram`` words gives one number
a place; of every ``window`` neighbouring numbers the least is chosen, the last
of equal ones, and each chosen place is kept once with its position.  Two texts
that share ``window + gram - 1`` words in a row therefore share a fingerprint.
Rolling hashes and window minima are built by doubling, so a text costs a few
passes over its words.

Defined results: a null text is empty; a text without words has no
fingerprint; a text of fewer words than ``gram`` has one, of all its words
padded with zeros; equal texts have equal fingerprints.  Neighbours are by
``doc_id``, null first, rows of one ``doc_id`` by text; repeated rows follow
each other; after the last comes the first; an empty table stays empty; only
key and text are read, so other columns may have any name.
"""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 4  # words; both are powers of two
WINDOW = 8
#: Low bits of a chosen number: its position, counted down so that the last of equal hashes is least.
PLACE_BITS = 27
ROWS_PER_BUCKET = 2000
MOST_BUCKETS = 1 << 16
_PLACES = (1 << PLACE_BITS) - 1
_HIGHEST = (1 << 63) - 1


def _doubled(df: DataFrame, name: str, width: int, join) -> DataFrame:
    """Column ``name`` with ``join`` over every ``width`` neighbours, one projection a doubling."""
    step = 1
    while step < width:
        size = F.greatest(F.size(name) - step, F.lit(0))
        df = df.withColumn(
            name,
            F.zip_with(F.slice(name, 1, size), F.slice(name, step + 1, size), join),
        )
        step *= 2
    return df


def fingerprint(df: DataFrame, text: str, name: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with the chosen numbers of ``text`` as column ``name``: hash above, position below."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " ")), " ")
    df = df.withColumn(name, F.filter(words, lambda w: w != ""))
    df = df.withColumn(name, F.transform(name, lambda w: F.xxhash64(w)))
    short = F.when(F.size(name) > 0, F.greatest(F.lit(gram) - F.size(name), F.lit(0))).otherwise(0)
    df = df.withColumn(name, F.concat(name, F.array_repeat(F.lit(0).cast("long"), short)))
    # The hashes of two neighbouring runs make the hash of both together.
    df = _doubled(df, name, gram, lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(
        name,
        F.transform(
            name,
            lambda h, i: F.shiftleft(F.shiftright(h, PLACE_BITS), PLACE_BITS).bitwiseOR((F.lit(_PLACES) - i).cast("long")),
        ),
    )
    # Fewer numbers than a window are one window.
    short = F.when(F.size(name) > 0, F.greatest(F.lit(window) - F.size(name), F.lit(0))).otherwise(0)
    df = df.withColumn(name, F.concat(name, F.array_repeat(F.lit(_HIGHEST), short)))
    df = _doubled(df, name, window, lambda a, b: F.least(a, b))
    return df.withColumn(name, F.array_distinct(name))


def hashes_of(chosen: Column) -> Column:
    """The distinct hashes of chosen numbers."""
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, PLACE_BITS)))


def positions_of(chosen: Column) -> Column:
    return F.transform(chosen, lambda x: F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES)))


def spelled(chosen: Column) -> Column:
    """A fingerprint as text: hash@position of each chosen place, in the order of the text."""
    return F.array_join(
        F.transform(
            chosen,
            lambda x: F.concat(
                F.lower(F.hex(F.shiftrightunsigned(x, PLACE_BITS))),
                F.lit("@"),
                (F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES))).cast("string"),
            ),
        ),
        " ",
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; 1 where both are empty."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def _longs(values: list[int]) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values))


def bucketed(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows of (doc_id, text) with ``bucket`` and ``extra``.

    Buckets are ranges of ``doc_id`` of about equal size, cut at quantiles that
    occur in the data.  The first rows of each bucket also stand, marked
    ``extra``, at the end of the bucket before, and those of the first bucket at
    the end of the last, so every row finds its successor in its own bucket.
    """
    ids = docs.select("doc_id")
    facts = ids.agg(
        F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls")
    ).first()
    buckets = min(MOST_BUCKETS, max(1, ceil(facts["rows"] / rows_per_bucket)))
    shares = [i / buckets for i in range(1, buckets)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 20 * buckets).alias("q")).first()["q"] if shares else []
    bounds = sorted({b for b in found or [] if b > facts["least"] or facts["nulls"]})
    if not bounds:
        bucket, first = F.lit(0), F.col("doc_id").eqNullSafe(F.lit(None if facts["nulls"] else facts["least"]).cast("long"))
    else:
        # Two steps of about the root of the number of bounds find the last bound at or below an id.
        wide = isqrt(len(bounds) - 1) + 1
        groups = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
        coarse = F.size(F.filter(_longs([g[0] for g in groups]), lambda b: b <= F.col("doc_id")))
        docs = docs.withColumn("coarse", F.when(F.col("doc_id").isNull(), 0).otherwise(coarse))
        fine = F.size(
            F.filter(F.element_at(F.array(*map(_longs, groups)), F.col("coarse")), lambda b: b <= F.col("doc_id"))
        )
        bucket = F.when(F.col("coarse") == 0, 0).otherwise((F.col("coarse") - 1) * wide + fine)
        least = F.lit(None if facts["nulls"] else facts["least"]).cast("long")
        first = F.when(
            F.col("bucket") == 0, F.col("doc_id").eqNullSafe(least)
        ).otherwise(F.element_at(_longs(bounds), F.greatest(F.col("bucket"), F.lit(1))) == F.col("doc_id"))
    rows = docs.withColumn("bucket", bucket)
    before = F.pmod(F.col("bucket") - 1, F.lit(len(bounds) + 1))
    places = F.when(
        first,
        F.array(
            F.struct(F.col("bucket").alias("at"), F.lit(False).alias("extra")),
            F.struct(before.alias("at"), F.lit(True).alias("extra")),
        ),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("extra"))))
    return rows.select("doc_id", "text", F.explode(places).alias("place")).select(
        "doc_id", "text", F.col("place.at").alias("bucket"), F.col("place.extra").alias("extra")
    )


def compared(docs: DataFrame, text: str = "text", key: str = "doc_id", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(doc_id, text, edited, chosen, edited_chosen, near_edited, near_next) of every row.

    The texts cross one exchange, by range of ``doc_id``; both windows use it.
    """
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = Window.partitionBy("bucket").orderBy("extra", F.col("doc_id").asc_nulls_first(), "text")
    rows = bucketed(given, rows_per_bucket).withColumn("next_text", F.lead("text").over(order))
    rows = fingerprint(rows, "text", "chosen").withColumn("hashes", hashes_of(F.col("chosen")))
    rows = rows.withColumn("next_hashes", F.lead("hashes").over(order)).filter(~F.col("extra"))
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    rows = rows.withColumn("half", half).withColumn(
        "edited",
        F.concat(F.substring("text", F.lit(1), chars - F.col("half")), F.substring("next_text", F.lit(1), F.col("half"))),
    )
    rows = fingerprint(rows, "edited", "edited_chosen").withColumn("edited_hashes", hashes_of(F.col("edited_chosen")))
    return rows.select(
        "doc_id", "text", "edited", "chosen", "edited_chosen",
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
