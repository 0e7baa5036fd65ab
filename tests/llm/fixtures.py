"""Small documents with the cases every operator must stand."""

import hashlib
import sys
import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = (
    "row, part, block, bucket, extra, class, class_id, k, none, tkey, line, lines, token, start, length, ids, n, a, b,"
    " s1, place, kept, marks, anchor, digest, rank, stretch, logp, n_grams, base_failed, band, key, hub, x, y, old, new"
).replace(" ", "").split(",")


def prose(seed, words):
    made, state = [], seed
    for _ in range(words):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        made.append("abcdefghijklmnop"[state >> 60] + hex(state >> 44)[2:5])
    return " ".join(made)


LONG = "\n".join(prose(100 + i, 40) for i in range(150))
EDGES = [
    (1, None, "en", "s", 0),
    (2, "", "en", "s", 0),
    (3, prose(1, 120), "en", None, 1),
    (4, prose(1, 120), "en", "s", 1),  # equal to 3
    (5, prose(1, 119) + " other", "en", "s", 1),  # near 3
    (6, prose(2, 120), None, "s", None),
    (6, prose(2, 120), None, "s", None),  # a repeated row
    (6, prose(3, 30), "de", "s", 1),  # the same doc_id, another text
    (None, prose(4, 60), "de", "s", 1),
    (None, None, None, None, None),
    (7, " \n\t\n ", "fr", "s", 1),
    (8, LONG, "en", "s", 1),
    (9, LONG[:3000] + "\n" + prose(9, 50), "en", "s", 1),
    (10, "one\ntwo words\n" + prose(7, 6) + "\n" + prose(7, 6), "en", "s", 1),
    (11, "é日本語 \x1c\x85　 <|endoftext|> don't  a\n\n b", "en", "s", 1),
]


def edges(spark, clashing=False):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(EDGES, SCHEMA)
    return docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING))) if clashing else docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(spark):
    return [(r["doc_id"], r["text"]) for r in documents(spark).orderBy("doc_id").collect()]


def sha(data):
    return hashlib.sha256(data).hexdigest()
