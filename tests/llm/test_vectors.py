"""Vector codes against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts, entries, rounds, scale, top):
    """[(vec_id, label, codes, error)], entries: loops over Python integers."""
    good = [
        r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    width = max(1, -(-max((len(r[1]) for r in good), default=0) // parts))

    def cut(vector):
        whole = [max(-top, min(top, math.floor(scale * x))) for x in vector] + [0] * (parts * width - len(vector))
        return [whole[p * width : (p + 1) * width] for p in range(parts)]

    cuts = [(r[0], r[2], cut(r[1])) for r in good]
    first = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(r[1])[p] for r in first] for p in range(parts)]

    def choose(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds if first else 0):
        made = []
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for _, _, x in cuts:
                members[choose(x[p], book)[1]].append(x[p])
            made.append([[sum(v) // len(m) for v in zip(*m)] if m else c for m, c in zip(members, book)])
        books = made
    out = []
    for i, label, x in cuts:
        found = [choose(x[p], books[p]) for p in range(parts)]
        out.append((i, label, [e for _, e in found], sum(d for d, _ in found)))
    return out, books


def rows_of(seed, n, dims):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.3) for _ in range(dims)], rng.choice([0, 0, 0, 1, 2, None])) for i in range(n)]


def single(rows):
    """Values as single precision holds them."""
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]


def expected(rows, parts, entries, rounds=2, top=1 << 27):
    coded, books = brute(rows, parts, entries, rounds, 256, top)
    sums = {}
    for _, label, _, error in coded:
        sums[label] = sums.get(label, 0) + error
    spelled = ",".join(str(x) for book in books for c in book for x in c)
    return sorted(map(repr, ((i, k, c, e, sums[k]) for i, k, c, e in coded))), hashlib.sha256(spelled.encode()).hexdigest()


def got(df):
    return sorted(repr((r["vec_id"], r["label"], r["codes"], r["error"], r["label_error"])) for r in df.collect())


@pytest.mark.parametrize("dims,parts,entries", [(64, 16, 64), (8, 2, 3), (10, 4, 5)])
def test_codes_equal_brute_force(spark, dims, parts, entries):
    rows = single(rows_of(dims, 90, dims))
    coded, book = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA).repartition(3), parts=parts, entries=entries)
    want, digest = expected(rows, parts, entries, top=vector_codes.bound(parts * -(-dims // parts)))
    assert got(coded) == want
    assert book.digest() == digest


def test_odd_rows(spark):
    rows = single(rows_of(5, 30, 8)) + [
        (100, None, 1),
        (101, [0.5, None] + [0.0] * 6, 1),
        (102, [float("nan")] + [0.0] * 7, 1),
        (103, [float("inf")] + [0.0] * 7, None),
        (104, [], 1),
        (105, [0.25], 1),
        (None, [0.5] * 8, 7),
        (None, [0.25] * 8, 7),
        (3, [0.5] * 8, 1),  # an id again
        (3, [0.5] * 8, 1),  # a row again
        (106, [1e30, -1e30] + [0.0] * 6, None),
    ]
    rows = single(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("codes", "error", "label_error", "_label", "_rows", "id", "vector", "cell", "total", "p", "x"):
        df = df.withColumn(name, F.lit(name))
    coded, book = vector_codes.compressed(df, parts=4, entries=40)
    want, digest = expected(rows, 4, 40, top=vector_codes.bound(8))
    assert got(coded) == want
    assert book.digest() == digest


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1)]):
        coded, book = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA))
        assert coded.columns == ["vec_id", "label", "codes", "error", "label_error"]
        assert coded.count() == 0
        assert book.digest() == hashlib.sha256(b"").hexdigest()


def test_hot_and_cold_labels_give_the_same(spark):
    rows = [(i, [0.1 * (i % 7)] * 4, i % 9 if i % 3 else 0) for i in range(200)] + [(i, [0.3] * 4, None) for i in range(200, 230)]
    coded, _ = vector_codes.compressed(spark.createDataFrame(single(rows), SCHEMA), parts=2, entries=3)
    stored = coded.drop("label_error")
    assert got(vector_codes.with_label_error(stored, hot_labels=3)) == got(coded)
    assert got(vector_codes.with_label_error(stored, hot_labels=1)) == got(coded)


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(1)
    for top, width in ((1, 1), (300, 4), (1 << 27, 4), (1 << 26, 64), (1 << 29, 3)):
        a = rng.integers(-top, top, (20, width), endpoint=True)
        b = rng.integers(-top, top, (width, 9), endpoint=True)
        exact = [[sum(int(x) * int(y) for x, y in zip(row, column)) for column in b.T] for row in a]
        assert vector_codes.exact_products(a, b).tolist() == exact
        bits = (53 - max(0, width - 1).bit_length()) // 2
        assert all(np.abs(limb).max() <= 1 << bits for limb in vector_codes.limbs(a, bits))


def test_equal_distances_go_to_the_lower_entry():
    codes, error = vector_codes.nearest(np.array([[[1]], [[5]]]), np.array([[[0], [2], [2]]]))
    assert codes.tolist() == [[0], [1]]
    assert error.tolist() == [1, 9]


def test_query_columns(spark):
    out = queries.op12_vector_codes(spark, "/root/testdata/sf0.001")
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    first = out.first()
    assert len(first["code"]) == 32 and first["code"] == first["code"].lower()
