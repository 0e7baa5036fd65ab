"""The compression classifier: held-out accuracy, and what it must not learn from."""

import zlib

import numpy as np
import pytest
from fixtures import SF, edges, empty
from pyspark.sql import functions as F

from seriesmill.llm import compression_quality as cq
from seriesmill.llm import queries

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return cq.fit(*tables)


def test_held_out_accuracy(spark, tables, model):
    out = queries.op11_compression_quality(spark, SF01)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(tables[1], "doc_id", "left").collect()
    assert len(rows) == tables[0].count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    own = [r for r in rows if r["held_out"] and r["quality"] is not None]
    right = np.mean([r["predicted"] == r["quality"] for r in own])
    good = [r["score"] for r in own if r["quality"] == 1]
    bad = [r["score"] for r in own if r["quality"] == 0]
    ranked = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(own) > 100
    assert right > np.mean([r["quality"] for r in own]) + 0.05
    assert ranked > 0.9
    # A calibrated score is right about as often as it says.
    assert abs(np.mean([r["score"] for r in own]) - np.mean([r["quality"] for r in own])) < 0.05


def test_held_out_labels_are_not_learnt_from(tables, model):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(cq.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert cq.fit(docs, turned) == model
    assert cq.fit(docs.repartition(7), labels.repartition(3)) == model


def test_only_the_text_counts(spark, tables, model):
    docs = tables[0]
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(1))

    def score(rows):
        return {r["row"]["doc_id"]: r["score"] for r in cq.scored(rows, model).collect()}

    assert score(docs) == score(other)
    assert score(docs) == {r["doc_id"]: cq.score(r["text"].encode(), model) for r in docs.collect()}


def test_odd_rows(spark, model):
    out = cq.scored(edges(spark, clashing=True), model).collect()
    assert len(out) == edges(spark).count()
    scores = {}
    for r in out:
        scores.setdefault(r["row"]["text"] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in scores.values())
    assert scores[""] == {cq.score(b"", model)}
    assert cq.scored(empty(spark), model).count() == 0


def test_labels_of_one_kind_or_none(spark):
    """Ids 8 to 11 are not held out; 3 is."""
    docs = edges(spark)
    for given, share in (([], 0.5), ([(8, 1)], 1.0), ([(8, 0), (9, 0)], 0.0), ([(9, None), (None, 1), (9, 7), (3, 1)], 0.5)):
        labels = spark.createDataFrame(given, "doc_id long, quality int").withColumn("id", F.lit(1))
        model = cq.fit(docs, labels)
        assert {r["score"] for r in cq.scored(docs, model).collect()} == {share}
    both = spark.createDataFrame([(8, 0), (8, 1)], "doc_id long, quality int")
    assert cq.fit(docs, both).prior == 0.5
    few = spark.createDataFrame([(8, 1), (9, 0), (10, 0), (11, 1)], "doc_id long, quality int")
    assert 0 <= cq.score(b"some text", cq.fit(docs, few)) <= 1


def test_pieces_cover_whole_texts():
    for size in (0, 1, 1023, 1024, 1025, 5000, 100_001):
        data = bytes(i % 251 for i in range(size))
        cut = list(cq.pieces(data))
        assert b"".join(cut) == data and max(map(len, cut)) <= 1024 and cut


def test_a_sample_has_its_bound(spark, tables):
    docs, labels = tables
    small = cq.fit(docs, labels, sample=20)
    assert small.prior is None and len(small.good) <= cq.DICTIONARY_BYTES
    assert SF.endswith("sf0.001")
