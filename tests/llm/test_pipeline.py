"""The pipeline's stages one after the other, each against brute force on its own input."""

from collections import Counter

import fixtures
import numpy as np
import pytest
from test_dedup import components, keyed, line_cut, shingle_sets
from test_quality import counts, failed
from test_tokens import check_packed, library

import corpus_pipeline
from seriesmill.session import work_path


@pytest.fixture(scope="module")
def stages(spark):
    """(name, input rows, output rows) of every stage."""
    docs, out = fixtures.documents(spark), []
    for name, stage in corpus_pipeline.STAGES:
        path = work_path(spark, "pipeline-test")
        stage(spark, docs, fixtures.SF).write.parquet(path)
        made = spark.read.parquet(path)
        out.append((name, docs.collect(), made.collect(), made.columns))
        docs = made
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = fixtures.documents(spark).columns
    assert [s[0] for s in stages] == ["quality rules", "line dedup", "near dedup", "suffix-array dedup", "packing"]
    assert all(s[3] == columns for s in stages[:-1])


def test_quality_drops_what_fails(stages):
    _, before, after, _ = stages[0]
    passed = {r["doc_id"] for r in before if not failed(counts(r["text"]))}
    left = {r["doc_id"] for r in after}
    assert left <= passed and len(left) > 0.95 * len(passed)


def test_lines_go_after_the_first(spark, stages):
    _, before, after, _ = stages[1]
    wanted = line_cut(keyed(spark, [(r["doc_id"], r["text"]) for r in before]))
    texts = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(before)
    assert all(r["text"] == wanted[r["doc_id"], texts[r["doc_id"]]] for r in after)


def test_one_of_each_group_stays(stages):
    _, before, after, _ = stages[2]
    rows = sorted((r["doc_id"], r["text"]) for r in before)
    df = Counter(s for _, t in rows for s in shingle_sets(t))
    weight = {s: 1 + np.log(len(rows) / n) / np.log(len(rows)) for s, n in df.items()}
    assert sorted(r["doc_id"] for r in after) == sorted(g[0] for g in components(rows, weight.__getitem__))


def test_passages_go(stages):
    _, before, after, _ = stages[3]
    seen = Counter(w for r in before for b in [r["text"].encode()] for w in {b[i : i + 400] for i in range(len(b) - 399)})
    texts = {r["doc_id"]: r["text"].encode() for r in before}
    assert len(after) == len(before)
    for r in after:
        data = texts[r["doc_id"]]
        covered = np.zeros(len(data), bool)
        for i in range(len(data) - 399):
            if seen[data[i : i + 400]] > 1 or data.find(data[i : i + 400]) != data.rfind(data[i : i + 400]):
                covered[i : i + 400] = True
        assert r["text"] == np.frombuffer(data, np.uint8)[~covered].tobytes().decode(errors="ignore")


def test_pieces_hold_all_ids(stages):
    _, before, after, _ = stages[4]
    check_packed(after, [(r["doc_id"], r["text"]) for r in before], 4096, library("word_bpe_49k.json"))


def test_stages_stand_odd_rows(spark):
    for clashing in (False, True):
        docs = fixtures.edges(spark, clashing=clashing)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, fixtures.SF)
            assert made.columns == docs.columns
            assert 0 < made.count() <= len(fixtures.EDGES)
            assert stage(spark, fixtures.empty(spark), fixtures.SF).count() == 0
        assert corpus_pipeline.STAGES[-1][1](spark, docs, fixtures.SF).count() >= len(fixtures.EDGES)


def test_whole_pipeline(spark, stages):
    made = corpus_pipeline.run(spark, fixtures.SF)
    assert made.agg({"length": "sum"}).first()[0] == sum(r["length"] for r in stages[-1][2])
