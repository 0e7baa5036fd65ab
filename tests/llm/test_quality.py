"""Quality rules: counts, the language model and its bands, against brute force."""

import re
from collections import Counter, defaultdict

import fixtures
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from seriesmill.llm import quality, queries, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    threes = Counter(zip(words, words[1:], words[2:]))
    again = [False] * len(words)
    for i in range(len(words) - 2):
        if threes[tuple(words[i : i + 3])] > 1:
            again[i] = again[i + 1] = again[i + 2] = True
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), sum(again),
    )


def failed(c):
    return c[0] < 50 or 100 * c[4] > 50 * c[0]


def test_op8_counts_equal_brute_force(spark):
    texts = dict(fixtures.texts(spark))
    rows = queries.op8_quality(spark, fixtures.SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.COUNTS) == own
        assert r["base_failed"] == failed(own) and not (r["base_failed"] and r["kept"])
    passed = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] for r in passed) > 0.95 * len(passed)


def normal(text):
    text = re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode())
    return bytes(b + 32 if 65 <= b <= 90 else b for b in text)


def grams(text, order):
    padded = b"\n" * (order - 1) + normal(text) + b"\n"
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


class BruteModel:
    """Interpolated modified Kneser-Ney over byte strings."""

    def __init__(self, texts, order):
        self.order = order
        self.n = {order: Counter(g for t in texts for g in grams(t, order))}
        for size in range(order - 1, 0, -1):
            self.n[size] = Counter(g[1:] for g in self.n[size + 1])
        self.d, self.contexts = {}, {}
        for size, table in self.n.items():
            t = Counter(table.values())
            y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else None
            own = []
            for i in (1, 2, 3):
                d = i - (i + 1) * y * t[i + 1] / t[i] if y is not None and t[i] else None
                own.append(d if d is not None and 0 < d < i else 0.5 * i)
            self.d[size] = own
            by = defaultdict(lambda: [0, 0.0])
            for g, n in table.items():
                by[g[:-1]][0] += n
                by[g[:-1]][1] += own[min(n, 3) - 1]
            self.contexts[size] = by

    def p(self, gram):
        size = len(gram)
        if not size:
            return 1 / 256
        by = self.contexts[size].get(gram[:-1])
        lower = self.p(gram[1:])
        if by is None:
            return lower
        n = self.n[size][gram]
        own = (n - self.d[size][min(n, 3) - 1]) / by[0] if n else 0
        return own + by[1] / by[0] * lower


def test_model_equals_brute_force(spark):
    texts = ["the cat sat on the mat", "The  dog\nsat on the cat", "a mat", "", None, "thé"]
    for order in (2, 3):
        docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").fillna({"text": ""})
        table = quality.kneser_ney(quality.gram_counts(docs, order), order)
        own = quality.gather(table, ["en"], order)["en"]
        brute = BruteModel(texts, order)
        for text in [*texts, "the bat sat", "xyz qq", "mat the"]:
            for gram in grams(text, order):
                key = np.array([int.from_bytes(gram, "big")], np.uint64)
                assert abs(own.log_probability(key)[0] - np.log(brute.p(gram))) < 1e-4, gram
        # Probabilities of all symbols after a context add up to one.
        for context in ("th", "qz"):
            keys = [int.from_bytes((context.encode() + bytes([b]))[-order:], "big") for b in range(256)]
            assert abs(np.exp(own.log_probability(np.array(keys, np.uint64))).sum() - 1) < 1e-3


def test_perplexity_is_that_of_the_language(spark):
    docs = fixtures.documents(spark).select("doc_id", "text", "lang")
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["lang"]].append((r["doc_id"], r["text"]))
    models = {lang: BruteModel([t for _, t in own], quality.ORDER) for lang, own in texts.items()}
    got = {r["row"]["doc_id"]: r["log_perplexity"] for r in quality.quality(docs, ["doc_id"]).collect()}
    for lang, own in texts.items():
        for key, text in own[:3]:
            every = [np.log(models[lang].p(g)) for g in grams(text, quality.ORDER)]
            assert abs(got[key] + np.mean(every)) < 1e-3


def test_odd_texts_leave_the_band(spark):
    import random

    draw = random.Random(1)
    words = [fixtures.prose(i, 1) + "ing" for i in range(40)]
    rows = [(i, " ".join(draw.choice(words) for _ in range(80)), "en") for i in range(300)]
    rows += [(900, " ".join("".join(draw.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(80)), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["row"]["doc_id"] for r in quality.quality(docs).filter("kept").collect()}
    assert 900 not in kept and len(kept) >= 297


def test_copies_do_not_set_the_band(spark):
    given = fixtures.documents(spark).filter("lang = 'en'").select("doc_id", "text", "lang").orderBy("doc_id").collect()
    one = {r["text"]: r for r in given if not failed(counts(r["text"]))}
    alone = spark.createDataFrame([tuple(r) for r in one.values()], "doc_id long, text string, lang string")
    scores = {r["row"]["doc_id"]: r["log_perplexity"] for r in quality.quality(alone).collect()}
    # The copied text is the one in the middle: a clean one.
    copied = sorted(scores, key=scores.get)[len(scores) // 2]
    copies = [(10**6 + i, r["text"], "en") for r in one.values() if r["doc_id"] == copied for i in range(3 * len(one))]
    docs = alone.unionByName(spark.createDataFrame(copies, alone.schema)).repartition(16)
    found = quality.quality(docs, ["doc_id"]).collect()
    kept = {r["row"]["doc_id"] for r in found if r["kept"]}
    assert len(kept & set(scores)) > 0.9 * len(scores)
    # The group has one score and stays with the others, however often the model has seen it.
    group = [r for r in found if r["row"]["doc_id"] == copied or r["row"]["doc_id"] >= 10**6]
    assert len(group) > len(found) / 2
    assert {(r["log_perplexity"], r["kept"]) for r in group} == {(group[0]["log_perplexity"], True)}


def test_equal_texts_have_a_band_of_some_width(spark):
    text = fixtures.prose(1, 200)
    near = " ".join([*text.split()[:-1], "other"])
    docs = spark.createDataFrame([(i, text, "en") for i in range(50)] + [(90, near, "en")], "doc_id long, text string, lang string")
    assert quality.kept_documents(docs).count() == 51


def test_quality_edges(spark, monkeypatch):
    docs = fixtures.edges(spark, clashing=True)
    got = quality.quality(docs).collect()
    assert Counter((r["row"]["doc_id"], r["row"]["text"], *(r[c] for c in quality.COUNTS)) for r in got) == Counter(
        (k, t, *counts(t)) for k, t, *_ in fixtures.EDGES
    )
    assert quality.kept_documents(docs).columns == docs.columns
    assert quality.kept_documents(fixtures.empty(spark)).count() == 0
    # One language a pass gives the same scores.
    monkeypatch.setattr(quality, "MODEL_ROWS", 1)
    again = quality.quality(docs).collect()
    key = lambda r: (str(r["row"]["doc_id"]), str(r["row"]["text"]), round(r["log_perplexity"], 6), r["kept"])
    assert sorted(map(key, again)) == sorted(map(key, got))
    # Counts that tasks hand on early add up to the same.
    monkeypatch.setattr(quality, "GATHERED", 5)
    few = quality.gram_counts(docs.select(F.coalesce("text", F.lit("")).alias("text"), "lang").fillna({"lang": ""}), 3)
    total = sum(len(grams(t, 3)) for _, t, *_ in fixtures.EDGES)
    assert few.agg({"n": "sum"}).first()[0] == total


def test_counting_drops_the_encoders_of_other_steps(spark):
    docs, tasks = fixtures.empty(spark).repartition(1), []

    def both(batches):
        tokens.encoder(queries.WORD_JSON)
        for _ in tasks[0](batches):
            pass
        yield pa.record_batch([pa.array([tokens.encoder.cache_info().currsize])], names=["left"])

    class Given:
        columns = docs.columns

        def mapInArrow(self, task, schema):
            tasks.append(task)
            return docs.limit(0).mapInArrow(task, schema)

    quality.gram_counts(Given(), 4)
    assert [r["left"] for r in docs.mapInArrow(both, "left long").collect()] == [0]


def test_model_plans_do_not_hold_all_longer_orders(spark):
    docs = spark.createDataFrame([("the cat sat", "en")], "text string, lang string")
    table = quality.kneser_ney(quality.gram_counts(docs, quality.ORDER), quality.ORDER)
    plan = table._jdf.queryExecution().executedPlan().toString()
    # The levels and weights of the orders are stored, so the union of them joins files.
    assert "Exchange" in plan and "HashAggregate" not in plan and "MapInArrow" not in plan
