"""Near duplicates, repeated passages and lines against brute force."""

import os
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import fixtures
import numpy as np
import pytest

from seriesmill.llm import line_dedup, near_dups, queries, sketches, suffixes
from seriesmill.session import written_at
from seriesmill.llm.text import line_spans, span_hashes, word_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def test_spans():
    texts = ["", "ab  c", "", "d\n\ne f", "\n", " x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    starts, ends, rows = word_spans(data, offsets)
    whole = data.tobytes().decode()
    assert [(whole[a:b], r) for a, b, r in zip(starts, ends, rows)] == [
        (w, i) for i, t in enumerate(texts) for w in WORD.findall(t)
    ]
    starts, ends, rows = line_spans(data, offsets)
    assert [(whole[a:b], r) for a, b, r in zip(starts, ends, rows)] == [
        (x, i) for i, t in enumerate(texts) for x in t.split("\n")
    ]
    data = np.frombuffer(b"abcabcabd", np.uint8)
    h = span_hashes(data, np.array([0, 3, 6, 0]), np.array([3, 6, 9, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


# Suffix arrays ---------------------------------------------------------------------------------


def windows(strings, times, length):
    seen = Counter()
    for s, t in zip(strings, times):
        for i in range(len(s) - length + 1):
            seen[s[i : i + length]] += t
    return [[seen[s[i : i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]


def test_merged_transforms_find_repeats():
    draw = random.Random(5)
    for _ in range(120):
        length = draw.choice([16, 32, 48, 64])
        base = bytes(draw.choice(b"ab\0") for _ in range(draw.randint(60, 200)))
        strings = set()
        for _ in range(draw.randint(1, 12)):
            s = bytearray(base[draw.randint(0, 20) :][: draw.randint(length, 150)])
            for _ in range(draw.randint(0, 3)):
                s[draw.randrange(len(s))] = draw.choice(b"abc")
            strings.add(bytes(s))
        strings = [s for s in strings if len(s) >= length]
        times = [draw.choice([1, 1, 2]) for _ in strings]
        found = suffixes.repeated_starts(strings, times, length, draw.choice([50, 100, 1000]))
        assert [f.tolist() for f in found] == windows(strings, times, length)
    with pytest.raises(ValueError):
        suffixes.repeated_starts([b"a"], [1], 20, 10)


def plain_stretches(texts, data, length, gram):
    """Runs of starts whose smallest gram, the last of equal ones, is at one place."""
    every = span_hashes_of_grams(data, gram)
    out, offset = [], 0
    for row, text in enumerate(texts):
        runs = {}
        for start in range(offset, offset + len(text) - length + 1):
            at = min(range(start, start + length - gram + 1), key=lambda i: (every[i] >> 24, -i))
            runs.setdefault(at, []).append(start)
        out += [(every[at], at, min(s), max(s), row) for at, s in runs.items()]
        offset += len(text)
    return out


def span_hashes_of_grams(data, gram):
    """The hash that stretches are anchored by, of every gram, from a text of it alone."""
    return [
        int(suffixes.anchored(data[i : i + gram], np.array([0, gram]), gram, gram)[0][0])
        for i in range(len(data) - gram + 1)
    ]


def test_stretches_have_one_anchor():
    draw = random.Random(9)
    for _ in range(40):
        length, gram = draw.choice([(24, 8), (16, 16), (40, 8)])
        texts = [
            bytes(draw.choice(b"ab") for _ in range(draw.choice([0, 1, length - 1, length, length + 1, 90])))
            for _ in range(draw.randint(0, 6))
        ]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        found = suffixes.anchored(data, offsets, length, gram)
        assert list(zip(*(x.tolist() for x in found))) == plain_stretches(texts, data, length, gram)


def test_marks_cover_what_their_starts_cover():
    draw = random.Random(4)
    for _ in range(40):
        size, length, marks, plain = 200, 16, [], set()
        for _ in range(draw.randint(0, 4)):
            starts = draw.randint(1, 50)
            start = draw.randint(0, size - starts - length + 1)
            flags = [draw.random() < 0.3 for _ in range(starts)] if draw.random() < 0.6 else None
            marks.append({"start": start, "starts": starts, "flags": flags and np.packbits(flags).tobytes()})
            for i in range(starts):
                if flags is None or flags[i]:
                    plain.update(range(start + i, start + i + length))
        marks += marks[:1]
        assert np.flatnonzero(suffixes._covered(size, marks, length)).tolist() == sorted(plain)


def cut(rows, length):
    """Brute force: (row, bytes left, bytes removed) for texts in order."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (key, _), t in zip(rows, texts):
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = True
        spans = int(covered[:1].sum() + (covered[1:] & ~covered[:-1]).sum())
        kept = np.frombuffer(t, np.uint8)[~covered].tobytes()
        out.append((key, len(t), len(t) - len(kept), spans, fixtures.sha(kept)))
    return out


SCHEMA = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def test_op7_equals_brute_force(spark):
    got = sorted(tuple(r) for r in queries.op7_suffix_dedup(spark, fixtures.SF).collect())
    assert got == sorted(cut(fixtures.texts(spark), 400))


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"bucket_bytes": 10**9, "shard_bytes": 700}])
def test_passages_edges(spark, monkeypatch, options):
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 1000)
    rows = [(k, t) for k, t, *_ in fixtures.EDGES] + [(20, "ab" * 300), (21, "x" + "ab" * 40), (22, "y" * 64)]
    docs = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in rows], "doc_id long, text string, marks int, row int, n int")
    made = suffixes.without_repeats(docs, queries._cut, SCHEMA, ["doc_id", "marks"], length=64, gram=16, **options)
    got = Counter((r["row"]["doc_id"], *r[1:]) for r in made.collect())
    assert got == Counter(cut(rows, 64))
    left = suffixes.dedup_passages(docs, length=64, gram=16, **options)
    assert left.columns == docs.columns and left.count() == len(rows)
    assert suffixes.dedup_passages(fixtures.empty(spark)).count() == 0


# Lines -----------------------------------------------------------------------------------------


def line_cut(rows, threshold=0.8, least=1):
    """Brute force over distinct documents in order: text left, by document."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    first, lines = {}, []
    for place, (key, text, _) in enumerate(docs):
        for number, line in enumerate((text or "").split("\n")):
            words = [lower(w) for w in WORD.findall(line)]
            if len(words) >= least:
                lines.append((place, number, frozenset(words)))
                first.setdefault(frozenset(words), (place, number))
    earliest = dict(first)
    for a, b in combinations(first, 2):
        shared = len(a & b)
        if shared >= threshold * (len(a) + len(b) - shared) - 1e-9:
            earliest[a], earliest[b] = min(earliest[a], first[b]), min(earliest[b], first[a])
    gone = defaultdict(set)
    for place, number, words in lines:
        if (place, number) > earliest[words]:
            gone[place].add(number)
    out = {}
    for place, (key, text, _) in enumerate(docs):
        out[key, text] = None if text is None else "\n".join(
            x for i, x in enumerate(text.split("\n")) if i not in gone[place]
        )
    return out


def keyed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return [tuple(r) for r in docs.selectExpr("doc_id", "text", "xxhash64(text) h").collect()]


def similar_lines(seed, count):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    lines = [[draw.choice(vocabulary) for _ in range(draw.randint(1, 14))] for _ in range(count // 3)]
    while len(lines) < count:
        line = list(draw.choice(lines))
        for _ in range(draw.randint(0, 2)):
            line[draw.randrange(len(line))] = draw.choice(vocabulary)
        lines.append(line)
    draw.shuffle(lines)
    return [(i, "\n".join(" ".join(x) for x in lines[i * 5 : i * 5 + 5])) for i in range(count // 5)]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_join_is_exact(spark, seed):
    rows = similar_lines(seed, 300)
    wanted = line_cut(keyed(spark, rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Few cells in the count table: the order gets blunt, the result stays.
    for bits in (8, 20):
        found = line_dedup.dedup_lines(docs, ["doc_id", "text"], bits=bits).collect()
        assert {(r["row"]["doc_id"], r["row"]["text"]): r["text"] for r in found} == wanted


def test_wide_bitmaps_leave_out_pairs_that_are_not_similar(spark):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(90)]
    lines = [words + [f"x{i}" for i in range(40 * k, 40 * k + 40)] for k in range(3)]
    lines += [words + [f"y{draw.random()}" for _ in range(k)] for k in (5, 12)]
    texts = spark.createDataFrame([(" ".join(x),) for x in lines], "text string")
    tokens = line_dedup.set_tokens(texts, np.full(1 << 13, 255, np.uint8), 1).localCheckpoint()
    by_size = {r["n"]: r["s1"] for r in tokens.collect()}
    keys = [r["s1"] for r in tokens.collect()]
    pairs = spark.createDataFrame([p for p in combinations(keys, 2)], "early long, late long")
    alike = {frozenset(r) for r in line_dedup.similar(pairs, tokens, 0.8).collect()}
    left = {frozenset(r) for r in line_dedup.close(pairs, tokens, 0.8).collect()}
    assert alike == {frozenset((by_size[95], by_size[102]))}
    assert alike <= left and len(left) < 6


def test_bitmaps_tell_long_sets_apart():
    draw = random.Random(3)
    vocabulary = np.array([draw.getrandbits(64) for _ in range(2000)], np.uint64)
    sets = [set(draw.sample(range(2000), draw.randint(90, 130))) for _ in range(60)]
    sets += [s ^ set(draw.sample(range(2000), 6)) for s in sets]
    cuts = np.cumsum([0, *map(len, sets)])
    token = vocabulary[[i for s in sets for i in sorted(s)]]
    made = line_dedup.bitmaps(token, cuts[:-1], line_dedup.NARROW)
    left = 0
    for a, b in combinations(range(len(sets)), 2):
        apart = sum(int(m[a] ^ m[b]).bit_count() for m in made)
        assert apart <= len(sets[a] ^ sets[b])
        left += b != a + 60 and apart <= (len(sets[a]) + len(sets[b])) / 9
    assert left < 5


def test_pairs_meet_once_for_words_that_follow_each_other(spark):
    words = [f"w{i}" for i in range(80)]
    docs = spark.createDataFrame([(i, i, " ".join([*words, f"x{i}"])) for i in range(2)], "doc_id long, tkey long, text string")
    rarity = np.full(1 << 10, 2, np.uint8)
    entries = line_dedup.prefix_entries(docs, np.full(1 << 13, 255, np.uint8), rarity, 0.8, 1).localCheckpoint()
    assert entries.count() > 30
    # A word of one set alone can stand between two runs of shared ones.
    assert 1 <= line_dedup.meetings(entries, 0.8).count() <= 3
    assert line_dedup.candidates(entries, 0.8).count() == 1


def test_join_of_lines_leaves_no_words_or_pairs_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "written_at", lambda df, label: kept(df, label))
    made = []

    def kept(df, label):
        out, path = written_at(df, label)
        made.append(path.removeprefix("file:"))
        return out, path

    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 20))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).agg({"n_removed": "sum"}).first()[0] == 5
    assert len(made) == 3 and not any(os.path.exists(path) for path in made)


def test_line_edges(spark):
    docs = fixtures.edges(spark, clashing=True)
    wanted = line_cut(keyed(spark, [(k, t) for k, t, *_ in fixtures.EDGES]))
    found = line_dedup.dedup_lines(docs).collect()
    assert Counter((r["row"]["doc_id"], r["row"]["text"], r["text"]) for r in found) == Counter(
        (k, t, wanted[k, t]) for k, t, *_ in fixtures.EDGES
    )
    assert line_dedup.dedup_lines(fixtures.empty(spark)).count() == 0


def test_op10_equals_brute_force(spark):
    rows = fixtures.texts(spark)
    wanted = line_cut(keyed(spark, rows))
    for r in queries.op10_line_dedup(spark, fixtures.SF).collect():
        text = dict(rows)[r["doc_id"]]
        left = wanted[r["doc_id"], text]
        assert r["kept_sha256"] == fixtures.sha(left.encode())
        assert r["n_lines"] == text.count("\n") + 1


def test_levels_keep_the_order():
    counts = np.array([0, 1, 2, 127, 128, 129, 1000, 10**6, 2**32 - 1], np.uint32)
    made = line_dedup.levels(counts).astype(int)
    assert (np.diff(made) >= 0).all() and made[1] == 1 and made[2] == 2


def test_bit_filter_holds_its_members(spark):
    keys = spark.range(1000).selectExpr("xxhash64(id) key")
    filled = sketches.bit_filter(keys, "key", 16)
    every = np.array([r[0] for r in keys.collect()], np.int64).view(np.uint64)
    assert sketches.in_filter(filled, every).all()
    others = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2)
    assert sketches.in_filter(filled, others).mean() < 0.1


# Near duplicates -------------------------------------------------------------------------------


def shingle_sets(text):
    words = [lower(w) for w in WORD.findall(text)]
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def components(rows, idf_of=lambda s: 1.0, threshold=0.8):
    sets = [shingle_sets(t or "") for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        least = sum(min(a[s], b[s]) * idf_of(s) for s in a.keys() & b.keys())
        most = sum(max(a[s], b[s]) * idf_of(s) for s in a.keys() | b.keys())
        if (rows[i][1] or "") == (rows[j][1] or "") or (most and least >= threshold * most):
            group[max(find(i), find(j))] = min(find(i), find(j))
    out = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        out[find(i)].append(key)
    return sorted(sorted(x for x in g) for g in out.values())


def test_op3_equals_brute_force(spark):
    rows = fixtures.texts(spark)
    found = defaultdict(list)
    for r in queries.op3_minhash_dedup(spark, fixtures.SF).collect():
        found[r["class_id"]].append(r["doc_id"])
    df = Counter(s for _, t in rows for s in shingle_sets(t))
    idf = {s: 1 + np.log(len(rows) / n) / np.log(len(rows)) for s, n in df.items()}
    assert sorted(sorted(g) for g in found.values()) == components(rows, idf.__getitem__)
    assert all(min(g) == c for c, g in found.items())


def test_group_of_copies_is_one_class(spark):
    base = fixtures.prose(50, 400).split()
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(200)]
    rows += [(300 + i, fixtures.prose(900 + i, 400)) for i in range(50)]
    # A chain: each is like the next, the ends are not alike.
    rows += [(400 + i, " ".join(fixtures.prose(51, 600).split()[i * 20 : i * 20 + 300])) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = dict(near_dups.near_duplicates(docs).select("doc_id", "class_id").collect())
    assert {classes[i] for i in range(200)} == {0}
    assert all(classes[300 + i] == 300 + i for i in range(50))
    assert {classes[400 + i] for i in range(8)} == {400}


def test_near_edges(spark):
    docs = fixtures.edges(spark, clashing=True)
    found = {(r["doc_id"], bytes(r["tkey"])): r["class_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert near_dups.near_duplicates(docs).count() == len(fixtures.EDGES)
    by_id = defaultdict(set)
    for (key, _), own in found.items():
        by_id[key].add(own)
    assert by_id[3] == by_id[4] == by_id[5] == {3} and by_id[8] == {8} and by_id[1] == by_id[2]
    kept = near_dups.one_of_each(docs)
    assert kept.columns == docs.columns
    left = Counter(r["doc_id"] for r in kept.collect())
    assert left[3] == 1 and left[4] == 0 and left[5] == 0 and left[8] == 1
    assert near_dups.one_of_each(fixtures.empty(spark)).count() == 0


def test_samples_agree_as_often_as_texts_are_alike():
    draw = np.random.default_rng(7)
    hashes = draw.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    weights = (1 + draw.random(3000)).astype(np.float32)
    for share in (0.5, 0.8):
        a = slice(0, 2000)
        b = slice(int(2000 * (1 - share) / (1 + share)), int(2000 * (1 - share) / (1 + share)) + 2000)
        x = near_dups.weighted_samples(hashes[a], weights[a], 2000)
        y = near_dups.weighted_samples(hashes[b], weights[b], 2000)
        idf = dict(zip(hashes.tolist(), weights.tolist()))
        both, every = set(hashes[a].tolist()) & set(hashes[b].tolist()), set(hashes[a].tolist()) | set(hashes[b].tolist())
        real = sum(map(idf.get, both)) / sum(map(idf.get, every))
        assert abs((x == y).mean() - real) < 0.05
