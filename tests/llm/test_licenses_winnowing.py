"""License scans and fingerprints: column expressions alone, checked by hand and by brute force."""

import re

import fixtures
import pytest
from pyspark.sql import functions as F

from seriesmill.llm import licenses, queries, winnowing

MIT = '''
// Copyright (c) 2020 Somebody
// Permission is hereby granted, free of charge, to any person obtaining a copy
// of this software and associated documentation files (the "Software"), to deal
// in the Software without restriction, including without limitation the rights
// to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
// copies of the Software, and to permit persons to whom the Software is
// furnished to do so, subject to the following conditions:
//
// The above copyright notice and this permission notice shall be included in all
// copies or substantial portions of the Software.
//
// THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
// IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
// FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
// AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
// LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
// OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
// SOFTWARE.
int main() {}
'''
APACHE = '''
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
'''
CASES = [
    (MIT, ["MIT"], 0),
    (APACHE, ["Apache-2.0"], 0),
    (APACHE + MIT + APACHE, ["Apache-2.0", "MIT"], 0),
    ("Some words. Released under the MIT License.\nMore.", ["MIT"], 0),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"], 0),
    ("Licensed under the Apache License, Version 2.0. Released under the MIT License.", ["Apache-2.0", "MIT"], 0),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"], 0),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. x", ["MPL-2.0"], 0),
    ("See the GNU General Public License for more details.", [], 1),
    ("not Released under the MIT License", [], 0),
    ("The MIT License is short.", [], 0),
    ("", [], 0),
    (None, [], 0),
]


def test_scan_cases(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, (t, *_) in enumerate(CASES)], "doc_id long, text string, licenses string")
    rows = {r["row"]["doc_id"]: r for r in licenses.scan(docs).collect()}
    for i, (_, names, rest) in enumerate(CASES):
        assert (rows[i]["licenses"], rows[i]["unmatched"]) == (names, rest), CASES[i][0]


LINES = [
    ("Words without an end ***\nLicensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("| a | row |\n| another | row |\nReleased under the MIT License.\nMore.", ["MIT"]),
    ("MIT License" + MIT.replace("// Copyright (c) 2020 Somebody\n", ""), ["MIT"]),
    ("int x\n" * 400 + "// Licensed under the Apache License,\n// Version 2.0.", ["Apache-2.0"]),
    # The longest run of lines counts, and once.
    ("head\nThis work is\nlicensed under the GNU General Public License,\nversion 3.", ["GPL-3.0-only"]),
    ("a line\nnot Released under the MIT License.", []),
]


def test_notices_after_lines_without_an_end(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LINES)], "doc_id long, text string")
    rows = {r["row"]["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert [rows[i]["licenses"] for i in range(len(LINES))] == [names for _, names in LINES]
    assert rows[4]["sentence_ids"] == ["gpl-3-under"]


def test_every_rule_matches_its_own_run(spark):
    rows = [(i, ". ".join(licenses.SENTENCES[s] for s in run) + ".") for i, (_, run) in enumerate(licenses.RULES)]
    got = {r["row"]["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (name, run) in enumerate(licenses.RULES):
        assert got[i]["sentence_ids"] == run and got[i]["licenses"] == [name] and got[i]["unmatched"] == 0
    assert len(set(licenses.SENTENCES.values())) == len(licenses.SENTENCES)


NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
}


def test_op2_finds_the_planted_notices(spark):
    found = {r["doc_id"]: r["licenses"].split() for r in queries.op2_license_scan(spark, fixtures.SF).collect()}
    texts = fixtures.texts(spark)
    assert len(found) == len(texts)
    for key, text in texts:
        assert set(found[key]) - {"LicenseRef-all-rights-reserved"} == {name for notice, name in NOTICES.items() if notice in text}


def test_scan_edges_and_plan(spark, plan_of):
    docs = fixtures.edges(spark, clashing=True)
    assert licenses.scan(docs).count() == len(fixtures.EDGES)
    assert licenses.scan(fixtures.empty(spark)).count() == 0
    plan = plan_of(queries.op2_license_scan(spark, fixtures.SF))
    assert "Exchange" not in plan and "Python" not in plan and "InArrow" not in plan


# Fingerprints ----------------------------------------------------------------------------------


def brute(hashes, gram, window):
    """Winnowing by its definition over hashes of grams: [(hash, position)]."""
    if not hashes:
        return []
    chosen = []
    for low in range(max(1, len(hashes) - window + 1)):
        part = hashes[low : low + window]
        least = min(part)
        at = low + max(i for i, h in enumerate(part) if h == least)
        if (least, at) not in chosen:
            chosen.append((least, at))
    return chosen


@pytest.mark.parametrize("gram,window", [(4, 8), (2, 4), (4, 1)])
def test_winnowing_equals_brute_force(spark, gram, window):
    texts = [t or "" for _, t, *_ in fixtures.EDGES] + ["a b " * 30, "a", "A\tb", fixtures.prose(5, 11), fixtures.prose(5, 12)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    every = winnowing.fingerprint(docs, "text", "all", gram, 1)  # a window of one chooses every place
    rows = winnowing.fingerprint(every, "text", "chosen", gram, window).select(
        "doc_id", "text",
        *(F.transform(c, lambda x: F.shiftright(x, winnowing.PLACE_BITS)).alias(f"{c}_h") for c in ("all", "chosen")),
        *(winnowing.positions_of(F.col(c)).alias(f"{c}_at") for c in ("all", "chosen")),
    )
    for r in rows.collect():
        words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", r["text"]) if w]
        assert r["all_at"] == list(range(max(len(words) - gram + 1, min(1, len(words)))))
        assert list(zip(r["chosen_h"], r["chosen_at"])) == brute(r["all_h"], gram, window)


def test_shared_runs_share_a_fingerprint(spark):
    shared = fixtures.prose(70, winnowing.WINDOW + winnowing.GRAM - 1)
    rows = [(i, f"{fixtures.prose(80 + i, 30 + i)} {shared} {fixtures.prose(90 + i, 20)}") for i in range(20)]
    docs = winnowing.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "c")
    sets = [set(r[0]) for r in docs.select(winnowing.hashes_of(F.col("c"))).collect()]
    assert set.intersection(*sets)


@pytest.mark.parametrize("per_bucket", [1, 3, 1000])
def test_neighbours_and_edits(spark, per_bucket):
    rows = sorted(((k, t or "") for k, t, *_ in fixtures.EDGES), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    docs = fixtures.edges(spark, clashing=True).repartition(5)
    got = [(r["doc_id"], r["text"], r["edited"]) for r in winnowing.compared(docs, rows_per_bucket=per_bucket).collect()]
    wanted = []
    for i, (key, text) in enumerate(rows):
        half = len(text) // 2
        wanted.append((key, text, text[: len(text) - half] + rows[(i + 1) % len(rows)][1][:half]))
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert winnowing.compared(fixtures.empty(spark)).count() == 0


def test_op9_over_the_documents(spark, plan_of):
    texts = fixtures.texts(spark)
    made = queries.op9_winnowing(spark, fixtures.SF)
    rows = {r["doc_id"]: r for r in made.collect()}
    for i, (key, text) in enumerate(texts):
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[(i + 1) % len(texts)][1][:half]
        r = rows[key]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == fixtures.sha(edited.encode())
        own = {x.split("@")[0] for x in r["fingerprint"].split()}
        for other, name in ((r["edited_fingerprint"], "near_edited"), (rows[texts[(i + 1) % len(texts)][0]]["fingerprint"], "near_next")):
            other = {x.split("@")[0] for x in other.split()}
            like = len(own & other) / len(own | other) if own | other else 1.0
            assert abs(r[name] - like) < 1e-12
    by_text = {}
    for key, text in texts:
        assert by_text.setdefault(text, rows[key]["fingerprint"]) == rows[key]["fingerprint"]
    plan = plan_of(queries.op9_winnowing(spark, fixtures.SF))
    assert "Python" not in plan and "InArrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
