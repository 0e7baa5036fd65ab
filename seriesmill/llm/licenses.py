"""License scans by recognised sentences.

A text is cut into sentences; each is normalised (small letters, no comment
marks, no punctuation, single spaces) and looked up among the sentences of known
licences, which gives the text's sequence of sentence identifiers.  A line break
need not end a sentence, but one may start after it: where a whole sentence is not
known, what follows each of its line breaks is looked up too, the longest first.
So a notice after a heading or a line without a full stop is recognised.  Ordered
rules, the longest first, then match runs of that sequence; what a rule has
matched later rules don't see.  All of it is one projection of column
expressions: nothing is shuffled.

The sentence table has a fixed size.  A sentence is looked up in it by a linear
search, at some nanoseconds for each of its entries.

Defined results: a null text has no sentences; a text without known sentences
has an empty sequence, no licences and ``unmatched`` 0; repeated rows and ties
give equal results; an empty table stays empty; the input's columns are kept in
a struct, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of public licences and notices, and their identifiers.
SENTENCES = {
    "mit-by": "released under the mit license",
    "mit-under": "licensed under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "spdx-mit": "spdx license identifier mit",
    "apache-2-under": "licensed under the apache license version 2.0",
    "apache-2-the": "licensed under the apache license version 2.0 the license",
    "apache-2-use": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "apache-2-url": "http www apache org licenses license 2.0",
    "apache-2-unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-2-see": "see the license for the specific language governing permissions and limitations under the license",
    "spdx-apache-2": "spdx license identifier apache 2.0",
    "gpl-3-under": "this work is licensed under the gnu general public license version 3",
    "gpl-3-licensed": "licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "spdx-gpl-3": "spdx license identifier gpl 3.0 or later",
    "spdx-gpl-3-only": "spdx license identifier gpl 3.0 only",
    "lgpl-3-under": "licensed under the gnu lesser general public license version 3",
    "agpl-3-under": "licensed under the gnu affero general public license version 3",
    "mpl-2-subject": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "mpl-2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2.0",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-under": "released under the bsd license",
    "cc-by-nc-4": "licensed under cc by nc 4.0",
    "cc-by-4": "licensed under cc by 4.0",
    "cc-by-sa-4": "licensed under cc by sa 4.0",
    "cc-by-long": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc0": "released under cc0 1.0",
    "isc-permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "all-rights": "all rights reserved",
}

# Licence, and the run of sentence identifiers that shows it; the first rule that matches wins.
RULES = [
    ("MIT", ["mit-permission", "mit-notice", "mit-warranty", "mit-liability"]),
    ("Apache-2.0", ["apache-2-the", "apache-2-use", "apache-2-copy", "apache-2-url", "apache-2-unless", "apache-2-see"]),
    ("Apache-2.0", ["apache-2-the", "apache-2-use", "apache-2-copy", "apache-2-unless", "apache-2-see"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("GPL-2.0-or-later", ["gpl-2-free", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-see"]),
    ("GPL-2.0-or-later", ["gpl-2-free", "gpl-hope", "gpl-see"]),
    ("MPL-2.0", ["mpl-2-subject", "mpl-2-copy"]),
    ("MIT", ["mit-permission", "mit-notice"]),
    ("Apache-2.0", ["apache-2-the", "apache-2-use"]),
    ("ISC", ["isc-permission"]),
    ("MPL-2.0", ["mpl-2-subject"]),
    ("MIT", ["mit-by"]),
    ("MIT", ["mit-under"]),
    ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["apache-2-the"]),
    ("Apache-2.0", ["apache-2-under"]),
    ("Apache-2.0", ["spdx-apache-2"]),
    ("GPL-3.0-only", ["gpl-3-under"]),
    ("GPL-3.0-only", ["gpl-3-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl-2-free"]),
    ("GPL-3.0-or-later", ["spdx-gpl-3"]),
    ("GPL-3.0-only", ["spdx-gpl-3-only"]),
    ("LGPL-3.0-only", ["lgpl-3-under"]),
    ("AGPL-3.0-only", ["agpl-3-under"]),
    ("BSD", ["bsd-under"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-long"]),
    ("CC0-1.0", ["cc0"]),
    ("LicenseRef-all-rights-reserved", ["all-rights"]),
]

# A sentence ends at . ; ! or ? before white space or the end of the text (but not at "v."), at a
# colon that ends a line, at a line that is empty but for comment marks, and around a copyright line.
_END = (
    r"(?<!\bv)[.;!?]+(?=\s|$)|:(?=[ \t]*(\n|$))|\n[ \t#/*;%-]*(?=\n|$)"
    r"|(?<![^\n])[ \t#/*;%-]*(copyright|\(c\)|©)[^\n.]*"
)
_BREAK, _LINE = "\u0001", "\u0002"


def sentences(text: Column) -> Column:
    """Normalised sentences of a text, in order; ``_LINE`` stands for the space at a line break."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _END, _BREAK)
    plain = F.translate(plain, "\n", _LINE)
    plain = F.regexp_replace(plain, f"[^\\p{{L}}\\p{{N}}.{_BREAK}{_LINE}]+", " ")
    # A dot counts between digits alone, as in a version.
    plain = F.regexp_replace(plain, r" *(\.(?!\p{N})|(?<!\p{N})\.) *", " ")
    plain = F.regexp_replace(plain, f" *{_LINE}[ {_LINE}]*", _LINE)
    return F.split(plain, f"[ {_LINE}]*{_BREAK}[ {_LINE}]*")


def sentence_ids(text: Column, known: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    table = F.create_map(*(F.lit(x) for name, sentence in known.items() for x in (sentence, name)))
    # What is longer than every known sentence is not one: no start before that is looked up.
    longest = F.lit(max(map(len, known.values())) + 1)
    lines = F.transform(sentences(text), lambda s: F.split(F.right(F.btrim(s, F.lit(f" {_LINE}")), longest), _LINE))

    def first_known(own: Column) -> Column:
        tails = F.transform(own, lambda _, i: F.element_at(table, F.array_join(F.slice(own, i + 1, F.size(own)), " ")))
        return F.get(F.filter(tails, lambda x: x.isNotNull()), F.lit(0))

    found = F.transform(lines, first_known)
    return F.filter(found, lambda x: x.isNotNull())


def matched(ids: Column, rules: list[tuple[str, list[str]]] = RULES) -> tuple[Column, Column]:
    """(numbers of the rules that match, in the order of the text; what is left of the sequence).

    The sequence is written as text, one identifier between bars; a rule's run
    becomes its number, which no later rule can match.
    """
    sequence = F.concat(F.lit("|"), F.array_join(F.transform(ids, lambda x: F.concat(F.lit("|"), x, F.lit("|"))), ""), F.lit("|"))

    def apply(text: Column, rule: tuple[int, tuple[str, list[str]]]) -> Column:
        number, (_, run) = rule
        return F.replace(text, F.lit("".join(f"|{x}|" for x in run)), F.lit(f"|={number}|"))

    done = F.filter(F.split(reduce(apply, enumerate(rules), sequence), "[|]+"), lambda x: x != "")
    return F.filter(done, lambda x: x.startswith("=")), F.filter(done, lambda x: ~x.startswith("="))


def scan(docs: DataFrame, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """(row, sentence_ids, licenses, unmatched): licences in order of appearance, each once."""
    names = F.create_map(*(F.lit(x) for i, (name, _) in enumerate(RULES) for x in (f"={i}", name)))
    rows = docs.select(F.struct(*(columns or docs.columns)).alias("row"), sentence_ids(F.col(text)).alias("sentence_ids"))
    found, rest = matched(F.col("sentence_ids"))
    return rows.select(
        "row",
        "sentence_ids",
        F.array_distinct(F.transform(found, lambda x: F.element_at(names, x))).alias("licenses"),
        F.size(rest).cast("long").alias("unmatched"),
    )
