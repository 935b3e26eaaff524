"""Licences in documents, by their sentences.

A text is cut into sentences, each is normalised, and those of a table of known licence sentences
become identifiers.  The sequence of identifiers is matched against licence rules in order: a rule is
a run of identifiers; where it occurs it names its licence and uses them up, so the whole text of a
licence is tried before a short notice that is part of it.  What no rule uses stays undecided.

``scan`` takes every line end as the end of a sentence, as its SQL does.  ``scan_whole`` reads
sentences that are wrapped over lines, also in comments and lists, with other names in them, and
knows more licences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of published licences and notices, by identifier.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                    "this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-basis": "Unless required by applicable law or agreed to in writing, software distributed "
                    "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                    "CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations "
                  "under the License.",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                 "software and associated documentation files (the \"Software\"), to deal in the "
                 "Software without restriction, including without limitation the rights to use, copy, "
                 "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
                 "and to permit persons to whom the Software is furnished to do so, subject to the "
                 "following conditions:",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies "
                "or substantial portions of the Software.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
             "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
             "PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
                     "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
                     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
                     "OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with "
                 "or without fee is hereby granted, provided that the above copyright notice and this "
                 "permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are "
                 "permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of "
                  "conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list "
                  "of conditions and the following disclaimer in the documentation and/or other "
                  "materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be "
                 "used to endorse or promote products derived from this software without specific "
                 "prior written permission.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-later": "This program is free software: you can redistribute it and/or modify it under the "
                  "terms of the GNU General Public License as published by the Free Software "
                  "Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
                    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
                    "PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "mpl2-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at "
                 "http://mozilla.org/MPL/2.0/.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc0": "Released under CC0 1.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights": "All rights reserved.",
}
# Licences and their runs of sentences, tried in this order.
RULES = (
    ("MIT", ("mit-grant", "mit-keep", "as-is", "mit-liability")),
    ("Apache-2.0", ("apache-grant", "apache-copy", "apache-basis", "apache-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("MPL-2.0", ("mpl2-terms", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-terms",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-grant",)),
    ("Apache-2.0", ("apache-notice",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-licensed",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
)

# Further sentences and rules of ``scan_whole``.
_GNU = ("This {what} is free software{mark} you can redistribute it and/or modify it under the terms of "
        "the GNU {name} as published by the Free Software Foundation{either} version {n} of the "
        "License{later}")
_LATER = ", or (at your option) any later version."


def _gnu(name: str, n: str, mark: str = ":", either: str = ", either", later: str = _LATER,
         what: str = "program") -> str:
    return _GNU.format(what=what, mark=mark, name=name, either=either, n=n, later=later)


_GPL, _LESSER = "General Public License", "Lesser General Public License"
_AFFERO = "Affero General Public License"
MORE_SENTENCES = {
    "gpl2-later": _gnu(_GPL, "2", ";", "; either"),
    "gpl2-only": _gnu(_GPL, "2", ";", ";", "."),
    "gpl3-only": _gnu(_GPL, "3", ":", ",", "."),
    "lgpl2-later": _gnu("Library General Public License", "2", ";", "; either"),
    "lgpl21-later": _gnu(_LESSER, "2.1", ";", "; either"),
    "lgpl21-only": _gnu(_LESSER, "2.1", ";", ";", "."),
    "lgpl3-later": _gnu(_LESSER, "3"),
    "lgpl3-only": _gnu(_LESSER, "3", ":", ",", "."),
    "agpl3-later": _gnu(_AFFERO, "3"),
    "agpl3-only": _gnu(_AFFERO, "3", ":", ",", "."),
    "lgpl-see": "See the GNU Lesser General Public License for more details.",
    "lgpl2-see": "See the GNU Library General Public License for more details.",
    "agpl-see": "See the GNU Affero General Public License for more details.",
    "epl1": "This program and the accompanying materials are made available under the terms of the "
            "Eclipse Public License v1.0 which accompanies this distribution, and is available at "
            "http://www.eclipse.org/legal/epl-v10.html",
    "epl2": "This program and the accompanying materials are made available under the terms of the "
            "Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/",
    "epl2-v": "This program and the accompanying materials are made available under the terms of the "
              "Eclipse Public License v2.0 which accompanies this distribution, and is available at "
              "http://www.eclipse.org/legal/epl-v20.html",
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0.",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining "
                 "a copy of the software and accompanying documentation covered by this license (the "
                 "\"Software\") to use, reproduce, display, distribute, execute, and transmit the "
                 "Software, and to prepare derivative works of the Software, and to permit third-parties "
                 "to whom the Software is furnished to do so, all subject to the following:",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liability": "In no event will the authors be held liable for any damages arising from the use "
                      "of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including "
                  "commercial applications, and to alter it and redistribute it freely, subject to the "
                  "following restrictions:",
    "isc-and": "Permission to use, copy, modify, and distribute this software for any purpose with or "
               "without fee is hereby granted, provided that the above copyright notice and this "
               "permission notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with "
                  "or without fee is hereby granted.",
}
MORE_RULES = (
    *((name, (i, "gpl-warranty", see)) for name, i, see in (
        ("GPL-2.0-or-later", "gpl2-later", "gpl-see"), ("GPL-2.0-only", "gpl2-only", "gpl-see"),
        ("GPL-3.0-only", "gpl3-only", "gpl-see"), ("LGPL-2.0-or-later", "lgpl2-later", "lgpl2-see"),
        ("LGPL-2.1-or-later", "lgpl21-later", "lgpl-see"), ("LGPL-2.1-only", "lgpl21-only", "lgpl-see"),
        ("LGPL-3.0-or-later", "lgpl3-later", "lgpl-see"), ("LGPL-3.0-only", "lgpl3-only", "lgpl-see"),
        ("AGPL-3.0-or-later", "agpl3-later", "agpl-see"), ("AGPL-3.0-only", "agpl3-only", "agpl-see"))),
    ("Zlib", ("zlib-as-is", "zlib-liability", "zlib-grant")),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("GPL-3.0-only", ("gpl3-only",)),
    ("LGPL-2.0-or-later", ("lgpl2-later",)),
    ("LGPL-2.1-or-later", ("lgpl21-later",)),
    ("LGPL-2.1-only", ("lgpl21-only",)),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("LGPL-3.0-only", ("lgpl3-only",)),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("AGPL-3.0-only", ("agpl3-only",)),
    ("EPL-1.0", ("epl1",)),
    ("EPL-2.0", ("epl2",)),
    ("EPL-2.0", ("epl2-v",)),
    ("BSL-1.0", ("bsl-grant",)),
    ("BSL-1.0", ("bsl-notice",)),
    ("Zlib", ("zlib-grant",)),
    ("ISC", ("isc-and",)),
    ("0BSD", ("0bsd-grant",)),
)
# Between words: a blank, the end of a sentence, a line end inside a paragraph.
_END, _LINE = "\x01", "\x02"
_GAP = f"[ {_END}{_LINE}]"
_NAME = f"(?:[a-z0-9]+{_GAP}){{1,16}}?"
# Places of names in sentences, and what is read there.
SLOTS = (
    ("neither the names? of ", " nor the names of (?:its|their|any|the|other) contributors may be",
     "neither the name of the copyright holder nor the names of its contributors may be"),
    ("in no event shall ", " be liable for any claim damages",
     "in no event shall the authors or copyright holders be liable for any claim damages"),
    ("", "is free software you can redistribute it",
     "this program is free software you can redistribute it"),
    ("", "is distributed in the hope that it will be useful but without",
     "this program is distributed in the hope that it will be useful but without"),
)


def sentences(text: Column) -> Column:
    """Normalised sentences: cut at line ends and at white space after ``.``, ``!``, ``?``, ``:``;
    lower-cased, every run of characters other than letters a-z and digits one blank."""
    cut = F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?:])[\x20\x09-\x0D]+", "$1\n")
    lower = F.translate(cut, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = F.regexp_replace(lower, r"[^a-z0-9\n]+", " ")
    return F.transform(F.split(plain, "\n"), lambda s: F.trim(s))


def normal(sentence: str) -> str:
    plain = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(plain.split())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_sentences, sentence_ids, licenses, undecided of every row of ``docs``.

    ``n_sentences`` counts the non-empty sentences, ``sentence_ids`` are those recognised in order of
    the text, ``licenses`` the distinct licences in order of the rules, ``undecided`` the number of
    recognised sentences that no rule used.  Null and empty texts have no sentences.
    """
    known = F.create_map(*(F.lit(x) for i, s in SENTENCES.items() for x in (normal(s), i)))
    found = docs.select(F.col(id_col), sentences(F.col(text_col)).alias("s")).select(
        id_col, F.size(F.filter("s", lambda s: s != "")).alias("n_sentences"),
        F.filter(F.transform("s", lambda s: F.try_element_at(known, s)),
                 lambda i: i.isNotNull()).alias("ids"))
    return _decide(found, id_col, RULES)


def broken(text: Column) -> Column:
    """The words of a text, with marks for ends of sentences and for line ends inside paragraphs.

    Sentences end at ``.``, ``!``, ``?``, ``:`` before white space, at lines without a letter or digit
    (comment marks alone are such) and at list marks, which go.  No pattern repeats a group without
    bound or begins anew inside a run it has passed over, so long runs and many blank lines take time
    and stack in proportion.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    t = F.translate(F.coalesce(text, F.lit("")), upper + _END + _LINE, upper.lower() + "  ")
    for pattern, by in (
            (r"\r\n?", "\n"),
            (r"(?m)^[^a-z0-9\n]*+(?:dnl|rem)(?=[ \t\n])", ""),
            (r"(?m)^(?:[^a-z0-9\n]*?\(?(?:[0-9]{1,2}|[a-z]|i{1,3}|iv)[.)]"
             r"|[ \t]*(?:(?://+|#+|;+|%+|\*)[ \t]+\*|(?:(?://+|#+|;+|%+|\*)[ \t]+)?[-+\u2022]))[ \t]+", _END),
            (r"[.!?:][\x20\x09-\x0D]+", _END),
            (rf"\n[^a-z0-9{_END}]*\n", _END),
            (rf"(?<![^a-z0-9{_END}])[^a-z0-9{_END}]*+{_END}[^a-z0-9]*+", _END),
            (rf"(?<![^a-z0-9\n{_END}])[^a-z0-9\n{_END}]*+\n[^a-z0-9\n{_END}]*+", _LINE),
            (rf"[^a-z0-9{_END}{_LINE}]+", " ")):
        t = F.regexp_replace(t, pattern, by)
    return F.trim(t)


def _gaps(words: str) -> str:
    return words.replace(" ", _GAP + "+")


def _named(t: Column) -> Column:
    """The usual words in the places of names, and http for https."""
    out = F.regexp_replace(t, r"\bhttps\b", "http")
    for before, after, usual in SLOTS:
        start = (_gaps(before) + _NAME if before else  # a name before it stands on its line
                 f"(?<=[{_END}{_LINE}])(?:[a-z0-9]+ ){{0,8}}?[a-z0-9]+{_GAP}+")
        out = F.regexp_replace(out, start + _gaps(after.lstrip()), usual)
    return F.when(t.rlike("redistribut|contributors|liable|https|hope"), out).otherwise(t)


def scan_whole(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``scan``, with the sentences and rules of both tables, wherever their lines are broken.

    A sentence begins and ends at the end of a sentence or a line; inside it any break may be.
    ``n_sentences`` counts a wrapped sentence once.
    """
    table = {normal(s).replace("https ", "http "): i
             for i, s in (SENTENCES | MORE_SENTENCES).items()}
    known = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    any_of = "|".join(_gaps(s) for s in sorted(table, key=len, reverse=True))
    text = docs.select(F.col(id_col), broken(F.col(text_col)).alias("t"))
    marked = _named(F.concat(F.lit(_END), F.col("t"), F.lit(_END)))
    found = text.select(id_col, "t", marked.alias("m")).select(
        id_col, F.size(F.filter(F.split(F.translate("t", _LINE, " "), _END),
                                lambda s: F.trim(s) != "")).alias("n_sentences"),
        F.transform(F.regexp_extract_all(
            "m", F.lit(f"(?<=[{_END}{_LINE}])(?:{any_of})(?=[{_END}{_LINE}])"), F.lit(0)),
            lambda s: F.element_at(known, F.regexp_replace(s, _GAP + "+", " "))).alias("ids"))
    return _decide(found, id_col, RULES + MORE_RULES)


def _decide(found: DataFrame, id_col: str, known_rules) -> DataFrame:
    rules = F.array(*(F.struct(F.lit(name).alias("name"),
                               F.lit("".join(f"<{i}>" for i in run)).alias("run"))
                      for name, run in known_rules))
    text = F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">")))
    matched = F.aggregate(
        rules, F.struct(F.array_join(text, "").alias("rest"),
                        F.array().cast("array<string>").alias("names")),
        lambda acc, r: F.struct(
            F.replace(acc["rest"], r["run"], F.lit("|")).alias("rest"),
            F.when(F.contains(acc["rest"], r["run"]),
                   F.array_union(acc["names"], F.array(r["name"]))).otherwise(acc["names"])
            .alias("names")))
    return found.withColumn("m", matched).select(
        id_col, F.col("n_sentences").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join("m.names", ",").alias("licenses"),
        F.regexp_count("m.rest", F.lit("<")).cast("long").alias("undecided"))


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql() -> str:
    """The same for DuckDB."""
    known = "map {" + ", ".join(f"{_text(normal(s))}: {_text(i)}"
                                for i, s in SENTENCES.items()) + "}"
    steps, last = [], "s0"
    for k, (name, run) in enumerate(RULES, 1):
        pattern = _text("".join(f"<{i}>" for i in run))
        steps.append(
            f"s{k} AS (SELECT * REPLACE (replace(rest, {pattern}, '|') AS rest, CASE WHEN "
            f"contains(rest, {pattern}) AND NOT list_contains(names, {_text(name)}) "
            f"THEN list_append(names, {_text(name)}) ELSE names END AS names) FROM {last})")
        last = f"s{k}"
    return rf"""
WITH a AS (
  SELECT doc_id, list_transform(string_split(regexp_replace(translate(regexp_replace(
    coalesce(text, ''), '([.!?:])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\n]+', ' ', 'g'),
    chr(10)), lambda s: trim(s)) AS s FROM documents),
b AS (
  SELECT doc_id, len(list_filter(s, lambda x: x <> '')) AS n_sentences,
    list_filter(list_transform(s, lambda x: {known}[x]), lambda i: i IS NOT NULL) AS ids FROM a),
s0 AS (SELECT doc_id, n_sentences, ids, array_to_string(
    list_transform(ids, lambda i: '<' || i || '>'), '') AS rest, CAST([] AS VARCHAR[]) AS names
  FROM b),
{(','+chr(10)).join(steps)}
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences,
  coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  coalesce(array_to_string(names, ','), '') AS licenses,
  CAST(len(rest) - len(replace(rest, '<', '')) AS BIGINT) AS undecided
FROM {last}
"""
