"""Licence notices found by Dice similarity over word bigrams; column expressions only."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Parts of short licences.
MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
MIT_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ISC_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

# Usual licence notices, titles and short licences whole, by identifier.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "MIT License",
        "The MIT License (MIT)",
        MIT_GRANT,
        MIT_NOTICE,
        MIT_WARRANTY,
        f"{MIT_GRANT} {MIT_NOTICE} {MIT_WARRANTY}",
    ],
    "ISC": ["ISC License", "Licensed under the ISC License.", ISC_GRANT, f"{ISC_GRANT} {ISC_WARRANTY}"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "BSD 2-Clause License", f"{BSD_GRANT} 1. {BSD_SOURCE} 2. {BSD_BINARY} {BSD_WARRANTY}"],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "BSD 3-Clause License",
        BSD_GRANT,
        BSD_NAMES,
        f"{BSD_GRANT} 1. {BSD_SOURCE} 2. {BSD_BINARY} 3. {BSD_NAMES} {BSD_WARRANTY}",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Mozilla Public License Version 2.0",
    ],
    "EPL-2.0": [
        "Eclipse Public License - v 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "LicenseRef-All-Rights-Reserved": ["All rights reserved."],
}
for _name, _texts in TEMPLATES.items():
    if not _name.startswith("LicenseRef-"):
        _forms = ["-only", "-or-later"] if "GPL" in _name else []
        _texts.extend(f"SPDX-License-Identifier: {_name}{form}" for form in ["", *_forms])

# Words that stand in any text.
COMMON = frozenset("a above all an and any are as at be by can for following free from in including is it may not of on or other provided shall that the this to under use with without work you your".split())
BREAK = r"\n(?:[^\p{L}\p{N}\n]*\n)+"  # a line, or several, without letter and digit: blank, or comment marks only
STOP = r"[.!?][ \t\r\n]+|:[ \t\r]*\n"


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of a template, by the rule of :func:`bigrams`."""
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def words_of(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def least_common(grams: int, threshold: float) -> int:
    """How many of a template's bigrams a unit must hold to reach the threshold."""
    return math.ceil(grams * threshold / (2 - threshold) - 1e-9)


def anchors(templates: list[list[str]], threshold: float) -> list[str]:
    """Words of which every unit that reaches the threshold for a template of these bigrams holds one.

    A unit may lack ``len - least_common`` bigrams of a template; the words taken
    from each template stand in more of its bigrams than that.  Words taken for others
    come first, then those that are not ``COMMON``, then those of many templates, then long ones.
    """
    taken: set[str] = set()
    spread = Counter(w for grams in templates for w in {w for g in grams for w in g.split(" ")})
    for grams in sorted(templates, key=lambda g: (len(g), g)):
        pairs = [tuple(g.split(" ")) for g in grams]
        spare = len(grams) - least_common(len(grams), threshold)
        own: set[str] = set()
        for word in sorted({w for p in pairs for w in p}, key=lambda w: (w not in taken, w in COMMON or w.isdigit(), -spread[w], -len(w), w)):
            if sum(a in own or b in own for a, b in pairs) > spare:
                break
            own.add(word)
        taken |= own
    return sorted(taken)


def normalised(text: Column) -> Column:
    """Words in lower case, what is neither letter nor digit as one space between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def bigrams(plain: Column) -> Column:
    """Distinct word bigrams of a normalised text."""

    def pairs(words: Column) -> Column:
        last = F.size(words) - 1
        return F.zip_with(F.slice(words, 1, last), F.slice(words, 2, last), lambda a, b: F.concat_ws(" ", a, b))

    # in a lambda, so that the text is split once
    return F.array_distinct(F.flatten(F.transform(F.array(F.split(plain, " ")), pairs)))


def licence_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """A row for each line, sentence, paragraph of several lines, or whole text that is like a licence notice.

    ``doc_id``, ``unit`` (line, sentence, paragraph, text), ``place`` (its number from 0),
    ``licence``, ``dice``, ``n_bigrams``, ``span`` (the unit as it stands; a sentence without its
    stop).  Paragraphs part at lines without letter and digit, so also at empty lines of a
    comment; sentences part there, at ``. ! ?`` before white space and at ``:`` before a new line, and may run over lines.
    A notice that is unit of several kinds gives a row for each.
    Each unit is held against the templates by the Dice coefficient of its
    distinct word bigrams; of templates with at least ``threshold`` the best
    counts, on a tie the licence first by name.

    What cannot reach the threshold is left out early, and only that: texts and units
    without any of the ``anchors``; units with too few words for any template, or too few
    bigrams that stand in any; templates of m bigrams for units of fewer than ``m t / (2 - t)``
    or more than ``m (2 - t) / t``.

    Texts that are null, empty or without bigrams give no row.  Repeated rows give
    theirs each; a null id stays null.  Extra columns are not read.  Each row
    is handled alone: there is no shuffle, whatever the input.
    """
    known = [(name, grams) for name, texts in sorted((templates or TEMPLATES).items()) for grams in map(bigrams_of, texts) if grams]
    if not known:
        known = [("", ["a b"])]
        threshold = 2.0  # out of reach
    low, high = min(threshold, 1.0) / (2 - min(threshold, 1.0)), (2 - min(threshold, 1.0)) / min(threshold, 1.0)
    fewest, most = min(len(g) for _, g in known) * low, max(len(g) for _, g in known) * high
    anchor = "|".join(anchors([g for _, g in known], min(threshold, 1.0)))
    anchor = rf"(?<![\p{{L}}\p{{N}}])(?:{anchor})(?![\p{{L}}\p{{N}}])"  # whole words, as normalising parts them
    vocabulary = sorted({g for _, grams in known for g in grams})
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.lower("text").rlike(anchor))

    def units(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda part, i: F.struct(F.lit(kind).alias("unit"), i.cast("int").alias("place"), part.alias("span")))

    paragraphs = F.filter(units("paragraph", F.split("text", BREAK, -1)), lambda p: p["span"].contains("\n"))
    whole = F.when(F.col("text").rlike(BREAK), units("text", F.array("text"))).otherwise(F.array().cast("array<struct<unit:string,place:int,span:string>>"))
    sentences = units("sentence", F.split("text", f"{STOP}|{BREAK}", -1))
    sentences = F.when(F.col("text").rlike(STOP), sentences).otherwise(F.array().cast("array<struct<unit:string,place:int,span:string>>"))
    parts = F.concat(units("line", F.split("text", "\n", -1)), sentences, paragraphs, whole)
    # Filters stand inside the arrays: each unit is normalised once, and only survivors become rows.
    # Word gaps bound the distinct bigrams from above, so what has fewer than any template needs is left out early.
    parts = F.filter(parts, lambda u: F.lower(u["span"]).rlike(anchor))
    plain = F.transform(parts, lambda u: F.struct(u["unit"].alias("unit"), u["place"].alias("place"), u["span"].alias("span"), normalised(u["span"]).alias("plain")))
    plain = F.filter(plain, lambda u: F.char_length(u["plain"]) - F.char_length(F.translate(u["plain"], " ", "")) >= fewest)
    split = F.transform(plain, lambda u: F.struct(u["unit"].alias("unit"), u["place"].alias("place"), u["span"].alias("span"), bigrams(u["plain"]).alias("grams")))
    split = F.filter(split, lambda u: F.size(u["grams"]).between(F.lit(fewest), F.lit(most)))
    split = F.filter(split, lambda u: F.size(F.filter(u["grams"], lambda g: g.isin(vocabulary))) >= F.size(u["grams"]) * (low - 1e-9))
    found = rows.select("doc_id", F.explode(split).alias("u")).select("doc_id", "u.*").withColumn("n_bigrams", F.size("grams"))
    tables = F.array(*[F.struct(F.lit(name).alias("licence"), F.array(*map(F.lit, own)).alias("own"), F.lit(len(own)).alias("m")) for name, own in known])
    near = F.filter(tables, lambda t: F.col("n_bigrams").between(t["m"] * low, t["m"] * high))
    dice = F.transform(
        near,
        lambda t: F.struct((2.0 * F.size(F.array_intersect("grams", t["own"])) / (F.col("n_bigrams") + t["m"])).alias("dice"), t["licence"].alias("licence")),
    )
    best = F.reduce(
        dice,
        F.struct(F.lit(-1.0).alias("dice"), F.lit("").alias("licence")),
        lambda a, b: F.when(b["dice"] > a["dice"], b).otherwise(a),
    )
    found = found.withColumn("best", best).where(F.col("best.dice") >= threshold)
    return found.select("doc_id", "unit", "place", F.col("best.licence").alias("licence"), F.round("best.dice", 6).alias("dice"), "n_bigrams", "span")
