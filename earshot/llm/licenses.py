"""License scans by sentence rules.

A text is cut into sentences, each sentence is normalised and mapped to the identifier of a
known licence sentence; the sequence of identifiers is then matched against ordered rules.
Longer rules come first and consume their identifiers, so the notice of a licence inside its
full text is not counted again.

A known sentence begins and ends where some sentence or line does.  Inside of it lines may be
wrapped (with or without comment marks) and there may be colons and semicolons, as in published
headers, but neither a final mark nor an empty line.  ``n_sentences`` counts the finest cut: at
each line end, final mark, colon and semicolon.

Everything is a projection of Spark expressions over one row: no shuffle, no user function,
so hot sources and copies need no care.  The rule table is fixed and small.

Null or empty text has no sentences and no licence.  Repeated rows give repeated results.
Further columns are carried along, whatever their names; the added columns are ``n_sentences``,
``sentence_ids``, ``licenses`` and ``n_licenses``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of public licences and of their usual notices.
SENTENCES = {
    "A1": "licensed under the apache license version 2 0",
    "A2": "you may not use this file except in compliance with the license",
    "A3": "you may obtain a copy of the license at",
    "A4": "http www apache org licenses license 2 0",
    "A5": "unless required by applicable law or agreed to in writing software distributed under "
    "the license is distributed on an as is basis without warranties or conditions of any kind "
    "either express or implied",
    "A6": "see the license for the specific language governing permissions and limitations under "
    "the license",
    "A7": "licensed under the apache license version 2 0 the license",
    "M1": "released under the mit license",
    "M2": "licensed under the mit license",
    "M3": "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files the software to deal in the software without "
    "restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the "
    "software is furnished to do so subject to the following conditions",
    "M4": "the above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the software",
    "M5": "the software is provided as is without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular "
    "purpose and noninfringement",
    "M6": "in no event shall the authors or copyright holders be liable for any claim damages or "
    "other liability whether in an action of contract tort or otherwise arising from out of or "
    "in connection with the software or the use or other dealings in the software",
    "G1": "this work is licensed under the gnu general public license version 3",
    "G2": "this work is licensed under the gnu general public license version 2",
    "G3": "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license as published by the free software foundation either "
    "version 3 of the license or at your option any later version",
    "G4": "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license as published by the free software foundation either "
    "version 2 of the license or at your option any later version",
    "G5": "this program is distributed in the hope that it will be useful but without any "
    "warranty without even the implied warranty of merchantability or fitness for a particular "
    "purpose",
    "G6": "see the gnu general public license for more details",
    "C1": "licensed under cc by nc 4 0",
    "C2": "licensed under cc by 4 0",
    "C3": "licensed under cc by sa 4 0",
    "C4": "this work is licensed under a creative commons attribution 4 0 international license",
    "C5": "this work is licensed under a creative commons attribution sharealike 4 0 "
    "international license",
    "C6": "this work is licensed under a creative commons attribution noncommercial 4 0 "
    "international license",
    "B1": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "B2": "redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer",
    "B3": "redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution",
    "B4": "neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written "
    "permission",
    "R1": "all rights reserved",
    "S1": "spdx license identifier mit",
    "S2": "spdx license identifier apache 2 0",
    "S3": "spdx license identifier gpl 3 0 or later",
}

# Ordered sequences of those identifiers and what they stand for.
RULES = (
    ("Apache-2.0", ("A7", "A2", "A3", "A4", "A5", "A6")),
    ("Apache-2.0", ("A7", "A2", "A3", "A5", "A6")),
    ("MIT", ("M3", "M4", "M5", "M6")),
    ("MIT", ("M3", "M4", "M5")),
    ("GPL-3.0-or-later", ("G3", "G5", "G6")),
    ("GPL-2.0-or-later", ("G4", "G5", "G6")),
    ("BSD-3-Clause", ("B1", "B2", "B3", "B4")),
    ("BSD-2-Clause", ("B1", "B2", "B3")),
    ("Apache-2.0", ("A7",)),
    ("Apache-2.0", ("A1",)),
    ("Apache-2.0", ("S2",)),
    ("MIT", ("M1",)),
    ("MIT", ("M2",)),
    ("MIT", ("S1",)),
    ("GPL-3.0-or-later", ("G3",)),
    ("GPL-2.0-or-later", ("G4",)),
    ("GPL-3.0-or-later", ("S3",)),
    ("GPL-3.0-only", ("G1",)),
    ("GPL-2.0-only", ("G2",)),
    ("CC-BY-NC-4.0", ("C1",)),
    ("CC-BY-NC-4.0", ("C6",)),
    ("CC-BY-4.0", ("C2",)),
    ("CC-BY-4.0", ("C4",)),
    ("CC-BY-SA-4.0", ("C3",)),
    ("CC-BY-SA-4.0", ("C5",)),
    ("All rights reserved", ("R1",)),
)

# Published forms of those sentences in which * stands for a name of some words.
FORMS = {
    "neither the name of * nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "B4",
    "* is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version 3 of the "
    "license or at your option any later version": "G3",
    "* is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version 2 of the "
    "license or at your option any later version": "G4",
    "* is distributed in the hope that it will be useful but without any warranty without even "
    "the implied warranty of merchantability or fitness for a particular purpose": "G5",
}
#: The most words of a name.
NAME_WORDS = 12

#: Where a sentence of the finest cut ends: final marks before white space, or a line end.
BREAK = r"[.!?:;]+[\x20\x09-\x0D]+|\n"
# Comment and list marks before a line's text.
_LEAD = r"(?m)^[^A-Za-z0-9\n]*(?:(?:dnl|DNL|rem|REM)[\x20\t]+)?(?:[0-9A-Za-z]{1,2}[.)][\x20\t]+)?[^A-Za-z0-9\n]*"
# What no sentence goes on over (an empty line, a final mark), and what it may.
_HARD = r"\n\n+|[.!?]+[\"')\]*/#-]*[\x20\x09-\x0D]+"
_SOFT = r"[:;]+[\x20\x09-\x0D]+|\n"
ADDED = ("n_sentences", "sentence_ids", "licenses", "n_licenses")


def pattern(ids: tuple[str, ...]) -> str:
    """How a rule looks inside ``sentence_ids``."""
    return "".join(f"[{i}]" for i in ids)


def normalise(sentence: Column) -> Column:
    """Lower-case ASCII letters and digits, with one blank between words."""
    plain = F.lower(F.regexp_replace(sentence, "[^A-Za-z0-9]+", " "))
    return F.btrim(plain)


def sentences_of(text: Column) -> Column:
    """The normalised sentences of a text that have a letter or digit."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), BREAK), normalise)
    return F.filter(parts, lambda s: s != "")


def marked(text: Column) -> Column:
    """The normalised words of a text, with ``|`` and ``~`` for breaks that end a sentence or may."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    plain = F.translate(F.regexp_replace(plain, _LEAD, ""), "|~", "  ")
    plain = F.regexp_replace(F.regexp_replace(plain, _HARD, " | "), _SOFT, " ~ ")
    plain = F.lower(F.regexp_replace(plain, "[^A-Za-z0-9|~]+", " "))
    return F.concat(F.lit("| "), plain, F.lit(" |"))


def _expression(words: str) -> str:
    """How a sentence looks in a marked text."""
    gap = "(?: ~)* "
    name = rf"[a-z0-9]+(?:{gap}[a-z0-9]+){{0,{NAME_WORDS - 1}}}?"
    return gap.join(name if w == "*" else w for w in words.split())


def known_ids(text: Column) -> Column:
    """The identifiers of a text's known sentences, in brackets and in order."""
    exact = sorted(SENTENCES.values(), key=len, reverse=True)
    known = "|".join(map(_expression, [*exact, *FORMS]))
    parts = F.regexp_extract_all(
        marked(text), F.lit(rf"(?<=[|~] )(?:{known})(?= +[|~])"), F.lit(0)
    )
    table = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (s, f"[{i}]")])

    def bracketed(part: Column) -> Column:
        plain = F.replace(part, F.lit(" ~"), F.lit(""))
        named = F.lit("")
        for form, i in FORMS.items():
            named = F.when(F.endswith(plain, F.lit(form.split("*")[1])), f"[{i}]").otherwise(named)
        return F.coalesce(F.element_at(table, plain), named)

    return F.array_join(F.transform(parts, bracketed), "")


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the licences found, in the order of the rules, each named once."""
    names = [c for c in docs.columns if c not in ADDED]
    cut = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("d"),
        F.size(sentences_of(F.col(f"`{text}`"))).cast("long").alias("n_sentences"),
        known_ids(F.col(f"`{text}`")).alias("sentence_ids"),
    )
    rules = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(pattern(ids)).alias("ids")) for n, ids in RULES]
    )
    nothing = F.array().cast("array<string>")
    matched = F.aggregate(
        rules,
        F.struct(F.col("sentence_ids").alias("rest"), nothing.alias("found")),
        lambda acc, rule: F.when(
            F.contains(acc["rest"], rule["ids"]),
            F.struct(
                F.replace(acc["rest"], rule["ids"], F.lit("[]")).alias("rest"),
                F.concat(acc["found"], F.array(rule["name"])).alias("found"),
            ),
        ).otherwise(acc),
        lambda acc: F.array_distinct(acc["found"]),
    )
    found = F.when(F.col("sentence_ids") != "", matched).otherwise(nothing)
    cut = cut.select("d", "n_sentences", "sentence_ids", found.alias("found"))
    return cut.select(
        *[F.col(f"d.`{c}`").alias(c) for c in names],
        "n_sentences",
        "sentence_ids",
        F.array_join("found", ",").alias("licenses"),
        F.size("found").cast("long").alias("n_licenses"),
    )
