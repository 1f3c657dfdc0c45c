"""Licence scan by sentence rules.

A text is cut into sentences, line ends being spaces (a notice wrapped over
lines). A sentence that isn't known is cut further, at blank lines (a notice below
a heading) and then at line ends (a licence line on its own). Sentences are
normalised to lower-case ASCII words and looked up in a table of known licence
sentences, then in a few patterns of sentences that hold names; list markers and
lines without letters are left out. A sentence of another wording that grants under a
licence by name ("distributed under the terms of the ...", an SPDX line) has the
identifiers ``named:`` and the licence, one for each licence named, ``and`` and
``or`` between them; "not licensed under" names none. The identifiers found, in order, form one
sequence in which ordered licence rules are matched. A rule that matches uses up
its identifiers, so a longer rule listed first keeps a shorter one from firing.

Versions are part of the names: "Mozilla Public License, v. 1.1" is MPL-1.1, and a
name whose version isn't in the table is no licence. GNU and Creative Commons
wordings are built from their families, versions and parts.

DataFrame functions only; a document is scanned where it is read. Texts without
any of ``KEYWORDS`` (every known sentence and every lead holds one) skip the sentence work.

Defined results: null and empty texts have no sentences and no licences; very long
texts and holders' names of any length are scanned whole; repeated rows are
scanned alike; other columns pass through, but one called ``license_sentences`` or
``licenses`` is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import free_name, let

# Licence sentences by identifier, in their published wording.
SENTENCES = {
    "MITshort": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "MITgrant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ],
    "MITnotice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ],
    "AsIs": [
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ],
    "Apache2short": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "This project is licensed under the Apache License, Version 2.0.",
    ],
    "Apache2use": ["you may not use this file except in compliance with the License."],
    "Apache2copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL3short": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is licensed under the GNU General Public License, version 3.",
    ],
    "GPL2short": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is licensed under the GNU General Public License, version 2.",
    ],
    "GPLfree": ["This program is free software"],
    "GPLhope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"],
    "GPLimplied": ["without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "BSDgrant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ],
    "BSDsource": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ],
    "BSDbinary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    ],
    "CCBYNC4": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "CCBYSA4": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."],
    "CCBY4": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "MPL2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "MPL1.1": [
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\");",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    ],
    "MPL2title": ["Mozilla Public License Version 2.0"],
    "Apache2title": [
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Apache License Version 2.0, January 2004",
    ],
    "ISCgrant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "0BSDgrant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
    ],
    "UnlicenseGrant": ["This is free and unencumbered software released into the public domain."],
    "BoostTitle": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "BoostGrant": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
        "is furnished to do so, all subject to the following:"
    ],
    "EPL2title": ["Eclipse Public License - v 2.0"],
    "EPL1title": ["Eclipse Public License - v 1.0"],
    "EPLprovided": [
        "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\")."
    ],
    "ZlibAsIs": ["This software is provided 'as-is', without any express or implied warranty."],
    "ZlibGrant": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions:"
    ],
    "CC0dedication": [
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide."
    ],
    "CC0title": ["Creative Commons Legal Code CC0 1.0 Universal"],
    "GPL2title": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL3title": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL2.1title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL3title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL3title": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
}

# GNU families, their names and versions.
GNU = {
    "GPL": (["GNU General Public License"], ["1", "2", "3"]),
    "LGPL": (["GNU Lesser General Public License", "GNU Library General Public License"], ["2", "2.1", "3"]),
    "AGPL": (["GNU Affero General Public License"], ["3"]),
}
# Creative Commons parts by their names.
CC_PARTS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
# Other licences and the names they go by ("version" and "v." before a number don't matter).
OTHER_NAMES = {
    "MIT": ["MIT", "Expat License"],
    "MIT-0": ["MIT-0", "MIT No Attribution"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache Software License 2.0", "Apache Public License 2.0", "Apache 2.0", "ASL 2.0"],
    "Apache-1.1": ["Apache Software License 1.1", "Apache License 1.1", "Apache 1.1"],
    "BSD-2-Clause": ["BSD-2-Clause", "BSD 2 Clause", "2-Clause BSD", "Simplified BSD", "FreeBSD License"],
    "BSD-3-Clause": ["BSD-3-Clause", "3-Clause BSD", "New BSD", "Modified BSD", "Revised BSD"],
    "0BSD": ["0BSD", "BSD Zero Clause", "Zero-Clause BSD"],
    "ISC": ["ISC"],
    "Zlib": ["zlib"],
    "Unlicense": ["Unlicense"],
    "BSL-1.0": ["BSL-1.0", "Boost Software License 1.0", "Boost Software License - Version 1.0", "Boost 1.0"],
    "EPL-1.0": ["EPL-1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["EPL-2.0", "Eclipse Public License v2.0"],
    "MPL-1.0": ["MPL-1.0", "Mozilla Public License 1.0"],
    "MPL-1.1": ["MPL-1.1", "Mozilla Public License 1.1"],
    "MPL-2.0": ["MPL-2.0", "Mozilla Public License 2.0"],
    "CC0-1.0": ["CC0", "CC0-1.0", "Creative Commons Zero v1.0 Universal", "Creative Commons CC0", "Creative Commons Zero"],
    "CDDL-1.0": ["CDDL-1.0", "Common Development and Distribution License 1.0"],
    "EUPL-1.2": ["EUPL-1.2", "European Union Public License 1.2"],
    "Artistic-2.0": ["Artistic-2.0", "Artistic License 2.0"],
    "OFL-1.1": ["OFL-1.1", "SIL Open Font License 1.1"],
    "PostgreSQL": ["PostgreSQL License", "PostgreSQL"],
    "WTFPL": ["WTFPL"],
    "MS-PL": ["MS-PL", "Microsoft Public License"],
    "NCSA": ["NCSA", "University of Illinois/NCSA Open Source License"],
}

# First and last words of normalised licence sentences with a holder's name, of any length, between
# them (one like "X Inc." ends a sentence).
PATTERNS = {
    "GNUfree": (r"^[a-z0-9].* is free software$", ""),
    "BSDendorse": (
        r"^(neither the names? of|nor|the names? of) ",
        r" may (not )?be used to endorse or promote products derived from this software without (specific )?prior written permission$",
    ),
    "BSDname": (r"^neither the names? of ", ""),
}


def gnu_sentences() -> dict[str, list[str]]:
    """The notices that the GNU licences recommend, whole and cut at a semicolon, by family and version."""
    start = "you can redistribute it and/or modify it under the terms of the "
    by_fsf = " as published by the Free Software Foundation"
    found: dict[str, list[str]] = {}
    for family, (names, versions) in GNU.items():
        found[f"{family}terms"] = [start + name + by_fsf for name in names]
        for v in versions:
            numbers = [v] if "." in v else [v, v + ".0"]
            found[f"{family}{v}orLater"] = [
                f"{start}{name}{by_fsf}, either version {n} of the License, or (at your option) any later version."
                for name in names for n in numbers
            ]
            found[f"{family}{v}only"] = [
                text for name in names for n in numbers
                for text in (f"{start}{name}{by_fsf}, version {n} of the License.", f"{start}{name} version {n}{by_fsf}.")
            ]
            found[f"Later{v}"] = [f"either version {n} of the License, or (at your option) any later version." for n in numbers]
            found[f"Only{v}"] = [f"version {n} of the License." for n in numbers]
    return found


def gnu_version(v: str) -> str:
    return v if "." in v else v + ".0"


def named() -> dict[str, list[str]]:
    """Names by licence: ``OTHER_NAMES`` and the GNU and Creative Commons names built from their parts."""
    found = {licence: list(names) for licence, names in OTHER_NAMES.items()}
    for family, (names, versions) in GNU.items():
        for v in versions:
            licence = f"{family}-{gnu_version(v)}"
            forms = [
                form for n in dict.fromkeys((v, gnu_version(v)))
                for form in (*[f"{name} {n}" for name in names], *[f"{name[4:]} {n}" for name in names], f"{family} {n}", f"{family}v{n}", f"GNU {family} {n}", f"GNU {family}v{n}")
            ]
            found[licence] = forms
            found[licence + "-or-later"] = [f + " or later" for f in forms]
            found[licence + "-only"] = [f + " only" for f in forms]
    for part, name in CC_PARTS.items():
        for v in CC_VERSIONS:
            found[f"CC-{part}-{v}"] = [f"CC {part} {v}", f"Creative Commons {name} {v}", f"Creative Commons {part} {v}"]
    return found


# Fixed order of rules: (licence, identifiers that follow each other).
RULES = (
    ("MIT", ("MITgrant", "MITnotice", "AsIs")),
    ("MIT", ("MITgrant", "MITnotice")),
    ("MIT-style", ("MITgrant",)),
    ("MIT", ("MITshort",)),
    ("Apache-2.0", ("Apache2short", "Apache2use", "Apache2copy")),
    ("Apache-2.0", ("Apache2short", "Apache2use")),
    ("Apache-2.0", ("Apache2short",)),
    ("GPL-3.0", ("GPL3short",)),
    ("GPL-2.0", ("GPL2short",)),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDname", "BSDendorse")),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse")),
    ("BSD-style", ("BSDgrant", "BSDsource", "BSDbinary", "BSDname")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary")),
    ("BSD-style", ("BSDgrant",)),
    ("CC-BY-NC-4.0", ("CCBYNC4",)),
    ("CC-BY-SA-4.0", ("CCBYSA4",)),
    ("CC-BY-4.0", ("CCBY4",)),
    ("MPL-2.0", ("MPL2",)),
    ("MPL-2.0", ("MPL2title",)),
    ("MPL-1.1", ("MPL1.1",)),
    ("Apache-2.0", ("Apache2title",)),
    ("Apache-2.0", ("named:Apache-2.0", "Apache2use", "Apache2copy")),
    ("Apache-2.0", ("named:Apache-2.0", "Apache2use")),
    ("ISC", ("ISCgrant",)),
    ("0BSD", ("0BSDgrant",)),
    ("Unlicense", ("UnlicenseGrant",)),
    ("BSL-1.0", ("BoostTitle", "BoostGrant")),
    ("BSL-1.0", ("BoostTitle",)),
    ("BSL-1.0", ("BoostGrant",)),
    ("EPL-2.0", ("EPL2title", "EPLprovided")),
    ("EPL-2.0", ("EPL2title",)),
    ("EPL-1.0", ("EPL1title", "EPLprovided")),
    ("EPL-1.0", ("EPL1title",)),
    ("Zlib", ("ZlibGrant",)),
    ("CC0-1.0", ("CC0dedication",)),
    ("CC0-1.0", ("CC0title",)),
    ("GPL-2.0", ("GPL2title",)),
    ("GPL-3.0", ("GPL3title",)),
    ("LGPL-2.1", ("LGPL2.1title",)),
    ("LGPL-3.0", ("LGPL3title",)),
    ("AGPL-3.0", ("AGPL3title",)),
)


def rules() -> tuple[tuple[str, tuple[str, ...]], ...]:
    """``RULES``, then those of the GNU notices (by family and version) and of the names."""
    gnu = []
    for family, (_, versions) in GNU.items():
        for v in versions:
            licence = f"{family}-{gnu_version(v)}"
            gnu += [
                (licence + "-or-later", (f"{family}{v}orLater",)),
                (licence + "-only", (f"{family}{v}only",)),
                (licence + "-or-later", (f"{family}terms", f"Later{v}")),
                (licence + "-only", (f"{family}terms", f"Only{v}")),
            ]
    return (*RULES, *gnu, *[(licence, (f"named:{licence}",)) for licence in named()])


# Letters that every known sentence, and every sentence that names a licence, holds at least one of.
KEYWORDS = r"licen|software|permission|warrant|redistribut|copyright|accompanying program|either version|creative commons|\bunder[^a-z0-9]"
# Not after "v." and "ver.", which a version follows, nor after the colon of "SPDX-License-Identifier:" or "License:".
SENTENCE_END = r"(?<=[.!?:;])(?<!(?i:[^a-z]v\.|[^a-z]ver\.|identifier:|license:|licence:))[\x20\x09-\x0D]+"
BLANK_LINE = r"\x0A[^\p{L}\p{N}\x0A]*\x0A|\x0D[^\p{L}\p{N}\x0A\x0D]*\x0D"
LINE_END = r"[\x0A\x0D]+"
ITEM = r"([0-9]{1,2}([.][0-9]{1,2}){0,3}|[a-z]|[ivx]{2,5})"
MARKER = rf"(?i)^[^\p{{L}}\p{{N}}]*({ITEM}[^\p{{L}}\p{{N}}]*)?$"  # '1.', '(a)', '*', or nothing
LEADING_MARKER = rf"^[^a-z0-9]*{ITEM}\)[\x20\x09-\x0D]+"  # '1) ', '(a) '
NOT_WORD = r"[^a-z0-9.]+"
# In normalised words: what comes before a licence's name, and how versions and "or later" are written.
LEAD = (
    r"(?<!\bnot )(?<!n t )\b(?:licen[sc]ed|released|distributed|redistributed|published|provided|available|usable|covered|governed)(?: to you)?(?: under| by)"
    r"(?: (?:the|a|an))?(?: (?:terms(?: and conditions)?|conditions) of(?: (?:the|a|an))?)? |\bspdx license identifier |^licen[sc]e "
)
VERSION = r"\bv(?:er(?:sion)?)?\.? ?(?=[0-9])"
OR_LATER = r" (?:or|and) (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?\b"
PLUS = r"(?<=[0-9])\+"
AND_OR = r" (?:and|or) (?:under )?(?:the )?(?!later)"
NAMED = "named:"
UNKNOWN = "?"


def normalised(sentence: str) -> str:
    """The Python form of ``normalise``, for the table."""
    return re.sub(NOT_WORD, " ", re.sub(PLUS, " or later", sentence.lower())).strip(" .")


def plain_name(name: str) -> str:
    """The Python form of ``plain_names``, for the table."""
    return re.sub(VERSION, "", re.sub(OR_LATER, " or later", normalised(name))).replace("licence", "license")


def table() -> dict[str, str]:
    """Identifier by normalised sentence; where two have the same, the one listed first."""
    found: dict[str, str] = {}
    for name, sentences in (*SENTENCES.items(), *gnu_sentences().items()):
        for s in sentences:
            found.setdefault(normalised(s), name)
    return found


def name_table() -> dict[str, str]:
    """Licence by plain name."""
    return {plain_name(n): licence for licence, names in named().items() for n in names}


def normalise(sentence: Column) -> Column:
    words = F.regexp_replace(F.lower(sentence), LEADING_MARKER, "")
    return F.btrim(F.regexp_replace(F.regexp_replace(words, PLUS, " or later"), NOT_WORD, " "), F.lit(" ."))


def plain_names(words: Column) -> Column:
    return F.replace(F.regexp_replace(F.regexp_replace(words, OR_LATER, " or later"), VERSION, ""), F.lit("licence"), F.lit("license"))


def licences_named(words: Column, names: Column, any_name: str) -> Column:
    """``named:`` identifiers of the licences that a normalised sentence grants under."""
    after_leads = lambda w: F.slice(F.split(w, LEAD), 2, F.greatest(F.size(F.split(w, LEAD)) - 1, F.lit(0)))
    parts = let(plain_names(words), lambda w: F.flatten(F.transform(after_leads(w), lambda rest: F.split(rest, AND_OR))))
    licences = F.transform(parts, lambda part: F.try_element_at(names, F.regexp_extract(part, any_name, 1)))
    return F.transform(F.filter(licences, lambda x: x.isNotNull()), lambda x: F.concat(F.lit(NAMED), x))


def identifier(sentence: Column, tables: tuple[Column, Column, str]) -> Column:
    """Identifiers of one sentence: one, or one for each licence named; none for an unknown one."""
    known, names, any_name = tables

    def find(words: Column) -> Column:
        of_pattern = [F.when(words.rlike(first) & words.rlike(last), F.lit(name)) for name, (first, last) in PATTERNS.items()]
        by_table = F.coalesce(F.try_element_at(known, words), *of_pattern)
        return let(
            by_table,
            lambda one: F.when(one.isNotNull(), F.array(one))
            .when(words.rlike(LEAD), licences_named(words, names, any_name))
            .otherwise(F.array().cast("array<string>")),
        )

    return let(normalise(sentence), find)


def identifiers(text: Column, tables: tuple[Column, Column, str]) -> Column:
    """Identifiers of the sentences of ``text`` in order, ``?`` for an unknown one."""

    def of_line(s: Column) -> Column:
        unknown = F.when(s.rlike(MARKER), F.array().cast("array<string>")).otherwise(F.array(F.lit(UNKNOWN)))
        return let(identifier(s, tables), lambda names: F.when(F.size(names) > 0, names).otherwise(unknown))

    def of_whole_or(parts, of_part):
        return lambda s: let(
            identifier(s, tables),
            lambda names: F.when(F.size(names) > 0, names).otherwise(F.flatten(F.transform(parts(s), of_part))),
        )

    of_paragraph = of_whole_or(lambda s: F.split(s, LINE_END), of_line)
    of_sentence = of_whole_or(lambda s: F.split(s, BLANK_LINE), of_paragraph)
    return F.flatten(F.transform(F.split(text, SENTENCE_END), of_sentence))


def matched(ids: Column, rules) -> Column:
    """Licences of the rules that match the identifier sequence, in rule order."""
    sequence = F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(","))
    listed = F.array(
        *[F.struct(F.lit(name).alias("licence"), F.lit("," + ",,".join(seq) + ",").alias("seq")) for name, seq in rules]
    )
    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("licences"))

    def apply(state: Column, rule: Column) -> Column:
        used = F.struct(
            F.replace(state["rest"], rule["seq"], F.lit(";")).alias("rest"),
            F.array_union(state["licences"], F.array(rule["licence"])).alias("licences"),
        )
        return F.when(F.contains(state["rest"], rule["seq"]), used).otherwise(state)

    return F.aggregate(listed, start, apply)["licences"]


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``license_sentences`` (identifiers in order) and ``licenses`` (sorted names)."""
    as_map = lambda found: F.create_map(*[F.lit(x) for pair in found.items() for x in pair])
    longest_first = sorted(name_table(), key=lambda n: (-len(n), n))
    any_name = "^(" + "|".join(re.escape(n).replace(r"\ ", " ") for n in longest_first) + ")(?= |$)(?! style| like)"
    tables = (as_map(table()), as_map(name_table()), any_name)
    ordered = rules()
    none = F.array().cast("array<string>")

    def found(t: Column) -> Column:
        return let(
            identifiers(t, tables),
            lambda ids: F.struct(F.filter(ids, lambda name: name != UNKNOWN).alias("sentences"), matched(ids, ordered).alias("licences")),
        )

    hit = F.coalesce(F.col(text).rlike(f"(?i){KEYWORDS}"), F.lit(False))
    nothing = F.struct(none.alias("sentences"), none.alias("licences"))
    made = free_name(df, "_found")
    scanned = df.withColumn(made, F.when(hit, found(F.col(text))).otherwise(nothing))
    return scanned.withColumns(
        {"license_sentences": F.col(f"{made}.sentences"), "licenses": F.array_sort(F.col(f"{made}.licences"))}
    ).drop(made)
