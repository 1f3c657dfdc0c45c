"""Licence scan against a plain loop over sentences, and published notices."""

import re

from contrail.llm import license_scan as ls
from tests.llm.test_native import MIT, bsd

HOLDER = "the " + "very " * 80 + "long named holder"
GNU = (
    "This {what} is free software{cut} you can redistribute it and/or modify\nit under the terms of the GNU {name} as published by\n"
    "the Free Software Foundation{sep} {version}\n\nThis {what} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; "
    "without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU {name} for more details.\n"
)
LATER = "either version {} of the License, or\n(at your option) any later version."
CASES = [
    (MIT + "\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
     "OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\nAUTHORS BE LIABLE.\n", ["MIT"]),
    (bsd(("1. ", "2. ", "3. "), holder=HOLDER), ["BSD-3-Clause"]),
    ("Copyright (c) 2020 A\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
     "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n", ["ISC"]),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n", ["0BSD"]),
    (GNU.format(what="library", cut=";", name="Lesser General Public License", sep=";", version=LATER.format("2.1")), ["LGPL-2.1-or-later"]),
    (GNU.format(what="library", cut=";", name="Library General Public License", sep=";", version=LATER.format("2")), ["LGPL-2.0-or-later"]),
    (GNU.format(what="program", cut=":", name="Affero General Public License", sep=",", version=LATER.format("3")), ["AGPL-3.0-or-later"]),
    (GNU.format(what="program", cut=";", name="General Public License", sep=";", version=LATER.format("2")), ["GPL-2.0-or-later"]),
    (GNU.format(what="program", cut=";", name="General Public License", sep=";", version="version 2 of the License."), ["GPL-2.0-only"]),
    ("foo is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as\n"
     "published by the Free Software Foundation.", ["GPL-2.0-only"]),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy it.", ["Unlicense"]),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, to nobody", ["BSL-1.0"]),
    ("// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file LICENSE_1_0.txt)", ["BSL-1.0"]),
    ("This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at "
     "https://www.eclipse.org/legal/epl-2.0/", ["EPL-2.0"]),
    ("Eclipse Public License - v 1.0\n\nTHE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC\nLICENSE (\"AGREEMENT\"). ANY USE", ["EPL-1.0"]),
    ("// SPDX-License-Identifier: GPL-2.0-or-later\n/* code */", ["GPL-2.0-or-later"]),
    ("# SPDX-License-Identifier: GPL-2.0+\nimport x", ["GPL-2.0-or-later"]),
    ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause */", ["Apache-2.0", "BSD-3-Clause", "MIT"]),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", ["GPL-2.0-only"]),
    ("SPDX-License-Identifier: Nobody-9.9", []),
    ("License: MIT\n", ["MIT"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with", ["MPL-2.0"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", ["MPL-1.1"]),
    ("The contents of this file are subject to the Mozilla Public License Version\n1.1 (the \"License\"); you may not use this file except in "
     "compliance with\nthe License.", ["MPL-1.1"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 7.5.", []),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    ("This text is available under the Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported licence; terms apply.", ["CC-BY-NC-SA-3.0"]),
    ("Released under CC0 1.0 Universal.", ["CC0-1.0"]),
    ("Dual-licensed under the MIT License and the Apache License, Version 2.0.", ["Apache-2.0", "MIT"]),
    ("You can use it, licensed under GPLv3 or any later version, or under the ISC licence.", ["GPL-3.0-or-later", "ISC"]),
    ("Copyright 2020 A\n\nLicensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the "
     "License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n", ["Apache-2.0"]),
    ("                                 Apache License\n                           Version 2.0, January 2004\n"
     "                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS\n\n   1. Definitions.\n", ["Apache-2.0"]),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007\n", ["GPL-3.0"]),
    ("It isn't licensed under the MIT License; it is not licensed under the ISC License.", []),
    ("This is not licensed under the MIT License.", []),
    ("An MIT-style text, released under MIT-like terms, published by the press under a licence.", []),
    ("Licensed under GPL 2.7.", []),
    ("", []),
    (None, []),
    ("a licence of words " * 40_000 + "\nReleased under the ISC license\n", ["ISC"]),
]


def plain_names_of(sentence, known, names):
    """Identifiers of one sentence, by a loop over names and leads."""
    words = sentence.lower()
    words = re.sub(ls.LEADING_MARKER, "", words)
    words = ls.normalised(words)
    if words in known:
        return [known[words]]
    for name, (first, last) in ls.PATTERNS.items():
        if re.search(first, words) and re.search(last, words):
            return [name]
    if not re.search(ls.LEAD, words):
        return []
    words = re.sub(ls.VERSION, "", re.sub(ls.OR_LATER, " or later", words)).replace("licence", "license")
    found = []
    for rest in re.split(ls.LEAD, words)[1:]:
        for part in re.split(ls.AND_OR, rest):
            fits = [n for n in names if (part + " ").startswith(n + " ")]
            if fits:
                n = max(fits, key=len)
                if not part[len(n):].startswith((" style", " like")):
                    found.append("named:" + names[n])
    return found


def plain_scan(text):
    known, names = ls.table(), ls.name_table()
    if text is None or not re.search(ls.KEYWORDS, text, re.I):
        return [], []
    cut = re.compile(r"(?<=[.!?:;])[\x20\x09-\x0D]+")
    held = re.compile(r"([^a-z](v|ver)\.|(identifier|license|licence):)$", re.I)
    sentences, at = [], 0
    for m in cut.finditer(text):
        if not held.search(text[max(0, m.start() - 12) : m.start()]):
            sentences.append(text[at : m.start()])
            at = m.end()
    sentences.append(text[at:])
    ids = []
    for s in sentences:
        got = plain_names_of(s, known, names)
        if got:
            ids += got
            continue
        for paragraph in re.split("(?:" + ls.BLANK_LINE.replace(r"\p{L}\p{N}", r"\w") + ")", s):
            got = plain_names_of(paragraph, known, names)
            if got:
                ids += got
                continue
            for line in re.split(ls.LINE_END, paragraph):
                got = plain_names_of(line, known, names)
                marker = not re.search(r"[^\W_]", re.sub(rf"(?i)^[\W_]*{ls.ITEM}(?=[\W_]*$)", "", line))
                ids += got or ([] if marker else ["?"])
    rest, licences = "," + ",,".join(ids) + ",", set()
    for licence, seq in ls.rules():
        pattern = "," + ",,".join(seq) + ","
        if pattern in rest:
            rest = rest.replace(pattern, ";")
            licences.add(licence)
    return [i for i in ids if i != "?"], sorted(licences)


def scanned(df):
    return {r["doc_id"]: (r["license_sentences"], r["licenses"]) for r in ls.scan(df).collect()}


def test_published_notices_and_names(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    got = scanned(df)
    wrong = [(CASES[i][0], got[i], want) for i, (_, want) in enumerate(CASES) if got[i][1] != want]
    assert not wrong, [(str(t)[:80], g, w) for t, g, w in wrong]
    assert all(got[i] == plain_scan(t) for i, (t, _) in enumerate(CASES))


def test_equal_to_plain_loop_on_documents(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    got = scanned(documents)
    assert {i: plain_scan(t) for i, t in texts.items()} == got
    assert any(licences for _, licences in got.values())


def test_tables_are_sound():
    rules = ls.rules()
    known = set(ls.table().values()) | {f"named:{n}" for n in ls.named()} | set(ls.PATTERNS)
    assert {i for _, seq in rules for i in seq} <= known
    sentences = [s for found in (*ls.SENTENCES.values(), *ls.gnu_sentences().values()) for s in found]
    assert all(re.search(f"(?i){ls.KEYWORDS}", s) for s in sentences)
    by_name = {}
    for licence, names in ls.named().items():
        for n in names:
            assert by_name.setdefault(ls.plain_name(n), licence) == licence, n
