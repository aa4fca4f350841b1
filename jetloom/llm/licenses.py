"""License scans by sentence rules, all native.

A text is normalised with its sentence and line ends marked, each known licence
sentence, wrapped over lines or not, is mapped to its identifier, and the identifiers in text order are
matched against ordered licence rules. A known sentence stands between two ends; where its
pattern begins (ends) with ``*`` other words of the same sentence may come before (after) it. A rule is
a run of identifiers; an earlier rule takes its identifiers away from later ones, so long
forms come first. What is taken leaves a gap: identifiers on its two sides are not neighbours.

Defined results: null or empty text has no sentences and no licences; null ids and
repeated rows are carried through; an empty table gives an empty result. Texts
without any key word are not cut at all, which changes no result because every
known sentence has one, and a word is never split by what becomes a space.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, text_or_empty

_CONDITIONS = "provided that the following conditions are met"
_GNU = "you can redistribute it and/or modify it under the terms of the gnu {} as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"

#: Identifier -> normalised sentence of a public licence text or notice (``*``: words may come before or after).
SENTENCES = {
    "apache-notice": "* licensed under the apache license version 2.0",
    "apache-notice-the": "* licensed under the apache license version 2.0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-notice": "* released under the mit license",
    "mit-licensed": "* licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted " + _CONDITIONS,
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-notice": "* licensed under the bsd license",
    "bsd2-notice": "* licensed under the bsd 2-clause license",
    "bsd3-notice": "* licensed under the bsd 3-clause license",
    "isc-grant": "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc-notice": "* licensed under the isc license",
    "mpl2-form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at *",
    "mpl2-notice": "* licensed under the mozilla public license 2.0",
    "gpl2-notice": "* licensed under the gnu general public license version 2",
    "gpl3-notice": "* licensed under the gnu general public license version 3",
    "lgpl21-notice": "* licensed under the gnu lesser general public license version 2.1",
    "lgpl3-notice": "* licensed under the gnu lesser general public license version 3",
    "agpl3-notice": "* licensed under the gnu affero general public license version 3",
    "gpl-free": "this program is free software",
    "lgpl-free": "this library is free software",
    "gpl-redistribute": _GNU.format("general public license"),
    "lgpl-redistribute": _GNU.format("lesser general public license"),
    "agpl-redistribute": _GNU.format("affero general public license"),
    "version2-later": _LATER.format("2"),
    "version21-later": _LATER.format("2.1"),
    "version3-later": _LATER.format("3"),
    "gpl-terms": _GNU.format("general public license") + " " + _LATER.format("3"),
    "gpl2-terms": _GNU.format("general public license") + " " + _LATER.format("2"),
    "lgpl3-terms": _GNU.format("lesser general public license") + " " + _LATER.format("3"),
    "lgpl21-terms": _GNU.format("lesser general public license") + " " + _LATER.format("2.1"),
    "agpl3-terms": _GNU.format("affero general public license") + " " + _LATER.format("3"),
    "ccbync-notice": "* licensed under cc by-nc 4.0",
    "ccbysa-notice": "* licensed under cc by-sa 4.0",
    "ccbyncsa-notice": "* licensed under cc by-nc-sa 4.0",
    "ccby-notice": "* licensed under cc by 4.0",
    "ccby-long": "* licensed under a creative commons attribution 4.0 international license",
    "ccbysa-long": "* licensed under a creative commons attribution-sharealike 4.0 international license",
    "ccbync-long": "* licensed under a creative commons attribution-noncommercial 4.0 international license",
    "cc0-waiver": "to the extent possible under law *",
    "cc0-rights": "* has waived all copyright and related or neighboring rights to this work",
    "cc0-notice": "* released under cc0 1.0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non-commercial and by any means",
    "boost-notice": "distributed under the boost software license version 1.0",
    "zlib-asis": "this software is provided as-is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "epl2-notice": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 *",
    "reserved": "* all rights reserved",
}

#: Licences that a tag of one line may name.
TAGS = (
    "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
    "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense", "BSL-1.0", "Zlib", "EPL-2.0",
)
SENTENCES |= {f"spdx-{tag.lower()}": f"spdx-license-identifier {tag.lower()}" for tag in TAGS}

#: Ordered rules: (licence, run of sentence identifiers).
RULES = (
    ("Apache-2.0", ("apache-notice-the", "apache-use", "apache-copy", "apache-asis")),
    ("Apache-2.0", ("apache-notice", "apache-use")),
    ("Apache-2.0", ("apache-notice-the",)),
    ("Apache-2.0", ("apache-notice",)),
    ("MIT", ("mit-notice", "mit-grant", "mit-keep")),
    ("MIT", ("mit-grant", "mit-keep")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-licensed",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd3-notice",)),
    ("BSD-2-Clause", ("bsd2-notice",)),
    ("BSD", ("bsd-notice",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-notice",)),
    ("0BSD", ("0bsd-grant",)),
    ("MPL-2.0", ("mpl2-form", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-notice",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-redistribute", "version2-later")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-redistribute", "version3-later")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl3-terms")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl21-terms")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-redistribute", "version21-later")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl3-terms")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl3-terms")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-redistribute", "version3-later")),
    ("GPL-2.0-only", ("gpl2-notice",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("LGPL-2.1-only", ("lgpl21-notice",)),
    ("LGPL-3.0-only", ("lgpl3-notice",)),
    ("AGPL-3.0-only", ("agpl3-notice",)),
    ("CC-BY-NC-4.0", ("ccbync-notice",)),
    ("CC-BY-NC-4.0", ("ccbync-long",)),
    ("CC-BY-SA-4.0", ("ccbysa-notice",)),
    ("CC-BY-SA-4.0", ("ccbysa-long",)),
    ("CC-BY-NC-SA-4.0", ("ccbyncsa-notice",)),
    ("CC-BY-4.0", ("ccby-notice",)),
    ("CC-BY-4.0", ("ccby-long",)),
    ("CC0-1.0", ("cc0-waiver", "cc0-rights")),
    ("CC0-1.0", ("cc0-notice",)),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("Unlicense", ("unlicense-free",)),
    ("BSL-1.0", ("boost-notice",)),
    ("Zlib", ("zlib-asis", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("EPL-2.0", ("epl2-notice",)),
    *((tag, (f"spdx-{tag.lower()}",)) for tag in TAGS),
    ("Proprietary", ("reserved",)),
)

#: A sentence ends at ; or : (not in an SPDX tag), or at . ! ? before white space (; is cut after the line ends are known).
SENTENCE_END = r"(?<!spdx-license-identifier):+|[.!?]+(?=[\x20\x09-\x0D])"
#: What becomes one space inside a line; | marks a sentence's end and ; may still be a comment mark.
NOISE = r"[^a-z0-9./\n|;-]+"


def phrase(pattern: str) -> str:
    return pattern.strip("* ")


def key_words(known: dict[str, str]) -> list[str]:
    """Words, long ones where there are any, so that every known sentence has at least one of them."""
    left, chosen = set(map(phrase, known.values())), []
    while left:
        longest = {s: max(s.split(" "), key=len) for s in left}
        words = {w for s in left for w in s.split(" ") if len(w) >= min(7, len(longest[s]))}
        chosen.append(max(sorted(words), key=lambda w: (sum(w in s for s in left), len(w))))
        left = {s for s in left if chosen[-1] not in s}
    return chosen


def marked(text: Column) -> Column:
    """Normalised text: | at the ends of sentences and paragraphs, ~ at single line ends, comment marks cut.

    A-Z are lower-cased, and every run of other signs is one space.
    """
    low = F.concat(F.lit("\n\n"), F.translate(lower_ascii(text), "|~", "  "), F.lit("\n\n"))
    for pattern, to in (
        (SENTENCE_END, "|"),
        (NOISE, " "),
        (r" [/-]+ ?(?=\n)", ""),  # closing comment marks
        (r"\n[ ;/-]*\n[ ;/\n-]*", "|"),
        (r"\n[ ;/-]*", "~"),
        (" ?([|~;]) ?", "$1"),
    ):
        low = F.regexp_replace(low, pattern, to)
    return F.translate(low, ";", "|")


def recognised(text: Column, known: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of ``text``, in order.

    A sentence begins and ends at a sentence's or line's end (at any word, where its pattern is open)
    and may go on over single line ends; the longest one that begins at a place counts.
    """
    if not known:
        return F.array().cast("array<string>")
    table = F.create_map(*[F.lit(x) for name, pattern in known.items() for x in (phrase(pattern), name)])

    def run(pattern: str) -> str:
        before, after = ("[|~ ]" if pattern.startswith("*") else "[|~]"), ("[|~ ]" if pattern.endswith("*") else "[|~]")
        return f"(?<={before}){'[ ~]'.join(re.escape(w) for w in phrase(pattern).split(' '))}(?={after})"

    longest = sorted(known.values(), key=lambda p: len(phrase(p)), reverse=True)
    hits = F.regexp_extract_all(marked(text), F.lit("|".join(map(run, longest))), F.lit(0))
    found = F.transform(hits, lambda s: F.try_element_at(table, F.translate(s, "~", " ")))
    return F.when(lower_ascii(text).rlike("|".join(map(re.escape, key_words(known)))), found).otherwise(F.array().cast("array<string>"))


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", known: dict[str, str] = SENTENCES, rules=RULES
) -> DataFrame:
    """id, n_sentences (recognised ones), sentence_ids and licenses (space-joined, in rule order, each once).

    Identifiers may not hold ``<`` or ``>``.
    """
    out = docs.select(F.col(id_col).alias("id"), recognised(text_or_empty(text), known).alias("ids"))
    left = F.array_join(F.transform("ids", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    out = out.select("id", "ids", left.alias("left_0"))
    hits = []
    for k, (_, run) in enumerate(rules):
        pattern = F.lit("".join(f"<{x}>" for x in run))
        out = out.select(
            "id", "ids", *[h for h in out.columns if h.startswith("hit_")],
            F.contains(f"left_{k}", pattern).alias(f"hit_{k}"),
            F.replace(F.col(f"left_{k}"), pattern, F.lit("-")).alias(f"left_{k + 1}"),
        )
        hits.append(f"hit_{k}")
    names = list(dict.fromkeys(name for name, _ in rules))
    each = [
        F.when(
            F.greatest(*[F.col(hits[k]) for k, (n, _) in enumerate(rules) if n == name], F.lit(False)), F.lit(name)
        )
        for name in names
    ]
    return out.select(
        F.col("id").alias(id_col),
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", " ").alias("sentence_ids"),
        F.array_join(F.array_compact(F.array(*each)), " ").alias("licenses"),
    )
