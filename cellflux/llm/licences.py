"""Licence notices in documents, by Dice coefficient over word bigrams (operator 8)."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflux.llm.common import ascii_lower

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:"
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:"
)
_BSD_LIST = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_VERBATIM = (
    "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
)


def _gnu_notice(licence: str, sign: str, version: str) -> str:
    return (
        f"This program is free software{sign} you can redistribute it and/or modify it under the terms of the GNU "
        f"{licence} General Public License as published by the Free Software Foundation, either version {version} of the "
        "License, or (at your option) any later version."
    )


# Usual notices of public licences, the whole text of short ones, and how the text of long ones begins.
TEMPLATES = {
    "agpl-3.0-notice": _gnu_notice("Affero", ":", "3"),
    "agpl-3.0-text": f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "apache-2.0-text": (
        "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "
        "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 "
        "of this document."
    ),
    "bsd": _BSD_GRANT,
    "bsd-text": f"{_BSD_GRANT} {_BSD_LIST}",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work."
    ),
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-notice": _gnu_notice("", ";", "2"),
    "gpl-2.0-text": f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. {_VERBATIM}",
    "gpl-2.0-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": _gnu_notice("", ":", "3"),
    "gpl-3.0-text": f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}",
    "gpl-3.0-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-notice": _gnu_notice("Lesser", ":", "3"),
    "mit": "Released under the MIT License.",
    "mit-grant": _MIT_GRANT,
    "mit-text": (
        f"{_MIT_GRANT} The above copyright notice and this permission notice shall be included in all copies or "
        f"substantial portions of the Software. {_WARRANTY}"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at"
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
}
THRESHOLD = 0.8



def licence_words(text: str | Column) -> Column:
    """The words of a text: runs of a-z and 0-9 in lower case, whatever marks and line ends are between them."""
    return F.filter(F.split(ascii_lower(text), "[^a-z0-9]+"), lambda w: w != "")


def word_bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words; none for fewer than two words."""
    pairs = F.transform(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat_ws(" ", F.get(words, i), w),
    )
    return F.array_distinct(pairs)


def _template_words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


class _Plan:
    """What the templates and the threshold say: bigrams, size bounds, and probes with their places."""

    def __init__(self, templates: Mapping[str, str], threshold: float):
        self.words = {k: w for k, t in sorted(templates.items()) if len(w := _template_words(t)) > 1}
        if not self.words:
            raise ValueError("no template has two words")
        self.places = {k: {} for k in self.words}
        for k, words in self.words.items():
            for i, pair in enumerate(zip(words, words[1:], strict=False)):
                self.places[k].setdefault(" ".join(pair), i)
        low, high = threshold / (2 - threshold), (2 - threshold) / threshold
        self.least = {k: -int(-len(b) * low // 1) for k, b in self.places.items()}
        self.most = {k: int(len(b) * high) for k, b in self.places.items()}
        # Bigrams that few templates share, and long ones, are the rarest in other texts.
        shared = {g: sum(g in b for b in self.places.values()) for b in self.places.values() for g in b}
        self.probes: dict[str, list[tuple[str, int]]] = {}
        for k, b in self.places.items():
            rare = sorted(b, key=lambda g: (shared[g], -len(g), g))
            for g in rare[: len(b) - self.least[k] + 1]:
                self.probes.setdefault(g, []).append((k, b[g]))


def _probe_pattern(probes: set[str]) -> str:
    """A pattern for raw text in which one of the bigrams stands, whatever marks are between its words.

    Bigrams are grouped by their first two characters, so that a word is rarely compared
    with more than a few of them.
    """
    between = "[^A-Za-z0-9]+"
    groups = []
    for start, group in groupby(sorted(probes), key=lambda g: g[:2] if g[1] != " " else g[0]):
        rest = "|".join(g[len(start) :].replace(" ", between) for g in group)
        groups.append(f"{start}(?:{rest})")
    return f"(?i)(?<![A-Za-z0-9])(?:{'|'.join(groups)})(?![A-Za-z0-9])"


def licence_matches(
    documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Templates that a document carries: doc_id, template, dice, units.

    A template is compared with windows of the document's words, as many as the template has (or all, if there are
    fewer), across line and sentence ends. A window of `a` distinct bigrams can reach `t` with a template of `b` only if
    `a` lies between `b*t/(2-t)` and `b*(2-t)/t`, and only if it holds one of any `b - ceil(b*t/(2-t)) + 1` bigrams of
    that template, its probes. Windows are laid where a probe stands, so that it has the place that it has in the
    template. `dice` is the best window's, `units` the number of windows that reach the threshold.

    Probes are first put to the raw text, so that a document without any such bigram costs one pass of a pattern. The
    templates are a parameter held in the plan, never a table that grows. No shuffle but that of the matches, summed per task.

    A missing or empty text has no matches; rows with equal doc_id are one document, and so are those without;
    columns other than doc_id and text are ignored. Templates of one word never match.
    """
    plan = _Plan(templates, threshold)
    found = documents.filter(F.col("text").rlike(_probe_pattern(set(plan.probes)))).select(
        "doc_id", F.explode(F.array(licence_words("text"))).alias("words")
    )
    probe = F.array(*[F.lit(g) for g in sorted(plan.probes)])
    pairs = F.transform(
        F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))),
        lambda w, i: F.struct(i.alias("at"), F.concat_ws(" ", F.get("words", i), w).alias("gram")),
    )
    hits = F.filter(pairs, lambda p: F.array_contains(probe, p["gram"]))
    places = F.create_map(
        *[
            part
            for gram, laid in sorted(plan.probes.items())
            for part in (
                F.lit(gram),
                F.array(*[F.struct(F.lit(k).alias("template"), F.lit(i).alias("place")) for k, i in laid]),
            )
        ]
    )
    sizes = F.create_map(*[part for k, words in plan.words.items() for part in (F.lit(k), F.lit(len(words)))])
    grams = F.create_map(
        *[part for k, b in plan.places.items() for part in (F.lit(k), F.array(*[F.lit(g) for g in sorted(b)]))]
    )
    laid = F.transform(
        hits,
        lambda h: F.transform(
            F.element_at(places, h["gram"]),
            lambda t: F.struct(t["template"].alias("template"), (h["at"] - t["place"]).alias("start")),
        ),
    )
    starts = F.transform(
        F.flatten(laid),
        lambda x: F.struct(
            x["template"].alias("template"),
            F.greatest(
                F.least(x["start"], F.size("words") - F.element_at(sizes, x["template"])), F.lit(0)
            ).alias("start"),
        ),
    )
    windows = F.transform(
        F.array_distinct(starts),
        lambda x: F.struct(
            x["template"].alias("template"),
            F.slice("words", x["start"] + 1, F.element_at(sizes, x["template"])).alias("words"),
        ),
    )
    opened = found.select("doc_id", F.explode(windows).alias("window"))
    judged = opened.select(
        "doc_id", "window.template", F.explode(F.array(word_bigrams(F.col("window.words")))).alias("grams")
    )
    own = F.element_at(grams, F.col("template"))
    dice = F.lit(2.0) * F.size(F.array_intersect("grams", own)) / (F.size("grams") + F.size(own))
    scored = judged.select("doc_id", "template", dice.alias("dice")).filter(F.col("dice") >= threshold)
    return scored.groupBy("doc_id", "template").agg(F.max("dice").alias("dice"), F.count(F.lit(1)).alias("units"))


def licence_sql(templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same for DuckDB: every bigram of every text is joined with the probes."""
    plan = _Plan(templates, threshold)
    rows = ", ".join(
        f"('{k}', {len(plan.words[k])}, ['{"', '".join(sorted(b))}'])" for k, b in plan.places.items()
    )
    probes = ", ".join(f"('{g}', '{k}', {i})" for g, laid in sorted(plan.probes.items()) for k, i in laid)
    return f"""
    WITH template(template, size, grams) AS (VALUES {rows}),
    probe(gram, template, place) AS (VALUES {probes}),
    word AS (
        SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda w: w <> '') AS w
        FROM documents WHERE text IS NOT NULL
    ),
    pair AS (
        SELECT r, unnest(range(1, len(w))) AS i, unnest(list_transform(range(1, len(w)),
            lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM word
    ),
    start AS (
        SELECT DISTINCT pair.r, template, greatest(least(i - 1 - place, len(w) - size), 0) AS s
        FROM pair JOIN probe USING (gram) JOIN template USING (template) JOIN word ON word.r = pair.r
    ),
    seen AS (
        SELECT doc_id, template, grams, list_slice(w, s + 1, s + size) AS v
        FROM start JOIN word USING (r) JOIN template USING (template)
    ),
    gram AS (
        SELECT doc_id, template, grams,
            list_distinct(list_transform(range(1, len(v)), lambda i: v[i] || ' ' || v[i + 1])) AS g FROM seen
    ),
    scored AS (
        SELECT doc_id, template, 2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice FROM gram
    )
    SELECT doc_id, template, round(max(dice), 6) AS dice, count(*) AS units
    FROM scored WHERE dice >= {threshold} GROUP BY doc_id, template
    """
