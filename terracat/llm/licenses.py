"""License scans: normalised text against licence templates by the Dice
coefficient over word bigrams.

Text and templates are lower-cased and cut into words of letters and digits.
A passage matches a template when 2 |A and B| / (|A| + |B|) >= tau over their
distinct word bigrams.  That needs |A| between tau/(2-tau) |B| and
(2-tau)/tau |B| (size bounds), so only passages of such sizes are compared; a
passage must share at least ceil(tau/(2-tau) |B|) bigrams with the template, so
templates with fewer shared bigrams in the whole text are pruned first.

Passages are windows of words that begin at a word pair of the template.
``scan`` reports for each template its best non-overlapping windows of a text.
In ``identify`` the templates compete as well: of overlapping windows only the
one of the highest coefficient stays (ties: the larger template, the earlier
passage, the earlier template), so that licences whose notices differ by a word
(versions, the terms of Creative Commons, GPL, LGPL and AGPL) are told apart.
Null or empty text has no match.  Repeated rows give repeated results.  Texts
are scanned whole.  Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAU = 0.8

#: Licence notices in common use (identifier, notice).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited"),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1"),
    ("Apache-1.0", "Licensed under the Apache License, Version 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-1.0", "This work is licensed under the GNU General Public License, version 1"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License, or (at your option) any later version"),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 3 of "
                 "the License, or (at your option) any later version"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "Affero General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                        "International License"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                        "International License"),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License"),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "Released under the ISC License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute "
             "it freely"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License v1.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
)

_WORD = re.compile(r"[^\W_]+")
MATCHES = "array<struct<license:string,template:int,start:int,end:int,dice:double>>"


def normalise(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


class Templates:
    """Bigram sets of the templates and the index from bigram to templates."""

    def __init__(self, templates=TEMPLATES, tau: float = TAU):
        self.tau, self.names, self.sets, self.lengths = tau, [], [], []
        self.index: dict[tuple[str, str], list[int]] = defaultdict(list)
        for name, text in templates:
            words = normalise(text)
            grams = bigrams(words)
            if not grams:
                raise ValueError(f"template of {name} has fewer than two words")
            for g in grams:
                self.index[g].append(len(self.names))
            self.names.append(name)
            self.sets.append(grams)
            self.lengths.append(len(words))
        # shared bigrams that tau demands, and the largest passage it allows
        self.least = [-(-tau * len(s) // (2 - tau)) for s in self.sets]
        self.most = [int((2 - tau) / tau * len(s)) for s in self.sets]
        self.firsts = {g[0] for g in self.index}


def match(text: str | None, t: Templates) -> list[tuple[str, int, int, int, float]]:
    """(licence, template, first word, past the last word, dice) of the best
    windows, by template, then position."""
    if not text:
        return []
    words = normalise(text)
    firsts = t.firsts
    hits: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words[:-1]):
        if w in firsts:
            for k in t.index.get((w, words[i + 1]), ()):
                hits[k].append(i)
    out = []
    for k in sorted(hits):
        at = hits[k]
        if len({(words[i], words[i + 1]) for i in at}) < t.least[k]:  # size bound over the whole text
            continue
        out += _windows(words, at, k, t)
    return out


def compete(matches: list[tuple[str, int, int, int, float]], t: Templates) -> list[tuple[str, int, int, int, float]]:
    """Of overlapping windows the best template's, by position."""
    kept: list[tuple[str, int, int, int, float]] = []
    taken: set[int] = set()
    for m in sorted(matches, key=lambda m: (-m[4], -len(t.sets[m[1]]), m[2], m[1])):
        if taken.isdisjoint(range(m[2], m[3])):
            taken.update(range(m[2], m[3]))
            kept.append(m)
    return sorted(kept, key=lambda m: m[2])


def _windows(words, at, k, t):
    """Best windows of one template, greedily by dice, without overlap.  A
    window begins and ends at a pair of the template: trimming others off
    either end never lowers the coefficient."""
    grams, found, n = t.sets[k], [], len(at)
    for x in range(n):
        inner, shared, best = set(), set(), None
        done = at[x]
        for y in range(x, n):
            e = at[y]
            if e - at[x] + 1 > 2 * t.most[k]:  # repeats inside a window may stretch it
                break
            for i in range(done, e + 1):
                inner.add((words[i], words[i + 1]))
            done = e + 1
            if len(inner) > t.most[k]:
                break
            shared.add((words[e], words[e + 1]))
            if len(shared) >= t.least[k]:
                dice = 2 * len(shared) / (len(inner) + len(grams))
                if dice >= t.tau and (best is None or dice > best[0]):
                    best = (dice, at[x], e + 2)
        if best:
            found.append(best)
    found.sort(key=lambda w: (-w[0], w[1], w[2]))
    kept: list[tuple[float, int, int]] = []
    taken = set()
    for d, s, e in found:
        if taken.isdisjoint(range(s, e)):
            taken.update(range(s, e))
            kept.append((d, s, e))
    return [(t.names[k], k, s, e, round(d, 6)) for d, s, e in sorted(kept, key=lambda w: w[1])]


def scan(docs: DataFrame, templates=TEMPLATES, tau: float = TAU) -> DataFrame:
    """doc_id and ``matches``: array of (license, template, start, end, dice);
    start and end count normalised words.  Every template is judged alone."""
    return _matches(docs, Templates(templates, tau), lambda found, table: found)


def identify(docs: DataFrame, templates=TEMPLATES, tau: float = TAU) -> DataFrame:
    """The same, of overlapping windows only the best template's."""
    return _matches(docs, Templates(templates, tau), compete)


def _matches(docs: DataFrame, table: Templates, choose) -> DataFrame:
    @F.pandas_udf(MATCHES)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: [dict(zip(("license", "template", "start", "end", "dice"), m))
                                    for m in choose(match(x, table), table)])

    return docs.select("doc_id", run(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("matches"))


def digest(scanned: DataFrame) -> DataFrame:
    """One row per document: matches, the licences found (by name), the best
    coefficient, and every match as template:start:end:dice."""
    return scanned.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0)).alias("best_dice"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(
            ":", m["template"].cast("string"), m["start"].cast("string"), m["end"].cast("string"),
            F.format_number(m["dice"], 3))), ",").alias("spans"))
