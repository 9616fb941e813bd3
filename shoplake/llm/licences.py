"""Licence scans: sparse TF-IDF cosine to templates, then nearest-ancestor inheritance.

Every line and sentence of a whole text, every run of a template's number of words
that may match it, over line ends, and the text as a whole, is a sparse vector
of words weighed by TF-IDF, with document frequencies of the templates' words counted
over all documents. A word that no template has weighs ``OUTSIDE``, as one that a tenth
of all documents has, so that ordinary words beside a notice cost it the same in a
corpus of any size. Templates are notices and headers by version (``TEMPLATES``) and
the licences' whole texts (``bodies``). The nearest template from a cosine of ``LEAST``
names the file's licence; a whole text from ``BODY`` comes before any notice, since
licences quote notices. A notice counts only where the words it is found in name its
licence and version or none, and don't deny it ("not licensed under"). An SPDX tag that names
known licences (``KNOWN``, LicenseRef-) tells the licence itself, with score 1: without -only,
-or-later or +, and an expression of several with its brackets. Templates whose
words in common with a text can't lift any cosine to ``LEAST`` are skipped exactly.

A file without a licence of its own inherits from the nearest directory on its path,
its own first, that holds a licence file with a licence. Directories are resolved
once each, by joining their ancestors with the directories of licence files; files
are then joined with their directory.

Defined results: a null text is read as empty; a null path has no directory and
inherits nothing; of several licence files in a directory the best score counts, then
the first name; equal rows give equal rows; an empty table gives an empty table;
other columns are kept but for those named like a result or a working column.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import shipped, staged, text_or_empty

LEAST = 0.6
BODY = 0.85
OUTSIDE = 1 + math.log(10)
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|copyright|notice|unlicense)([._-].*)?$"
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]*)"
# SPDX licence identifiers, without -only and -or-later.
KNOWN = """
    0BSD AFL-3.0 AGPL-1.0 AGPL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 Beerware BlueOak-1.0.0
    BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 bzip2-1.0.6
    CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-2.0
    CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 curl ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1
    EUPL-1.2 FSFAP FTL GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 HPND ICU IJG ISC LGPL-2.0 LGPL-2.1 LGPL-3.0 Libpng LPPL-1.3c
    MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA NPL-1.1 ODbL-1.0 OFL-1.1 OLDAP-2.8 OpenSSL OSL-3.0 PDDL-1.0
    PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SISSL Sleepycat SSPL-1.0 Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL
    X11 Zlib ZPL-2.1
""".split()
TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licence_texts")
_FREE = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License "
         "as published by the Free Software Foundation; either version {} of the License")
_ONLY = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License "
         "version {} as published by the Free Software Foundation")
# Notices, headers and openings of licences, as their owners word them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    *((name, _FREE.format(what, kind, version)) for what in ("program", "library") for name, kind, version in (
        ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.0", "Library General", "2"),
        ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"))),
    *((name, _ONLY.format(what, kind, version)) for what in ("program", "library") for name, kind, version in (
        ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.1", "Lesser General", "2.1"),
        ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"))),
    *((name, f"Licensed under the GNU {kind} Public License {version}") for name, kind, versions in (
        ("GPL-2.0", "General", ("version 2", "v2")), ("GPL-3.0", "General", ("version 3", "v3")),
        ("LGPL-2.1", "Lesser General", ("v2.1",)), ("LGPL-3.0", "Lesser General", ("v3",)),
        ("AGPL-3.0", "Affero General", ("v3",))) for version in versions),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Licensed under the ISC License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain, CC0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_PART = re.compile(r"\n+|(?<=[.;!?])\s+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@cache
def bodies() -> tuple[tuple[str, str], ...]:
    """The licences' whole texts; those without a file here are told from their next relative by the words that differ."""
    held = {}
    for file in sorted(os.listdir(TEXTS)):
        with open(os.path.join(TEXTS, file), encoding="utf-8") as f:
            held[file.removesuffix(".txt")] = f.read()
    alike = held["CC-BY-SA-4.0"]
    held["AGPL-3.0"] = re.sub(r"(?i)\bGNU(\s+)General(\s+)Public", r"GNU\1Affero General\2Public", held["GPL-3.0"])
    held["CC-BY-4.0"] = alike.replace("-ShareAlike", "").replace("ShareAlike", "")
    held["CC-BY-NC-4.0"] = alike.replace("ShareAlike", "NonCommercial")
    return tuple(held.items())


_IDS = {name.lower(): name for name in KNOWN}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+-]+")
_LATER = re.compile(r"(?i)(-only|-or-later|\+)$")


def _licence_id(token: str) -> str | None:
    own = _LATER.sub("", token)
    if re.fullmatch(r"(?i)LicenseRef-[A-Za-z0-9.-]+", own):
        return own
    return _IDS.get(own.lower())


def _term(tokens: list[str], at: int) -> tuple[str, int] | None:
    """A licence, with its exception, or an expression in brackets; None where there is neither."""
    depth = at
    while depth < len(tokens) and tokens[depth] == "(":
        depth += 1
    if depth - at > 8:
        return None
    if depth > at:
        inner = _expression(tokens, at + 1)
        if not inner:
            return None
        text, at = inner
        if at < len(tokens) and tokens[at] == ")":
            return (f"({text})" if " " in text else text), at + 1
        return text, len(tokens)  # a bracket left open ends the tag
    name = _licence_id(tokens[at]) if at < len(tokens) else None
    if not name:
        return None
    if at + 2 < len(tokens) and tokens[at + 1].upper() == "WITH" and "exception" in tokens[at + 2].lower():
        return f"{name} WITH {tokens[at + 2]}", at + 3
    return name, at + 1


def _expression(tokens: list[str], at: int) -> tuple[str, int] | None:
    """Terms with AND and OR between them, as far as they are known licences."""
    first = _term(tokens, at)
    if not first:
        return None
    text, at = first
    while at + 1 < len(tokens) and tokens[at].upper() in ("AND", "OR") and (more := _term(tokens, at + 1)):
        text, at = f"{text} {tokens[at].upper()} {more[0]}", more[1]
    return text, at


def tagged(text: str) -> str | None:
    """The licence, or the expression of licences, of the first SPDX tag that names one."""
    for found in re.finditer(SPDX, text):
        # a line's first tokens: the longest expression in use has a few dozen
        tokens = [m[0] for m, _ in zip(_TOKEN.finditer(found[1]), range(200))]
        if _TOKEN.match(found[1]) and (whole := _expression(tokens, 0)):
            return _bare(whole[0])
    return None


def _bare(text: str) -> str:
    """An expression without brackets around the whole of it."""
    depth = 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if not depth and i < len(text) - 1:
            return text
    return text[1:-1]


_DENIED = re.compile(r"\b(?:not|never|no longer)(?: be| been| yet)? (?:licensed|released|distributed|available|covered)\b")
_NAMES = frozenset({"apache", "bsd", "cc", "cc0", "creative", "gnu", "isc", "mit", "mozilla"})
_NUMBER = re.compile(r"v?([0-9]+(?:\.[0-9]+)*)")


def versions(own: list[str]) -> set[str]:
    """The version numbers that words name: v3, or a number after version, v, license or public; 2.0 is 2."""
    out = set()
    for before, w in zip(["", *own], own):
        m = _NUMBER.fullmatch(w)
        if m and (w[0] == "v" or before in ("version", "v", "license", "licence", "clause")):
            out.add(re.sub(r"(\.0)+$", "", m[1]))
    return out


class Model:
    """Word weights and the templates' unit vectors: a few kB, whatever the input."""

    def __init__(self, templates: tuple[tuple[str, str], ...], frequency: dict[str, int], documents: int, least: float = LEAST,
                 whole: tuple[tuple[str, str], ...] = ()):
        self.least, self.documents = least, documents
        self.idf = {w: math.log((1 + documents) / (1 + frequency.get(w, 0))) + 1
                    for _, t in (*templates, *whole) for w in words(t)}
        self.unknown = OUTSIDE
        every = [*templates, *whole]
        self.templates = [(name, self._unit(Counter(words(t)))) for name, t in every]
        self.lengths = [len(words(t)) for _, t in every]
        self.notices = len(templates)
        self.names = [_NAMES.intersection(words(t)) for _, t in every]
        self.versions = [versions(words(t)) if i < self.notices else set() for i, (_, t) in enumerate(every)]
        self.held: dict[str, list[tuple[int, float]]] = {}
        for i, (_, vector) in enumerate(self.templates):
            for w, x in vector.items():
                self.held.setdefault(w, []).append((i, x))
        self.distinctive: set[str] = set()
        for _, vector in self.templates:
            rest = 1.0
            for w, x in sorted(vector.items(), key=lambda item: (-self.idf[item[0]], item[0])):
                if math.sqrt(max(0.0, rest)) < least - 1e-9:
                    break
                self.distinctive.add(w)
                rest -= x * x

    def _unit(self, counts: Counter) -> dict[str, float]:
        vector = {w: n * self.idf.get(w, self.unknown) for w, n in counts.items()}
        length = math.sqrt(sum(x * x for x in vector.values()))
        return {w: x / length for w, x in vector.items()}

    def best(self, counts: Counter) -> tuple[float, str]:
        """The best cosine and its licence; of equal ones the first name, and a whole text from ``BODY`` before notices."""
        cos = [0.0] * len(self.templates)
        for w, x in self._unit(counts).items():
            for i, y in self.held.get(w, ()):
                cos[i] += x * y
        return self._first([(round(c, 12), i) for i, c in enumerate(cos)])[:2]

    def _first(self, found: list[tuple[float, int]]) -> tuple[float, str, bool]:
        ranked = [(c, self.templates[i][0], i >= self.notices and c >= BODY) for c, i in found]
        return min(ranked, key=lambda f: (not f[2], -f[0], f[1]))

    def possible(self, every: list[str]) -> list[int]:
        """Templates that a vector of some of these words can reach: a cosine is at most their part of the length."""
        mass = [0.0] * len(self.templates)
        for w in set(every):
            for i, x in self.held.get(w, ()):
                mass[i] += x * x
        return [i for i, m in enumerate(mass) if m >= self.least * self.least - 1e-9]

    def _fits(self, own: list[str], i: int) -> bool:
        """A notice names its own licence and version, or none, and isn't denied."""
        if i >= self.notices:
            return True
        if self.names[i] and self.names[i].isdisjoint(own) and not _NAMES.isdisjoint(own):
            return False
        named = versions(own) if self.versions[i] else set()
        return (not named or not named.isdisjoint(self.versions[i])) and not _DENIED.search(" ".join(own))

    def _cosine(self, own: list[str], i: int, around: list[str] | None = None) -> float:
        """The cosine with a template; ``around`` adds the words on either side that can change a notice's sense."""
        if not self._fits(around or own, i):
            return 0.0
        template = self.templates[i][1]
        return round(sum(x * template.get(w, 0.0) for w, x in self._unit(Counter(own)).items()), 12)

    def _window(self, every: list[str], i: int) -> float:
        """The best cosine of a template with as many words in a row as it has."""
        n, template = self.lengths[i], self.templates[i][1]
        if len(every) <= n:
            return self._cosine(every, i)
        idf, unknown = self.idf, self.unknown
        weight = [idf.get(w, unknown) for w in every]
        gain = [x * template.get(w, 0.0) for w, x in zip(every, weight, strict=True)]
        counts: dict[str, int] = {}
        dot = square = 0.0
        top, at = -1.0, 0
        for end, w in enumerate(every):
            k = counts.get(w, 0)
            counts[w] = k + 1
            square += weight[end] * weight[end] * (2 * k + 1)
            dot += gain[end]
            begin = end - n
            if begin >= 0:
                old = every[begin]
                k = counts[old]
                counts[old] = k - 1
                square -= weight[begin] * weight[begin] * (2 * k - 1)
                dot -= gain[begin]
            if begin >= -1 and dot * dot > top * square:
                top, at = dot * dot / square, begin + 1
        return self._cosine(every[at:at + n], i, every[max(0, at - 3):at + n + 2])

    def scan(self, text: str) -> tuple[str | None, float]:
        tag = tagged(text)
        if tag:
            return tag, 1.0
        every = words(text)
        if self.distinctive.isdisjoint(every):
            return None, 0.0
        near = self.possible(every)
        if not near:
            return None, 0.0
        found = [(max(self._cosine(every, i), self._window(every, i)), i) for i in near]
        for part in set(_PART.split(text)):
            own = words(part)
            if not self.distinctive.isdisjoint(own):
                found.extend((self._cosine(own, i), i) for i in self.possible(own))
        score, name, _ = self._first(found)
        return (name, min(1.0, score)) if score >= self.least else (None, 0.0)


def fit(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, text: str = "text", least: float = LEAST,
        whole: tuple[tuple[str, str], ...] = ()) -> Model:
    """Counts, over all documents, in how many each template word occurs."""
    vocabulary = {w for _, t in (*templates, *whole) for w in words(t)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, seen = 0, Counter()
        for pdf in batches:
            n += len(pdf)
            for t in pdf["text"]:
                seen.update(vocabulary.intersection(words(t)))
        yield pd.DataFrame([("", n), *seen.items()], columns=["word", "n"])

    rows = shipped(files.select(text_or_empty(text).alias("text"))).mapInPandas(count, "word string, n long")
    found = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return Model(templates, found, found.get("", 0), least, whole)


def detect(files: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``files`` with ``licence`` and ``score`` of their own texts."""

    @F.pandas_udf("licence string, score double")
    def own(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([model.scan(t) for t in texts], columns=["licence", "score"])

    found = own(text_or_empty(text))
    return shipped(files).select("*", found.alias("found")).select(*files.columns, "found.licence", "found.score")


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherit(files: DataFrame) -> DataFrame:
    """Adds ``method`` (file, header, inherited, none) and ``origin``; fills ``licence`` of files without one."""
    names = [c for c in files.columns if c not in ("licence", "score")]
    is_file = F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENCE_FILE)
    files = files.withColumn("directory", _directory(F.col("path"))).withColumn("is_file", is_file)
    given = (files.filter("licence is not null and is_file").groupBy(F.col("directory").alias("ancestor"))
             .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("licence").alias("l"), "path")).alias("best"))
             .select("ancestor", F.col("best.l").alias("given"), F.col("best.path").alias("origin")))
    steps = F.split("directory", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(steps, 1, n), "/").alias("ancestor")))
    open_dirs = files.filter("licence is null and directory is not null").select("directory").distinct()
    found = (open_dirs.select("directory", F.explode(up).alias("up")).select("directory", "up.depth", "up.ancestor")
             .join(given, "ancestor").groupBy("directory")
             .agg(F.max(F.struct("depth", "given", "origin")).alias("nearest")))
    found = staged(found.select("directory", "nearest.given", "nearest.origin"), "licence_dirs")
    out = files.join(found, "directory", "left")
    own = F.col("licence").isNotNull()
    method = (F.when(own & F.col("is_file"), "file").when(own, "header").when(F.col("given").isNotNull(), "inherited")
              .otherwise("none"))
    return out.select(*names, F.coalesce("licence", "given").alias("licence"), "score", method.alias("method"),
                      F.when(own, F.col("path")).otherwise(F.col("origin")).alias("origin"))


def scan(files: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """Licences of all files (path, text, ...): own ones, then inherited ones. The text itself isn't returned."""
    files = files.drop("licence", "score", "method", "origin", "directory", "is_file", "given", "found")
    own = detect(files, fit(files, templates, text, whole=bodies()), text).drop(text)
    return inherit(staged(own, "licences"))
