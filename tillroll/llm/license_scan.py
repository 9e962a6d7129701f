"""License scans by sentence rules.

A text is read paragraph by paragraph (blank lines, also commented ones, part them; an
address set off by one belongs to the sentence before it). A paragraph is cut after full
stops, question and exclamation marks followed by white space (not after "v."), which end
a sentence, and into pieces at line ends and semicolons, which may not: a known sentence
takes one piece or several that follow each other, up to the end of its sentence or to
the next piece that starts a known one. Pieces are normalised: letters lowered, comment
and list marks and quotes dropped, white space collapsed, the closing mark removed.
Known licence sentences map it to an identifier with a captured version
where the wording has one; the identifiers, in text order with unknown pieces between
them as gaps, are matched against ordered licence rules. A rule is a sequence of
identifiers that must follow each other without a gap; rules are tried from the top at
every position, the first that fits takes its sentences, and an identifier that no rule
takes is reported as UNMATCHED.

Defined cases: NULL and empty texts have no sentences and an empty result; repeated rows
are reported each; a sentence of any length is read whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: identifier -> pattern of a whole normalised sentence; group 1 is a version or variant
SENTENCES = [
    ("ApacheRef", r"licensed under the apache licen[sc]e,? version (\d+(?:\.\d+)*)(?: \(the license\))?"),
    ("ApacheUse", r"you may not use this file except in compliance with the license"),
    ("ApacheCopy", r"you may obtain a copy of the license at .*"),
    ("MitRef", r"(?:re)?(?:licensed|released|distributed) under (?:the terms of )?the mit licen[sc]e"),
    ("MitGrant", r"permission is hereby granted, free of charge, to any person obtaining a copy of .*"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included in .*"),
    ("AsIs", r"(?:the|this) software is provided (?:by .* )?as is,? .*"),
    ("GplRef", r"this work is licensed under the gnu general public licen[sc]e,? version (\d+(?:\.\d+)*)"),
    ("GplFree", r"this program is free software(?:[:;] you can redistribute it and/or modify it under the terms "
                r"of the gnu general public licen[sc]e .*)?"),
    ("GplNoWarranty", r"this program is distributed in the hope that it will be useful,? .*"),
    ("LgplRef", r".*licensed under the gnu lesser general public licen[sc]e,? version (\d+(?:\.\d+)*)"),
    ("AgplRef", r".*licensed under the gnu affero general public licen[sc]e,? version (\d+(?:\.\d+)*)"),
    ("CcRef", r"(?:this work is )?licensed under (?:a )?(?:cc|creative commons) "
              r"(by(?:-nc)?(?:-sa|-nd)?(?: \d+(?:\.\d+)*)?)(?: license)?"),
    ("CcZero", r".*(?:cc0|dedicated to the public domain).*"),
    ("MplRef", r"this source code form is subject to the terms of the mozilla public license, v\. (\d+\.\d+)"),
    ("BsdRedist", r"redistribution and use in source and binary forms, with or without modification, .*"),
    ("BsdSource", r"redistributions of source code must retain .*"),
    ("BsdBinary", r"redistributions in binary form must reproduce .*"),
    ("BsdNames", r"neither the name of .* may be used to endorse or promote .*"),
    ("Spdx", r"spdx-license-identifier: ([a-z0-9.+-]+(?: (?:or|and|with) [a-z0-9.+-]+)*)"),
    ("Reserved", r"all rights reserved"),
    ("Copyright", r"(?:copyright )?(?:\(c\)|©|copyright) .*"),
]

#: licence -> identifiers in order; {} is the version captured by the first of them
RULES = [
    ("Apache-{}", ["ApacheRef", "ApacheUse", "ApacheCopy"]),
    ("MIT", ["MitGrant", "MitNotice", "AsIs"]),
    ("GPL", ["GplFree", "GplNoWarranty"]),
    ("BSD", ["BsdRedist", "BsdSource", "BsdBinary", "BsdNames", "AsIs"]),
    ("BSD", ["BsdRedist", "BsdSource", "BsdBinary", "AsIs"]),
    ("BSD", ["BsdRedist", "AsIs"]),
    ("Apache-{}", ["ApacheRef"]),
    ("MIT", ["MitRef"]),
    ("MIT", ["MitGrant"]),
    ("GPL-{}", ["GplRef"]),
    ("LGPL-{}", ["LgplRef"]),
    ("AGPL-{}", ["AgplRef"]),
    ("GPL", ["GplFree"]),
    ("CC-{}", ["CcRef"]),
    ("CC0", ["CcZero"]),
    ("MPL-{}", ["MplRef"]),
    ("BSD", ["BsdRedist", "BsdSource", "BsdBinary", "BsdNames"]),
    ("BSD", ["BsdRedist", "BsdSource", "BsdBinary"]),
    ("BSD", ["BsdRedist"]),
    ("SPDX:{}", ["Spdx"]),
    ("AllRightsReserved", ["Copyright", "Reserved"]),
    ("AllRightsReserved", ["Reserved"]),
    ("Copyright", ["Copyright"]),
]

#: identifiers that end with their line
ONE_LINE = {"Copyright", "Spdx"}

_LINE = re.compile(r"\r\n|\r|\n")
_STOP = re.compile(r"[.!?;]\s+|\n")
_MARKS = re.compile(r"[\"'`“”‘’]|^[\s#/*;\-]+|[\s*/]+$")
_SPACE = re.compile(r"\s+")
_LIST_MARK = re.compile(r"[\s#/*;\-]*\(?\d{1,2}[.)]\s+(?=\S)")
_ADDRESS = re.compile(r"<?(?:https?://|www\.)")
_CLOSING = ".!?;: "
#: words that follow "copyright" inside a sentence, where it starts no notice
_PROSE = re.compile(r"copyright (?:holder|owner|notice|licen[sc]e|law)")


def normalise(piece: str) -> str:
    return _SPACE.sub(" ", _MARKS.sub("", piece.lower())).strip()


def sentences(text: str) -> Iterator[list[str]]:
    """The normalised pieces of each sentence."""
    pieces, blank = [], False
    for line in _LINE.split(text):
        line += "\n"
        at, empty = 0, True
        if (not pieces or blank or pieces[-1][-1] in ":;") and (m := _LIST_MARK.match(line)):
            at = m.end()
        for m in _STOP.finditer(line, at):
            end = m[0][0] in ".!?"
            if end and line[max(0, m.start() - 2):m.start()].lower() in (" v", "v"):
                if m.end() < len(line):
                    continue
                end = False
            piece = normalise(line[at:m.end()])
            at = m.end()
            if not piece:
                continue
            empty = False
            if blank and pieces and not _ADDRESS.match(piece):
                yield pieces
                pieces = []
            blank = False
            pieces.append(piece)
            if end:
                yield pieces
                pieces = []
        blank = blank or empty
    if pieces:
        yield pieces


class Recogniser:
    """Sentences to identifiers and identifiers to licences."""

    def __init__(self, sentences=SENTENCES, rules=RULES):
        self.known = [(name, re.compile(p, re.S)) for name, p in sentences]
        anchored = [p for _, p in sentences if not p.startswith(".*")]
        self.starts = re.compile("|".join(f"(?:{p})" for p in anchored) or "(?!)", re.S)
        self.inside = [re.compile(p[2:].removesuffix(".*"), re.S) for _, p in sentences if p.startswith(".*")]
        self.rules = rules

    def identify(self, pieces: list[str]) -> Iterator[tuple[str, str] | None]:
        """Identifier and version of each known sentence; None for every other piece.

        Pieces are tried from the last to the first, so that a sentence stops where the
        next one is known to start."""
        text = " ".join(pieces)
        begin = [0, *accumulate(len(p) + 1 for p in pieces)][:-1]
        close = [b + len(p.rstrip(_CLOSING)) for b, p in zip(begin, pieces)]
        inside = {bisect_right(begin, m.start()) - 1 for p in self.inside for m in p.finditer(text)}
        found, limit = {}, len(pieces)
        for k in range(len(pieces) - 1, -1, -1):
            if k in inside or self.starts.match(text, begin[k]):
                if hit := self._at(text, begin, close, k, limit):
                    found[k], limit = hit, k
        k = 0
        while k < len(pieces):
            name, version, k = found.get(k, (None, "", k + 1))
            yield (name, version) if name else None

    def _at(self, text: str, begin: list[int], close: list[int], k: int,
            limit: int) -> tuple[str, str, int] | None:
        """The known sentence that starts with piece k, its version and the piece after it."""
        alone = None
        for name, pattern in self.known:
            if m := pattern.fullmatch(text, begin[k], close[k]):
                if not (name == "Copyright" and k and _PROSE.match(text, begin[k])):
                    alone = name, pattern, m
                    break
        if limit > k + 1:
            for name, pattern in [alone[:2]] if alone else self.known:
                if name not in ONE_LINE and (m := pattern.match(text, begin[k], close[limit - 1])):
                    last = bisect_right(begin, max(m.end() - 1, begin[k])) - 1
                    if m.end() >= close[last]:
                        return name, (m[1] or "") if pattern.groups else "", last + 1
        return (alone[0], (alone[2][1] or "") if alone[1].groups else "", k + 1) if alone else None

    def sentences(self, text: str) -> Iterator[tuple[str, str] | None]:
        """Per known sentence its identifier and version; None for pieces that are not known."""
        for pieces in sentences(text):
            yield from self.identify(pieces)

    def scan(self, text: str) -> tuple[list[str], list[str]]:
        """(identifiers in order, licences in order)."""
        runs, run = [], []
        for found in self.sentences(text):
            if found:
                run.append(found)
            elif run:
                runs.append(run)
                run = []
        if run:
            runs.append(run)
        licences = []
        for run in runs:
            i = 0
            while i < len(run):
                for name, seq in self.rules:
                    if [x for x, _ in run[i:i + len(seq)]] == seq:
                        licences.append(name.format(run[i][1].upper()) if "{}" in name else name)
                        i += len(seq)
                        break
                else:
                    licences.append(f"UNMATCHED:{run[i][0]}")
                    i += 1
        return [x for run in runs for x, _ in run], licences


def scanner(sentences, rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recogniser = Recogniser(sentences, rules)
        for batch in batches:
            out = [recogniser.scan(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in out], pa.list_(pa.string())),
                 pa.array([x for _, x in out], pa.list_(pa.string()))],
                ["doc_id", "sentence_ids", "licences"])
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sentences=SENTENCES, rules=RULES) -> DataFrame:
    """One row per document: doc_id, sentence_ids (array), licences (array)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(scanner(sentences, rules),
                           "doc_id long, sentence_ids array<string>, licences array<string>")
