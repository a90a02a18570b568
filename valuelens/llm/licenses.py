"""License scans (4): ordered signature rules with keyword gates, priorities and containment.

A rule is a regular expression over the lowered text with keywords, one of which must be in the
text for the rule to run, a label, a priority and a confidence. An Aho-Corasick automaton over all
keywords gates the rules of a text in one pass. Detections are settled by interval: one that lies
within the interval of a detection of higher priority (at equal priority: of a longer one, then of
an earlier rule) is suppressed. Base phrases are counted in any case.

The rules are a table of families (fixed values, kept in plain form) times forms: SPDX tag, grant,
full name, short name with version, address. Notices and sentences follow as single rules.
Scale: one pass over each text, no shuffle; nothing of the text is cut.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm import words as W
from valuelens.llm.tables import map_arrow

#: Base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Label, SPDX identifier, full name, short name with version (expressions), part of the address.
FAMILIES = (
    ("gpl-1.0", "gpl-1.0", "gnu general public license v(?:ersion )?1", "gplv?1", "gnu.org/licenses/old-licenses/gpl-1.0"),
    ("gpl-2.0", "gpl-2.0", "gnu general public license,? (?:v|version )2", "gpl ?v?2", "gnu.org/licenses/old-licenses/gpl-2.0"),
    ("gpl-3.0", "gpl-3.0", "gnu general public license,? (?:v|version )3", "gpl ?v?3", "gnu.org/licenses/gpl-3.0"),
    ("lgpl-2.0", "lgpl-2.0", "gnu library general public license", "lgpl ?v?2[.]0", "gnu.org/licenses/old-licenses/lgpl-2.0"),
    ("lgpl-2.1", "lgpl-2.1", "gnu lesser general public license,? (?:v|version )2[.]1", "lgpl ?v?2[.]1", "gnu.org/licenses/old-licenses/lgpl-2.1"),
    ("lgpl-3.0", "lgpl-3.0", "gnu lesser general public license,? (?:v|version )3", "lgpl ?v?3", "gnu.org/licenses/lgpl-3.0"),
    ("agpl-3.0", "agpl-3.0", "gnu affero general public license", "agpl ?v?3", "gnu.org/licenses/agpl-3.0"),
    ("gfdl-1.3", "gfdl-1.3", "gnu free documentation license", "gfdl", "gnu.org/licenses/fdl-1.3"),
    ("apache-1.1", "apache-1.1", "apache software license,? version 1[.]1", "apache[ -]1[.]1", "apache.org/licenses/license-1.1"),
    ("apache-2.0", "apache-2.0", "apache license,? version 2[.]0", "apache[ -]2(?:[.]0)?", "apache.org/licenses/license-2.0"),
    ("mit", "mit", "mit license", "mit licen[cs]ed", "opensource.org/licenses/mit"),
    ("mit-0", "mit-0", "mit no attribution license", "mit-0", "opensource.org/licenses/mit-0"),
    ("x11", "x11", "x11 license", "x11 licen[cs]ed", "spdx.org/licenses/x11"),
    ("isc", "isc", "isc license", "isc licen[cs]ed", "opensource.org/licenses/isc"),
    ("bsd-0", "0bsd", "bsd zero clause license", "0bsd", "opensource.org/licenses/0bsd"),
    ("bsd-2-clause", "bsd-2-clause", "(?:simplified bsd|2-clause bsd|bsd 2-clause) license", "bsd[ -]2[ -]clause", "opensource.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", "bsd-3-clause", "(?:new bsd|modified bsd|3-clause bsd|bsd 3-clause) license", "bsd[ -]3[ -]clause", "opensource.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", "bsd-4-clause", "(?:original bsd|4-clause bsd|bsd 4-clause) license", "bsd[ -]4[ -]clause", "spdx.org/licenses/bsd-4-clause"),
    ("mpl-1.1", "mpl-1.1", "mozilla public license,? (?:v|version )1[.]1", "mpl ?v?1[.]1", "mozilla.org/mpl/1.1"),
    ("mpl-2.0", "mpl-2.0", "mozilla public license,? (?:v|version )[.]?2[.]0", "mpl ?v?2(?:[.]0)?", "mozilla.org/mpl/2.0"),
    ("epl-1.0", "epl-1.0", "eclipse public license,? (?:- )?(?:v|version )1", "epl ?v?1", "eclipse.org/legal/epl-v10"),
    ("epl-2.0", "epl-2.0", "eclipse public license,? (?:- )?(?:v|version )2", "epl ?v?2", "eclipse.org/legal/epl-2.0"),
    ("cddl-1.0", "cddl-1.0", "common development and distribution license", "cddl", "opensource.org/licenses/cddl-1.0"),
    ("cpl-1.0", "cpl-1.0", "common public license", "cpl ?v?1", "opensource.org/licenses/cpl1.0"),
    ("artistic-1.0", "artistic-1.0", "artistic license 1[.]0", "artistic[ -]1", "opensource.org/licenses/artistic-license-1.0"),
    ("artistic-2.0", "artistic-2.0", "artistic license 2[.]0", "artistic[ -]2", "opensource.org/licenses/artistic-license-2.0"),
    ("bsl-1.0", "bsl-1.0", "boost software license", "bsl-1[.]0", "boost.org/license_1_0"),
    ("zlib", "zlib", "zlib license", "zlib/libpng", "opensource.org/licenses/zlib"),
    ("unlicense", "unlicense", "the unlicense", "unlicen[cs]ed work", "unlicense.org"),
    ("wtfpl", "wtfpl", "do what the fuck you want to public license", "wtfpl", "wtfpl.net"),
    ("cc0-1.0", "cc0-1.0", "(?:cc0|creative commons zero)(?: 1[.]0)?(?: universal)?", "cc0", "creativecommons.org/publicdomain/zero"),
    ("cc-by-1.0", "cc-by-1.0", "creative commons attribution 1[.]0", "cc[ -]by[ -]1[.]0", "creativecommons.org/licenses/by/1.0"),
    ("cc-by-2.0", "cc-by-2.0", "creative commons attribution 2[.]0", "cc[ -]by[ -]2[.]0", "creativecommons.org/licenses/by/2.0"),
    ("cc-by-3.0", "cc-by-3.0", "creative commons attribution 3[.]0", "cc[ -]by[ -]3[.]0", "creativecommons.org/licenses/by/3.0"),
    ("cc-by-4.0", "cc-by-4.0", "creative commons attribution 4[.]0", "cc[ -]by[ -]4[.]0", "creativecommons.org/licenses/by/4.0"),
    ("cc-by-sa-3.0", "cc-by-sa-3.0", "creative commons attribution[- ]share ?alike 3[.]0", "cc[ -]by[ -]sa[ -]3[.]0", "creativecommons.org/licenses/by-sa/3.0"),
    ("cc-by-sa-4.0", "cc-by-sa-4.0", "creative commons attribution[- ]share ?alike 4[.]0", "cc[ -]by[ -]sa[ -]4[.]0", "creativecommons.org/licenses/by-sa/4.0"),
    ("cc-by-nd-4.0", "cc-by-nd-4.0", "creative commons attribution[- ]no ?derivatives 4[.]0", "cc[ -]by[ -]nd[ -]4[.]0", "creativecommons.org/licenses/by-nd/4.0"),
    ("cc-by-nc-3.0", "cc-by-nc-3.0", "creative commons attribution[- ]non ?commercial 3[.]0", "cc[ -]by[ -]nc[ -]3[.]0", "creativecommons.org/licenses/by-nc/3.0"),
    ("cc-by-nc-4.0", "cc-by-nc-4.0", "creative commons attribution[- ]non ?commercial 4[.]0", "cc[ -]by[ -]nc[ -]4[.]0", "creativecommons.org/licenses/by-nc/4.0"),
    ("cc-by-nc-sa-4.0", "cc-by-nc-sa-4.0", "creative commons attribution[- ]non ?commercial[- ]share ?alike 4[.]0", "cc[ -]by[ -]nc[ -]sa[ -]4[.]0", "creativecommons.org/licenses/by-nc-sa/4.0"),
    ("cc-by-nc-nd-4.0", "cc-by-nc-nd-4.0", "creative commons attribution[- ]non ?commercial[- ]no ?derivatives 4[.]0", "cc[ -]by[ -]nc[ -]nd[ -]4[.]0", "creativecommons.org/licenses/by-nc-nd/4.0"),
    ("odbl-1.0", "odbl-1.0", "open database license", "odbl", "opendatacommons.org/licenses/odbl"),
    ("odc-by-1.0", "odc-by-1.0", "open data commons attribution license", "odc-by", "opendatacommons.org/licenses/by"),
    ("pddl-1.0", "pddl-1.0", "public domain dedication and license", "pddl", "opendatacommons.org/licenses/pddl"),
    ("eupl-1.2", "eupl-1.2", "european union public licen[cs]e", "eupl ?v?1", "joinup.ec.europa.eu/collection/eupl"),
    ("ofl-1.1", "ofl-1.1", "sil open font license", "ofl-1[.]1", "scripts.sil.org/ofl"),
    ("ms-pl", "ms-pl", "microsoft public license", "ms-pl", "opensource.org/licenses/ms-pl"),
    ("ms-rl", "ms-rl", "microsoft reciprocal license", "ms-rl", "opensource.org/licenses/ms-rl"),
    ("afl-3.0", "afl-3.0", "academic free license", "afl ?v?3", "opensource.org/licenses/afl-3.0"),
    ("osl-3.0", "osl-3.0", "open software license", "osl ?v?3", "opensource.org/licenses/osl-3.0"),
    ("ncsa", "ncsa", "(?:university of illinois/)?ncsa open source license", "uiuc license", "opensource.org/licenses/ncsa"),
    ("postgresql", "postgresql", "postgresql license", "postgresql licen[cs]ed", "opensource.org/licenses/postgresql"),
    ("python-2.0", "psf-2.0", "python software foundation license", "psf license", "docs.python.org/3/license"),
    ("php-3.01", "php-3.01", "php license", "php licen[cs]ed", "php.net/license/3_01"),
    ("ruby", "ruby", "ruby license", "ruby's license", "ruby-lang.org/en/about/license"),
    ("openssl", "openssl", "openssl license", "openssl/ssleay", "openssl.org/source/license"),
    ("curl", "curl", "curl license", "curl/libcurl license", "curl.se/docs/copyright"),
    ("upl-1.0", "upl-1.0", "universal permissive license", "upl ?v?1", "oss.oracle.com/licenses/upl"),
    ("bsl-1.1", "busl-1.1", "business source license", "busl", "mariadb.com/bsl11"),
    ("sspl-1.0", "sspl-1.0", "server side public license", "sspl", "mongodb.com/licensing/server-side-public-license"),
    ("elastic-2.0", "elastic-2.0", "elastic license 2[.]0", "elv2", "elastic.co/licensing/elastic-license"),
    ("openrail", "openrail", "(?:creativeml )?open ?rail(?:[ -][+]?m)? license", "openrail", "huggingface.co/spaces/bigscience/license"),
    ("llama", "llama2", "llama (?:2|3)?[ ]?community license", "llama license", "ai.meta.com/llama/license"),
)

#: Label, keywords, expression, priority, confidence of single rules.
NOTICES = (
    ("all-rights-reserved", ("rights reserved",), r"all rights reserved", 20, 0.6),
    ("all-rights-reserved", ("rights are reserved",), r"all rights are reserved", 20, 0.6),
    ("some-rights-reserved", ("rights reserved",), r"some rights reserved", 20, 0.5),
    ("copyright", ("copyright",), r"copyright\s+(?:\(c\)|©)\s*[0-9]{4}", 15, 0.4),
    ("copyright", ("copyright",), r"copyright\s+[0-9]{4}(?:\s*-\s*[0-9]{4})?", 14, 0.4),
    ("mit", ("permission is hereby granted",), r"permission is hereby granted,\s+free of charge,\s+to any person obtaining a copy", 80, 1.0),
    ("mit", ("the software is provided",), r'the software is provided "as is", without warranty of any kind', 60, 0.8),
    ("isc", ("permission to use, copy, modify",), r"permission to use, copy, modify, and/or distribute this software for any purpose", 80, 1.0),
    ("bsd", ("redistribution and use",), r"redistribution and use in source and binary forms", 75, 0.9),
    ("bsd-3-clause", ("neither the name",), r"neither the name of .{1,80}? nor the names of its contributors", 80, 1.0),
    ("bsd-4-clause", ("all advertising materials",), r"all advertising materials mentioning features or use of this software", 82, 1.0),
    ("gpl", ("free software",), r"this program is free software[:;,] you can redistribute it", 78, 0.9),
    ("gpl", ("terms of the gnu",), r"under the terms of the gnu general public license", 55, 0.8),
    ("lgpl", ("terms of the gnu",), r"under the terms of the gnu lesser general public license", 56, 0.8),
    ("agpl", ("terms of the gnu",), r"under the terms of the gnu affero general public license", 56, 0.8),
    ("gpl-or-later", ("any later version",), r"(?:either )?version [0-9](?:[.][0-9])? of the license,? or \(at your option\) any later version", 79, 0.9),
    ("gpl-exception", ("linking exception",), r"(?:gcc runtime library|classpath|linking) exception", 50, 0.7),
    ("apache-2.0", ("compliance",), r"you may not use this file except in compliance with the license", 80, 1.0),
    ("apache-2.0", ("unless required by applicable law",), r"unless required by applicable law or agreed to in writing, software", 70, 0.9),
    ("mpl-2.0", ("source code form",), r"this source code form is subject to the terms of the mozilla public", 80, 1.0),
    ("bsl-1.0", ("boost software license",), r"boost software license - version 1[.]0", 80, 1.0),
    ("zlib", ("altered source versions",), r"altered source versions must be plainly marked as such", 80, 1.0),
    ("unlicense", ("unencumbered software",), r"this is free and unencumbered software released into the public domain", 85, 1.0),
    ("public-domain", ("public domain",), r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain", 40, 0.7),
    ("public-domain", ("public domain",), r"public domain", 10, 0.4),
    ("cc0-1.0", ("dedicated this work",), r"has dedicated this work to the public domain", 80, 1.0),
    ("proprietary", ("proprietary and confidential",), r"proprietary and confidential", 45, 0.8),
    ("proprietary", ("unauthorized copying",), r"unauthorized copying of this file", 45, 0.8),
    ("proprietary", ("reproduced",), r"no part of this (?:publication|work|book) may be reproduced", 45, 0.8),
    ("proprietary", ("trade secret",), r"contains trade secrets?", 40, 0.6),
    ("commercial", ("commercial license",), r"commercial license", 25, 0.5),
    ("non-commercial", ("non-commercial",), r"for non-commercial use only", 35, 0.7),
    ("non-commercial", ("noncommercial",), r"for noncommercial (?:use|purposes)", 35, 0.7),
    ("research-only", ("academic purposes", "research purposes"), r"for (?:academic|research) (?:and research )?purposes only", 35, 0.7),
    ("fair-use", ("fair use",), r"under (?:the )?fair use", 20, 0.4),
    ("see-license", ("license",), r"see (?:the )?license(?:[.](?:txt|md))? (?:file )?(?:for|in)", 12, 0.3),
    ("lgpl", ("lesser general public",), r"gnu lesser general public license", 40, 0.7),
    ("gpl", ("general public license",), r"gnu general public license", 38, 0.7),
    ("apache", ("apache license",), r"apache license", 36, 0.7),
    ("mit", ("mit license",), r"mit license", 36, 0.7),
    ("cc", ("creative commons",), r"creative commons", 18, 0.4),
    ("cc-by", ("cc by", "cc-by"), r"cc[ -]by", 16, 0.4),
    ("bsd", ("bsd license",), r"bsd(?:-style)? license", 36, 0.7),
    ("open-data", ("open data",), r"open data license", 20, 0.5),
    ("crown-copyright", ("crown copyright",), r"crown copyright", 40, 0.8),
    ("ogl-3.0", ("open government licence",), r"open government licen[cs]e(?: v3[.]0)?", 50, 0.9),
    ("terms-of-service", ("terms of service",), r"subject to (?:our|the|these) terms of service", 15, 0.4),
)

_W = rb"0-9a-z\x80-\xff"


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    priority: int
    confidence: float


def _spaced(expression: str) -> bytes:
    """The expression for lowered bytes: a space stands for any run of white space, an optional one or one in a class too; ends fall on word borders."""
    body = expression.encode().replace(b"[ ]?", rb"\s*").replace(b" ?", rb"\s*")
    body = body.replace(b"[ -]", rb"(?:\s+|-)").replace(b"[- ]", rb"(?:\s+|-)").replace(b" ", rb"\s+")
    return rb"(?<![" + _W + rb"])(?:" + body + rb")(?![" + _W + rb"])"


def _gates(expression: str) -> tuple[str, ...]:
    """Keywords of which every match contains one: the longest word outside of groups, or all words if there is none."""
    without = re.sub(r"\((?:[^()]|\([^()]*\))*\)[?*+]?", "|", expression)
    without = re.sub(r"\[[^\]]*\][?*+]?|.[?*+]", "|", without)
    longest = max(re.findall(r"[a-z0-9]+", without), key=len, default="")
    return (longest,) if len(longest) >= 2 else tuple(re.findall(r"[a-z0-9]{2,}", expression))


def rules() -> list[Rule]:
    """All rules in order."""
    out = []

    def add(label, keywords, expression, priority, confidence):
        keywords = tuple(max(k.split(" "), key=len) for k in keywords)  # white space may be any
        out.append(Rule(label, keywords, re.compile(_spaced(expression), re.DOTALL), priority, confidence))

    for label, spdx, name, short, address in FAMILIES:
        tag = re.escape(spdx)
        add(label, ("spdx-license-identifier",), rf"spdx-license-identifier: ?{tag}(?:-only|-or-later)?", 100, 1.0)
        add(label, ("licen", "released", "distributed", "available"), rf"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?(?:{name})", 90, 0.95)
        add(label, ("licen", "released", "distributed", "available"), rf"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:{short}|{tag})", 88, 0.9)
        add(label, _gates(name), name, 50, 0.8)
        add(label, _gates(short), short, 30, 0.6)
        add(label, (address,), rf"(?:https?://)?(?:www[.])?{re.escape(address)}", 70, 0.9)
    for label, keywords, expression, priority, confidence in NOTICES:
        add(label, keywords, expression, priority, confidence)
    return out


class Scanner:
    """Rules with their gate. Built once per task."""

    def __init__(self):
        self.rules = rules()
        self.gate = ahocorasick.Automaton()
        by_word: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            for k in r.keywords:
                by_word.setdefault(k, []).append(i)
        for k, v in by_word.items():
            self.gate.add_word(k, tuple(v))
        self.gate.make_automaton()
        gap = rb"[^" + _W + rb"]+"
        self.base = [(re.compile(rb"(?<![" + _W + rb"])" + gap.join(p.encode().split()) + rb"(?![" + _W + rb"])"), label, p.split()[0].encode()) for p, label in BASE]

    def detect(self, low: bytes) -> list[tuple[int, int, int]]:
        """(rule, first byte, end byte) of the detections that stay, by place."""
        on = set()
        for _, numbers in self.gate.iter(low.decode("latin-1")):
            on.update(numbers)
        found = [(self.rules[i].priority, m.end() - m.start(), -i, m.start(), m.end()) for i in sorted(on) for m in self.rules[i].pattern.finditer(low)]
        return [(-i, a, b) for _, _, i, a, b in settle(found)]

    def places(self, low: bytes) -> list[tuple[int, str]]:
        """(first byte, label) of all places of the base phrases."""
        return [(m.start(), label) for pattern, label, word in self.base if word in low for m in pattern.finditer(low)]


def settle(found: list[tuple]) -> list[tuple]:
    """Detections (priority, length, -rule, first, end) less those within the interval of a stronger one, by place."""
    kept: list[tuple] = []
    starts: list[int] = []  # of kept detections, ascending, with the farthest end up to each
    far: list[int] = []
    for d in sorted(found, key=lambda d: (-d[0], -d[1], -d[2], d[3])):
        a, b = d[3], d[4]
        i = bisect.bisect_right(starts, a)
        if i and far[i - 1] >= b:
            continue
        kept.append(d)
        starts.insert(i, a)
        far.insert(i, max(b, far[i - 1] if i else b))
        for j in range(i + 1, len(far)):
            if far[j] >= b:
                break
            far[j] = b
    return sorted(kept, key=lambda d: (d[3], d[4]))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score, detections.

    docs needs doc_id and text; other columns are ignored. Null and empty texts have no words and no
    labels, first_word and last_word are null, score 0. score is the highest confidence of a
    detection that stays (0.5 at least where a base phrase stands). Repeated rows are scanned alike.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scanner = Scanner()
        found_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("priority", pa.int64())]))
        for b in W.pieces(batches):
            w = W.split(b.column("text"), W.ALNUM)
            sizes = np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0)).astype(np.int64)
            ends = np.cumsum(sizes).tolist()
            raw = w.data.tobytes()
            cols: list[list] = [[] for _ in range(7)]
            for i, (a, e) in enumerate(zip([0, *ends[:-1]], ends)):
                low = raw[a:e]
                places, kept = scanner.places(low), scanner.detect(low)
                at = sorted(int(np.searchsorted(w.start, a + p)) - int(w.first[i]) for p, _ in places)
                base = sorted({label for _, label in places})
                strong = [scanner.rules[r].confidence for r, _, _ in kept]
                row = (len(places), at[0] if at else None, at[-1] if at else None, base, sorted({*base, *(scanner.rules[r].label for r, _, _ in kept)}),
                       max([*strong, 0.5 if places else 0.0]),
                       [{"label": scanner.rules[r].label, "first": x, "end": y, "priority": scanner.rules[r].priority} for r, x, y in kept])
                for c, v in zip(cols, row):
                    c.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), found_type]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(w.counts, pa.int64()), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])

    return map_arrow(docs.select("doc_id", F.col("text")), run,
                     f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
                     "score double, detections array<struct<label:string,first:long,end:long,priority:long>>")
