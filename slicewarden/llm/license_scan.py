"""License scan by conditional compression.

Every hint word opens a stretch of words for each template, as far to both
sides as a notice of that template can reach, whatever the lines are.  The
stretch is compressed with zstandard alone and with the template as raw
dictionary.  The bytes saved decide: templates that save none are out, the
others are ranked by what they save, and in that order compared with the
stretch word by word.  A template is confirmed where its wording is there with
few words changed and the words that tell licenses apart unchanged; the words
it covers are taken, and what is left of the stretch is compressed and ranked
again.  So of notices that overlap the one that saves the most counts.

Templates are a parameter: short notices and whole license bodies alike.

Defined cases: null and empty texts have no block; a block (hints widened by the
longest reach, merged where they overlap) that no template explains is counted
but names no license; equal savings rank by template order; spans count code
points, the end exclusive; columns named like a result are replaced; repeated
rows each get a row; very long texts cost a stretch for each run of hints.
"""

from __future__ import annotations

import bisect
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewarden.llm.common import bound_batches

# Public license notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
            "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
            "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
            "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, public domain dedication."),
)
HINT = r"(?i)licen[sc]|copyright|permission|redistribut|warrant|free software|public domain|creative commons|\bCC[ 0-]"
_HINT = regex.compile(HINT)
_WORD = regex.compile(r"[\p{L}]+|\p{N}+")
# Words that tell one license of a family from another.
_TELLING = frozenset("mit apache gnu lesser affero mozilla bsd isc cc0 nc sa nd not cc by v".split())


# Share of a template's words that may be changed.
MOST_CHANGED = 0.15
_UNIT, _NEVER = 1 << 32, 1000       # place of the cost above the start; cost of a telling word


def _plain(text: str) -> bytes:
    """What is compressed: lower case, single spaces."""
    return " ".join(text.lower().split()).encode()


Templates = tuple[tuple[str, str], ...]


@functools.lru_cache(maxsize=4)
def _wanted(templates: Templates) -> tuple[dict[str, int], list[tuple[list[int], list[int], int]]]:
    """Word numbers, and per template its words, the cost of lacking each, and
    how many words a notice can hold."""
    numbers: dict[str, int] = {}
    out = []
    for _, text in templates:
        words = _WORD.findall(text.lower())
        out.append(([numbers.setdefault(w, len(numbers)) for w in words], [_cost(w) for w in words],
                    len(words) + int(MOST_CHANGED * len(words))))
    return numbers, out


def _cost(word: str) -> int:
    return _NEVER if word in _TELLING or word.isdigit() else 1


@functools.lru_cache(maxsize=4)
def _packers(templates: Templates, level: int):
    import zstandard

    plain = zstandard.ZstdCompressor(level=level, write_checksum=False)
    by_template = []
    for _, text in templates:
        d = zstandard.ZstdCompressionDict(_plain(text), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        by_template.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False))
    return plain.compress, [c.compress for c in by_template]


def wording(have: np.ndarray, adds: np.ndarray, want: list[int], lacks: list[int]) -> tuple[int, int, int]:
    """(cost, start, end) of the words in ``have`` that hold ``want`` with the
    least cost of template words lacking and other words put in between.

    One row per template word over all ends at once; the start rides along in
    the low bits, so of equal costs the earliest start counts."""
    best = np.arange(len(have) + 1, dtype=np.int64)
    added = np.concatenate(([0], np.cumsum(adds))) * _UNIT
    for word, lack in zip(want, lacks):
        row = best + lack * _UNIT
        np.minimum(row[1:], best[:-1], out=row[1:], where=have == word)
        best = np.minimum.accumulate(row - added) + added
    end = int(best.argmin())
    return int(best[end]) >> 32, int(best[end]) & (_UNIT - 1), end


def _windows(hints: list[int], reach: int, n: int, longest: int) -> list[tuple[int, int]]:
    """Word ranges that reach ``reach`` words to both sides of each hint; hints
    at most ``longest`` words apart share one."""
    out, i = [], 0
    while i < len(hints):
        j = bisect.bisect_right(hints, hints[i] + longest)
        out.append((max(0, hints[i] - reach), min(n, hints[j - 1] + reach + 1)))
        i = j
    return out


def scan_text(text: str, templates: Templates = TEMPLATES, level: int = 3) -> tuple[int, list[tuple]]:
    """Number of blocks, and (license, saved, changed, start, end) found: the
    share saved of the compressed stretch, the number of changed words."""
    found = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = [f[1] for f in found]
    hints = sorted({bisect.bisect_right(starts, m.start()) - 1 for m in _HINT.finditer(text)})
    if not hints:
        return 0, []
    numbers, wanted = _wanted(templates)
    plain, by_template = _packers(templates, level)
    ids = np.array([numbers.get(w, -1) for w, _, _ in found], np.int64)
    adds = np.array([_cost(w) for w, _, _ in found], np.int64)
    widest = max(reach for _, _, reach in wanted)
    n_blocks = 1 + sum(b - a > 2 * widest for a, b in zip(hints, hints[1:]))
    alone: dict[tuple[int, int], int] = {}
    ranked: list[tuple[int, int, int, int]] = []

    def rank(i: int, lo: int, hi: int) -> None:
        data = _plain(text[found[lo][1]:found[hi - 1][2]])
        if (lo, hi) not in alone:
            alone[lo, hi] = len(plain(data))
        saved = alone[lo, hi] - len(by_template[i](data))
        if saved > 0:
            heapq.heappush(ranked, (-saved, i, lo, hi))

    for i, (_, _, reach) in enumerate(wanted):
        for lo, hi in _windows(hints, reach, len(found), 2 * reach):
            rank(i, lo, hi)
    out: list[tuple] = []
    taken = np.zeros(len(found), bool)
    while ranked:
        saved, i, lo, hi = heapq.heappop(ranked)
        want, lacks, _ = wanted[i]
        if taken[lo:hi].any():                      # others took part of it meanwhile: rank what is left
            edges = np.flatnonzero(np.diff(np.concatenate([[1], taken[lo:hi], [1]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                rank(i, lo + a, lo + b)
            continue
        here = set(ids[lo:hi].tolist())
        # Words that are nowhere in the stretch are lacking in any wording.
        if sum(lack for w, lack in zip(want, lacks) if w not in here) > MOST_CHANGED * len(want):
            continue
        cost, start, end = wording(ids[lo:hi], adds[lo:hi], want, lacks)
        if end > start and cost <= MOST_CHANGED * len(want):
            taken[lo + start:lo + end] = True
            out.append((templates[i][0], -saved / alone[lo, hi], cost, found[lo + start][1], found[lo + end - 1][2]))
            for a, b in ((lo, lo + start), (lo + end, hi)):
                if a < b:
                    rank(i, a, b)
    return n_blocks, sorted(out, key=lambda f: f[3:])


def license_scan(df: DataFrame, text_col: str = "text", templates: Templates = TEMPLATES) -> DataFrame:
    """``df`` with ``n_blocks``, ``licenses`` (distinct names, sorted, comma-
    joined), ``spans`` ("license:start:end") and ``best_saving``."""
    bound_batches(df.sparkSession)
    out_type = pa.struct([("n_blocks", pa.int64()), ("licenses", pa.string()), ("spans", pa.string()),
                          ("best_saving", pa.float64())])

    @F.arrow_udf("struct<n_blocks:long,licenses:string,spans:string,best_saving:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for text in texts.to_pylist():
                n, found = scan_text(text, templates) if text else (0, [])
                rows.append({"n_blocks": n, "licenses": ",".join(sorted({f[0] for f in found})),
                             "spans": ",".join(f"{f[0]}:{f[3]}:{f[4]}" for f in found),
                             "best_saving": max((f[1] for f in found), default=None)})
            yield pa.array(rows, out_type)

    # Texts without a hint never leave the JVM.
    hinted = F.when(F.col(text_col).rlike(HINT), F.col(text_col))
    names = [f.name for f in out_type]
    done = df.select(F.struct(*df.columns).alias("row"), run(hinted).alias("r"))
    return done.select(*[F.col(f"row.{c}").alias(c) for c in df.columns if c not in names], "r.*")
