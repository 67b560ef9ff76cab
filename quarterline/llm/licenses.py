"""License scan: MinHash bands over overlapping windows find templates, exact containment of shingles proves them.

Templates are grouped by their number of shingles, rounded up to a power of two n. A text is cut into blocks of n
shingles and every two neighbouring blocks are a window, so a stretch as long as a template lies within one window.
A window and a template with ``least`` of its shingles have a similarity of least * (n / 2) / (2 n + n / 2) or more;
with bands of one minimum, BANDS bands miss such a pair with probability (1 - 0.15)**64 = 3e-5 at least 0.75.

Of templates found in the same stretch, one stays beside another that matches more shingles only if the stretch has
shingles of it that the other lacks, such as those with the version: siblings share most of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import shingles, sliced, utf8, words
from quarterline.llm.minhash import _family
from quarterline.llm.spotsigs import _APART

SHINGLE = 5
LEAST = 0.75
BANDS = 64
#: Share of a template's shingles in a stretch that a better template must lack for it to stay beside that one.
OWN = 0.02

# Notices by which works are put under a license, and the usual paragraphs.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}

_GNU = "can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
_SHORT = "This work is licensed under the GNU {}, version {}."
_MIT = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""


@cache
def whole_texts() -> dict[str, list[str]]:
    """Whole licenses, and the notices of their siblings. That of AGPL-3.0 is GPL-3.0's terms under its name."""
    folder = files("quarterline.llm") / "license_texts"

    def terms(name: str, start: str = "") -> str:
        text = (folder / f"{name}.txt").read_text(encoding="utf-8").partition("END OF TERMS AND CONDITIONS")[0]
        return text[text.index(start):]

    general, lesser, affero = (f"{k}General Public License" for k in ("", "Lesser ", "Affero "))
    gpl3 = terms("GPL-3", "TERMS AND CONDITIONS")
    either = ", either version {} of the License, or (at your option) any later version."
    return {
        "MIT": [TEMPLATES["MIT"][1] + ", subject to the following conditions: The above copyright notice and this permission "
                "notice shall be included in all copies or substantial portions of the Software." + _MIT],
        "ISC": [TEMPLATES["ISC"][0] + _ISC],
        "BSD-2-Clause": [_BSD.format("")],
        "BSD-3-Clause": [_BSD.format(_NAMES)],
        "Apache-2.0": [terms("Apache-2.0")],
        "MPL-2.0": [terms("MPL-2.0")],
        "CC0-1.0": [terms("CC0-1.0")],
        "GPL-2.0": [terms("GPL-2", "TERMS AND CONDITIONS FOR COPYING"), _SHORT.format(general, 2), "This program is free software; you " + _GNU.format(general) + either.format(2)],
        "GPL-3.0": [gpl3],
        "LGPL-2.1": [terms("LGPL-2.1"), _SHORT.format(lesser, "2.1"), "This library is free software; you " + _GNU.format(lesser) + either.format("2.1")],
        "LGPL-3.0": [terms("LGPL-3"), "This program is free software: you " + _GNU.format(lesser) + either.format(3)],
        "AGPL-3.0": [gpl3.replace("GNU General Public License", "GNU Affero General Public License"), _SHORT.format(affero, 3),
                     "This program is free software: you " + _GNU.format(affero) + either.format(3)],
    }


class Index:
    """Templates by class of size, with their minima."""

    def __init__(self, *templates: dict[str, list[str]], bands: int = BANDS):
        flat = [(name, t) for table in templates for name, ts in table.items() for t in ts]
        h, first = shingles(words([t.encode() for _, t in flat], _APART), SHINGLE)
        self.names = [name for name, _ in flat]
        self.sets = [np.unique(h[a:b]) for a, b in zip(first, first[1:])]
        self.a, self.b = _family(bands)
        self.classes: dict[int, list[int]] = {}
        for i, s in enumerate(self.sets):
            self.classes.setdefault(1 << int(np.ceil(np.log2(len(s)))), []).append(i)
        minima = np.array([[(s * a + b).min() for s in self.sets] for a, b in zip(self.a, self.b)], np.uint64)
        # by class and band the templates in the order of their minima: a band is looked up, whatever their number; and
        # which low bits these have, as nearly no window has them
        self.bands, self.low = {}, {}
        for n, ts in self.classes.items():
            orders = [np.argsort(m, kind="stable") for m in minima[:, ts]]
            self.bands[n] = [(m[o], np.array(ts)[o]) for m, o in zip(minima[:, ts], orders)]
            self.low[n] = np.zeros((bands, 1 << max(12, len(ts).bit_length() + 8)), bool)
            for k, m in enumerate(minima[:, ts]):
                self.low[n][k, (m & np.uint64(self.low[n].shape[1] - 1)).astype(np.int64)] = True

    def candidates(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first shingle, end, template) of the windows that share a band with a template. ``first``: where each
        text's shingles begin."""
        blocks, within = {}, {}
        sizes = sorted(self.classes)
        for n in sizes:
            starts = np.concatenate([np.arange(a, b, n) for a, b in zip(first, first[1:])] or [np.zeros(0, np.int64)])
            last = np.isin(starts, first, assume_unique=False)  # the first block of a text ends the window before it
            blocks[n] = (starts, np.append(last[1:], True))
        for smaller, n in zip(sizes, sizes[1:]):  # a block consists of those of the size before
            within[n] = np.searchsorted(blocks[smaller][0], blocks[n][0])
        hits: dict[int, list[np.ndarray]] = {n: [] for n in sizes}
        for k, (a, b) in enumerate(zip(self.a, self.b)):
            low = h * a + b
            for n in sizes:
                (minima, templates), (starts, ends_text) = self.bands[n][k], blocks[n]
                low = np.minimum.reduceat(low, within.get(n, starts))
                window = np.where(ends_text, low, np.minimum(low, np.append(low[1:], low[-1:])))
                may = self.low[n][k]
                met = np.flatnonzero(may[(window & np.uint64(len(may) - 1)).astype(np.int64)])
                at = np.searchsorted(minima, window[met])
                while True:  # templates may have one minimum in common
                    there = at < len(minima)
                    there[there] = minima[at[there]] == window[met[there]]
                    met, at = met[there], at[there]
                    if not len(met):
                        break
                    hits[n].append(met * len(self.sets) + templates[at])
                    at = at + 1
        for n in sizes:
            starts, ends_text = blocks[n]
            edge = np.append(starts, len(h))
            for i, t in zip(*np.divmod(np.unique(np.concatenate(hits[n])), len(self.sets))) if hits[n] else ():
                yield int(starts[i]), int(edge[i + 1] if ends_text[i] else edge[i + 2]), int(t)

    def matches(self, texts: list[bytes], least: float) -> list[list[tuple[str, int, int, float]]]:
        """Per text (license, first word, end word, containment), of overlapping finds the best: see above."""
        w = words(texts, _APART)
        h, first = shingles(w, SHINGLE)
        out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
        if not len(h):
            return out
        finds: dict[int, dict[tuple, np.ndarray]] = {}
        filled = first[np.flatnonzero(np.append(np.diff(first) > 0, True))]
        for lo, hi, t in self.candidates(h, filled):
            inside = np.isin(h[lo:hi], self.sets[t])
            matched = np.unique(h[lo:hi][inside])
            share = len(matched) / len(self.sets[t])
            if share >= least:
                d = int(np.searchsorted(first, lo, "right")) - 1
                at = np.flatnonzero(inside)
                finds.setdefault(d, {})[lo + int(at[0]) - int(first[d]), lo + int(at[-1]) - int(first[d]) + SHINGLE, share, t] = matched
        for d, found in finds.items():
            kept: list[tuple[int, int, float, int]] = []
            for m in sorted(found, key=lambda m: (-len(found[m]), -m[2], m[0], m[3])):
                over = [k for k in kept if k[0] < m[1] and m[0] < k[1]]
                if not any(self.names[k[3]] == self.names[m[3]] or (~np.isin(found[m], self.sets[k[3]])).sum() <= OWN * len(found[m]) for k in over):
                    kept.append(m)
            out[d] = sorted(((self.names[t], a, b, share) for a, b, share, t in kept), key=lambda m: (m[1], m[0]))
        return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None, least: float = LEAST) -> DataFrame:
    """A row per row of ``docs``: doc_id and ``found``, an array of (license, first_word, end_word, containment).

    Words are runs of ASCII letters, digits and other bytes over 127, lower-cased (A-Z), counted from 0; the end is
    exclusive. Templates of fewer than five words would match anything and are an error. Null, empty and short texts
    find nothing; repeated rows come back each; an empty table gives an empty result.
    """
    chosen = (TEMPLATES, whole_texts()) if templates is None else (templates,)
    for ts in (ts for table in chosen for ts in table.values()):
        if any(len(words([t.encode()], _APART).hashes) < SHINGLE for t in ts):
            raise ValueError(f"a template needs {SHINGLE} words or more")
    kind = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*chosen)
        for b in sliced(batches, "text", 1 << 20):
            found = [[dict(zip(("license", "first_word", "end_word", "containment"), m)) for m in ms] for ms in index.matches(utf8(b.column("text")), least)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)], names=["doc_id", "found"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, found array<struct<license:string,first_word:bigint,end_word:bigint,containment:double>>")
