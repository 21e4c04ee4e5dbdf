"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Texts and templates are lower-cased, punctuation is white space, and shingles are five words. A template
with ``s`` distinct shingles is found in a text if some run of ``ceil(1.25 s)`` consecutive shingles of the
text contains at least 80 % of them.

Windows of ``W`` shingles, ``W`` the least power of two with ``W / 2 >= ceil(1.25 s)``, start at every multiple of
``W / 2``, so one of them contains that run whole. Its Jaccard similarity with the template is then at
least ``0.8 s / (W + 0.2 s) > 0.15``, and with ``BANDS`` bands of one minimum each the chance that no band
agrees is below ``0.85 ** 96 = 2e-7`` (the wider the window, the nearer; most are far below). Windows run
over the joined shingles of a slice of texts: what a window holds of a neighbour only adds candidates,
since verification looks at one text at a time.

Cases: null, empty and short texts have no match; a text with several licenses gives a row for each; repeated rows
give repeated results; an empty table gives no rows; columns beside those named are ignored.

The registered query reports of templates that match the same words the one with most of them (``specific``): BSD-3-Clause and not the
BSD-2-Clause that it contains, version 2 and not the nearly equal sentence of version 3. The others are looked for again in the rest of the text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aerostat.llm.common import sliced, table
from aerostat.llm.shingles import MinHash, shingles, words

SHINGLE, CONTAINED, BANDS, SLACK = 5, 0.8, 96, 1.25

# Public licence notices, as they are printed in works
TEMPLATES = {
    "MIT (short)": "Released under the MIT License.",
    "Apache-2.0 (short)": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 (short)": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 (short)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}
TEMPLATES |= {
    "BSD-3-Clause": TEMPLATES["BSD-2-Clause"] + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "LGPL-3.0-or-later": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0 (body)": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    "MPL-2.0 (body)": "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    **{f"EPL-{v} (body)": f"Eclipse Public License - v {v} THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT." for v in ("1.0", "2.0")},
    **{f"{i} (body)": f"{name} Version {v}, {date} {owner} Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
       for i, name, v, date, owner in (
           ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE", "2", "June 1991", "Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
           ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE", "3", "29 June 2007", "Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>"),
           ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE", "2.1", "February 1999", "Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
           ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE", "3", "29 June 2007", "Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>"),
           ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE", "3", "19 November 2007", "Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>"))},
}

# names of licences as sentences give them; every one gets every form of _FORMS that has five words
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NAMES = {
    "MIT": ["the MIT License"], "ISC": ["the ISC License"], "Zlib": ["the zlib License"], "Unlicense": ["the Unlicense License"],
    "BSD": ["the BSD License"], "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License"], "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License"],
    **{f"{short}-{v}": [f"the GNU {long}General Public License, version {v.removesuffix('.0')}", f"the GNU {long}General Public License v{v}", f"the {short} version {v.removesuffix('.0')}", f"the {short}-{v} License"]
       for short, long, versions in (("GPL", "", ("1.0", "2.0", "3.0")), ("LGPL", "Lesser ", ("2.1", "3.0")), ("AGPL", "Affero ", ("3.0",))) for v in versions},
    **{i: [f"the {name} License, version {i.rsplit('-', 1)[1]}", f"the {name} License {i.rsplit('-', 1)[1]}"] for i, name in (
        ("MPL-2.0", "Mozilla Public"), ("EPL-1.0", "Eclipse Public"), ("EPL-2.0", "Eclipse Public"), ("BSL-1.0", "Boost Software"), ("Artistic-2.0", "Artistic"), ("OFL-1.1", "SIL Open Font"))},
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    **{f"CC-{kind}-{v}": [f"CC {kind} {v}", f"a Creative Commons {name} {v} {'International' if v == '4.0' else 'Unported'} License"] for v in ("4.0", "3.0") for kind, name in _CC.items()},
}
_FORMS = ("Released under {}", "Licensed under {}", "Distributed under {}", "Published under {}", "Available under {}", "This work is licensed under {}")


def _short_forms() -> dict[str, str]:
    """A template for every name in every form, and for every identifier as SPDX tag, as far as it has the five words of a shingle."""
    have, out = {" ".join(plain(t).lower().split()) for t in TEMPLATES.values()}, {}
    for i, names in NAMES.items():
        made = [(f"{i} ({form.split()[0].lower()}{k or ''})", form.format(name)) for k, name in enumerate(names) for form in _FORMS]
        for key, text in (*made, (f"{i} (SPDX)", f"SPDX-License-Identifier: {i}")):
            words_ = plain(text).lower().split()
            if len(words_) >= SHINGLE and " ".join(words_) not in have:
                have.add(" ".join(words_))
                out[key] = text
    return out


_PLAIN = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalnum()})


def plain(text: str | None) -> str | None:
    """The text with ASCII punctuation as spaces (length kept)."""
    return text.translate(_PLAIN) if text else text


TEMPLATES |= _short_forms()
TEMPLATES |= {f"CC-{kind}-4.0 (body)": "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this "
              f"Creative Commons {name} 4.0 International Public License (\"Public License\")." for kind, name in _CC.items()}


class Scanner:
    """Templates prepared for retrieval and verification."""

    def __init__(self, templates: dict[str, str], k: int = SHINGLE, contained: float = CONTAINED, bands: int = BANDS):
        self.k, self.contained, self.hasher = k, contained, MinHash(bands, 41)
        values, at = shingles(*words([plain(t) for t in templates.values()]), k)
        self.names = list(templates)
        self.sets = [np.unique(values[a:z]) for a, z in zip(at[:-1], at[1:])]
        if any(not len(s) for s in self.sets):
            raise ValueError("a template has no words")
        self.run = [math.ceil(SLACK * len(s)) for s in self.sets]
        self.half = [1 << (r - 1).bit_length() for r in self.run]  # half a window: a power of two, at least the run
        self.minima = [self.hasher.signature(s) for s in self.sets]
        self.lookup: dict[tuple[int, int], tuple[np.ndarray, dict[int, list[int]]]] = {}  # band, half: last bits of minima; templates by minimum
        for band in range(bands):
            for half in set(self.half):
                by: dict[int, list[int]] = {}
                for t in (i for i, h in enumerate(self.half) if h == half):
                    by.setdefault(int(self.minima[t][band]), []).append(t)
                bits = np.zeros(1 << 16, bool)
                bits[[m & 0xFFFF for m in by]] = True
                self.lookup[band, half] = bits, by

    def candidates(self, values: np.ndarray) -> dict[int, np.ndarray]:
        """Per template the starts of the windows that agree with it in some band."""
        found: dict[int, list[np.ndarray]] = {}
        for band in range(len(self.hasher.a)):
            low = (values ^ self.hasher.b[band]) * self.hasher.a[band]
            width = 1
            for half in sorted(set(self.half)):
                while width < half:  # minima of blocks of twice the width
                    if len(low) % 2:
                        low = np.append(low, np.iinfo(np.uint64).max)
                    low = np.minimum(low[::2], low[1::2])
                    width *= 2
                window = np.minimum(low, np.append(low[1:], np.iinfo(np.uint64).max))
                bits, by = self.lookup[band, half]
                at = np.flatnonzero(bits[window & np.uint64(0xFFFF)])
                some = window[at]
                for value in np.unique(some).tolist():
                    for t in by.get(value, ()):
                        found.setdefault(t, []).append(at[some == value] * half)
        return {t: np.unique(np.concatenate(h)) for t, h in found.items()}

    def contained_in(self, values: np.ndarray, t: int, free: np.ndarray | None = None) -> tuple[float, int, int]:
        """Greatest share of the template's shingles in a run of the text (of those that are ``free``), with its first and last hit."""
        own = self.sets[t]
        at = np.minimum(np.searchsorted(own, values), len(own) - 1)
        hits = np.flatnonzero(own[at] == values if free is None else (own[at] == values) & free)
        best, span = 0, (0, -1)
        seen: dict[int, int] = {}
        first = 0
        for i, p in enumerate(hits.tolist()):  # a run that ends at hit i
            seen[at[p]] = seen.get(at[p], 0) + 1
            while hits[first] <= p - self.run[t]:
                gone = at[hits[first]]
                seen[gone] -= 1
                if not seen[gone]:
                    del seen[gone]
                first += 1
            if len(seen) > best:
                best, span = len(seen), (int(hits[first]), p)
        return best / len(own), *span

    def specific(self, values: np.ndarray, found: dict[int, tuple[float, int, int]]) -> dict[int, tuple[float, int, int]]:
        """Of a text's matches the ones with most shingles; what shares words with them is looked for in the rest of the text."""
        left, out = dict(found), {}
        free = np.ones(len(values), bool)
        while left:
            t = max(left, key=lambda i: (round(left[i][0] * len(self.sets[i])), left[i][0], self.names[i]))
            _, first, last = out[t] = left.pop(t)
            free[max(0, first - self.k + 1):last + self.k] = False  # shingles that share a word with the match
            for i in [i for i, (_, a, z) in left.items() if not free[a:z + 1].all()]:
                left[i] = self.contained_in(values, i, free)
                if left[i][0] < self.contained - 1e-12:
                    del left[i]
        return out

    def scan(self, texts: list[str | None], specific: bool = False) -> list[tuple[int, str, float, int, int]]:
        """(text's index, template, containment, first word, last word) of every match, or of the most specific ones."""
        values, at = shingles(*words([plain(t) for t in texts]), self.k)
        found: dict[int, dict[int, tuple[float, int, int]]] = {}
        for t, starts in self.candidates(values).items():
            width = 2 * self.half[t]
            docs = np.unique(np.concatenate([np.arange(a, z + 1) for a, z in zip(
                np.searchsorted(at, starts, "right") - 1, np.searchsorted(at, np.minimum(starts + width, len(values)) - 1, "right") - 1)]))
            for doc in docs[docs < len(texts)].tolist():
                match = self.contained_in(values[at[doc]:at[doc + 1]], t)
                if match[0] >= self.contained - 1e-12:
                    found.setdefault(doc, {})[t] = match
        if specific:
            found = {doc: self.specific(values[at[doc]:at[doc + 1]], m) if len(m) > 1 else m for doc, m in found.items()}
        out = [(doc, self.names[t], share, first, last + self.k - 1) for doc, m in found.items() for t, (share, first, last) in m.items()]
        return sorted(out)


def scan_licenses(df: DataFrame, id_col: str, text_col: str, templates: dict[str, str] | None = None, specific: bool = False) -> DataFrame:
    """``id, license, containment, first_word, last_word`` (of the best run) for every text and template found in it, or only
    for the most specific templates where several match the same words."""
    spec = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind, used = spec.schema["id"].dataType.simpleString(), dict(templates or TEMPLATES)

    def run(batches):
        scanner = Scanner(used)
        for b in sliced(batches, "text"):
            rows = scanner.scan(b.column("text").to_pylist(), specific)
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], ["id", "license", "containment", "first_word", "last_word"])

    return spec.mapInArrow(run, f"id {kind}, license string, containment double, first_word long, last_word long")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), "doc_id", "text", specific=True).withColumnRenamed("id", "doc_id")
