"""Licence scans: patience alignment of texts with licence templates.

Words are lower-cased and separated by white space and punctuation. Where at least ``COVER`` hundredths of a
template's words lie in a window a quarter longer than the template, window and template are aligned, whatever the
length of the template: equal ends are matched, words that are unique in both are anchors, the longest increasing run of
anchors is kept, and the gaps between anchors are aligned in the same way. Coverage is the share of template words
matched; a match needs ``COVER`` hundredths and begins with a matched word. Where a window holds enough but begins with
other words the scan goes on at its first matched word. Matches of one template do not overlap; the scan goes on behind
a match.

What tells licences apart is never left to coverage: a match must hold the ``MARKS`` of its template, runs of words
with the licence's name and version.

The templates are parameters of bounded size and go to every task. Texts are read once, whole, and nothing is shuffled.

Defined cases: NULL and empty texts have no match; a match that lies mostly in one of a longer template yields to it,
other ties between templates go to the larger coverage, then the longer template, then the name; repeated rows get equal results; NULL ids are returned as they are; an empty table gives an
empty result. Columns other than id and text are not looked at.
"""

from bisect import bisect_left
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm import words
from permitry.llm.slices import slices

COVER = 80
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
    that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
    this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
    copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
    materials provided with the distribution."""
_ADVERTISING = """All advertising materials mentioning features or use of this software must display the following
    acknowledgement: This product includes software developed by the copyright holder."""
_ENDORSE = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
_GNU = """This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by
    the Free Software Foundation, either version {} of the License, or (at your option) any later version."""
_GNU_LICENCES = {
    "GPL-2.0": ("program", "General Public License", "2"), "GPL-3.0": ("program", "General Public License", "3"),
    "LGPL-2.1": ("library", "Lesser General Public License", "2.1"),
    "LGPL-3.0": ("program", "Lesser General Public License", "3"),
    "AGPL-3.0": ("program", "Affero General Public License", "3"),
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: Public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "BSD": "Released under the BSD License.",
    "BSD-2-Clause": _BSD,
    "BSD-3-Clause": f"{_BSD} 3. {_ENDORSE}",
    "BSD-4-Clause": f"{_BSD} 3. {_ADVERTISING} 4. {_ENDORSE}",
    **{f"CC-{k}-4.0": f"This work is licensed under a Creative Commons {v} 4.0 International License." for k, v in _CC.items()},
    **{f"CC-{k}-4.0 name": f"Licensed under CC {k} 4.0." for k in _CC},
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0 name": f"This work is licensed under a Creative Commons {_CC['BY-NC']} 4.0 International License.",
    **{f"CC-{k}-3.0": f"This work is licensed under a Creative Commons {v} 3.0 Unported License." for k, v in _CC.items()
       if not k.endswith("ND")},
    "CC-BY-ND-3.0": "This work is licensed under a Creative Commons Attribution-NoDerivs 3.0 Unported License.",
    "CC-BY-NC-ND-3.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License.",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License
        2.0 which is available at""",
    **{k: f"This work is licensed under the GNU {v[1]}, version {v[2]}." for k, v in _GNU_LICENCES.items()},
    **{f"{k} notice": _GNU.format(*v) for k, v in _GNU_LICENCES.items()},
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MIT": "Released under the MIT License.",
    "MIT text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Runs of words that a match of a template must hold.
MARKS = {
    "Apache-2.0": ("Apache License Version 2.0",), "Apache-2.0 notice": ("Apache License Version 2.0",), "BSD": ("BSD License",),
    "BSD-3-Clause": ("promote products derived",), "BSD-4-Clause": ("All advertising materials", "promote products derived"),
    **{f"CC-{k}-4.0": (f"Creative Commons {v} 4.0 International",) for k, v in _CC.items()},
    **{f"CC-{k}-4.0 name": (f"CC {k} 4.0",) for k in _CC},
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",), "CC-BY-NC-4.0 name": (f"Creative Commons {_CC['BY-NC']} 4.0 International",),
    **{f"CC-{k}-3.0": (f"Creative Commons {v} 3.0 Unported",) for k, v in _CC.items()},
    "CC-BY-ND-3.0": ("Creative Commons Attribution-NoDerivs 3.0 Unported",),
    "CC-BY-NC-ND-3.0": ("Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported",),
    "EPL-2.0": ("Eclipse Public License 2.0",), "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License Version 2.0",), "MPL-2.0 notice": ("Public License v. 2.0", "MPL"),
    **{k: (f"GNU {v[1]} version {v[2]}",) for k, v in _GNU_LICENCES.items()},
    **{f"{k} notice": (f"GNU {v[1]}", f"version {v[2]} of") for k, v in _GNU_LICENCES.items()},
    "Unlicense": ("free and unencumbered software",),
}
_SPACE = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def tokens(text):
    """Words of a text (bytes) without case and punctuation."""
    return text.lower().translate(_SPACE).split()


def _unique_places(items, first, last):
    places, twice = {}, set()
    for i in range(first, last):
        if items[i] in places:
            twice.add(items[i])
        places[items[i]] = i
    return {item: i for item, i in places.items() if item not in twice}


def _increasing(pairs):
    """Longest run of pairs, ascending in the first place, that also ascends in the second."""
    ends, tails, back = [], [], [None] * len(pairs)
    for k, (_, second) in enumerate(pairs):
        at = bisect_left(ends, second)
        if at == len(ends):
            ends.append(second)
            tails.append(k)
        else:
            ends[at], tails[at] = second, k
        back[k] = tails[at - 1] if at else None
    chain, k = [], tails[-1] if tails else None
    while k is not None:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def patience(text, template):
    """Matched places (in text, in template), ascending in both."""
    matched, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and text[a] == template[b]:
            matched.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            matched.append((a_end, b_end))
        in_text, in_template = _unique_places(text, a, a_end), _unique_places(template, b, b_end)
        anchors = _increasing(sorted((i, in_template[w]) for w, i in in_text.items() if w in in_template))
        if anchors:
            matched += anchors
            for (i, j), (k, m) in zip([(a - 1, b - 1), *anchors], [*anchors, (a_end, b_end)]):
                if k - i > 1 and m - j > 1:
                    todo.append((i + 1, k, j + 1, m))
    return sorted(matched)


def _holds(text, run):
    return any(text[i:i + len(run)] == run for i, word in enumerate(text) if word == run[0])


class _Template:
    def __init__(self, name, own, cover, marks=()):
        self.name, self.words, self.marks = name, own, marks
        self.need = -(-cover * len(own) // 100)
        self.window = len(own) + len(own) // 4 + 1

    def _marked(self, window):
        return all(_holds(window, run) for run in self.marks)

    def scan(self, numbers, hits):
        """Matches (coverage, start, end) in one text from the places of template words, ascending."""
        found, after = [], -1
        if len(hits) < self.need:
            return found
        last = len(hits) - self.need + 1
        for start in hits[:last][hits[self.need - 1:] - hits[:last] < self.window].tolist():
            if start <= after:
                continue
            window = numbers[start:start + self.window].tolist()
            pairs = patience(window, self.words) if self._marked(window) else []
            if len(pairs) < self.need:
                continue
            if pairs[0][0]:
                after = start + pairs[0][0] - 1
            elif self._marked(window[:pairs[-1][0] + 1]):
                after = start + pairs[-1][0]
                found.append((len(pairs) / len(self.words), start, after + 1))
        return found


def _yields(match, found):
    """Whether a match lies mostly in one of a longer template."""
    _, size, _, start, end = match
    return any(other > size and 2 * (min(end, e) - max(start, s)) > end - start for _, other, _, s, e in found)


def _scan(batches, templates, marks, cover, schema):
    numbers = words.Numbers()
    known = []
    for name, text in templates.items():
        own, *runs = (words.numbered(tokens(t.encode()), numbers).tolist() for t in (text, *marks.get(name, ())))
        known.append(_Template(name, own, cover, runs))
    vocabulary = np.array(sorted({w for t in known for w in t.words}), np.uint64)
    has = np.array([np.isin(vocabulary, np.array(t.words, np.uint64)) for t in known])
    screen = np.zeros(1 << 16, bool)
    screen[vocabulary >> np.uint64(48)] = True
    for whole in batches:
        for batch in slices(whole, 1):
            rows = []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                own = words.numbered(tokens(text or b""), numbers)
                places = np.flatnonzero(screen[own >> np.uint64(48)])
                at = np.minimum(np.searchsorted(vocabulary, own[places]), len(vocabulary) - 1)
                there = vocabulary[at] == own[places]
                places, at = places[there], at[there]
                found = []
                for i, template in enumerate(known):
                    if len(places) >= template.need:
                        found += [(c, len(template.words), template.name, s, e) for c, s, e in template.scan(own, places[has[i, at]])]
                found.sort(key=lambda m: (-m[0], -m[1], m[2], m[3]))
                best = next((m for m in found if not _yields(m, found)), (None,) * 5)
                rows.append((best[2], best[0], best[3], best[4], len(found), [
                    {"licence": m[2], "coverage": m[0], "start_word": m[3], "end_word": m[4]} for m in found]))
            columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), list(schema)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)


def scan(docs, templates=None, id_column="doc_id", text_column="text", cover=COVER, marks=None):
    """One row per document: id, the best licence with coverage, start_word and end_word, n_found, and all matches.

    ``marks`` are the runs of words that matches of own ``templates`` must hold.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    one = [("licence", T.StringType()), ("coverage", T.DoubleType()), ("start_word", T.LongType()), ("end_word", T.LongType())]
    match = T.StructType([T.StructField(*f) for f in one])
    types = T.StructType([docs.schema[id_column], *match, T.StructField("n_found", T.LongType()),
                          T.StructField("matches", T.ArrayType(match))])
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    run = partial(_scan, templates=templates or TEMPLATES, marks=(marks or {}) if templates else MARKS, cover=cover, schema=to_arrow_schema(types))
    return rows.mapInArrow(run, types)
