"""Licence scans against a plain longest-common-subsequence bound and planted notices."""

import random

import pytest
from documents import prose, table

from permitry.llm import licences


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_patience_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(150):
        a = [rng.randrange(40) for _ in range(rng.randrange(50))]
        b = [x for x in a if rng.random() < 0.8]
        for _ in range(rng.randrange(4)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(40))
        pairs = licences.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) <= common(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert licences.patience(a, a) == [(i, i) for i in range(len(a))]
    whole = list(range(60))
    assert len(licences.patience(whole[:20] + [99, 98] + whole[25:], whole)) == 55


@pytest.mark.parametrize("name", sorted(licences.TEMPLATES))
def test_planted_notices(spark, name):
    rng = random.Random(name)
    own = licences.TEMPLATES[name].split()
    changed = [w for i, w in enumerate(own) if len(own) < 20 or i % 11]
    texts = [prose(rng, 50) + "\n" + " ".join(own) + " " + prose(rng, 30), prose(rng, 10) + " " + " ".join(changed).upper(),
             " ".join(own) + " " + prose(rng, 40) + " " + " ".join(own), prose(rng, 300), " ".join(own[:len(own) // 2]), None, ""]
    found = {r["doc_id"]: r for r in licences.scan(table(spark, texts)).collect()}
    assert found[0]["licence"] == name and found[0]["coverage"] == 1 and found[0]["start_word"] == 50
    assert found[1]["licence"] == name and found[1]["coverage"] >= 0.8 and found[1]["start_word"] >= 10
    assert sum(m["licence"] == name for m in found[2]["matches"]) == 2 and found[2]["n_found"] == len(found[2]["matches"])
    assert all(found[i]["licence"] is None and found[i]["n_found"] == 0 for i in (3, 5, 6))
    assert found[4]["licence"] != name


GPL_2 = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
    License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
    version."""
NEIGHBOURS = {
    "Distributed under the MIT License.": "MIT", "Licensed under the terms of the Apache License, Version 2.0": "Apache-2.0",
    "Released under the BSD License.": "BSD", "released under the same license": None, "Released under the MIT-0 License": None,
    "Licensed under CC BY 4.0": "CC-BY-4.0 name", "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0 name",
    "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0", "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0 name",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "CC-BY-4.0",
    "This work is licensed under the GNU General Public License, version 2": "GPL-2.0",
    "This work is licensed under the GNU Lesser General Public License, version 3": "LGPL-3.0",
    "Licensed under the Academic License, Version 2.0.": None, GPL_2: "GPL-2.0 notice",
    GPL_2.replace("version 2 of", "version 3 of"): "GPL-3.0 notice", GPL_2.replace("version 2 of", "version 4 of"): None,
    GPL_2.replace("General", "Lesser General").replace("version 2 of", "version 2.1 of").replace("program", "library"):
        "LGPL-2.1 notice",
    GPL_2.replace("General", "Affero General").replace("version 2 of", "version 3 of"): "AGPL-3.0 notice",
    licences.TEMPLATES["Apache-2.0 notice"].replace("Apache License", "Educational Community License"): None,
    licences.TEMPLATES["BSD-2-Clause"] + " THIS SOFTWARE IS PROVIDED": "BSD-2-Clause",
    licences.TEMPLATES["BSD-3-Clause"].replace("the copyright holder nor", "the Acme Works nor"): "BSD-3-Clause",
    licences.TEMPLATES["BSD-4-Clause"].replace("developed by the copyright holder", "developed by Acme"): "BSD-4-Clause",
}


def test_neighbours_are_told_apart(spark):
    texts = list(NEIGHBOURS)
    rng = random.Random(6)
    docs = table(spark, [f"{prose(rng, 20)}\n{t}\n{prose(rng, 20)}" for t in texts])
    found = {texts[r["doc_id"]]: r["licence"] for r in licences.scan(docs).collect()}
    assert found == NEIGHBOURS


def every_window(text, template, marks, cover):
    """Align every window that begins with a word of the template, in order."""
    found, start, size = [], 0, len(template) + len(template) // 4 + 1
    while start < len(text):
        window = text[start:start + size]
        pairs = licences.patience(window, template) if text[start] in template else []
        if 100 * len(pairs) < cover * len(template) or not pairs or not all(f" {m} " in f" {' '.join(window)} " for m in marks):
            start += 1
        elif pairs[0][0]:
            start += pairs[0][0]
        elif all(f" {m} " in f" {' '.join(window[:pairs[-1][0] + 1])} " for m in marks):
            found.append((len(pairs) / len(template), start, start + pairs[-1][0] + 1))
            start += pairs[-1][0] + 1
        else:
            start += 1
    return found


def test_scan_against_every_window(spark):
    """Templates of 4 to 60 words of a small vocabulary, planted with words changed, left out and put in."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(25)]
    templates = {f"t{n}": " ".join(rng.choice(vocabulary) for _ in range(n)) for n in (4, 7, 19, 20, 60)}
    marks = {"t7": [" ".join(templates["t7"].split()[2:4])], "t60": [templates["t60"].split()[30]]}
    texts = []
    for _ in range(60):
        text = []
        for _ in range(6):
            text += [rng.choice(vocabulary) for _ in range(rng.randrange(12))]
            for word in rng.choice(list(templates.values())).split():
                chance = rng.random()
                text += [] if chance < 0.06 else [word, rng.choice(vocabulary)] if chance < 0.12 else [word]
        texts.append(" ".join(text))
    found = {r["doc_id"]: r["matches"] for r in licences.scan(table(spark, texts), templates, marks=marks).collect()}
    for i, text in enumerate(texts):
        expected = sorted((name, *m) for name, own in templates.items()
                          for m in every_window(text.split(), own.split(), marks.get(name, ()), licences.COVER))
        assert sorted(tuple(m) for m in found[i]) == expected
    assert sum(map(len, found.values())) > 100


def test_coverage_of_a_long_licence(spark):
    """A text of the length of a whole licence: all of it, halves of it, and with one word in twenty changed."""
    rng = random.Random(3)
    own = [rng.choice(["the", "of", "a", "you", "work"]) if rng.random() < 0.5 else f"w{rng.randrange(900)}" for _ in range(3000)]
    changed = [f"x{i}" if i % 20 == 7 else w for i, w in enumerate(own)]
    texts = [" ".join([prose(rng, 40), *part, prose(rng, 40)]) for part in (own, own[:1500], own[1500:], changed, [])]
    rows = licences.scan(table(spark, texts), {"long": " ".join(own)}, cover=40).orderBy("doc_id").collect()
    assert rows[0]["coverage"] == 1 and rows[4]["licence"] is None
    assert all(0.48 < rows[i]["coverage"] < 0.53 for i in (1, 2)) and 0.93 < rows[3]["coverage"] < 0.96


def test_own_templates_with_marks(spark):
    own = "one two three four five six seven eight nine ten " * 2 + "version 7 of it"
    docs = table(spark, [own, own.replace("7", "8")])
    assert [r["n_found"] for r in licences.scan(docs, {"own": own}).orderBy("doc_id").collect()] == [1, 1]
    found = licences.scan(docs, {"own": own}, marks={"own": ["version 7"]}).orderBy("doc_id").collect()
    assert [r["n_found"] for r in found] == [1, 0]


def test_repeated_rows_clashing_columns_and_empty(spark):
    text = "Released under the MIT License."
    docs = table(spark, [text, text, "x"], ids=[1, 1, None]).selectExpr("*", "lang AS licence", "1 AS matches")
    assert sorted((str(r["doc_id"]), r["licence"]) for r in licences.scan(docs).collect()) == [("1", "MIT"), ("1", "MIT"), ("None", None)]
    assert licences.scan(table(spark, [])).count() == 0
