import random
import re
from collections import Counter

from fixtures_llm import documents, edge_rows, prose

from intactly.llm import licences


def grams(text):
    w = re.findall("[a-z0-9]+", "".join(c.lower() if c.isascii() else c for c in text))
    return Counter(zip(w, w[1:], strict=False)), " ".join(w)


def brute(text):
    found = set()
    for unit in [*(text or "").split("\n"), *re.split("\n[ \t\r]*\n", text or ""), text or ""]:
        a, name = grams(unit)
        for licence, template in licences.TEMPLATES:
            b, _ = grams(template)
            total = sum(a.values()) + sum(b.values())
            if total and (d := 2 * sum((a & b).values()) / total) >= licences.THRESHOLD:
                found.add((round(d, 9), licence, name))
    return found


def test_against_brute_force(spark):
    rng = random.Random(11)
    rows = edge_rows(rng)
    for i in range(150):
        _, text = rng.choice(licences.TEMPLATES)
        w = text.split()
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(["the", "Licence", "and-or", ""])
        if rng.random() < .2:
            w *= 2
        note = rng.choice([" ", "  ", "\n"]).join(w)
        parts = [prose(rng, 20), note if rng.random() < .5 else note.upper(), prose(rng, 5)]
        rows.append((100 + i, rng.choice(["\n", "\n\n", "\n \t\n", " "]).join(parts[rng.choice([0, 1]):])))
    got = licences.licence_scan(documents(spark, rows)).collect()
    key = lambda i, m: (str(i), sorted(m))
    assert sorted(key(r.doc_id, {(round(m.dice, 9), m.licence, m.unit) for m in r.matches}) for r in got) \
        == sorted(key(i, brute(t)) for i, t in rows)
    assert any(r.matches for r in got)
    for r in got:
        assert [m.dice for m in r.matches] == sorted((m.dice for m in r.matches), reverse=True)
    assert licences.licence_scan(documents(spark, rows).limit(0)).count() == 0


def test_size_bounds_are_exact():
    for n in range(1, 60):
        low, high = licences.size_bounds(n, 0.8)
        reach = [a for a in range(1, 200) if 2 * min(a, n) / (a + n) >= 0.8]
        assert (low, high) == (reach[0], reach[-1])


def test_no_python_in_the_plan(spark):
    plan = licences.op10_licence_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange|Cartesian|NestedLoop", plan)


def test_full_texts_and_standard_notices(spark):
    text = {name: max((t for k, t in licences.TEMPLATES if k == name), key=len) for name, _ in licences.TEMPLATES}
    gpl = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation; either version {} of the License, or (at your option) any "
           "later version.")
    rows = [(1, text["BSD-2-Clause"]), (2, text["BSD-3-Clause"].replace("COPYRIGHT HOLDER", "AUTHOR")), (3, text["ISC"]),
            (4, gpl.format(2)), (5, gpl.format(3)), (6, text["LGPL-2.1"]), (7, text["CC-BY-SA-4.0"])]
    assert all("Redistribution and use" in t for _, t in rows[:2])
    got = {r.doc_id: r.matches for r in licences.licence_scan(documents(spark, rows)).collect()}
    assert [got[i][0].licence for i in range(1, 8)] == [
        "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "CC-BY-SA-4.0"]
