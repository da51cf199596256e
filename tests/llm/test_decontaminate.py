import random
import re
from collections import defaultdict

import pytest
from fixtures_llm import documents, edge_rows, prose

from intactly.llm import decontaminate

ITEMS = "item_id long, text string, pattern string, item string"


def brute(docs, items, width=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if c.isascii() else c for c in t or ""))
    runs = {(tuple(p[k:k + width]), str(item)) for item, text in items if item is not None and (p := words(text))
            for k in range(max(1, len(p) - width + 1))}
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        places = defaultdict(list)
        for n in {len(run) for run, _ in runs}:
            for a in range(len(w) - n + 1):
                places[tuple(w[a:a + n])].append(a)
        for run, item in runs:
            for a in places.get(run, ()):
                hit.update(range(a, a + len(run)))
                found.add(item)
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(map(str, out))


@pytest.mark.parametrize("block", [200_000, 20])
def test_against_brute_force(spark, block):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice([1, 2, 5, 10, 11, 25]))) for i in range(20)]
    items += [(20, items[5][1]), (20, items[5][1]), (21, None), (22, "..."), (None, items[3][1]), (23, "ÉTÉ Été été")]
    rows = edge_rows(rng)[:5] + [(8, "Été; ÉTÉ été!")]
    for i in range(60):
        w = prose(rng, rng.randint(5, 80)).split()
        text = items[rng.randrange(20)][1].upper().split()
        at = rng.randrange(len(w))
        w[at:at] = text[rng.choice([0, 0, 1]):] * rng.choice([1, 2])
        rows.append((100 + i, rng.choice([" ", ", ", "\n"]).join(w)))
    bench = spark.createDataFrame([(*x, "p", "i") for x in items], ITEMS)
    df = documents(spark, rows)
    got = decontaminate.contamination(df, bench, block_patterns=block).collect()
    assert sorted(str((r.doc_id, r.n_words, sum(s.after - s.first for s in r.spans), list(r["items"]))) for r in got) \
        == brute(rows, items)
    kept = decontaminate.uncontaminated(df, bench, block_patterns=block)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.spans)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    df = documents(spark, [(1, "a b c")])
    assert [(r.n_words, r.spans) for r in decontaminate.contamination(df, none).collect()] == [(3, [])]
    assert decontaminate.contamination(df.limit(0), none).count() == 0
    assert decontaminate.uncontaminated(df, none).count() == 1
