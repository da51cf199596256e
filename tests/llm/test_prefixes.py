import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from fixtures_llm import prose

from intactly.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, depth string, conv string, w1 string, first string"


def brute(rows, family=5, shared=9):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in talks.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % shared
        seq = tuple(talks.get(c - int(math.fmod(c, family)), [])[:h] + own[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        """Leaves and saved bytes of a subtree."""
        found = [below(child) for child in children[node]]
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        return sum(n for n, _ in found) or 1, own + sum(s for _, s in found)

    out = []
    for node, convs in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    *below(node), digest))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    return sorted(map(tuple, prefixes.trie(df).collect()), key=str)


def sample(rng):
    rows = []
    openings = [[("user", prose(rng, 3)), ("bot", "é 🎉"), ("user", "")] for _ in range(3)]
    for c in range(60):
        start = rng.choice(openings)[:rng.randint(0, 3)]
        talk = start + [(rng.choice(["user", "bot", None]), rng.choice(["a", "b", None, prose(rng, 2)]))
                        for _ in range(rng.choice([0, 1, 2, 10]))]
        rows += [(c, rng.choice([None, i, i, i // 2]), *x) for i, x in enumerate(talk)]
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(3)]  # one large group of copies
    rows += [(200, 0, "user", "twice")] * 2 + [(None, 0, "user", "no id"), (201, 0, "bot", "x" * 50_000)]
    rows += [(-7, 0, "user", "a"), (-5, 0, "user", "b")]
    return rows


@pytest.mark.parametrize("run_of", [4096, 2])
def test_against_brute_force(spark, monkeypatch, run_of):
    monkeypatch.setattr(prefixes, "RUN", run_of)
    monkeypatch.setattr(prefixes, "LIST_IDS", 7)
    rows = sample(random.Random(11))
    assert run(spark, rows) == brute(rows)


def test_empty_and_turnless(spark):
    assert run(spark, []) == []
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)  # its base does not exist
    nothing = hashlib.sha256(str(lone).encode()).hexdigest()
    assert run(spark, [(lone, 0, "user", "gone")]) == [(lone, 0, None, 1, 0, 1, 0, nothing)]
