import random

import numpy as np
import pytest
from fixtures_llm import documents, edge_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from intactly.llm import jaccard
from intactly.llm.components import components


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x00", "\x00")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    return frozenset(tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset()


def brute(rows):
    found = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in found if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in found:
        for j, b in found:
            if i is not None and j is not None and i < j and a and b:
                both = len(a & b)
                if 100 * both >= 90 * (len(a) + len(b) - both):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return sorted(str((i, len(s), find(i) if i is not None and s else i)) for i, s in found)


@pytest.mark.parametrize("elements", [jaccard.BLOCK_ELEMENTS, 2500])
def test_against_brute_force(spark, elements):
    rng = random.Random(6)
    rows = [r for r in edge_rows(rng) if r[0] is not None]
    for n in (1, 2, 3, 8, 12, 21, 40, 120, 250):
        base = [rng.choice("abcdefghij") + str(rng.randint(0, 30)) for _ in range(n)]
        last = base
        for _ in range(25):
            w = list(rng.choice([base, last]))
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                k = rng.randrange(len(w)) if w else 0
                w[k:k + rng.choice([0, 1])] = rng.choice([[], ["z%d" % rng.randint(0, 99)]])
            last = w
            rows.append((100 + len(rows), rng.choice([" ", "\n", "\t "]).join(w)))
    rng.shuffle(rows)
    got = jaccard.jaccard_components(documents(spark, rows), elements).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows)


def test_one_of_each_and_empty_tables(spark):
    rows = [(3, "a b c d"), (1, "A b c d"), (2, "other words are here"), (5, None), (6, ""), (None, "a b c d")]
    df = documents(spark, rows)
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "6", "None"]
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    assert jaccard.one_of_each(df.limit(0)).count() == 0


def test_width_and_similarity_are_parameters(spark):
    words = [f"w{i}" for i in range(200)]
    copy = [*words[:90], *[f"z{i}" for i in range(15)], *words[105:]]  # 0.82 by five words, 0.84 by three
    rows = [(1, " ".join(words)), (2, " ".join(copy)), (3, " ".join(f"y{i}" for i in range(200)))]
    of = lambda df: {r.doc_id: r.component_id for r in df.collect()}
    docs = documents(spark, rows)
    assert of(jaccard.jaccard_components(docs)) == {1: 1, 2: 2, 3: 3}
    assert of(jaccard.jaccard_components(docs, words=5, share=80)) == {1: 1, 2: 1, 3: 3}
    assert sorted(r.doc_id for r in jaccard.one_of_each(docs, 5, 80).collect()) == [1, 3]


def test_linked_sets_share_a_signature_at_four_fifths():
    rng = np.random.default_rng(13)
    classes = jaccard.SizeClasses(80)
    for a in range(2, 60):
        for b in range(a, a * 5 // 4 + 1):
            common = jaccard.least_overlap(a, b, 80)
            for parts in (1, 2, 3, 5, 8):
                both = rng.integers(0, 2 ** 64 // parts, common, np.uint64)
                x, y = (np.unique(np.concatenate([both, rng.integers(0, 2 ** 64, n - common, np.uint64)]))
                        for n in (a, b))
                assert len(np.intersect1d(jaccard.signatures(x, classes), jaccard.signatures(y, classes))), (a, b)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_linked_sets_share_a_signature(data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10 ** 6)))
    n = data.draw(st.integers(1, 300))
    x = rng.integers(0, 2 ** 64, n, np.uint64)
    cut = data.draw(st.integers(0, max(1, n // 10)))
    y = np.unique(np.concatenate([x[cut:], rng.integers(0, 2 ** 64, data.draw(st.integers(0, max(1, n // 10))), np.uint64)]))
    x = np.unique(x)
    common = len(np.intersect1d(x, y))
    linked = 100 * common >= 90 * (len(x) + len(y) - common)
    assert linked == (common >= jaccard.least_overlap(len(x), len(y)))
    if linked and len(y):
        classes = jaccard.SizeClasses()
        assert len(np.intersect1d(jaccard.signatures(x, classes), jaccard.signatures(y, classes)))


def test_short_sets_share_a_signature_when_common_hashes_lie_in_one_range():
    rng = np.random.default_rng(12)
    classes = jaccard.SizeClasses()
    for a in range(9, 31):
        for b in range(a, a * 10 // 9 + 1):
            common = jaccard.least_overlap(a, b)
            for parts in (2, 3, 4, 5):
                width = 2 ** 64 // parts
                for k in range(parts):
                    for _ in range(10):
                        both = rng.integers(k * width, (k + 1) * width, common, np.uint64)
                        x, y = (np.unique(np.concatenate([both, rng.integers(0, 2 ** 64, n - common, np.uint64)]))
                                for n in (a, b))
                        shared = np.intersect1d(jaccard.signatures(x, classes), jaccard.signatures(y, classes))
                        assert len(shared), (a, b, parts, k)


@pytest.mark.parametrize("flat", [10 ** 9, 1])
def test_tree_finds_all_links(flat, monkeypatch):
    monkeypatch.setattr(jaccard, "FLAT_ELEMENTS", flat)
    rng = np.random.default_rng(3)
    base = np.arange(60)
    sets = list({tuple(np.sort(rng.choice(base, 60 - rng.integers(0, 9), replace=False))) for _ in range(150)})
    sets = [np.array(s) for s in sets]
    tree = jaccard.PrefixTree(sets, 60)
    for i, s in enumerate(sets):
        tree.probe(s, int(tree.place[i]))
    parent = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if len(np.intersect1d(a, b)) >= jaccard.least_overlap(len(a), len(b)):
                x, y = parent[i], parent[j]
                parent = [min(x, y) if p in (x, y) else p for p in parent]
    got = tree.labels[tree.place]
    assert len({(a, b) for a, b in zip(got.tolist(), parent, strict=True)}) == len(set(parent)) == len(set(got.tolist()))


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (101, 100)]
    got = {r.node: r.label for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_other_texts_under_a_repeated_id_stay(spark):
    rng = random.Random(21)
    x, other, third = prose(rng, 60), prose(rng, 60), prose(rng, 60)
    near = " ".join(x.split()[:-1])
    rows = [(1, x), (2, x), (2, other), (2, other), (3, near), (3, third), (4, third), (None, x), (5, None), (5, "")]
    kept = jaccard.one_of_each(documents(spark, rows), words=3, share=90)
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(str, [
        (1, x), (2, other), (2, other), (3, third), (None, x), (5, None), (5, "")]))
    assert kept.columns == documents(spark, rows).columns


def test_links_between_sets_outside_the_main_component_of_a_large_block(spark):
    # One block by shared ranges: a main component, and pairs linked only with each other, which lie in different parts.
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join([*base[:399], f"m{i}"])))
    for i in range(30):
        cut = [*base[:300], *[f"p{i}x{k}" for k in range(100)]]  # about 0.6 with the base
        rows += [(1000 + 2 * i + k, " ".join([*cut[:399], f"q{i}x{k}"])) for k in (0, 1)]
    rng.shuffle(rows)
    docs = documents(spark, rows)
    every = jaccard.staged(jaccard.sets(docs), "sets")
    assert len({r.label for r in jaccard.candidates(every).collect()}) == 1
    got = jaccard.jaccard_components(docs, 8000).collect()  # six parts; one group would hold fewer
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows)


def test_a_set_of_one_shingle_at_a_half(spark):
    docs = documents(spark, [(1, "a b c"), (2, "a b c d"), (3, "x y z")])
    of = lambda share: {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, share=share).collect()}
    assert of(50) == {1: 1, 2: 1, 3: 3}
    assert of(51) == {1: 1, 2: 2, 3: 3}
