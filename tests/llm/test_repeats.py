import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from fixtures_llm import documents, edge_rows, prose

from intactly.llm import repeats


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def run(spark, rows, length, **limits):
    df = repeats.without_repeats(documents(spark, rows), length, **limits)
    got = df.collect()
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got)


def sample(rng):
    rows = edge_rows(rng)[:5] + [(7, "x" * 3000), (8, "ab" * 500 + "é 中 🎉" * 40), (9, "x" * 39 + "y")]
    passage = prose(rng, 40)
    rows += [(20 + i, prose(rng, rng.randint(0, 40)) + passage[rng.randint(0, 30):] + prose(rng, rng.randint(0, 40)))
             for i in range(25)]  # one passage in many contexts
    line = prose(rng, 8)
    rows += [(60 + i, "\n".join([prose(rng, 6), line, prose(rng, 6), line])) for i in range(25)]
    rows += [(100 + i, passage) for i in range(10)] + [(120, passage), (120, passage), (None, passage[5:])]
    for i in range(15):  # near copies
        w = passage.split()
        w[rng.randrange(len(w))] = "other"
        rows.append((200 + i, " ".join(w)))
    return rows


# Few distinct pieces to a collection and to an anchor: groups come apart over several levels.
@pytest.mark.parametrize("length, collection, limit", [(40, 16_384, 8_192), (40, 5, 3), (25, 50, 2), (200, 7, 2)])
def test_against_brute_force(spark, length, collection, limit):
    rows = sample(random.Random(length))
    assert run(spark, rows, length, collection=collection, limit=limit) == brute(rows, length)


def test_empty_and_long(spark):
    assert run(spark, [], 40) == []
    long = prose(random.Random(2), 400_000)
    rows = [(1, long), (2, "start " + long[500_000:500_300] + " end"), (3, None)]
    got = run(spark, rows, 200)
    both = hashlib.sha256((long[:500_000] + long[500_300:]).encode()).hexdigest()
    assert got[1:] == [str((2, 310, 300, 1, hashlib.sha256(b"start  end").hexdigest())),
                       str((3, 0, 0, 0, hashlib.sha256(b"").hexdigest()))]
    assert got[0] == str((1, len(long), 300, 1, both))


@pytest.mark.parametrize("segment", [1 << 20, 50])
def test_each_string_is_in_one_piece_and_its_anchor_is_its_own(monkeypatch, segment):
    monkeypatch.setattr(repeats, "SEGMENT", segment)
    rng, length = random.Random(4), 30
    text = b"".join(rng.choice([b"a", b"b", prose(rng, 2).encode()]) for _ in range(120)) + b"z" * 100
    text += text[100:300]
    place, strings = {}, []
    for first, last, anchor, _ in repeats.pieces(text, length):
        for a, z, p in zip(first.tolist(), last.tolist(), anchor.tolist(), strict=True):
            for k in range(a, z + 1):
                strings.append(k)
                assert place.setdefault(text[k:k + length], p - k) == p - k
    assert strings == list(range(len(text) - length + 1))
    assert [list(c) for c in repeats.pieces(b"short", length)] == []


def test_order_and_common_prefixes_of_each_column():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(4, 12))) for _ in range(40)]
    shifts = np.array([rng.randint(0, 3) for _ in strings])
    group = repeats.Collection(strings, shifts)
    padded = [b"\xff" * s + t + b"\xff" * (group.width - s - len(t)) for s, t in zip(shifts.tolist(), strings, strict=True)]
    for x, order, ends in group.rounds():
        tails = [padded[i][x:] for i in order]
        assert tails == sorted(tails)
        for k in range(1, len(tails)):
            agree = next((j for j, (a, b) in enumerate(zip(tails[k - 1], tails[k], strict=True)) if a != b), len(tails[k]))
            assert ends[k] == x + agree
    group.close()
