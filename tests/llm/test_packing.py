import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from fixtures_llm import documents, edge_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from intactly.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
OWN = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*OWN.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sab\x1c\x85　")), max_size=40))
def test_ids_are_the_librarys(text):
    assert np.frombuffer(packing.token_ids(PATH)(text), "<u4").tolist() == ids_of(text)[:-1]


@pytest.mark.parametrize("text", [
    "a <|endoftext|> b<|endoftext|>", " " * 120_000 + "x", "ab" * 60_000, "don't  \t\r\n  can't'll ", "x" * 99_999 + "\n\n y",
    "".join(map(chr, range(1, 0xD800))), " ".join(map(chr, range(0xE000, 0x20000, 3)))])
def test_ids_of_special_strings_long_runs_and_all_scripts(text):
    assert packing.token_ids(PATH).fast
    assert np.frombuffer(packing.token_ids(PATH)(text), "<u4").tolist() == ids_of(text)[:-1]


def test_vocabularies_without_byte_ranks_use_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.token_ids(path).fast is None
    want = Tokenizer.from_file(path).encode("Some words, and more", add_special_tokens=False).ids
    assert np.frombuffer(packing.token_ids(path)("Some words, and more"), "<u4").tolist() == want


def test_cut():
    assert packing.cut(5, 5) == [(0, 5)]
    assert packing.cut(12, 5) == [(0, 2), (2, 5), (7, 5)]
    assert packing.cut(10, 5) == [(0, 5), (5, 5)]


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_packed_lengths_fit_and_waste_little(n):
    rng = np.random.default_rng(n)
    lengths = np.minimum(rng.lognormal(6, 1, n).astype(int) + 1, 2048)
    bins, offsets = packing.pack_lengths(lengths, 2048)
    fill = defaultdict(list)
    for b, o, size in zip(bins, offsets, lengths, strict=True):
        fill[b].append((o, o + size))
    for spans in fill.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 2048
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert len(fill) <= -(-lengths.sum() // 2048) * 1.02 + 1


def test_the_least_sum_of_squares_decides():
    packer = packing.SumOfSquares(10)
    for size in (6, 7):
        packer.place(size)  # gaps 4 and 3
    # 2 into gap 4 leaves gaps 2 and 3; into gap 3, gaps 4 and 1: both 2; the smaller gap comes first.
    assert packer.place(2) == (1, 7)
    # 1 into gap 4 leaves 3 and 1 (sum 2); into gap 1 it closes a sequence (sum 1).
    assert packer.place(1) == (1, 9)


@pytest.mark.parametrize("group", [100_000, 7])
def test_pack(spark, group):
    rng = random.Random(2)
    rows = edge_rows(rng) + [(100 + i, prose(rng, rng.randint(0, 900))) for i in range(60)]
    got = packing.pack(documents(spark, rows), PATH, group_pieces=group).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in rows:
        ids = ids_of(text)
        want = [(k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()))
                for k, (s, n) in enumerate(packing.cut(len(ids), 2048))]
        assert set(want) <= set(docs[i])
    assert len(got) == sum(len(packing.cut(len(ids_of(t)), 2048)) for _, t in rows)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(documents(spark, rows).limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_every_placement_makes_the_sum_of_squares_least(seed):
    rng = random.Random(seed)
    capacity = 24
    packer = packing.SumOfSquares(capacity)
    where: dict[int, int] = {}  # the gap of every open sequence, by its number
    for _ in range(400):
        size = rng.choice([1, 2, 3, 5, 8, 13, 24, rng.randint(1, capacity)])
        count = defaultdict(int)
        for gap in where.values():
            count[gap] += 1
        options = []
        for gap in sorted(g for g in count if g >= size):
            after = dict(count)
            after[gap] -= 1
            if gap > size:
                after[gap - size] = after.get(gap - size, 0) + 1
            options.append((sum(n * n for n in after.values()), gap))
        bin_id, offset = packer.place(size)
        gap = where.pop(bin_id, capacity)
        assert gap == (min(options)[1] if options else capacity) and offset == capacity - gap
        if gap > size:
            where[bin_id] = gap - size
