import random

import public_tokenizers
from fixtures_llm import documents, edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from intactly.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
OWN = Tokenizer.from_file(PATH)


def of_library(text):
    return len(OWN.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("'s're \n\tÉİΣ́ﬁ<|endoftext|>")), max_size=40))
def test_same_as_the_library(text):
    assert tokens.counter(PATH)(text) == of_library(text)


def test_special_strings_and_long_words():
    count = tokens.counter(PATH)
    for text in ("a<|endoftext|>b", "<|startoftext|><|endoftext|>", " <|endoftext|>  x", "!" * 999, "ab" * 5000, "ΑΣ ΟΔΟΣ."):
        assert count(text) == of_library(text)


def test_heap_merging_takes_the_lowest_rank_and_the_leftmost():
    ranks = {("a", "a"): 0, ("aa", "b"): 1}
    assert tokens.count_symbols(list("aaab"), ranks) == 3  # aa a b
    assert tokens.count_symbols(list("aab"), ranks) == 1
    assert tokens.count_symbols([], ranks) == 0


def test_a_full_cache_changes_nothing():
    small = tokens.TokenCounter(PATH, cache_entries=3)
    text = "one two three four five six one two three four five six"
    assert small(text) == of_library(text)


def test_rows(spark):
    rows = edge_rows(random.Random(1))
    got = tokens.token_counts(documents(spark, rows), PATH, limit=100).collect()
    want = [(i, len((t or "").encode()), n := of_library(t), n > 100) for i, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert tokens.token_counts(documents(spark, rows).limit(0), PATH).count() == 0
