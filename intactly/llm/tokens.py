"""Token counts without token ids: byte-pair merging with a heap and a linked list.

A text is cut at special strings, then at spaces and line feeds; no token and no canonical composition
crosses those, so each chunk counts on its own and repeated chunks are looked up. In a chunk, each word
starts as one symbol per byte (the last one marked as a word's end). The adjacent pair of the lowest
merge rank is popped and merged until no pair has a rank; the count is symbols minus merges.

Null and empty texts have 0 tokens. Rows, ties and repeated rows pass through one by one.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from intactly.llm.common import BoundedCache, map_texts, table, utf8

TOKEN_LIMIT = 2048
#: Distinct chunks remembered by a Python worker (about 60 MB).
CACHE_ENTRIES = 400_000

_PLAIN = re.compile(r"[!-~]+")
# The vocabulary's word pattern, for lower-case ASCII.
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[!-/:-`{-~]+")
_CHUNKS = re.compile(r"[^ \n]+")


def count_symbols(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left when the lowest-ranked adjacent pair (leftmost first) is merged again and again."""
    n = len(symbols)
    sym = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if sym[i] is None or j >= n or ranks.get((sym[i], sym[j])) != rank:
            continue  # one of the two has been merged since
        sym[i] += sym[j]
        sym[j] = None
        after[i] = k = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (r := ranks.get((sym[i], sym[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (p := before[i]) >= 0 and (r := ranks.get((sym[p], sym[i]))) is not None:
            heapq.heappush(heap, (r, p))
    return n - merges


class TokenCounter:
    """Counts tokens of texts as the vocabulary file at ``path`` gives them."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.known, self.end = model["vocab"].keys(), model["end_of_word_suffix"] or ""
        # The library's own normaliser and splitter serve chunks beyond plain ASCII: their Unicode tables decide.
        own = Tokenizer.from_file(path)
        self.normalise, self.split = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.counts = BoundedCache(self._chunk, cache_entries)

    def _word(self, word: str) -> int:
        symbols = [*word[:-1], word[-1] + self.end]
        return count_symbols([s for s in symbols if s in self.known], self.ranks)

    def _chunk(self, chunk: str) -> int:
        if _PLAIN.fullmatch(chunk):
            words = _ASCII_WORD.findall(chunk.lower())
        else:
            words = [w for w, _ in self.split(self.normalise(chunk))]
        return sum(map(self._word, words))

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        parts, found = [text], 0
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            found = len(parts) - 1
        return found + sum(sum(map(self.counts.__getitem__, _CHUNKS.findall(p))) for p in parts)


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter for each Python worker and vocabulary."""
    return TokenCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""

    def factory():
        count = counter(vocabulary)

        def fn(texts):
            tokens = [count(t) for t in texts]
            return [len(utf8(t or "")) for t in texts], tokens, [n > limit for n in tokens]

        return fn

    return map_texts(docs, "n_bytes long, n_tokens long, over_limit boolean", factory)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op7_token_counts": op7_token_counts}
SQL: dict[str, str] = {}
