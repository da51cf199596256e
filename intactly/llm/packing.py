"""Packing of token sequences by the sum of squares.

Documents become pieces of at most ``capacity`` tokens (only longer documents are cut; the first piece takes the
remainder). Pieces are dealt evenly, whatever their key, into groups of a bounded number of pieces. In a group a piece
goes where the sum over residual gaps of (open bins with that gap) squared becomes smallest; a piece of full length is
a sequence of its own. Larger pieces go first: small ones then fill the gaps that are left.

Null text counts as empty: such a document is the closing id alone. Repeated rows, null ids too, are packed each. An
empty table gives no rows. A text of any length is one row of its task, and its ids are held at once.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from intactly.llm.common import staged, table

CAPACITY = 2048
CLOSING_ID = 0
#: Pieces that one task packs.
GROUP_PIECES = 100_000

# Fixed value: how a byte-level vocabulary cuts a text; runs are possessive, which cuts the same and never goes back.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
#: Texts with a run of so many characters, of white space or of others, are left to the tokenizers library.
LONG_RUN = 100_000
_LONG_RUN = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for themselves, the
    others, in order, are the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ids by bytes of a byte-level vocabulary whose merges are listed in the order of their ids, else None: only
    then is the lowest-ranked merge the one that makes the lowest id."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in (
        "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not (plain and model.get("type") == "BPE" and spec.get("normalizer") is None and cut.get("type") == "ByteLevel"
            and cut.get("use_regex") and not cut.get("add_prefix_space")):
        return None
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    made = [model["vocab"][a + b] for a, b in pairs]
    byte = byte_letters()
    special = {t["content"] for t in spec["added_tokens"]}
    words = {w: i for w, i in model["vocab"].items() if w not in special}
    if made != sorted(set(made)) or len(made) + len(byte) != len(words) or not set().union(*words) <= byte.keys():
        return None
    return {bytes(byte[c] for c in w): i for w, i in words.items()}


class TokenIds:
    """Little-endian 32-bit ids of a text as the tokenizers library gives them.

    A byte-level vocabulary is also handed to tiktoken, which cuts and merges the same way and is several times as
    fast. Texts with special strings or very long runs, and other vocabularies, go to the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = None
        if ranks := byte_ranks(spec):
            import tiktoken

            self.fast = tiktoken.Encoding(path, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.special = [t["content"] for t in spec["added_tokens"]]

    def encode(self, text: str) -> bytes:
        return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.fast or any(s in text for s in self.special):
            return self.encode(text)
        if len(text) >= LONG_RUN and _LONG_RUN.search(text):
            return self.encode(text)
        ids = array("I", self.fast.encode_ordinary(text))
        return (ids if ids.itemsize == 4 else np.array(ids, "<u4")).tobytes()


@lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    """One encoder for each Python worker and vocabulary."""
    return TokenIds(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter than ``capacity``."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def run(frames):
        encode = token_ids(vocabulary)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = encode(text if isinstance(text, str) else None) + closing
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInPandas(run, PIECES.format(id=kind))


class SumOfSquares:
    """Bins of ``capacity``; ``place`` puts an item where the squared counts of open bins per gap sum up least.

    A new bin is opened only for an item that fits no open one, which keeps the number of bins low.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)  # open bins by gap; gap 0 is closed and not counted
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bins = 0

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of an item of 1 to ``capacity``."""
        c, room = self.capacity, self.count[size:self.capacity]
        # Change of the sum when a bin with gap g takes the item: it leaves g and joins g - size.
        change = 2 * (self.count[:c - size] - room) + 2
        if room.any():
            change[0] -= 1  # a bin that gets full joins no gap
            gap = size + int(np.argmin(np.where(room > 0, change, np.iinfo(np.int64).max)))
            bin_id = self.open[gap].pop()
            self.count[gap] -= 1
        else:
            gap, bin_id = c, self.bins
            self.bins += 1
        if gap > size:
            self.open[gap - size].append(bin_id)
            self.count[gap - size] += 1
        return bin_id, c - gap


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; larger lengths are placed first, ties in order."""
    packer = SumOfSquares(capacity)
    placed = np.empty((len(lengths), 2), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        placed[i] = packer.place(int(lengths[i]))
    return placed[:, 0], placed[:, 1]


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    cut_up = staged(pieces(docs, vocabulary, capacity), "pieces")
    groups = max(1, -(-cut_up.count() // group_pieces))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames):
        group = pd.concat([*frames, pd.DataFrame(columns=["length"])])
        if len(group):
            bins, offsets = pack_lengths(group["length"].to_numpy(np.int64), capacity)
            yield group.assign(sequence_id=(TaskContext.get().partitionId() << 40) + bins, offset=offsets)

    return cut_up.repartition(groups).mapInPandas(run, PIECES.format(id=kind) + ", sequence_id long, offset long")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op5_best_fit_packing": op5_best_fit_packing}
SQL: dict[str, str] = {}
