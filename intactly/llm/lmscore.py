"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Words (lower-case A-Z, cut at ASCII white space) go by a 64-bit hash of their bytes, made for a whole run of text at
once. They get ids: the most frequent words of the whole corpus one each, all others one by their last bytes; there are
more ids of both kinds the more distinct words the corpus has. A network with one hidden layer predicts each word's id
from the WINDOW words on both sides; its output is a class and then a member of the class. A word that shares its id has
the id's probability times its own share of the id's count, from the counts of all words (one is added to the id's count
for words that the corpus lacks). A document's score is the sum of the log probabilities of its words. The shares come by
a join of the documents' words with the counts, both dealt by the words' hashes.

All documents train the network, each once. They are dealt into rounds by a hash of their text; in a round, every task
starts from the same parameters, takes Adagrad steps over its own documents in numpy, and returns its parameters; tasks
add them up, weighted by words read. What reaches the driver in a round is one set of parameters, whose size grows with
the root of the number of distinct words. The parameters, and so the scores, depend on how the documents are dealt into
tasks, as every parallel training by averages does.

Null and empty texts have no words: log_prob 0 and no mean. Repeated rows and rows with null ids get a row each and train
as often. Very long texts are hashed in runs of about RUN_BYTES. Without any words all parameters keep their start; an
empty table has no scores. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.llm.common import LOWER, map_texts, staged, table, utf8

#: Classes, and members of each; the least of both, and their growth with the fourth root of the distinct words.
LEAST_SIDE, SIDE_GROWTH = 32, 1.25
#: The least number of ids. A quarter of the ids are for words by their ending; id 0 stands for places outside the text.
VOCABULARY = LEAST_SIDE ** 2
WINDOW = 2
WIDTH = 16
STEP_WORDS = 8192
RATE = 0.15
#: Shares of the documents that the rounds read (of 16).
ROUNDS = (1, 4, 11)
#: Bytes of text hashed at once.
RUN_BYTES = 1 << 18
#: Tasks that add up the parameters of all others, before one adds up theirs.
ADDERS = 16

#: Words' shares are summed as whole numbers of this fraction of 1, in any order.
PARTS = 1e9

_SPACE = b" \t\n\r\x0b\x0c"
_PLAIN = bytes(32 if b in _SPACE else LOWER[b] for b in range(256))
#: A word's hash is the sum of a random number for each byte times the BASE to the power of its place, modulo 2^64.
_LETTERS = np.random.default_rng(64).integers(1, 2 ** 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2 ** 64)


def side_of(distinct: int) -> int:
    """Classes (and members of each) for a corpus of so many distinct words."""
    return max(LEAST_SIDE, math.ceil(SIDE_GROWTH * distinct ** 0.25))


def endings_of(side: int) -> tuple[int, int]:
    """Ids of words by their ending, and the bytes of an ending."""
    n = side * side // 4
    return n, 2 if n <= 1024 else 3


def _shapes(side: int) -> dict[str, tuple[int, ...]]:
    return {"embed": (2 * WINDOW, side * side, WIDTH), "hidden": (WIDTH,), "to_class": (WIDTH, side),
            "class_bias": (side,), "to_member": (side, WIDTH, side), "member_bias": (side, side)}


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(LOWER).split() if text else []


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Spelling:
    """Hashes and last bytes of the words of texts."""

    def __init__(self, run_bytes: int = RUN_BYTES):
        self.run_bytes = run_bytes
        self.up, self.down = _powers(_BASE, 2 * run_bytes), _powers(_INVERSE, 2 * run_bytes)

    def _run(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.frombuffer(data, np.uint8)
        up, down = self.up, self.down
        if len(a) > len(up):  # one word longer than a run
            up, down = _powers(_BASE, len(a)), _powers(_INVERSE, len(a))
        edges = np.flatnonzero(np.diff(a != 32, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(_LETTERS[a] * up[:len(a)], out=sums[1:])
        names = (sums[ends] - sums[starts]) * down[starts]
        names ^= names >> np.uint64(29)
        names *= np.uint64(0xBF58476D1CE4E5B9)
        names ^= names >> np.uint64(32)
        tails = np.zeros(len(ends), np.int64)
        for k in (3, 2, 1):
            tails = tails * 256 + np.where(ends - k >= starts, a[ends - k], 0)
        return starts, names.view(np.int64), tails

    def _runs(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        """Runs of ``data`` and where they begin; no word is cut."""
        at = 0
        while at < len(data):
            end = at + self.run_bytes
            if end < len(data):
                space = data.rfind(b" ", at, end)
                space = space if space >= 0 else data.find(b" ", end)
                end = space + 1 if space >= 0 else len(data)
            yield at, data[at:end]
            at = end

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; hashes and last three bytes (the last one lowest) of all words, in order."""
        data = [utf8(t).translate(_PLAIN) if t else b"" for t in texts]
        text_ends = np.cumsum([len(d) + 1 for d in data])
        names, tails, n = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(len(data), np.int64)
        for at, run in self._runs(b" ".join(data)):
            starts, run_names, run_tails = self._run(run)
            n += np.bincount(np.searchsorted(text_ends, starts + at, side="right"), minlength=len(data))
            names.append(run_names)
            tails.append(run_tails)
        return n, np.concatenate(names), np.concatenate(tails)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text")).where("length(text) > 0")


def word_counts(docs: DataFrame) -> DataFrame:
    """name (a word's hash), tail (its last three bytes) and n over all texts."""

    def run(frames):
        spell = Spelling()
        for frame in frames:
            _, names, tails = spell(frame["text"])
            if len(names):
                found, at, n = np.unique(names, return_index=True, return_counts=True)
                yield pd.DataFrame({"name": found, "tail": tails[at], "n": n})

    return (texts_of(docs).mapInPandas(run, "name long, tail long, n long").groupBy("name")
            .agg(F.min("tail").alias("tail"), F.sum("n").alias("n")))


def ending_of(tail, side: int):
    """Which ending a tail (a column, an array or a number) has, from 0."""
    endings, ending = endings_of(side)
    mixed = (tail % 256 ** ending) * 2654435761 % 2 ** 32
    if isinstance(tail, Column):
        return (F.shiftright(mixed, 8) % endings).cast("long")
    return (mixed >> 8) % endings


class Ids:
    """Ids of words: frequent ones (by hash) their own, others by their ending."""

    def __init__(self, frequent: np.ndarray, side: int = LEAST_SIDE):
        frequent = np.asarray(frequent, np.int64)
        self.side, self.first = side, side * side - endings_of(side)[0]
        order = np.argsort(frequent)
        self.names, self.own = frequent[order], order + 1
        self.spell = Spelling()

    def __call__(self, text: str | None) -> np.ndarray:
        return self.of([text])[1]

    def of(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; ids and hashes of all words."""
        n, names, tails = self.spell(texts)
        ids = self.first + ending_of(tails, self.side)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            ids = np.where(self.names[at] == names, self.own[at], ids)
        return n, ids, names


def in_texts(n: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """The words of each text."""
    return np.split(words, np.cumsum(n)[:-1]) if len(n) else []


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each word of the texts and, in rows, the ids on both sides of it (0 outside its text)."""
    gap = np.zeros(WINDOW, np.int64)
    line = np.concatenate([gap, *[x for ids in texts for x in (ids, gap)]])
    at = np.flatnonzero(line)
    sides = [*range(-WINDOW, 0), *range(1, WINDOW + 1)]
    return line[at], np.stack([line[at + k] for k in sides])


@dataclass
class Network:
    """Parameters by name; every method works on a run of words and their windows."""

    p: dict[str, np.ndarray]

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 7) -> Network:
        """Small random weights, and biases such that the network begins as the frequencies ``counts`` by id."""
        rng = np.random.default_rng(seed)
        side = math.isqrt(len(counts))
        p = {k: (0.1 * rng.standard_normal(shape)).astype(np.float32) for k, shape in _shapes(side).items()}
        share = (counts + 0.5).reshape(side, side)
        p["class_bias"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
        p["member_bias"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
        p["hidden"] = np.zeros(WIDTH, np.float32)
        return cls(p)

    @classmethod
    def of(cls, flat: np.ndarray, side: int) -> Network:
        p, at = {}, 0
        for k, shape in _shapes(side).items():
            n = int(np.prod(shape))
            p[k] = flat[at:at + n].reshape(shape).astype(np.float32)
            at += n
        return cls(p)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p.values()])

    @property
    def side(self) -> int:
        return len(self.p["class_bias"])

    def _hidden(self, around: np.ndarray) -> np.ndarray:
        total = self.p["hidden"] + np.take(self.p["embed"][0], around[0], axis=0)
        for k in range(1, len(around)):
            total += np.take(self.p["embed"][k], around[k], axis=0)
        return np.tanh(total, out=total)

    def _outputs(self, kind: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the classes, and of the members of each word's class, in columns; words come by class."""
        z = self.p["to_class"].T @ h.T + self.p["class_bias"][:, None]
        inner = np.empty_like(z)
        for c, a, b in _runs_of(kind, self.side):
            inner[:, a:b] = self.p["to_member"][c].T @ h[a:b].T + self.p["member_bias"][c][:, None]
        return z, inner

    def log_p(self, words: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Log probability of each word given the words around it."""
        order = _by_class(words, self.side)
        kind, member = np.divmod(words[order], self.side)
        out = np.empty(len(words), np.float32)
        each = np.arange(len(words))
        total = 0
        for z, at in zip(self._outputs(kind, self._hidden(np.take(around, order, axis=1))), (kind, member), strict=True):
            chosen, _, high, sums = _softmax(z, at, each)
            total = total + chosen - high - np.log(sums)
        out[order] = total
        return out

    def gradient(self, words: np.ndarray, around: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log probability."""
        order = _by_class(words, self.side)
        around = np.take(around, order, axis=1)
        kind, member = np.divmod(words[order], self.side)
        n, each = np.float32(len(words)), np.arange(len(words))
        h = self._hidden(around)
        g = {k: np.zeros(x.shape, np.float32) for k, x in self.p.items()}
        d, inner = self._outputs(kind, h)
        for z, at in ((d, kind), (inner, member)):
            _, e, _, sums = _softmax(z, at, each)
            e *= -1 / (sums * n)
            e[at, each] += 1 / n
        g["to_class"], g["class_bias"] = (d @ h).T, d.sum(axis=1)
        dh = (self.p["to_class"] @ d).T
        for c, a, b in _runs_of(kind, self.side):
            part = inner[:, a:b]
            g["to_member"][c], g["member_bias"][c] = (part @ h[a:b]).T, part.sum(axis=1)
            dh[a:b] += (self.p["to_member"][c] @ part).T
        dh *= 1 - h * h
        g["hidden"] = dh.sum(axis=0)
        across = np.ascontiguousarray(dh.T, np.float64)
        for k in range(len(around)):
            for j in range(WIDTH):
                g["embed"][k][:, j] = np.bincount(around[k], across[j], self.side ** 2)
        return g


def _softmax(z: np.ndarray, at: np.ndarray, each: np.ndarray):
    """Per column: the chosen logit, the exponentials over the highest logit (in place of ``z``), that logit, and
    their sum."""
    chosen, high = z[at, each], z.max(axis=0)
    z -= high
    np.exp(z, out=z)
    return chosen, z, high, z.sum(axis=0)


def _by_class(words: np.ndarray, side: int) -> np.ndarray:
    """Places of the words, class after class."""
    return np.argsort((words // side).astype(np.uint8 if side <= 256 else np.uint16), kind="stable")


def _runs_of(kind: np.ndarray, classes: int):
    """Each class with words, and where its words begin and end."""
    ends = np.cumsum(np.bincount(kind, minlength=classes))
    for c, end in enumerate(ends.tolist()):
        if (a := int(ends[c - 1]) if c else 0) < end:
            yield c, a, end


def added(each: DataFrame) -> DataFrame:
    """One row: read and flat (doubles, as bytes) of all rows, added up by a bounded number of tasks and then by one."""

    def run(frames):
        read, total = 0, None
        for frame in frames:
            for n, flat in zip(frame["read"], frame["flat"], strict=True):
                read += int(n)
                x = np.frombuffer(flat, np.float64)
                total = x.copy() if total is None else np.add(total, x, out=total)
        if read:
            yield pd.DataFrame({"read": [read], "flat": [total.tobytes()]})

    fields = "read long, flat binary"
    return each.repartition(ADDERS).mapInPandas(run, fields).repartition(1).mapInPandas(run, fields)


def _fitted(texts: DataFrame, frequent: np.ndarray, start: np.ndarray, side: int) -> np.ndarray:
    """Parameters after one round: the tasks' own, averaged by words read."""
    shared = texts.sparkSession.sparkContext.broadcast((frequent, start))

    def run(frames):
        frequent, start = shared.value
        ids, net = Ids(frequent, side), Network.of(start, side)
        squares = {k: np.full(x.shape, 1e-6, np.float32) for k, x in net.p.items()}
        read = 0
        for frame in frames:
            n, found, _ = ids.of(frame["text"])
            words, around = windows(in_texts(n, found))
            read += len(words)
            for a in range(0, len(words), STEP_WORDS):
                for k, g in net.gradient(words[a:a + STEP_WORDS], around[:, a:a + STEP_WORDS]).items():
                    squares[k] += g * g
                    net.p[k] += np.float32(RATE) * g / np.sqrt(squares[k])
        if read:
            yield pd.DataFrame({"read": [read], "flat": [(net.flat().astype(np.float64) * read).tobytes()]})

    got = added(texts.mapInPandas(run, "read long, flat binary")).first()
    shared.destroy()
    return (np.frombuffer(got["flat"], np.float64) / got["read"]).astype(np.float32) if got else start


@dataclass
class Model:
    """Hashes of the words with ids of their own, parameters, the corpus' count of each id, and counts of all words."""

    frequent: np.ndarray
    flat: np.ndarray
    by_id: np.ndarray
    counts: DataFrame


def train(docs: DataFrame, rounds: tuple[int, ...] = ROUNDS) -> Model:
    """Learned from every document."""
    counts = staged(word_counts(docs), "words")
    side = side_of(counts.count())
    first = side * side - endings_of(side)[0]
    top = counts.orderBy(F.desc("n"), "name").limit(first - 1).collect()
    frequent = np.array([r["name"] for r in top], np.int64)
    rare = counts.groupBy(ending_of(F.col("tail"), side).alias("e")).agg(F.sum("n").alias("n")).collect()
    by_id = np.zeros(side * side)
    by_id[1:1 + len(top)] = [r["n"] for r in top]
    by_id[first + np.array([r["e"] for r in rare], np.int64)] = [r["n"] for r in rare]
    for r in top:  # the endings' sums hold the frequent words, too
        by_id[first + ending_of(r["tail"], side)] -= r["n"]
    now = Network.start(by_id).flat()
    texts = texts_of(docs)
    turn = F.pmod(F.xxhash64("text"), F.lit(sum(rounds)))
    at = 0
    for share in rounds:
        now = _fitted(texts.where((turn >= at) & (turn < at + share)), frequent, now, side)
        at += share
    return Model(frequent, now, by_id, counts)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_words, log_prob and mean_log_prob of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.frequent, model.flat, model.by_id))

    def factory():
        frequent, flat, by_id = shared.value
        side = math.isqrt(len(by_id))
        ids, net = Ids(frequent, side), Network.of(flat, side)
        of_id = np.where(np.arange(len(by_id)) < ids.first, 0.0, -np.log(by_id + 1))

        def fn(texts):
            n, found, names = ids.of(texts)
            words, around = windows(in_texts(n, found))
            each = [net.log_p(words[a:a + STEP_WORDS], around[:, a:a + STEP_WORDS]) + of_id[words[a:a + STEP_WORDS]]
                    for a in range(0, len(words), STEP_WORDS)]
            sums = np.concatenate([[0.0], np.cumsum(np.concatenate(each or [np.empty(0)]), dtype=np.float64)])
            ends = np.cumsum(n)
            rare = [x[i >= ids.first] for x, i in zip(in_texts(n, names), in_texts(n, found), strict=True)]
            return n, sums[ends] - sums[ends - n], rare

        return fn

    # Rows are numbered, as ids may be null or repeated.
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    based = staged(map_texts(rows, "n_words long, base double, rare array<long>", factory, carry=("doc_id", "row")),
                   "bases")
    # A word counted once adds log 1 to its id's part, and so does one that the corpus lacks.
    weights = model.counts.where("n > 1").select("name", F.round(F.log("n") * PARTS).cast("long").alias("weight"))
    own = (based.select("row", F.explode("rare").alias("name")).join(weights, "name")
           .groupBy("row").agg(F.sum("weight").alias("own")))
    log_prob = F.round(F.col("base") + F.coalesce("own", F.lit(0)) / PARTS, 6)
    return (based.select("doc_id", "row", "n_words", "base").join(own, "row", "left")
            .select("doc_id", "n_words", log_prob.alias("log_prob"))
            .withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, train(docs))


QUERIES = {"op2_lm_scoring": op2_lm_scoring}
SQL: dict[str, str] = {}
