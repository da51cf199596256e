"""Small inputs for the tests of the training-data operators."""

from __future__ import annotations

import random

SYLLABLES = ("an the ing er on at re ed th nd es or is it of to").split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(words))


def documents(spark, rows, extra: bool = True):
    """(doc_id, text) rows as a documents table, with columns that clash with names the operators use."""
    clash = ", n_words string, score string, node string, label string, block string, key string, id string" * extra
    tail = ("x",) * 7 if extra else ()
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *tail) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long" + clash)


def edge_rows(rng: random.Random):
    """Null, empty and blank texts, a null id, repeated rows, one long text and one long word."""
    return [(1, None), (2, ""), (3, " \n\t "), (None, "the thing"), (4, "the thing"), (4, "the thing"), (5, "the thing"),
            (6, prose(rng, 30_000)), (7, "x" * 20_000), (8, "é ß 中 🎉\u0000 \u2028 end")]
