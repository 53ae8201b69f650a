"""Small tables with everything that operators must bear."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, _t string, n_words string, score string, _k string, length string, kept string"


def table(spark, rows):
    """Documents of (id, text), with other columns whose names clash with what operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z", "u", "v", "w", "q") for i, t in rows], DOCS).repartition(3)


def prose(rng: random.Random, n: int, sizes=(3, 9)) -> str:
    out = []
    while n > 0:
        k = min(n, rng.randint(*sizes))
        out.append(" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(k)).capitalize() + ".")
        n -= k
    return "\n".join(" ".join(out[k : k + 2]) for k in range(0, len(out), 2))


def awkward(seed: int = 1):
    """Nulls, empty and blank texts, one very long, repeated rows, repeated and missing ids, odd characters."""
    rng = random.Random(seed)
    same = prose(rng, 90)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, same), (5, same), (5, same), (6, same.replace("a", "b", 1)), (None, same), (None, "one two"), (7, "É ß ﬁ \U0001f600 <|end|> </s> #|%\x00"),
        (8, prose(rng, 6000)), (9, "word " * 300), (10, prose(rng, 70)), (5, prose(rng, 60)), (11, "\n".join(["Same line here again."] * 40)), (12, "x" * 30000),
    ]
