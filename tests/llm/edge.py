"""The cases every operator has to stand: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, c long, node long, k1 long, row string, score double, label string"


def word(rng: random.Random) -> str:
    return "".join(rng.choice("abcdeghilmnoprstu") for _ in range(rng.randint(2, 8)))


def prose(rng: random.Random, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(4)
    base = prose(rng, 90)
    passage = prose(rng, 60)
    texts = {
        0: base,
        1: base,
        2: base.replace(" ", "\n", 1) + " tail",
        3: None,
        4: "",
        5: " \n\t ",
        6: "word",
        7: prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 10),
        8: passage + "\n" + prose(rng, 50),
        9: "é漢字😀 " * 40,
        10: "a" * 30_000,
        11: prose(rng, 6_000),
        12: "one two three four five",
        13: "ONE Two three FOUR five",
        14: "x y\nx y\nx y\nx y",
    }
    out = [(i, t, "en", None, None, 1, 2, 3, "r", 0.5, "l") for i, t in texts.items()]
    out += [out[0], out[7]]  # repeated rows
    out += [(7, prose(rng, 30), None, "s", 5, None, None, None, None, None, None)]  # an id with another text
    out += [(None, base, None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None)]
    return out


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
