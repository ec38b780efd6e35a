"""Small documents with everything that tables can hold, and helpers for brute-force checks."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row string, pos int"


def rows() -> list[tuple]:
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 8))) for _ in range(200)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base, shared = prose(150), prose(90)
    edited = base.split(" ")
    edited[75] = "changed"
    texts = [
        None, "", " ", "\n\n\t", "one", "one two three", base, base, base.upper(), " ".join(edited),
        f"Shared line of text\n{prose(40)}\nLast line here", f"{prose(30)}\n  shared LINE of text \nLast line here\nLast line here",
        prose(30) + " " + shared, shared + " " + prose(20) + "\n" + shared, "x y " * 400, "Und " * 300,
        prose(30_000), "\U0001f600 日本語 ## $$ | <b>", prose(60), prose(60), "ÄÖÜ ÀÉÎ line with capitals ÄÖ", "äöü àéî line with capitals äö",
    ]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [(6, base), (6, base), (None, base), (None, None), (7, None), (9, "another text under the same id")]
    return [(i, t, "en", "src", None, "k", "r", 1) for i, t in out]


def table(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
