"""Small documents with the odd cases, and columns whose names clash with those the operators use inside."""

import datetime as dt
import random

CLASH = ["id", "key", "fp", "doc", "text_key", "drop_id", "drop_key", "drop_doc", "drop_lines", "line", "word", "language"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASH)


def rows(texts):
    """(doc_id, text) or (doc_id, text, lang) pairs as full rows."""
    out = []
    for t in texts:
        i, text, lang = (*t, None)[:3]
        out.append((i, text, lang, "s", None if text is None else len(text), *([7] * len(CLASH))))
    return out


def docs(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA)


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    names = ["".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(vocabulary)]
    return " ".join(r.choice(names) for _ in range(words))


BASE = prose(1, 120)
ODD = [
    (0, BASE), (1, BASE), (1, BASE),                       # copies, and a repeated row
    (2, BASE.replace(" ", "  ", 3).upper()),               # the same words
    (3, None), (4, ""), (5, " \t\n \r\n"), (6, "..."), (7, "É"),
    (None, BASE + " more"), (None, None),
    (8, prose(2, 3)), (9, prose(3, 5)), (10, "\n".join(prose(s, 12) for s in range(4, 9))),
    (11, "one\ttwo three"), (12, "é ß ü 漢字 😀 " * 20),
    (13, prose(50, 20_000)),                               # a long text
    (14, "x" * 100_000),                                   # one long word
]
TODAY = dt.date(2024, 1, 1)
