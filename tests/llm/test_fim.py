"""Fill-in-middle against a plain version over Python's own strings."""

import hashlib
import re

import numpy as np
import pytest

from salespark.llm import fim
from . import fixtures as X

TEXTS = [*X.ODD, (20, "a\n\nb\n"), (21, "\n"), (22, "no <P> marker"), (23, "tail<M>"), (24, "ends with <"), (25, "<\nS>\n<P\n>"),
         (26, "é\n漢字\n😀😀\nx"), (27, "\r\n\x00\nß"), (28, "😀" * 5_000 + "\n" + "a" * 5_000), (29, "́\n" * 9)]


def plain(i, text, unit, rate=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[k:k + 8], 16) for k in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return i, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return i, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit, rate, spm", [("line", 100, 50), ("char", 100, 50), ("char", 60, 0), ("line", 0, 50)])
def test_equals_plain_version_and_is_restored(spark, unit, rate, spm):
    from pyspark.sql import functions as F
    docs = X.docs(spark, [*TEXTS, *((500 + i, X.prose(i, 30).replace(" ", "\n", i)) for i in range(60))])
    found = fim.fill_in_middle(docs, unit=unit, rate=rate, spm=spm)
    got = found.select(*found.columns, fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    texts = {r.doc_id: r.text for r in docs.where("doc_id is not null").collect()}
    want = [plain(r.doc_id, r.text, unit, rate, spm) for r in docs.collect()]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert all(r.back == (texts[r.id] or "") for r in got if r.id is not None)
    assert {r.form for r in got} == ({"plain"} if rate == 0 else {"plain", "psm"} if spm == 0 else {"plain", "psm", "spm"})


def test_index_converts_every_cut():
    text = "aé漢😀b" * 7 + "́"
    data = np.frombuffer(text.encode(), np.uint8)
    index = fim.Exceptions(data)
    points = np.arange(len(text) + 1)
    want = np.array([len(text[:p].encode()) for p in points])
    assert index.chars == len(text) and len(index.position) == 22
    assert (index.to_bytes(points) == want).all() and (index.to_chars(want) == points).all()
    assert len(fim.Exceptions(np.frombuffer(b"plain", np.uint8)).position) == 0


def test_nothing_to_transform(spark):
    assert fim.fill_in_middle(X.docs(spark, []).where("false")).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(X.docs(spark, []), unit="word")
