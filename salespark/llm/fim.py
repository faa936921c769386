"""Fill-in-middle transformation: a text is cut in prefix, middle and suffix, and its parts are written in the order a model
learns to fill the middle from.

Texts are handled as UTF-8 bytes, whole.  A text's sparse exception index (``Exceptions``) records only its multibyte
characters: their positions, where they end, and how many bytes more than one each took so far.  A cut is converted between
code points and bytes by one ``searchsorted`` in that index; what lies between exceptions is ASCII and stays arithmetic
(a text of ASCII alone has an empty index, and both counts are equal).  The index serves both ways:

* units of lines are found as bytes (the newline is one byte), and their cuts are converted to code points;
* units of characters are code points, and their cuts are converted to bytes, where the text is cut.

Cuts and form come from the SHA-256 of ``seed:id`` (decimal): with h1 to h4 its first four groups of eight hex digits and n
units, the prefix ends after the smaller of h1 % (n+1) and h2 % (n+1) units, the middle after the larger.  A text is left
plain if it is empty, holds one of the markers, or h3 % 100 >= ``rate``; else it is SPM if h4 % 100 < ``spm``, PSM if not.

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle

``restored`` gives the exact text back from output and form alone: no part holds a marker, and none can arise where a part
and a marker meet, since each marker starts with ``<`` and has no other.

Defined results: a null text counts as empty; a null id hashes as ``seed:`` alone; repeated rows are each transformed, alike;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 7
RATE = 100  # percent of the texts that are transformed
SPM = 50    # percent of those that get the suffix first
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
NEWLINE = 0x0A


class Exceptions:
    """The multibyte characters of UTF-8 ``data``: code-point ``position``, byte ``start``, and ``excess``, the bytes beyond
    one a character up to and with each of them (with a leading 0)."""

    def __init__(self, data: np.ndarray):
        lead = np.flatnonzero(data >= 0xC0)
        first = data[lead]
        more = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.start = lead
        self.excess = np.concatenate([[0], np.cumsum(more)])
        self.position = lead - self.excess[:-1]
        self.size = len(data)

    @property
    def chars(self) -> int:
        return self.size - int(self.excess[-1])

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        """Byte offsets of the cuts before the given code points."""
        return chars + self.excess[np.searchsorted(self.position, chars, "left")]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code-point offsets of cuts at the given bytes, each at the start of a character or at the end."""
        return cuts - self.excess[np.searchsorted(self.start, cuts, "left")]


def line_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets behind the lines, a last one without a newline among them, after a leading 0."""
    ends = np.flatnonzero(data == NEWLINE) + 1
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    return np.concatenate([[0], ends]).astype(np.int64)


def cuts(text: bytes, unit: str, h: list[int]) -> tuple[int, np.ndarray, np.ndarray]:
    """(n units, cuts in bytes, cuts in code points): the two cuts of a text."""
    data = np.frombuffer(text, np.uint8)
    index = Exceptions(data)
    if unit == "line":
        ends = line_ends(data)
        n = len(ends) - 1
        at = ends[sorted((h[0] % (n + 1), h[1] % (n + 1)))]
        return n, at, index.to_chars(at)
    n = index.chars
    points = np.array(sorted((h[0] % (n + 1), h[1] % (n + 1))), np.int64)
    return n, index.to_bytes(points), points


def transformed(text: bytes, unit: str, h: list[int], rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output)"""
    n, (a, b), (p, m) = cuts(text, unit, h)
    if not text or h[2] % 100 >= rate or any(mark in text for mark in MARKS):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        parts = (MARKS[1], suffix, MARKS[0], prefix, MARKS[2], middle)
        return n, "spm", int(p), int(m - p), b"".join(parts)
    return n, "psm", int(p), int(m - p), b"".join((MARKS[0], prefix, MARKS[1], suffix, MARKS[2], middle))


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", rate: int = RATE,
                   spm: int = SPM, seed: int = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of each row; ``unit``: "line" or "char".  The numbers of characters are
    null where the form is plain."""
    if unit not in ("line", "char"):
        raise ValueError("unit is line or char")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                     F.substring(digest, 1, 32).alias("h"))
    id_type = rows.schema["id"].dataType.simpleString()
    out = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                     ("output", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [transformed(t.as_py(), unit, [int(h.as_py()[i:i + 8], 16) for i in range(0, 32, 8)], rate, spm)
                     for t, h in zip(batch.column("text"), batch.column("h"))]
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*found) if found else [[]] * len(out), out)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", *out.names])

    return rows.mapInArrow(run, f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text from the output and the form."""
    def after(text: Column, mark: str) -> Column:
        return F.split_part(text, F.lit(mark), F.lit(2))

    def before(text: Column, mark: str) -> Column:
        return F.split_part(text, F.lit(mark), F.lit(1))

    middle = after(output, MIDDLE)
    psm = F.concat(before(after(output, PREFIX), SUFFIX), middle, before(after(output, SUFFIX), MIDDLE))
    spm = F.concat(before(after(output, PREFIX), MIDDLE), middle, before(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
