"""Secret scan: fixed patterns, and sliding-window Shannon entropy per character class; DataFrame
operations only.

Base spans come from three patterns, matched leftmost and without overlap:
assignments to a secret-like name, access keys and runs of hex digits.

The entropy scan reads candidate strings, the maximal runs of a character class.  A window of fixed
length slides over a candidate; the number of each character in it is kept up to date by
adding the character that enters and taking off the one that leaves, and with it
S = sum(c * log2(c)).  The window's entropy is log2(length) - S / length.  Windows at or above the
class's threshold are merged where they touch, each run of them being one span.

Suppression: candidates without both a letter and a digit, and candidates that match
the allow-list (identifiers of known forms, placeholders, words joined by
punctuation), are not scanned; an entropy span inside a base span is not repeated.  Base spans
are never suppressed.

Offsets count code points, the end is exclusive.  Defined results: a null text is empty and has
no spans; repeated rows are each returned; ids are passed on as they are, nulls too; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# Fixed values of the contract: the patterns and shortest lengths of base spans.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 18
HEX = r"[0-9a-f]+"
HEX_LENGTH = 16

#: class name, its characters, window length, threshold in bits
CLASSES = [
    ("entropy_hex", "0123456789abcdefABCDEF", 16, 2.75),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 24, 3.75),
]
ALLOW = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i)example|sample|placeholder|dummy|changeme|your|xxxx|redacted",
    r"^[+/_=-]*[A-Za-z]+([+/_=-]+[A-Za-z]+)*[+/_=-]*[0-9]{0,4}$",  # words, perhaps numbered
    r"^[0-9+/_=-]+$",  # numbers, dates, telephone numbers
]
ROUNDING = 1e-9

SPAN = "array<struct<at:int,kind_no:int,until:int,kind:string>>"


BLOCK = 128


def running(values: Column, combine) -> Column:
    """For each of an array's ints, 0 combined with all before it, in order.

    An array is copied for each value that is put behind it; so each block of ``BLOCK`` values makes one of its own,
    starting from what all blocks before it come to, and the cost stays near the number of values."""
    def blocks(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                           lambda k: F.slice(v, k * BLOCK + 1, F.lit(BLOCK)))

    def before(v: Column, first: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            return F.struct(combine(acc["now"], x).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out"))
        return F.aggregate(v, F.struct(first.alias("now"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])

    def within(parts: Column) -> Column:
        totals = F.transform(parts, lambda b: F.aggregate(b, F.lit(0), combine))
        return let(before(totals, F.lit(0)), lambda firsts: F.flatten(F.transform(parts, lambda b, k: before(b, F.get(firsts, k)))))

    return F.when(F.size(values) > 0, let(values, lambda v: let(blocks(v), within))).otherwise(F.array().cast("array<int>"))


def located(text: Column, pattern: str, group: int | None = None) -> Column:
    """array<struct(at, until, match[, value])> of a pattern's matches, in order.

    What ``split`` leaves between the matches gives their places."""
    values = [F.regexp_extract_all(text, F.lit(pattern), F.lit(group))] if group is not None else []
    names = ["gap", "match", "value"][:2 + len(values)]
    zipped = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), *values)
    each = F.filter(F.transform(zipped, lambda z: F.struct(*(z[str(i)].alias(n) for i, n in enumerate(names)))),
                    lambda z: z["match"].isNotNull())  # the text after the last match has none
    found = f"struct<at:int,until:int,match:string{',value:string' if values else ''}>"

    def placed(each: Column) -> Column:
        lengths = F.transform(each, lambda z: z["gap"] + F.length(z["match"]))

        def place(z: Column, before: Column) -> Column:
            at = before + z["gap"]
            return F.struct(at.alias("at"), (at + F.length(z["match"])).alias("until"), *(z[n].alias(n) for n in names[1:]))
        return let(running(lengths, lambda a, b: a + b), lambda starts: F.transform(each, lambda z, i: place(z, F.get(starts, i))))

    return F.when(F.rlike(text, F.lit(pattern)), let(each, placed)).otherwise(F.array().cast(f"array<{found}>"))


def uncovered(spans: Column, base: Column) -> Column:
    """The spans that lie in no base span: in order of start, base first, none before has an end as far as theirs."""
    def event(no: int):
        return lambda x: F.struct(x["at"].alias("at"), F.lit(no).alias("own"), x["until"].alias("until"), x["kind_no"].alias("kind_no"),
                                  x["kind"].alias("kind"))

    def kept(events: Column) -> Column:
        ends = F.transform(events, lambda e: F.when(e["own"] == 0, e["until"]).otherwise(0))
        return let(running(ends, lambda a, b: F.greatest(a, b)), lambda furthest: F.filter(
            events, lambda e, i: (e["own"] == 1) & (F.get(furthest, i) < e["until"])))

    events = F.array_sort(F.concat(F.transform(base, event(0)), F.transform(spans, event(1))))
    bare = F.transform(let(events, kept), lambda e: F.struct(*(e[n].alias(n) for n in ("at", "kind_no", "until", "kind"))))
    return F.when(F.size(spans) > 0, bare).otherwise(F.array().cast(SPAN))


def _spans(found: Column, no: int, kind: str) -> Column:
    return F.transform(found, lambda z: F.struct(z["at"].alias("at"), F.lit(no).alias("kind_no"),
                                                 z["until"].alias("until"), F.lit(kind).alias("kind")))


def base_spans(text: Column) -> list[Column]:
    """The arrays of assign, access and hex spans."""
    assign = F.filter(located(text, ASSIGN, 2), lambda z: F.length(z["value"]) >= ASSIGN_VALUE)
    # a run is maximal, so asking for its shortest length in the pattern leaves the same runs
    access = located(text, ACCESS[:-1] + "{%d,}" % (ACCESS_LENGTH - 4))
    runs = located(text, HEX[:-1] + "{%d,}" % HEX_LENGTH)
    return [_spans(assign, 0, "assign"), _spans(access, 1, "access"), _spans(runs, 2, "hex")]


def _x_log_x(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


def hot_windows(s: Column, alphabet: str, window: int, bits: float) -> Column:
    """array<struct(at, until)>: the merged windows of ``s`` with an entropy of ``bits`` or more."""
    most = window * (F.log2(F.lit(window)) - bits) + ROUNDING  # S at the threshold
    blank = F.array_repeat(F.lit(0), len(alphabet))
    spans = "array<struct<at:int,until:int>>"

    def over(places: Column) -> Column:  # number of each character of s in the alphabet, from 0
        def step(acc: Column, i: Column) -> Column:
            enters, leaves = places[i], F.when(i >= window, F.get(places, i - window)).otherwise(F.lit(-1))
            less = F.when(leaves >= 0, F.get(acc["counts"], leaves)).otherwise(F.lit(1))
            more = F.get(acc["counts"], enters) - F.when(leaves == enters, 1).otherwise(0)
            s2 = acc["s"] - _x_log_x(less) + _x_log_x(less - 1) - _x_log_x(more) + _x_log_x(more + 1)
            counts = F.transform(acc["counts"], lambda c, k: c + F.when(k == enters, 1).otherwise(0)
                                 - F.when(k == leaves, 1).otherwise(0))
            hot = (i >= window - 1) & (s2 <= most)
            at, until = i - (window - 1), i + 1
            begins = hot & (acc["until"] < at)  # apart from the span that grows, which is put away
            return F.struct(counts.alias("counts"), s2.alias("s"),
                            F.when(begins, at).otherwise(acc["at"]).alias("at"),
                            F.when(hot, until).otherwise(acc["until"]).alias("until"),
                            F.when(begins, put_away(acc)).otherwise(acc["out"]).alias("out"))

        def put_away(acc: Column) -> Column:
            last = F.array(F.struct(acc["at"].alias("at"), acc["until"].alias("until"))).cast(spans)
            return F.when(acc["until"] >= 0, F.concat(acc["out"], last)).otherwise(acc["out"])

        start = F.struct(blank.alias("counts"), F.lit(0.0).alias("s"), F.lit(-1).alias("at"), F.lit(-1).alias("until"),
                         F.array().cast(spans).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), start, step, put_away)

    chars = F.filter(F.split(s, ""), lambda c: c != "")
    return let(F.transform(chars, lambda c: F.instr(F.lit(alphabet), c) - 1), over)


def entropy_spans(text: Column, base: Column, allow: list[str] = ALLOW) -> list[Column]:
    """The spans each character class adds to ``base``."""
    out = []
    for no, (kind, alphabet, window, bits) in enumerate(CLASSES, 3):
        pattern = "[" + "".join("\\" + c if c in "-[]^" else c for c in alphabet) + "]{%d,}" % window

        def wanted(z: Column) -> Column:
            ok = F.rlike(z["match"], F.lit("[0-9]")) & F.rlike(z["match"], F.lit("[A-Za-z]"))
            for a in allow:
                ok = ok & ~F.rlike(z["match"], F.lit(a))
            return ok

        spans = F.flatten(F.transform(F.filter(located(text, pattern), wanted), lambda z: F.transform(
            hot_windows(z["match"], alphabet, window, bits),
            lambda w: F.struct((z["at"] + w["at"]).alias("at"), F.lit(no).alias("kind_no"),
                               (z["at"] + w["until"]).alias("until"), F.lit(kind).alias("kind")))))
        out.append(let(spans, lambda found: uncovered(found, base)))
    return out


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: list[str] = ALLOW) -> DataFrame:
    """(id, text, assign, access, hex, base, spans): the arrays of spans (at, kind_no, until, kind) of each
    row; base and spans in order of start, then kind."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    assign, access, runs = base_spans(F.col("text"))
    found = rows.select("id", "text", assign.cast(SPAN).alias("assign"), access.cast(SPAN).alias("access"),
                        runs.cast(SPAN).alias("hex"))
    found = found.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    more = entropy_spans(F.col("text"), F.col("base"), allow)
    return found.withColumn("spans", F.array_sort(F.concat("base", *(m.cast(SPAN) for m in more))))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"], s["until"])), ",")
