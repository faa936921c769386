"""Chat formatting by quotation linking.  DataFrame operations only.

1. A line's quote level is the number of ``>`` marks before it.  A passage is a run of lines of one level without a
   blank line between them.
2. A passage, and each of its lines, is normalised (lower case, white space collapsed) and hashed; a quotation that
   was wrapped anew still matches as a passage, one that was shortened still matches by its lines.
3. Quoted hashes are joined to the original in the same conversation: the earliest message that has the hash
   without a quote mark.  One row per conversation and hash is left of the originals before the join, so a line that
   everyone writes doesn't multiply.  A message answers the original of its outermost quotations; of several
   the one with the most quoted words, then the latest.
4. Each message's thread (the first message of its chain of answers) and depth follow by pointer doubling.
5. Quoted lines and the lines that announce them are taken out.  Quotations without an original are handed back
   in a column of their own, so no text is lost.

Sorted by conversation, root, depth and turn, each message comes after the one it answers; messages that quote nothing
are roots, in the order of their turns.

Defined results: a null or empty text has no lines; rows with equal conversation and turn are versions of
one message; a row without conversation or turn quotes nothing and is its own root; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let

_MARKS = r"^((?:[ \t]*>)+)"
#: lines that announce a quotation
_ANNOUNCES = r"(?i)^\s*(on\b.*\bwrote:|.*\bschrieb:|.*\ba écrit\s?:|.*\bescribió:|-+\s*original message\s*-+)\s*$"


def _words(body: Column) -> Column:
    plain = F.lower(body)
    for blank in "\t\r":
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def lines(text: Column) -> Column:
    """array<struct(level, body, raw)>: quote level and what follows the marks."""
    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 1)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.trim(F.substr(line, F.length(marks) + 1)).alias("body"), line.alias("raw"))
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), parsed)


def passages(parsed: Column) -> Column:
    """array<struct(level, lines)> of the runs of one level, blank lines left out.

    Lines are written one after another with a mark before each that begins a passage, and cut there."""
    def written(all_lines: Column) -> Column:
        def one(line: Column, i: Column) -> Column:
            level = F.when(line["body"] == "", -1).otherwise(line["level"])
            before = F.get(all_lines, i - 1)
            same = (i > 0) & (level >= 0) & (before["body"] != "") & (before["level"] == level)
            body = F.translate(line["body"], "\x01\x02", "  ")
            return F.when(same, F.concat(F.lit("\n"), body)).otherwise(
                F.concat(F.lit("\x01"), level.cast("string"), F.lit("\x02"), body))
        return F.split(F.array_join(F.transform(all_lines, one), ""), "\x01")

    cut_up = F.transform(let(parsed, written), lambda p: F.split(p, "\x02"))
    fine = F.filter(cut_up, lambda p: (F.size(p) == 2) & (p[0] != "-1"))
    return F.transform(fine, lambda p: F.struct(p[0].cast("int").alias("level"), F.split(p[1], "\n").alias("lines")))


def units(messages: DataFrame) -> DataFrame:
    """(conv, turn, passage, level, body, k1, k2, n): every passage and every line of a passage of several."""
    p = messages.select("conv", "turn", F.posexplode(passages(lines(F.col("text")))).alias("passage", "p"))
    whole = F.array_join("p.lines", " ")
    each = p.select("conv", "turn", "passage", F.col("p.level").alias("level"), F.array_join("p.lines", "\n").alias("body"),
                    F.explode(F.when(F.size("p.lines") > 1, F.concat(F.array(whole), F.col("p.lines")))
                              .otherwise(F.array(whole))).alias("unit"))
    hashed = each.select("conv", "turn", "passage", "level", "body", let(_words(F.col("unit")), lambda w: F.struct(
        F.xxhash64(w).alias("k1"), F.xxhash64(F.lit(1), w).alias("k2"), F.size(w).alias("n"))).alias("h"))
    return hashed.select("conv", "turn", "passage", "level", "body", F.col("h.k1").alias("k1"), F.col("h.k2").alias("k2"),
                         F.col("h.n").alias("n"))


def link(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, turn, parent) of the messages that quote an original, and (conv, turn, unlinked, n_quotes) of all that
    quote: the passages without an original, and the number of passages."""
    found = cut(units(messages.where(F.col("conv").isNotNull() & F.col("turn").isNotNull())))
    originals = cut(found.where("level = 0").groupBy("conv", "k1", "k2").agg(F.min("turn").alias("original"))
                    .select(F.col("conv").alias("c"), F.col("k1").alias("o1"), F.col("k2").alias("o2"), "original"))
    quoted = cut(found.where("level > 0").join(
        originals, (F.col("conv") == F.col("c")) & (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2"))
        & (F.col("original") < F.col("turn")), "left"))
    votes = quoted.where("original is not null").groupBy("conv", "turn", "level", "original").agg(F.sum("n").alias("words"))
    parents = votes.groupBy("conv", "turn").agg(F.min(F.struct(
        "level", (-F.col("words")).alias("words"), (-F.col("original")).alias("late"))).alias("best")) \
        .select("conv", "turn", (-F.col("best.late")).alias("parent"))
    each = quoted.groupBy("conv", "turn", "passage", "body").agg(F.count("original").alias("hits"))
    rest = each.groupBy("conv", "turn").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("hits") == 0, F.struct("passage", "body")))),
                    lambda p: p["body"]).alias("unlinked"), F.count("*").alias("n_quotes"))
    return cut(parents), cut(rest)


def roots(parents: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of the messages that have a parent."""
    at = cut(parents.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = at.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("root").alias("up"), F.col("depth").alias("more"))
        new = cut(at.join(up, (F.col("conv") == F.col("c")) & (F.col("root") == F.col("t")), "left").select(
            "conv", "turn", F.coalesce("up", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("up").isNotNull().alias("moved")))
        at = new.drop("moved")
        if new.where("moved").isEmpty():
            return at


def unquoted(text: Column) -> Column:
    """The text without quoted lines and without lines that announce a quotation."""
    def kept(all_lines: Column) -> Column:
        def own(line: Column, i: Column) -> Column:
            announces = F.rlike(line["raw"], F.lit(_ANNOUNCES)) & (F.coalesce(F.get(all_lines, i + 1)["level"], F.lit(0)) > 0)
            return (line["level"] == 0) & ~announces
        return F.filter(all_lines, own)
    return F.trim(F.array_join(F.transform(let(lines(text), kept), lambda x: x["raw"]), "\n"))


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, turn, role, parent, root, depth, n_quotes, text, unlinked), one row per input row, in reply order."""
    messages = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                         F.col(text_col).alias("text"))
    parents, rest = link(messages)
    chain = roots(parents)
    tree = cut(chain.join(parents, ["conv", "turn"]).join(rest, ["conv", "turn"], "full").select(
        F.col("conv").alias("c"), F.col("turn").alias("t"), "parent", "root", "depth", "unlinked", "n_quotes"))
    out = messages.join(tree, (F.col("conv") == F.col("c")) & (F.col("turn") == F.col("t")), "left").select(
        "conv", "turn", "role", "parent", F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), unquoted(F.col("text")).alias("text"),
        F.coalesce("unlinked", F.array().cast("array<string>")).alias("unlinked"))
    return out.orderBy("conv", "root", "depth", "turn")
