"""Line dedup by a log-template tree.

Lines go down a tree of fixed depth: number of tokens, then the leading
tokens, with tokens that hold digits as one variable field; a line with too
few other tokens is taken as it is. Within a leaf, lines that agree but for a
few places share a template, which has variable fields there. A template that
occurs in several documents stays in the first place only. All of it is Spark
SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm.common import fresh, stored

DEPTH = 3
CONSTANT = 0.8
#: Share of tokens without digits from which lines that differ in their digits are alike.
WORDED = 0.75
#: Lines below this number of tokens have all pairs of places tried as fields.
PAIRED = 15
FIELD = "<*>"
#: Places of lines up to this number (44 bytes each) are sent to all tasks; more meet the documents in a shuffle.
SENT = 1_000_000


def _digest(*parts: Column) -> Column:
    """128 bits of the values, nulls apart from empty texts."""
    return F.unhex(F.md5(F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("0")) for p in parts])))


def _masked(rows: DataFrame, raw: str) -> DataFrame:
    """The rows with `line` instead of a raw line: single spaces between tokens, and fields for those with digits.

    `digits` tells whether it still holds some, as it has too few other tokens.

    Step by step after the explode, so that each step is compiled and done once a line; inside a lambda it is neither.
    """
    line, rest = F.col(raw), [c for c in rows.columns if c != raw]
    uneven = F.lit(False)
    for mark in ("  ", "\t", "\r", "\f", "\x0b"):
        uneven |= F.contains(line, F.lit(mark))
    even, marked = F.col("even"), F.col("marked")
    rows = rows.select(*rest, F.trim(F.when(uneven, F.regexp_replace(line, r"[ \t\r\f\x0b]+", " ")).otherwise(line)).alias("even"))
    fields = F.regexp_replace(even, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)
    rows = rows.select(*rest, "even", F.when(even.rlike("[0-9]"), fields).alias("marked"))
    alike = marked.isNotNull() & _within(_fields(marked), _words(marked), WORDED)
    rows = rows.select(*rest, "even", "marked", alike.alias("alike"))
    return rows.select(*rest, F.when(F.col("alike"), marked).otherwise(even).alias("line"), (marked.isNotNull() & ~F.col("alike")).alias("digits"))


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _fields(line: Column) -> Column:
    """How many tokens are fields; runs of spaces do not occur, so each has a space of its own once they are doubled."""
    padded = F.concat(F.lit(" "), F.replace(line, F.lit(" "), F.lit("  ")), F.lit(" "))
    return ((F.length(padded) - F.length(F.replace(padded, F.lit(f" {FIELD} "), F.lit("")))) / (len(FIELD) + 2)).cast("int")


def _within(fields: Column, words: Column, constant: float) -> Column:
    """Whether the other tokens make up the share `constant`; in whole numbers, as 0.2 * 5 is below 1 otherwise."""
    return fields * 10_000 <= words * round((1 - constant) * 10_000)


def _leaf(line: Column, depth: int) -> Column:
    """Token count and leading tokens of a masked line."""
    return F.concat_ws(" ", (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))).cast("string"), F.substring_index(line, " ", depth))


def _lines(docs: DataFrame, key: str, text: str, depth: int) -> DataFrame:
    """`rid` (of the document), `key`, `pos`, `line`, `digits` (it holds some), `h` (the line), `leaf`; lines without tokens are left out."""
    # the digest comes first, or it would be computed for each line of the document; the outer form, because Spark
    # would compute the lines twice to leave out empty arrays, of which there are none
    named = docs.select(_digest(F.col(key), F.col(text)).alias("rid"), F.col(key).alias("key"), F.col(text).alias("text"))
    cut = named.select("rid", "key", F.posexplode_outer(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "raw"))
    # told by the raw line, or Spark would mask it once more to leave out those that are empty then
    cut = _masked(cut.where(F.btrim("raw", F.lit(" \t\r\f\x0b")) != ""), "raw")
    return cut.select("*", _digest(F.col("line")).alias("h"), F.xxhash64(_leaf(F.col("line"), depth)).alias("leaf"))


def _texts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """`leaf`, `h`, `line` of the lines at some places; only documents that hold one are parted again, and only its lines masked."""
    at = wanted.groupBy("rid").agg(F.collect_list(F.struct("pos", "leaf", "h")).alias("at"))
    named = docs.select(_digest(F.col(key), F.col(text)).alias("rid"), F.col(text).alias("text"))
    found = named.join(F.broadcast(at) if wanted.count() <= SENT else at, "rid")
    lines = F.transform(F.array(F.split("text", "\n", -1)), lambda cut: F.transform("at", lambda a: F.struct(
        a["leaf"].alias("leaf"), a["h"].alias("h"), cut[a["pos"]].alias("raw"))))[0]
    return _masked(found.select(F.explode_outer(lines).alias("x")).select("x.*"), "raw")


def _generalised(docs: DataFrame, known: DataFrame, key: str, text: str, depth: int, constant: float) -> DataFrame:
    """`h`, `template` of the lines that have variable fields besides those with digits.

    Each line tries as fields: each place, each pair of places (lines below
    `PAIRED` tokens), and its rarest places together, two or more. Of the
    patterns that several lines of the leaf have, it takes the one with the
    most lines, or one that others took if nobody else takes that.

    Lines that share a pattern share all tokens that are not its fields. So
    patterns that leave out one of the line's lone tokens, which no other line
    of the leaf has at their place, are never built, and only the other tokens
    are gathered by line again.
    """
    crowded = known.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1").select("leaf")
    # lines that still hold digits have too few constants to be generalised
    wanted = stored(known.where(~F.col("digits")).join(crowded, "leaf", "left_semi").select("leaf", "h", F.col("first.rid").alias("rid"), F.col("first.pos").alias("pos")))
    distinct = _texts(docs, wanted, key, text).groupBy("leaf", "h").agg(F.first("line").alias("line"))  # repeated documents
    # once per distinct line, and not per token below
    texts = stored(distinct.select("leaf", "h", "line", _words(F.col("line")).alias("words"), _fields(F.col("line")).alias("had")))
    open_ = F.floor(F.col("words") * round((1 - constant) * 10_000) / 10_000) - F.col("had")
    texts = texts.withColumn("room", open_.cast("int")).where("room > 0 or had > 0")
    tokens = texts.select("leaf", "h", "room", "had", "words", F.posexplode(F.split("line", " ")).alias("place", "token"))
    tokens = tokens.where(F.col("place") >= depth)
    # a pattern's hash is the exclusive or over its places, so that a field changes it by `delta`
    digest = F.xxhash64("place", "token")
    tokens = tokens.select("*", digest.alias("x"), F.when(F.col("token") != FIELD, digest.bitwiseXOR(F.xxhash64("place", F.lit(FIELD)))).alias("delta"))
    wholes = tokens.groupBy("leaf", "h").agg(
        *[F.max(c).alias(c) for c in ("room", "had", "words")],
        F.bit_xor("x").alias("whole"), F.count("delta").alias("free"), F.coalesce(F.bit_xor("delta"), F.lit(0).cast("long")).alias("deltas"))
    support = tokens.where(F.col("delta").isNotNull()).select(
        "leaf", "h", "place", "delta", F.count("*").over(Window.partitionBy("leaf", "x")).alias("n")).where("n > 1")
    line = Window.partitionBy("leaf", "h")
    rows = wholes.join(support, ["leaf", "h"], "left").select(
        "*", (F.col("free") - F.count("delta").over(line)).cast("int").alias("lone"),
        F.col("whole").bitwiseXOR(F.col("deltas")).bitwiseXOR(F.coalesce(F.bit_xor("delta").over(line), F.lit(0).cast("long"))).alias("base"))
    rows = rows.where(F.col("lone") <= F.greatest("room", F.lit(0)))
    rarest = line.orderBy("n", "place")
    before = rarest.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*", F.row_number().over(rarest).alias("j"),
        F.bit_xor("delta").over(rarest.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.collect_list(F.when((F.col("words") < PAIRED) & (F.col("room") > 1) & (F.col("lone") == 0), F.col("delta"))).over(before).alias("others"))

    def pattern(when: Column, fields, start: str, *deltas: Column) -> Column:
        sig = F.col(start)
        for delta in deltas:
            sig = sig.bitwiseXOR(delta)
        return F.when(when, F.struct(F.lit(fields).cast("int").alias("fields"), sig.alias("sig")))

    # `base` has the lone tokens as fields, `j` is the row's place among the other tokens of its line
    lone, some, pairs, most = F.col("lone"), F.col("delta").isNotNull(), F.col("words") < PAIRED, F.col("lone") + F.col("j")
    tried = F.array_compact(F.concat(
        F.array(
            pattern((F.col("j") == 1) & (F.col("had") > 0) & (lone == 0), 0, "whole"),
            pattern((F.col("j") == 1) & (lone > 0) & (lone <= F.col("room")) & (~pairs | (lone <= 2)), lone, "base"),
            pattern(some & (lone == 0) & (F.col("room") > 0), 1, "whole", F.col("delta")),
            pattern(some & ~pairs & (most > 1) & (most <= F.col("room")), most, "base", F.col("run")),
            pattern(some & pairs & (lone == 1) & (F.col("room") > 1), 2, "base", F.col("delta")),
        ),
        F.transform("others", lambda other: pattern(some, 2, "whole", F.col("delta"), other)),
    ))
    # the outer form, or the patterns would be built once more to leave out rows without any
    patterns = rows.select("leaf", "h", F.explode_outer(tried).alias("p")).where("p is not null").select("leaf", "h", "p.fields", "p.sig")
    choices = stored(patterns.select("*", F.count("*").over(Window.partitionBy("leaf", "sig")).alias("n")).where("n > 1"))
    best = F.min(F.struct((-F.col("n")).alias("most"), "fields", "sig")).alias("best")
    first = stored(choices.groupBy("leaf", "h").agg(best).select("leaf", "h", "best.sig"))
    taken = stored(first.groupBy("leaf", "sig").agg(F.count("*").alias("takers")))
    settled = first.join(taken.where("takers > 1"), ["leaf", "sig"]).select("leaf", "h", "sig")
    left = first.join(taken.where("takers = 1"), ["leaf", "sig"]).select("leaf", "h")
    late = choices.join(left, ["leaf", "h"]).join(taken.where("takers > 1").select("leaf", "sig"), ["leaf", "sig"])
    found = settled.unionByName(late.groupBy("leaf", "h").agg(best).select("leaf", "h", "best.sig"))
    return found.select("h", _digest(F.col("leaf"), F.col("sig")).alias("template"))


def duplicate_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, constant: float = CONSTANT) -> DataFrame:
    """`rid`, `drop` (sorted line numbers from 0): what each document loses, for those that lose a line."""
    lines = _lines(docs, key, text, depth)
    places = stored(lines.drop("line"))
    # null keys come after all others
    first = F.struct(F.col("key").isNull().alias("null"), F.col("key").alias("key"), F.col("rid").alias("rid"), F.col("pos").alias("pos"))
    known = stored(places.groupBy("leaf", "h", "digits").agg(F.min(first).alias("first"), F.min("rid").alias("low"), F.max("rid").alias("high")))
    wider = stored(_generalised(docs, known, key, text, depth, constant))
    # each side has one row per line; a line without further fields is its own template, and recurs if it does itself
    place = [F.col("first.rid").alias("first_rid"), F.col("first.pos").alias("first_pos")]
    own = known.where("low <> high").join(wider, "h", "left_anti").select("h", *place)
    templated = stored(known.join(wider, "h").select("h", "template", "first", "low", "high"))
    spread = templated.groupBy("template").agg(F.min("first").alias("first"), F.min("low").alias("low"), F.max("high").alias("high"))
    recurring = spread.where("low <> high").select("template", "first")
    gone = stored(own.unionByName(templated.select("h", "template").join(recurring, "template").select("h", *place)))
    dropped = places.join(gone, "h").where((F.col("rid") != F.col("first_rid")) | (F.col("pos") != F.col("first_pos")))
    return dropped.groupBy("rid").agg(F.array_sort(F.collect_set("pos")).alias("drop"))


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", dropped: str = "dropped_lines", depth: int = DEPTH, constant: float = CONSTANT
) -> DataFrame:
    """The documents without the lines whose template occurred before, and how many lines each lost.

    Lines are parted by newlines. A template recurs if lines of at least two
    documents have it; it stays at the first place by key (nulls last), digest
    of key and text, and line number, so a text that only copies others loses
    all of its lines and becomes empty. Lines that recur within one document
    only, and lines without tokens, stay. Rows that repeat both key and text
    are one document and lose the same lines. Null texts stay null. Other
    columns pass through; an empty table stays empty.
    """
    rid, drop = fresh(docs, "rid", "drop")
    count, = fresh(docs, dropped)
    lost = stored(duplicate_lines(docs, key, text, depth, constant)).select(F.col("rid").alias(rid + "_"), F.col("drop").alias(drop))
    joined = docs.withColumn(rid, _digest(F.col(key), F.col(text))).join(lost, F.col(rid) == F.col(rid + "_"), "left")
    # the lines are bound by a transform of one, so that they are split once
    kept = F.transform(F.array(F.split(F.col(text), "\n", -1)), lambda lines: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop)), lambda i: lines[i]), "\n"))[0]
    shorter = F.when(F.col(drop).isNull(), F.col(text)).otherwise(kept)
    columns = [shorter.alias(c) if c == text else F.col(c) for c in docs.columns]
    return joined.select(*columns, F.coalesce(F.size(drop), F.lit(0)).alias(count))
