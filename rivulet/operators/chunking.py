"""Cutting documents into chunks: by characters, words, sentences, paragraphs or recursively.

Offsets count code points. Character windows are a native expression. The other
strategies walk along one document, so they run as Arrow batches of documents;
no document leaves its partition.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivulet.functions.text import WHITESPACE, rows_of, trimmed
from rivulet.records import unnest

CHUNK = T.StructType([T.StructField("text", T.StringType()), T.StructField("start_offset", T.IntegerType()),
                      T.StructField("end_offset", T.IntegerType())])
STRATEGIES = ("fixed-size", "sentence", "paragraph", "recursive")


def _char_windows(text: Column, size: int, step: int, trim: bool) -> Column:
    """Windows of `size` characters every `step`. Each match consumes one step and
    looks ahead over the window, so the text is read once."""
    found = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{size}}})).{{1,{step}}}"), F.lit(1))
    return F.transform(
        found,
        lambda w, i: F.struct(
            (trimmed(w) if trim else w).alias("text"),
            (i * step).alias("start_offset"),
            (i * step + F.length(w)).alias("end_offset"),
        ),
    )


Piece = tuple[str, int, int]


def _groups(lengths: Sequence[int], size: int, overlap: int, keep_single: bool) -> Iterator[tuple[int, int, int]]:
    """Greedy packing as (first, new, end): pieces first..end-1, of which those from `new` on are new.

    A chunk takes pieces while their lengths fit into `size`, at least one new
    piece. The next chunk repeats the trailing pieces that reach `overlap`.
    """
    upto = [0, *accumulate(lengths)]
    first = new = 0
    while new < len(lengths):
        end = max(new + 1, bisect_right(upto, upto[first] + size) - 1)
        yield first, new, end
        repeat = end
        if overlap > 0 and (keep_single or end - first > 1):
            target = min(overlap, upto[end] - upto[first])
            repeat = max(first, bisect_right(upto, upto[end] - target) - 1)
        first, new = repeat, end


def _packed(pieces: list[Piece], joiner: str, size: int, overlap: int, trim: bool) -> list[Piece]:
    made = []
    for first, _, end in _groups([len(p[0]) for p in pieces], size, overlap, keep_single=False):
        text = joiner.join(p[0] for p in pieces[first:end])
        made.append((text.strip(WHITESPACE) if trim else text, pieces[first][1], pieces[end - 1][2]))
    return made


def _word_windows(text: str, size: int, step: int) -> list[Piece]:
    found = [m.span() for m in re.finditer(f"[^{re.escape(WHITESPACE)}]+", text)]
    made = []
    for i in range(0, len(found), step):
        part = found[i : i + size]
        made.append((" ".join(text[a:b] for a, b in part), part[0][0], part[-1][1]))
    return made


def _sentences(text: str, delimiters: str, trim: bool, least: int) -> list[Piece]:
    marks, spaces = re.escape(delimiters), re.escape(WHITESPACE)
    found = re.finditer(f"[^{marks}]*[{marks}][{spaces}]*|[^{marks}]+", text)
    pieces = [(m.group().strip(WHITESPACE) if trim else m.group(), m.start(), m.end()) for m in found]
    return [p for p in pieces if len(p[0]) >= least]


def _paragraphs(text: str, separator: str, trim: bool, least: int) -> list[Piece]:
    pieces, at = [], 0
    for part in text.split(separator):
        pieces.append((part.strip(WHITESPACE) if trim else part, at, at + len(part)))
        at += len(part) + len(separator)
    return [p for p in pieces if len(p[0]) >= least]


def _fitting(text: str, at: int, separators: Sequence[str], size: int, overlap: int) -> Iterator[Piece]:
    """Pieces of at most `size` characters, cut at the first separator that helps."""
    if len(text) <= size:
        if text:
            yield text, at, at + len(text)
    elif not separators:
        for i in range(0, len(text), size - overlap):
            yield text[i : i + size], at + i, at + min(i + size, len(text))
    else:
        mark = separators[0]
        # every part keeps the separator that ends it
        parts = re.findall(f"(?s).*?{re.escape(mark)}|.+$", text) if mark else list(text)
        if len(parts) <= 1:
            yield from _fitting(text, at, separators[1:], size, overlap)
            return
        for part in parts:
            yield from _fitting(part, at, separators[1:], size, overlap)
            at += len(part)


def _recursive(text: str, separators: Sequence[str], size: int, overlap: int, trim: bool, least: int, compat: bool) -> list[Piece]:
    raw = list(_fitting(text, 0, separators, size, overlap))
    if compat and trim:
        raw = [(p.strip(WHITESPACE), a, b) for p, a, b in raw]
    if compat:
        raw = [p for p in raw if len(p[0]) >= least]
    lengths = [len(p[0]) for p in raw]
    upto = [0, *accumulate(lengths)]
    made = []
    for first, new, end in _groups(lengths, size, overlap, keep_single=True):
        joined = "".join(p[0] for p in raw[first:end])
        # compat: the start after an overlap is estimated from trimmed lengths
        start = raw[new][1] - (upto[new] - upto[first]) if compat else raw[first][1]
        stop = start + upto[end] - upto[first] if compat else raw[end - 1][2]
        made.append((joined.strip(WHITESPACE) if trim else joined, start, stop))
    return [p for p in made if len(p[0]) >= least]


def _packer(strategy: str, size: int, overlap: int, trim: bool, least: int, delimiters: str, separator: str,
            separators: Sequence[str], compat: bool) -> Callable[[str], list[Piece]]:
    def chunks(text: str) -> list[Piece]:
        if strategy == "words":
            return _word_windows(text, size, size - overlap)
        if strategy == "sentence":
            return _packed(_sentences(text, delimiters, trim, least), " ", size, overlap, trim)
        if strategy == "paragraph":
            return _packed(_paragraphs(text, separator, trim, least), separator, size, overlap, trim)
        return _recursive(text, separators, size, overlap, trim, least, compat)

    return chunks


def chunk(df: DataFrame, text_col: str = "text", strategy: str = "fixed-size", size: int = 1000, overlap: int = 200,
          unit: str = "characters", min_size: int = 1, trim: bool = True, delimiters: str = ".!?",
          separator: str = "\n\n", separators: Sequence[str] = ("\n\n", "\n", " ", ""), compat: bool = False,
          skip_empty: bool = True, metadata: bool = False, prefix: str = "chunk_") -> DataFrame:
    """One row per chunk: `chunk`, `chunk_index`, `chunk_total`, `start_offset`, `end_offset`.

    `compat` joins the trimmed pieces of the recursive strategy without a
    space; by default pieces keep their separators. Empty documents give no
    rows unless `skip_empty` is off. `metadata` moves the numbers into a
    `headers` map next to the record's topic, partition and offset.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, expected one of {STRATEGIES}")
    if size <= 0 or overlap < 0:
        raise ValueError("size must be positive and overlap not negative")
    if strategy in ("fixed-size", "recursive") and overlap >= size:
        raise ValueError("overlap must be less than size")
    text = F.col(text_col).cast("string")
    kept = [c for c in df.columns if c != text_col]
    if strategy == "fixed-size" and unit == "characters":
        staged = df.withColumn("__chunks", _char_windows(text, size, size - overlap, trim))
    else:
        packer = _packer("words" if strategy == "fixed-size" else strategy, size, overlap, trim, min_size, delimiters, separator, separators, compat)
        staged = rows_of(df, kept if skip_empty else df.columns, text, packer, CHUNK, "__chunks")
    found = F.col("__chunks")
    if strategy == "fixed-size":
        found = F.filter(found, lambda c: F.length(c["text"]) >= min_size)
    nothing = F.array(F.struct(F.coalesce(text, F.lit("")).alias("text"), F.lit(0).alias("start_offset"), F.lit(0).alias("end_offset")))
    if not skip_empty:
        found = F.when(F.length(F.coalesce(text, F.lit(""))) == 0, nothing).otherwise(found)
    staged = staged.withColumn("__chunks", found)
    counted = staged.withColumn("chunk_total", F.size("__chunks"))
    out = unnest(counted, [*kept, "chunk_total"], "__chunks", "chunk_index", "__chunk")
    out = out.select(*kept, F.col("__chunk.text").alias("chunk"), "chunk_index", "chunk_total", "__chunk.start_offset", "__chunk.end_offset")
    if skip_empty:
        out = out.where(trimmed(F.col("chunk")) != "")
    return _with_headers(out, prefix) if metadata else out


def _with_headers(df: DataFrame, prefix: str) -> DataFrame:
    values = {"index": "chunk_index", "total": "chunk_total", "start_offset": "start_offset", "end_offset": "end_offset",
              "original_topic": "topic", "original_partition": "partition", "original_offset": "offset"}
    pairs = [x for name, c in values.items() if c in df.columns for x in (F.lit(prefix + name), F.col(c).cast("string").cast("binary"))]
    made = F.create_map(*pairs)
    if "headers" in df.columns:
        own = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,binary>")), lambda k, _: ~F.map_contains_key(made, k))
        made = F.map_concat(own, made)
    return df.withColumn("headers", made).drop("chunk_index", "chunk_total", "start_offset", "end_offset")
