"""Files as records: delimited, columnar, JSON, lines and whole objects."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rivulet.functions.text import trimmed
from rivulet.operators.routing import split
from rivulet.records import kind_of, node_at, parsed, unnest


def listed(paths: str | Sequence[str]) -> list[str]:
    """Paths given as a list or joined by `;`."""
    parts = paths.split(";") if isinstance(paths, str) else paths
    return [p.strip() for p in parts if p.strip()]


def existing(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The paths that can be read; a missing one is left out."""
    found = []
    for path in listed(paths):
        try:
            spark.read.text(path).schema  # noqa: B018 - resolving the path is the check
            found.append(path)
        except AnalysisException:
            continue
    return found


def read_csv(spark: SparkSession, paths: str | Sequence[str], delimiter: str = ",", header: bool = True,
             encoding: str = "utf-8", trim: bool = False, quoted_newlines: bool = True,
             key_field: str | None = None) -> DataFrame:
    """Delimited files as text columns, with `source_file`; without a header the columns are `field_0`, `field_1`, ...

    Each file's own header names its columns; files are read per header and
    joined by column name, with null where a file lacks a column. Blank lines
    are dropped. Values with line breaks need whole-file parsing; turn
    `quoted_newlines` off to let Spark split large files.
    """
    found = existing(spark, paths)
    if not found:
        return spark.createDataFrame([], T.StructType([T.StructField("source_file", T.StringType())]))
    options = dict(
        sep=delimiter, header=header, encoding=encoding, multiLine=quoted_newlines, quote='"', escape='"',
        ignoreLeadingWhiteSpace=trim, ignoreTrailingWhiteSpace=trim, inferSchema=False)
    out = None
    for group in _by_header(spark, found, encoding) if header else [found]:
        rows = spark.read.options(**options).csv(group)
        names = {c: f"field_{i}" for i, c in enumerate(rows.columns)} if not header else {}
        columns = [F.col(f"`{c}`").alias(names.get(c, c)) for c in rows.columns]
        rows = rows.select(*columns, F.col("_metadata.file_path").alias("source_file"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.withColumn("key", F.col(key_field)) if key_field else out


def _by_header(spark: SparkSession, paths: list[str], encoding: str) -> list[list[str]]:
    """The files in groups of equal first lines. One file needs no look; of more, only first blocks are searched."""
    lines = spark.read.option("encoding", encoding).text(paths)
    files = lines.inputFiles()
    if len(files) <= 1:
        return [paths]
    first = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                         F.monotonically_increasing_id().alias("at"))
    heads = first.where("start = 0 AND trim(value) <> ''").groupBy("file").agg(F.min_by("value", "at").alias("head"))
    groups = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy(F.col("files")[0])
    return [[unquote(f) for f in row["files"]] for row in groups.collect()] or [paths]  # file names, which the driver lists anyway


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Columnar files with `source_file` and `row_index`, the row's place in its file."""
    rows = spark.read.parquet(*listed(paths))
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("row_index"))


def read_json_objects(spark: SparkSession, path: str) -> DataFrame:
    """Objects holding JSON: a root array gives a row per element, anything else one row with the text."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("key"))
    return split(whole, ".")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One row per non-empty line, trimmed, keyed by its file."""
    lines = spark.read.text(path).select(trimmed(F.col("value")).alias("value"), F.col("_metadata.file_path").alias("key"))
    return lines.where("value <> ''")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Every object as one value, keyed by its name."""
    return spark.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("key"), F.col("content").alias("value"), "length",
        F.col("modificationTime").alias("timestamp"), F.col("path").alias("source_file"))


def glob_regex(glob: str) -> str:
    """`**` crosses folders, `*` stays inside one, `?` is one character."""
    parts = re.split(r"(\*\*|\*|\?)", glob)
    meaning = {"**": ".*", "*": "[^/]*", "?": "."}
    return "(?i)^" + "".join(meaning.get(p, re.escape(p)) for p in parts) + "$"


def filter_paths(df: DataFrame, include: str | None = None, exclude: str | None = None, path: str = "path") -> DataFrame:
    """Rows whose path matches `include` and not `exclude`, compared without case."""
    test = F.col(path).rlike(glob_regex(include)) if include else F.lit(True)
    return df.where(test & ~F.col(path).rlike(glob_regex(exclude)) if exclude else test)


def extract_rows(df: DataFrame, path: str, value: str = "value") -> DataFrame:
    """A row per element of the array at a dotted path, one row for any other node, none if it is missing."""
    staged = df.withColumn("__node", node_at(parsed(value), path))
    node = F.col("__node")
    one = F.array(F.to_json(node))
    many = F.transform(node.try_cast("array<variant>"), lambda e: F.coalesce(F.to_json(e), F.lit("null")))
    pieces = F.when(node.isNull(), F.array().cast("array<string>")).when(kind_of(node).startswith("ARRAY"), many).otherwise(one)
    kept = [c for c in df.columns if c != value]
    return unnest(staged, kept, pieces, "index", value)


def concat_sources(sources: Sequence, topic: str, index_col: str = "source_index", continue_on_error: bool = False) -> DataFrame:
    """Several sources one after the other under one topic.

    A source is a frame or a function that opens one. `index_col` holds its
    place; order by it and the source's own offset. A source that cannot be
    opened fails the job, or is left out with `continue_on_error`.
    """
    out = None
    for i, source in enumerate(sources):
        try:
            frame = source() if callable(source) else source
        except Exception:
            if not continue_on_error:
                raise
            continue
        frame = frame.withColumns({index_col: F.lit(i), "topic": F.lit(topic)})
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    if out is None:
        raise ValueError("no source could be opened")
    return out


def stream_files(spark: SparkSession, fmt: str, path: str, schema: T.StructType | str | None, max_files: int | None = None,
                 after: str = "keep", archive: str | None = None, **options) -> DataFrame:
    """New files of a folder, oldest first, each once; the checkpoint remembers them.

    Finished files are kept, deleted or moved to the `archive` folder, always
    after the batch that read them is committed.
    """
    if after not in ("keep", "delete", "archive"):
        raise ValueError(f"unknown clean-up {after!r}")
    reader = spark.readStream.format(fmt).options(**options).option("latestFirst", "false")
    reader = reader.option("cleanSource", {"keep": "off"}.get(after, after))
    if after == "archive":
        reader = reader.option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """One row per line of the closed files of a folder, carriage returns stripped."""
    lines = stream_files(spark, "text", folder, None, max_files)
    return lines.select(F.regexp_replace("value", "\r$", "").alias("value"))
