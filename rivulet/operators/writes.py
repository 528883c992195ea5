"""Write modes: a table and its updates give the new table.

When several updates touch one key, the last in `order` counts. Updates are
reduced to one row per key before they meet the table, and the table is only
probed by key, so Spark may broadcast a small batch instead of moving the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivulet.operators.ordered import latest_per_key
from rivulet.records import as_text

MODES = ("insert", "create", "upsert", "replace", "update", "merge", "delete", "increment", "append")


def _checked(updates: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Updates with a complete key; a missing key field fails the job."""
    missing = [k for k in pk if k not in updates.columns]
    if missing:
        raise ValueError(f"updates lack the key columns {missing}")
    complete = F.lit(True)
    for k in pk:
        complete &= F.col(k).isNotNull()
    failed = F.raise_error(F.lit(f"an update lacks a value for its key {', '.join(pk)}"))
    return updates.where(F.when(complete, F.lit(True)).otherwise(failed.cast("boolean")))


def _last(updates: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_per_key(updates, pk, [F.desc(c) for c in order])


def _first(updates: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_per_key(updates, pk, [F.asc(c) for c in order])


def align(df: DataFrame, target: T.StructType, keep_extra: bool = False) -> DataFrame:
    """The frame with the table's columns: matched without case, cast, missing ones null."""
    own = {c.lower(): c for c in df.columns}
    chosen = [
        (F.col(f"`{own[f.name.lower()]}`").cast(f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target
    ]
    known = {f.name.lower() for f in target}
    extra = [F.col(f"`{c}`") for c in df.columns if c.lower() not in known] if keep_extra else []
    return df.select(*chosen, *extra)


def insert(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Append every update."""
    return target.unionByName(align(updates, target.schema))


def _unknown(target: DataFrame, patch: DataFrame, by: Sequence[str]) -> DataFrame:
    """The patch's rows whose key the target does not hold.

    The keys found in the target are at most as many as the patch's, so a small patch is sent to the table's tasks.
    """
    found = target.select(*by).join(patch.select(*by), list(by), "left_semi")
    return patch.join(found, list(by), "left_anti")


def patched(target: DataFrame, patch: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every row of the target with its patch, and the patch's other rows: a full outer join that
    moves the table only if the patch is too large to be sent to its tasks."""
    return target.join(patch, list(by), "left").unionByName(_unknown(target, patch, by), allowMissingColumns=True)


def create(target: DataFrame, updates: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert only keys the table does not hold; the first of several updates counts."""
    fresh = _first(_checked(updates, pk), pk, order).join(target.select(*pk), list(pk), "left_anti")
    return target.unionByName(align(fresh, target.schema))


def upsert(target: DataFrame, updates: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert, or update every non-key column the updates carry."""
    last = _last(_checked(updates, pk), pk, order)
    if set(target.columns) <= set(last.columns):
        kept = target.join(last.select(*pk), list(pk), "left_anti").select(*target.columns)
        return kept.unionByName(align(last, target.schema))
    known = _combine(target, last, pk, {c: F.lit(True) for c in last.columns}, "left")
    return known.unionByName(align(_unknown(target, last, pk).select(*[c for c in last.columns if c in target.columns]), target.schema))


def replace(target: DataFrame, updates: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Replace the whole row of existing keys; fields an update lacks become null."""
    last = align(_last(_checked(updates, pk), pk, order), target.schema)
    return _combine(target, last, pk, {c: F.lit(True) for c in target.columns}, "left")


def update(target: DataFrame, updates: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Update the carried columns of existing keys."""
    last = _last(_checked(updates, pk), pk, order)
    carried = [c for c in target.columns if c in last.columns and c not in pk]
    if not carried:
        return target
    return _combine(target, last, pk, {c: F.lit(True) for c in carried}, "left")


def _combine(target: DataFrame, last: DataFrame, pk: Sequence[str], present: dict[str, Column], how: str) -> DataFrame:
    """Join the table with one update per key; `present` says when an update sets a column."""
    new = last.select(*pk, F.struct(*last.columns).alias("__new"))
    joined = target.withColumn("__old", F.lit(True)).join(new, list(pk), how)
    touched = F.col("__new").isNotNull()

    def column(f: T.StructField) -> Column:
        if f.name in pk or f.name not in present or f.name not in last.columns:
            return F.col(f.name)
        fresh = F.col(f"__new.{f.name}").cast(f.dataType)
        return F.when(touched & present[f.name], fresh).otherwise(F.col(f.name)).alias(f.name)

    return joined.select(*[column(f) for f in target.schema])


def merge(target: DataFrame, updates: DataFrame, pk: Sequence[str], order: Sequence[str],
          present: str = "present") -> DataFrame:
    """Patch: only the fields an update names change; new keys are inserted.

    `present` is an array column with the names the update carries, so a field
    set to null differs from an absent one. Struct fields patch member by
    member, named by dotted path.
    """
    def paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
        found = []
        for f in schema:
            if isinstance(f.dataType, T.StructType):
                found += paths(f.dataType, f"{prefix}{f.name}.")
            else:
                found.append((prefix + f.name, f.dataType))
        return found

    checked = _checked(updates, pk)
    available = {p for p, _ in paths(checked.schema)}
    leaves = [(p, t) for p, t in paths(target.schema) if p not in pk and p in available]
    at = F.struct(*order)

    def named(path: str) -> Column:
        parts = path.split(".")
        whole = [".".join(parts[: i + 1]) for i in range(len(parts))]
        return F.arrays_overlap(F.col(present), F.array(*[F.lit(w) for w in whole]))

    aggs = []
    for i, (path, _) in enumerate(leaves):
        when = F.when(named(path), at)
        aggs += [F.max_by(F.col(path), when).alias(f"__v{i}"), F.max(named(path)).alias(f"__p{i}")]
    patch = checked.groupBy(*pk).agg(*aggs) if aggs else checked.select(*pk).distinct()
    index = {path: i for i, (path, _) in enumerate(leaves)}
    joined = patched(target, patch, pk)

    def build(schema: T.StructType, prefix: str = "") -> list[Column]:
        made = []
        for f in schema:
            path = prefix + f.name
            if isinstance(f.dataType, T.StructType) and any(p.startswith(path + ".") for p in index):
                touched = F.lit(False)
                for p, i in index.items():
                    if p.startswith(path + "."):
                        touched |= F.coalesce(F.col(f"__p{i}"), F.lit(False))
                made.append(F.when(F.col(path).isNotNull() | touched, F.struct(*build(f.dataType, path + "."))).alias(f.name))
            elif path in index:
                i = index[path]
                made.append(F.when(F.col(f"__p{i}"), F.col(f"__v{i}").cast(f.dataType)).otherwise(F.col(path)).alias(f.name))
            else:
                made.append(F.col(path).alias(f.name))
        return made

    return joined.select(*build(target.schema))


def delete(target: DataFrame, updates: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Remove the keys named by the updates."""
    return target.join(updates.select(*pk), list(pk), "left_anti").select(*target.columns)


def _members(text: str) -> list[tuple[str, str]]:
    """Top-level (name, type) pairs of `OBJECT<a: BIGINT, b: ARRAY<STRING>>`."""
    body, pairs, depth, start = text[text.index("<") + 1 : -1], [], 0, 0
    for i, sign in enumerate(body + ","):
        depth += (sign in "<(") - (sign in ">)")
        if sign == "," and depth == 0:
            name, _, kind = body[start:i].strip().partition(": ")
            pairs.append((name.strip("`"), kind))
            start = i + 1
    return [p for p in pairs if p[0]]


def infer(df: DataFrame, value: str = "value") -> T.StructType:
    """Table schema of JSON payloads from one pass over them: booleans, whole numbers and
    texts keep their type, other numbers are doubles, arrays and objects stay JSON."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(as_text(value))).alias("s")).first().s
    if not found or not found.startswith("OBJECT<"):
        raise ValueError(f"payloads are not JSON objects but {found}")
    kinds = {"BOOLEAN": T.BooleanType(), "BIGINT": T.LongType(), "STRING": T.StringType(), "VOID": T.StringType(),
             "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType()}

    def column(kind: str) -> T.DataType:
        if kind.startswith("DECIMAL"):
            return T.DoubleType()
        return kinds.get(kind, T.VariantType())

    return T.StructType([T.StructField(name, column(kind)) for name, kind in _members(found)])


def typed_payload(df: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    """The payload as table columns of the given or inferred schema."""
    schema = schema or infer(df, value)
    return df.withColumn("__row", F.from_json(as_text(value), schema)).select("__row.*")


CELL = ("row_key", "family", "column")


def increment(target: DataFrame, deltas: DataFrame, by: Sequence[str] = CELL, value: str = "value") -> DataFrame:
    """Add integers to cells; a cell that does not exist starts at zero, a non-integer fails the job."""
    number = F.col(value).try_cast("long")
    failed = F.raise_error(F.concat(F.lit("not an integer: "), F.coalesce(F.col(value).cast("string"), F.lit("null"))))
    amount = F.when(number.isNotNull(), number).otherwise(failed.cast("long"))
    sums = deltas.groupBy(*by).agg(F.sum(amount).alias("__delta"))
    joined = patched(target, sums, by)
    kind = target.schema[value].dataType
    total = F.coalesce(F.col(value).cast("long"), F.lit(0)) + F.coalesce("__delta", F.lit(0))
    return joined.select(*[total.cast(kind).alias(value) if c == value else F.col(c) for c in target.columns])


def append_cell(target: DataFrame, pieces: DataFrame, order: Sequence[str], by: Sequence[str] = CELL,
                value: str = "value") -> DataFrame:
    """Append text to cells, pieces in their order. The result is one cell value, so it must fit one."""
    listed = F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("string").alias("__piece"))))
    added = pieces.where(F.col(value).isNotNull()).groupBy(*by).agg(listed.alias("__pieces"))
    text = F.array_join(F.transform("__pieces", lambda p: p["__piece"]), "")
    joined = patched(target, added.select(*by, text.alias("__tail")), by)
    whole = F.concat(F.coalesce(F.col(value).cast("string"), F.lit("")), F.coalesce("__tail", F.lit("")))
    kind = target.schema[value].dataType
    return joined.select(*[whole.cast(kind).alias(value) if c == value else F.col(c) for c in target.columns])


def write_mode(target: DataFrame, updates: DataFrame, mode: str, pk: Sequence[str] = (),
               order: Sequence[str] = ("offset",), **options) -> DataFrame:
    """The table after `updates` under one of the write modes."""
    if mode == "insert":
        return insert(target, updates)
    if mode == "delete":
        return delete(target, updates, pk)
    if mode == "increment":
        return increment(target, updates, pk or CELL, **options)
    if mode == "append":
        return append_cell(target, updates, order, pk or CELL, **options)
    keyed = {"create": create, "upsert": upsert, "replace": replace, "update": update, "merge": merge}
    if mode not in keyed:
        raise ValueError(f"unknown write mode {mode!r}, expected one of {MODES}")
    return keyed[mode](target, updates, pk, order, **options)


def to_cells(df: DataFrame, row_key_field: str = "row_key", default_family: str = "default",
             ts: str = "timestamp") -> DataFrame:
    """JSON records as cells (row_key, family, column, value, ts).

    A `families` object gives family and column; otherwise all members but the
    row key go to the default family. Records without a row key are skipped.
    """
    text = as_text("value")
    members = F.from_json(text, "map<string,string>")
    families = F.from_json(F.try_element_at(F.col("__members"), F.lit("families")), "map<string,map<string,string>>")
    flat = F.map_filter(F.col("__members"), lambda k, _: k != row_key_field)
    key = F.coalesce(F.try_element_at(F.col("__members"), F.lit(row_key_field)), as_text("key"))
    staged = (
        df.withColumn("__members", members)
        .select(key.alias("row_key"), F.col(ts).alias("ts"),
                F.coalesce(families, F.create_map(F.lit(default_family), flat)).alias("__families"))
        .where(F.length("row_key") > 0)
    )
    by_family = staged.select("row_key", "ts", F.explode_outer("__families").alias("family", "__columns"))
    cells = by_family.select("row_key", "family", F.explode_outer("__columns").alias("column", "value"), "ts")
    return cells.where(F.col("column").isNotNull())
