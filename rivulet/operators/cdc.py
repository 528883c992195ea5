"""Change data capture: building, ordering and applying change envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.ordered import latest_per_key, scan, top_per_group

# Operation codes of a change-table log (fixed values).
DELETED, INSERTED, BEFORE, AFTER = 1, 2, 3, 4


def _row(df: DataFrame, columns: Sequence[str], qualifier: str = "") -> Column:
    return F.struct(*[F.col(f"{qualifier}{c}").alias(c) for c in columns])


def snapshot_events(df: DataFrame, schema: str, table: str, ts_ms: Column | int) -> DataFrame:
    """Every table row as a read envelope."""
    after = _row(df, df.columns)
    stamp = ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms)
    return df.select(
        F.lit("r").alias("op"),
        F.struct(F.lit(schema).alias("schema"), F.lit(table).alias("table"), F.lit(None).cast("string").alias("lsn"),
                 F.lit(True).alias("snapshot")).alias("source"),
        F.when(F.lit(False), after).alias("before"),
        after.alias("after"),
        stamp.cast("long").alias("ts_ms"),
    )


def change_events(old: DataFrame, new: DataFrame, keys: Sequence[str], include_before: bool = True) -> DataFrame:
    """The create, update and delete envelopes that lead from one table state to another."""
    columns = new.columns
    left = old.select(*keys, _row(old, columns).alias("before"))
    right = new.select(*keys, _row(new, columns).alias("after"))
    pairs = left.join(right, list(keys), "full_outer")
    op = (
        F.when(F.col("before").isNull(), "c")
        .when(F.col("after").isNull(), "d")
        .when(~F.col("before").eqNullSafe(F.col("after")), "u")
    )
    events = pairs.withColumn("op", op).where(F.col("op").isNotNull())
    if not include_before:
        events = events.withColumn("before", F.when(F.col("op") == "d", F.col("before")))
    return events.select(*keys, "op", "before", "after")


def pair_updates(log: DataFrame, table: str = "table", lsn: str = "lsn", seq: str = "seq", operation: str = "operation",
                 ranges: int | None = None) -> DataFrame:
    """Envelopes from a change log, where an update is a `before` row followed by its `after` row."""
    values = [c for c in log.columns if c not in (table, lsn, seq, operation)]
    row = F.struct(*values)
    old = F.when(F.col(operation) == BEFORE, row)
    seen = scan(log, [table], [lsn, seq], previous={"__old": old}, ranges=ranges)
    code = F.col(operation)
    return seen.where(code != BEFORE).select(
        table, lsn, seq,
        F.when(code == INSERTED, "c").when(code == DELETED, "d").otherwise("u").alias("op"),
        F.when(code == DELETED, row).when(code == AFTER, F.col("__old")).alias("before"),
        F.when(code != DELETED, row).alias("after"),
    )


def lsn_window(log: DataFrame, after: int | None, n: int, table: str = "table", lsn: str = "lsn",
               seq: str = "seq") -> DataFrame:
    """The next window of about `n` changes per table that never splits one LSN.

    Each table with more than `n` pending changes ends the window at the LSN of
    change n+1; the earliest such end counts for all tables.
    """
    pending = log if after is None else log.where(F.col(lsn) > after)
    heads = top_per_group(pending.select(table, lsn, seq), [table], [F.asc(lsn), F.asc(seq)], n + 1)
    end = heads.where(F.col("rank") == n + 1).agg(F.min(lsn).alias("end")).first().end
    # as a literal the bound reaches the scan
    return pending if end is None else pending.where(F.col(lsn) <= end)


# Change names of each dialect and the operation they stand for (fixed values).
_OPERATIONS = {
    "stream": {"INSERT": "c", "MODIFY": "u", "REMOVE": "d"},
    "listener": {"ADDED": "c", "MODIFIED": "u", "REMOVED": "d"},
    "document": {"INSERT": "c", "UPDATE": "u", "REPLACE": "replace", "DELETE": "d"},
}
_OTHERWISE = {"stream": "r", "listener": "u", "document": "u"}


def map_op(df: DataFrame, dialect: str, action: str = "action", is_update: str | None = None, into: str = "op") -> DataFrame:
    """The envelope operation of a source's change name."""
    name = F.upper(F.col(action))
    if dialect == "warehouse":
        updated = F.coalesce(F.col(is_update), F.lit(False)) if is_update else F.lit(False)
        op = F.when(name == "DELETE", "d").when((name == "INSERT") & updated, "u").otherwise("c")
    else:
        table = F.create_map(*[F.lit(x) for pair in _OPERATIONS[dialect].items() for x in pair])
        op = F.coalesce(F.try_element_at(table, name), F.lit(_OTHERWISE[dialect]))
    return df.withColumn(into, op)


def cdc_key(df: DataFrame, keys: Sequence[str] | None = None, row_id: str | None = None, into: str = "key") -> DataFrame:
    """Message key: the configured columns, else the row id, else the first non-null of the usual
    id columns, else the first column."""
    if keys:
        chosen = F.concat_ws("_", *[F.col(k).cast("string") for k in keys])
    elif row_id:
        chosen = F.col(row_id).cast("string")
    else:
        usual = [c for c in ("id", "Id", "ID", "_id") if c in df.columns]
        chosen = F.coalesce(*[F.col(c).cast("string") for c in [*usual, df.columns[0]]], F.lit(""))
    return df.withColumn(into, chosen)


def apply_changes(target: DataFrame, events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table after its changes: the last change per key wins, deletes remove the row.

    Events carry the key columns, `op`, `after` and their order. The target is
    only probed for the changed keys, so a small batch of changes does not
    move the whole table.
    """
    last = latest_per_key(events, keys, [F.desc(c) for c in order])
    changed = last.select(*keys)
    alive = last.where((F.col("op") != "d") & F.col("after").isNotNull()).select("after.*").select(*target.columns)
    return target.join(changed, list(keys), "left_anti").select(*target.columns).unionByName(alive)
