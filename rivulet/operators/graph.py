"""Graph nodes and edges as tables.

Nodes are (label, id, properties); edges are (from, to, label, properties).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.writes import patched


def _properties(df: DataFrame, without: Sequence[str], keep_null: bool) -> Column:
    dropped = {c.lower() for c in without}
    pairs = [x for c in df.columns if c.lower() not in dropped for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    if not pairs:
        return F.create_map().cast("map<string,string>")
    made = F.create_map(*pairs)
    return made if keep_null else F.map_filter(made, lambda _, v: v.isNotNull())


def _identity(id_cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols])


def nodes_of(df: DataFrame, label: str, id_cols: Sequence[str], label_field: str | None = None,
             without: Sequence[str] = (), keep_null: bool = False) -> DataFrame:
    """Rows as nodes; the label is a field's text when it has one, else the constant."""
    own = F.when(F.length(F.col(label_field).cast("string")) > 0, F.col(label_field).cast("string")) if label_field else F.lit(None)
    return df.select(
        F.coalesce(own.cast("string"), F.lit(label)).alias("label"),
        _identity(id_cols).alias("id"),
        _properties(df, without, keep_null).alias("properties"),
        *[F.col(c) for c in without if c in df.columns],
    )


def upsert_nodes(nodes: DataFrame, rows: DataFrame, label: str, id_cols: Sequence[str], mode: str = "merge",
                 label_field: str | None = None, order: str = "offset") -> DataFrame:
    """Nodes after a batch of rows.

    `create` adds a node per row. `merge` patches the node of the same label and
    id: the last value of each property counts, a null value removes it.
    """
    made = nodes_of(rows, label, id_cols, label_field, without=[order], keep_null=mode == "merge")
    if mode == "create":
        return nodes.unionByName(made.drop(order))
    # values reduce per property before a node is put together, so many rows of one node spread over the map tasks
    last = (
        made.select("label", "id", order, F.explode_outer("properties").alias("name", "value"))
        .where(F.col("name").isNotNull())
        .groupBy("label", "id", "name")
        .agg(F.max_by("value", order).alias("value"))
        .groupBy("label", "id")
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("__patch"))
    )
    joined = patched(nodes, last, ["label", "id"])
    none = F.create_map().cast("map<string,string>")
    patch = F.coalesce("__patch", none)
    kept = F.map_filter(F.coalesce("properties", none), lambda k, _: ~F.map_contains_key(patch, k))
    set_ = F.map_filter(patch, lambda _, v: v.isNotNull())
    return joined.select("label", "id", F.map_concat(kept, set_).alias("properties"))


def build_edges(df: DataFrame, from_col: str, to_col: str, label: str, nodes: DataFrame | None = None,
                id_col: str | None = None) -> DataFrame:
    """Rows as edges; rows without both ends, or with an end that is no node, give none."""
    ends = [F.col(from_col).cast("string"), F.col(to_col).cast("string")]
    without = [from_col, to_col, *([id_col] if id_col else [])]
    edges = df.where((F.length(ends[0]) > 0) & (F.length(ends[1]) > 0)).select(
        ends[0].alias("from"), ends[1].alias("to"), F.lit(label).alias("label"),
        _properties(df, without, keep_null=False).alias("properties"))
    if nodes is None:
        return edges
    for end in ("from", "to"):
        edges = edges.join(nodes.select(F.col("id").alias(end)), end, "left_semi")
    return edges.select("from", "to", "label", "properties")


def match(nodes: DataFrame, label: str, ts_property: str | None = None, since: str | None = None,
          limit: int | None = None) -> DataFrame:
    """Nodes of a label, changed at or after a time, oldest first."""
    found = nodes.where(F.col("label") == label)
    order = [F.asc("id")]
    if ts_property:
        stamp = F.try_element_at("properties", F.lit(ts_property))
        order.insert(0, stamp.asc())
        if since is not None:
            found = found.where(stamp >= since)
    return found if limit is None else found.orderBy(*order).limit(limit)
