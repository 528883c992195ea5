"""Embedding near-duplicates by lattice hashing.

Each table projects a unit vector at random into a few eight-dimensional
blocks and decodes each block to its nearest point of the E8 lattice; the
points name a cell. A vector is at home in one cell per table and also visits
the lattice cells next nearest to it. Vectors that share a cell, at least one
of them at home, are compared by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.common import stored
from rivulet.llm.components import components

TABLES = 6
BLOCKS = 2
PROBES = 8
#: Side of a lattice cell in the projected unit vectors, whose blocks have unit-variance Gaussian projections.
WIDTH = 1.9
SEED = 20240229
#: Vectors of a crowded cell that one task compares with as many others at a time.
ROWS = 2048


@lru_cache(maxsize=1)
def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            found.append(v)
    for signs in product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            found.append(list(signs))
    return np.array(found)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even coordinate sum."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    if len(odd):
        rest = x[odd] - point[odd]
        worst = np.abs(rest).argmax(axis=1)
        rows = np.arange(len(odd))
        point[odd, worst] += np.where(rest[rows, worst] >= 0, 1.0, -1.0)
    return point


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row of eight numbers."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@lru_cache(maxsize=8)
def _projection(dims: int, tables: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Random directions [tables, dims, 8 * blocks] and odd multipliers [tables, 8 * blocks] that hash a cell."""
    rng = np.random.default_rng([SEED, dims])
    return rng.standard_normal((tables, dims, 8 * blocks)), rng.integers(1, 1 << 62, (tables, 8 * blocks)) * 2 + 1


def _mixed(cell: np.ndarray, table: int, dims: int) -> np.ndarray:
    """Spread cell sums over 64 bits, apart for each table and dimension."""
    x = cell.astype(np.uint64) ^ np.uint64((table + 1) * 0x9E3779B97F4A7C15 + dims * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def cells(vectors: np.ndarray, tables: int, blocks: int, probes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cells [n, tables] and visited cells [n, tables * probes] of unit vectors."""
    n, dims = vectors.shape
    directions, multipliers = _projection(dims, tables, blocks)
    short = _shortest()
    home, visited = np.empty((n, tables), np.int64), np.empty((n, tables, probes), np.int64)
    for t in range(tables):
        y = vectors @ directions[t] / width
        total, gains, steps = np.zeros(n, np.int64), [], []
        for b in range(blocks):
            part, factors = y[:, 8 * b : 8 * b + 8], multipliers[t, 8 * b : 8 * b + 8]
            point = decode_e8(part)
            total += (point * 2).astype(np.int64) @ factors
            gains.append((part - point) @ short.T)  # larger: the neighbour is nearer
            steps.append((short * 2).astype(np.int64) @ factors)
        home[:, t] = _mixed(total, t, dims)
        if probes:
            gain, step = np.hstack(gains), np.concatenate(steps)
            best = np.argpartition(-gain, probes, axis=1)[:, :probes]
            visited[:, t] = _mixed(total[:, None] + step[best], t, dims)
    return home, visited.reshape(n, tables * probes)


def _usable(vector: Column) -> Column:
    """No null, nothing but finite numbers, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def _units(vectors: pd.Series) -> np.ndarray:
    rows = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions is joined with over the given pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


def _compare(group: pd.DataFrame, threshold: float, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verified links of one cell block: positions of both ends, counted once over all cells.

    A pair may meet in several cells. It belongs to the first of them, by
    table and then by cell, as both sides' home and visited cells tell.
    """
    none = np.empty(0, np.int64)
    at_home, other = np.flatnonzero(group["left"].to_numpy()), np.flatnonzero(group["right"].to_numpy())
    if not len(at_home) or not len(other):
        return none, none, none
    vectors = _units(group["vec"])
    close = vectors[at_home] @ vectors[other].T >= threshold
    i, j = np.nonzero(close)
    i, j = at_home[i], other[j]
    home = np.stack(group["home"].to_numpy())
    spots = np.concatenate([home[:, :, None], np.stack(group["visited"].to_numpy()).reshape(len(home), tables, -1)], axis=2)
    node, unit, table = group["node"].to_numpy(), group["unit"].iloc[0], int(group["t"].iloc[0])
    keep = node[i] != node[j]
    i, j = i[keep], j[keep]
    keep = (home[j, table] != unit) | (node[i] < node[j])  # both at home: they come in either order
    i, j = i[keep], j[keep]
    for t in range(table + 1):
        meets_i = (spots[j, t] == home[i, t][:, None]).any(axis=1)  # they meet at i's home
        meets_j = (spots[i, t] == home[j, t][:, None]).any(axis=1)
        if t < table:
            keep = ~(meets_i | meets_j)
        else:
            keep = ~meets_j | (home[i, t] <= home[j, t])
        i, j = i[keep], j[keep]
    return i, j, home


def _links(threshold: float, tables: int):
    """Over rows sorted by block: per row its number of links and a smaller node it is joined with."""

    def one(group: pd.DataFrame) -> pd.DataFrame | None:
        i, j, _ = _compare(group, threshold, tables)
        if not len(i):
            return None
        size = group["size"].to_numpy()
        node = group["node"].to_numpy()
        names, at = np.unique(node, return_inverse=True)  # a node can be in the block as left and as right
        counts = np.bincount(at[i], weights=size[j], minlength=len(names)) + np.bincount(at[j], weights=size[i], minlength=len(names))
        root = _roots(len(names), at[i], at[j])
        some = np.flatnonzero(counts)
        return pd.DataFrame({"node": names[some], "links": counts[some].astype(np.int64), "root": names[root[some]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = frame[["unit", "left_block", "right_block"]].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)]
            found = [one(frame.iloc[a:b]) for a, b in zip(cuts, cuts[1:])]
            rest = frame.iloc[cuts[-1] :]
            found = [x for x in found if x is not None]
            if found:
                yield pd.concat(found, ignore_index=True)
        if rest is not None and len(rest):
            last = one(rest)
            if last is not None:
                yield last

    return run


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
    tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, width: float = WIDTH, rows: int = ROWS,
) -> DataFrame:
    """One row per vector: `key`, `n_links`, `component_id`, `kept`.

    `n_links` counts the other vectors with cosine >= `threshold` that were
    found, `component_id` is the smallest key reached over links, itself
    included, and `kept` tells whether that is the row's own. Equal vectors are
    compared once and counted each. Vectors that are null, empty, zero or hold
    null or non-finite numbers, and vectors of different length, link with
    nothing. A null key names no component; its row is not kept unless its
    component has null keys only. Other columns are not read.

    Recall depends on the tables: it is measured in the tests. Larger
    collections want more `blocks`, which make cells finer. Cells with more
    than `rows` vectors are compared block by block, and only counts and
    spanning links leave a task, so a crowded cell neither meets one task nor
    emits its pairs.
    """
    given = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    usable = given.where(_usable(F.col("vec")))
    name = F.md5(F.concat_ws(",", F.transform("vec", lambda x: (x + F.lit(0.0)).cast("string"))))
    classes = stored(usable.select(name.alias("node"), "id", "vec").groupBy("node").agg(
        F.min("id").alias("least"), F.count("*").alias("size"), F.first("vec").alias("vec")
    ))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, same in frame.groupby(frame["vec"].map(len), sort=True):
                home, visited = cells(_units(same["vec"]), tables, blocks, probes, width)
                yield pd.DataFrame({
                    "node": same["node"].to_numpy(), "size": same["size"].to_numpy(), "vec": same["vec"].to_numpy(),
                    "home": list(home), "visited": list(visited),
                })

    placed = stored(classes.select("node", "size", "vec").mapInPandas(
        hashed, "node string, size long, vec array<double>, home array<long>, visited array<long>"
    ))
    at = F.transform("home", lambda c, i: F.struct(i.alias("t"), c.alias("unit"), F.lit(True).alias("home")))
    near = F.transform("visited", lambda c, i: F.struct(F.floor(i / probes).cast("int").alias("t"), c.alias("unit"), F.lit(False).alias("home")))
    roles = placed.select("node", F.explode(F.concat(at, near) if probes else at).alias("r")).select(
        "node", "r.t", "r.unit", F.col("r.home").alias("at_home")
    )
    units = stored(roles.groupBy("unit").agg(F.sum(F.col("at_home").cast("long")).alias("homes"), F.count("*").alias("n")).where("homes > 0 and n > 1"))
    rights = F.ceil(F.col("n") / rows).cast("int")
    lefts = F.ceil(F.col("homes") / rows).cast("int")
    shared = stored(roles.join(units, "unit").select(
        "unit", "t", "node", "at_home", lefts.alias("lefts"), rights.alias("rights"),
        F.pmod(F.xxhash64("node", F.lit(1)), lefts).cast("int").alias("own_left"),
        F.pmod(F.xxhash64("node", F.lit(2)), rights).cast("int").alias("own_right"),
    ))
    # a row stands on the right of its own block for every left block and, at home, on the left for every right one
    sides = F.flatten(F.array(
        F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda b: F.struct(
            b.alias("left_block"), F.col("own_right").alias("right_block"),
            (F.col("at_home") & (b == F.col("own_left"))).alias("left"), F.lit(True).alias("right"))),
        F.when(F.col("at_home"), F.filter(F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda b: F.struct(
            F.col("own_left").alias("left_block"), b.alias("right_block"), F.lit(True).alias("left"), F.lit(False).alias("right"))),
            lambda s: s["right_block"] != F.col("own_right"))).otherwise(F.array().cast(
                "array<struct<left_block:int,right_block:int,left:boolean,right:boolean>>")),
    ))
    items = shared.select("unit", "t", "node", F.explode(sides).alias("s")).select("unit", "t", "node", "s.*")
    full = items.join(placed, "node").select(
        "unit", "left_block", "right_block", "t", "node", "left", "right", "size", "vec", "home", "visited"
    )
    grouped = full.repartition("unit", "left_block", "right_block").sortWithinPartitions("unit", "left_block", "right_block")
    found = stored(grouped.mapInPandas(_links(threshold, tables), "node string, links long, root string"))

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = classes.select("node", "least", "size").join(counts, "node", "left").join(
        joined.withColumnRenamed("node", "joined"), F.col("node") == F.col("joined"), "left"
    ).select("node", "least", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(linked.join(least, "component").select(F.col("node").alias("its"), "n_links", "component_id"))
    rows_named = given.select("id", F.when(_usable(F.col("vec")), name).alias("node"))
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows_named.join(named, F.col("node") == F.col("its"), "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
