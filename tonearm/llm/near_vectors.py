"""Near-duplicate vectors by an exact metric range join.

Unit vectors with a cosine of at least c lie within r = sqrt(2 - 2c) of each other. A few pivots cut the vectors of a
label into cells, each vector's home being the cell of its nearest pivot. By the triangle inequality a vector that has
a neighbour at home in another cell lies within r of the plane halfway between the two pivots, so exactly those vectors
are copied there. Each cell then holds all neighbours of its own vectors and is joined on its own; a large cell is cut
into blocks of bounded size that are joined one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.components import components
from tonearm.llm.files import stored

READ = "vec_id long, label string, dims int, key_high long, key_low long, vector binary"
PLACED = "label string, dims int, cell int, home boolean, node long, copies long, vector binary"
FOUND = "node long, links long, a long, b long"
#: Width of the margin by which copies exceed what exact arithmetic needs.
SLACK = 1e-6


def as_matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dims)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def read_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label and vector in double precision, with a digest of label and vector; stored, with a row number.

    dims is null for what links with nothing: no label, no vector, an empty or zero one, or one with a missing or
    non-finite part. Vectors are scaled by their largest part, so that squares neither overflow nor vanish.
    """
    names = [f.split()[0] for f in READ.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(4)]
            for label, value in zip(batch.column(1).to_pylist(), batch.column(2)):
                vector = None
                if label is not None and value.is_valid and len(value) and not value.values.null_count:
                    vector = np.asarray(value.values).astype(np.float64)
                    most = np.abs(vector).max()
                    vector = vector / most if np.isfinite(vector).all() and most > 0 else None
                if vector is None:
                    own: tuple = (None, None, None, None)
                else:
                    data = (vector + 0.0).tobytes()  # no negative zero
                    digest = xxhash.xxh3_128_digest(data + label.encode())
                    own = (len(vector), *np.frombuffer(digest, np.int64).tolist(), data)
                for column, part in zip(columns, own):
                    column.append(part)
            types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            made = [pa.array(column, kind) for column, kind in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names)

    own = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding")
    return stored(own.mapInArrow(read, READ).withColumn("row", F.monotonically_increasing_id()), "vectors")


def choose_pivots(nodes: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Unit vectors by number of dimensions: ``count`` vectors with the smallest hashes, whatever the table's size."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(count).select("dims", "vector").collect()
    found: dict[int, list[bytes]] = {}
    for row in rows:
        found.setdefault(row.dims, []).append(bytes(row.vector))
    return {d: unit_rows(np.frombuffer(b"".join(v), np.float64).reshape(-1, d)) for d, v in found.items()}


def cells_of(units: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and which cells it is needed in.

    For y at home in cell j and x in cell i, both within r of each other, the distance of x from the plane between the
    pivots is at most r: (|x - p_j|^2 - |x - p_i|^2) / (2 |p_i - p_j|) <= r.
    """
    squares = np.maximum(2 - 2 * units @ pivots.T, 0)
    home = squares.argmin(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))[home]
    beyond = squares - squares[np.arange(len(units)), home][:, None]
    needed = beyond <= 2 * apart * radius + SLACK
    needed[np.arange(len(units)), home] = True
    return home, needed


def place(nodes: DataFrame, pivots: dict[int, np.ndarray], radius: float) -> DataFrame:
    """Every vector in its home cell and, marked as a copy, in the cells whose vectors it may be close to; stored."""
    names = [f.split()[0] for f in PLACED.split(", ")]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_dims = np.asarray(batch.column(1))
            for dims in np.unique(all_dims).tolist():
                for own in np.array_split(own_rows := np.flatnonzero(all_dims == dims), len(own_rows) // 1000 + 1):
                    part = batch.take(pa.array(own))
                    if dims in pivots:
                        home, needed = cells_of(unit_rows(as_matrix(part.column(4), dims)), pivots[dims], radius)
                    else:
                        home, needed = np.zeros(len(own), np.int64), np.ones((len(own), 1), bool)
                    at, cells = np.nonzero(needed)
                    rows = part.take(pa.array(at))
                    columns = [rows.column(0), rows.column(1), pa.array(cells.astype(np.int32)), pa.array(home[at] == cells)]
                    yield pa.RecordBatch.from_arrays([*columns, rows.column(2), rows.column(3), rows.column(4)], names)

    own = nodes.select("label", "dims", "node", "copies", "vector")
    return stored(own.mapInArrow(placed, PLACED), "vectors-in-cells")


class Forest:
    """Links found so far between the nodes of a block; gives the few that join parts not yet joined."""

    def __init__(self, nodes: np.ndarray) -> None:
        self.nodes = nodes
        self.part = np.arange(len(nodes))
        self.edges: list[tuple[int, int]] = []

    def join(self, members: np.ndarray) -> None:
        parts = np.unique(self.part[members])
        if len(parts) > 1:
            self.edges += [(int(self.nodes[parts[0]]), int(self.nodes[p])) for p in parts[1:]]
            self.part[np.isin(self.part, parts[1:])] = parts[0]


def join_block(table: pa.Table, cosine: float, at_once: int = 512) -> pa.Table:
    """Links of the block's home vectors with its members: their number by node, and links that span its parts."""
    dims = table["dims"][0].as_py()
    table = table.combine_chunks()
    home = np.asarray(table["as_home"].combine_chunks().to_numpy(zero_copy_only=False))
    nodes = table["node"].to_numpy()
    units = unit_rows(as_matrix(table["vector"].combine_chunks(), dims))
    own, others = np.flatnonzero(home), np.flatnonzero(~home)
    copies = table["copies"].to_numpy()[others]
    known, where = np.unique(nodes, return_inverse=True)
    forest = Forest(known)
    counts = np.zeros(len(own), np.int64)
    for first in range(0, len(own), at_once):
        part = own[first : first + at_once]
        close = units[part] @ units[others].T >= cosine
        close &= nodes[part][:, None] != nodes[others][None, :]
        counts[first : first + len(part)] = close @ copies
        for k in np.flatnonzero(close.any(axis=1)).tolist():
            forest.join(np.append(where[others[close[k]]], where[part[k]]))
    found = counts > 0
    a, b = [e[0] for e in forest.edges], [e[1] for e in forest.edges]
    none_a, none_b = [None] * int(found.sum()), [None] * len(a)
    return pa.table(
        {
            "node": pa.array(nodes[own][found].tolist() + none_b, pa.int64()),
            "links": pa.array(counts[found].tolist() + none_b, pa.int64()),
            "a": pa.array(none_a + a, pa.int64()),
            "b": pa.array(none_a + b, pa.int64()),
        }
    )


def join_cells(placed: DataFrame, cosine: float, block: int) -> DataFrame:
    """Links by node and links that span the components; stored.

    A cell of more than ``block`` homes or members is cut by hash into blocks, each a task of its own, so no task holds
    more than about two blocks of vectors, whatever share of all vectors a cell has.
    """
    cell = ["label", "dims", "cell"]
    sizes = placed.groupBy(*cell).agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("members"))
    cuts = stored(
        sizes.where("homes > 0").select(
            *cell, F.ceil(F.col("homes") / block).alias("home_cuts"), F.ceil(F.col("members") / block).alias("member_cuts")
        ),
        "cell-cuts",
    )
    rows = placed.join(cuts, cell).drop("home")
    every = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    own = F.pmod(F.xxhash64("node"), F.col("home_cuts")).cast("int")
    homes = (
        placed.where("home").join(cuts, cell).drop("home")
        .withColumn("home_block", own)
        .withColumn("member_block", every(F.col("member_cuts")))
        .withColumn("as_home", F.lit(True))
    )
    members = (
        rows.withColumn("member_block", F.pmod(F.xxhash64("node"), F.col("member_cuts")).cast("int"))
        .withColumn("home_block", every(F.col("home_cuts")))
        .withColumn("as_home", F.lit(False))
    )
    blocks = homes.unionByName(members).drop("home_cuts", "member_cuts")
    keys = [*cell, "home_block", "member_block"]
    return stored(blocks.groupBy(*keys).applyInArrow(lambda table: join_block(table, cosine), FOUND), "vector-links")


def near_vectors(rows: DataFrame, cosine: float = 0.98, pivots: int = 16, block: int = 4096) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per row of ``rows`` (vec_id, embedding, label).

    Vectors of one label link at a cosine of at least ``cosine``. Equal vectors of a label are one node with a number
    of copies, which count as links of each other. n_links counts rows; component_id is the smallest vec_id that links
    reach, kept whether it is the row's own. A vector that is null, zero, or has a null or non-finite part, and one
    without a label, links with nothing and is kept. Vectors of different length do not link. No rows give no rows;
    further columns are not looked at.
    """
    vectors = read_vectors(rows)
    key = ["label", "dims", "key_high", "key_low"]
    classes = stored(
        vectors.where("dims is not null")
        .groupBy(*key)
        .agg(F.min("row").alias("node"), F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies")),
        "vector-classes",
    )
    nodes = stored(
        classes.select("node", "copies").join(vectors.withColumnRenamed("row", "node"), "node").select("node", "label", "dims", "copies", "vector"),
        "vector-nodes",
    )
    placed = place(nodes, choose_pivots(nodes, pivots), math.sqrt(2 - 2 * cosine))
    found = join_cells(placed, cosine, block)
    roots = components(found.where("a is not null").select("a", "b"))
    links = found.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    rooted = classes.join(roots, "node", "left").join(links, "node", "left")
    rooted = rooted.select(*key, "least_id", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = stored(rooted.join(least, "root").select(*key, "n_links", "component_id"), "vector-components")
    result = vectors.select("vec_id", *key).join(of_class, key, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("dims").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
