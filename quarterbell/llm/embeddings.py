"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors of one label are linked if their cosine is 0.98 or more. On unit
vectors that is a squared distance of at most 0.04. A fixed random rotation
spreads the distance over all coordinates, which are split into blocks. If all
blocks differed by more than their share of the budget, in proportion to their
coordinates, so would the whole: two linked vectors are near in some block.

1. *Classes.* Equal vectors of a label are one node; its copies are counted.
2. *Range join.* In each block the first coordinates make a grid whose cells
   are as wide as the block's radius. A vector lives in one cell of each block
   and visits the neighbouring cells that come later in order, so vectors that
   are near in a block meet in one cell. Cells are cut into tiles of bounded
   size by counts of their residents and visitors, so that a crowded cell is many tasks.
3. *Verification.* In a tile, pairs within the block's budget are taken, and
   their cosine is computed from the given numbers in double precision. A pair
   that is near in several blocks counts in the first of them, so that counts
   need no list of pairs: a tile reports for each vector how many it links to,
   and what the links connect it with.
4. Components of what tiles report.

Results in the odd cases: null vectors, vectors without coordinates, zero
vectors and those with null or non-finite coordinates, and vectors without a
label, link with nothing; vectors of different lengths don't link; rows that
share a vec_id are one vector; a vector without id links, but its component_id
is null if nothing with an id is linked; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.components import components
from quarterbell.llm.tables import saved, table

COSINE = 0.98
#: Coordinates of a block, and those of them that make the grid.
BLOCK, GRID = 16, 2
#: Residents and visitors of a tile, on average at most.
TILE = 1024
#: Added to squared distances, so that rounding loses no pair.
SLACK = 1e-6

_rotations: dict[int, np.ndarray] = {}


def rotation(n: int) -> np.ndarray:
    """The same random rotation of n coordinates everywhere."""
    if n not in _rotations:
        _rotations[n] = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))[0]
    return _rotations[n]


def blocks(n: int) -> list[tuple[int, int, float]]:
    """(first coordinate, end, squared-distance budget) of each block of n coordinates."""
    whole = 2 - 2 * COSINE
    return [(a, min(a + BLOCK, n), whole * (min(a + BLOCK, n) - a) / n + SLACK) for a in range(0, n, BLOCK)]


def _matrix(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) for each length of vectors."""
    sizes = np.diff(np.asarray(vectors.offsets))
    flat, begin = vectors.values.to_numpy(zero_copy_only=False), np.asarray(vectors.offsets)[:-1]
    return [(at := np.flatnonzero(sizes == n), flat[begin[at][:, None] + np.arange(n)[None, :]]) for n in np.unique(sizes)]


def _turned(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)) @ rotation(x.shape[1])


def _later_neighbours(dims: int) -> np.ndarray:
    """Steps to the neighbouring cells that come later in order, after none at all."""
    steps = np.stack(np.meshgrid(*[[-1, 0, 1]] * dims, indexing="ij"), -1).reshape(-1, dims)
    return steps[len(steps) // 2:]


def _cell(family: np.ndarray, block: int, at: np.ndarray) -> np.ndarray:
    key = T.seeded(family.view(np.uint64), block)
    for k in range(at.shape[-1]):
        key = T.mix(key * np.uint64(3) + at[..., k].astype(np.int64).view(np.uint64))
    return T.signed(key)


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, block, cell and whether it lives there, for each cell that a vector lives in or visits."""
    for batch in batches:
        node, family = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "family"))
        for at, x in _matrix(batch.column("embedding")):
            x = _turned(x)
            for b, (first, end, budget) in enumerate(blocks(x.shape[1])):
                steps = _later_neighbours(min(GRID, end - first))
                place = np.floor(x[:, first:first + steps.shape[1]] / np.sqrt(budget)).astype(np.int64)
                cell = np.stack([_cell(family[at], b, place + step) for step in steps], 1)
                yield pa.RecordBatch.from_pydict({
                    "node": np.repeat(node[at], len(steps)), "block": np.full(cell.size, b, np.int32), "cell": cell.ravel(),
                    "lives": np.tile(np.arange(len(steps)) == 0, len(at))})


def _tile(table: pa.Table) -> pa.Table:
    """node, links, root: for each vector of a tile with links, their number and the least node that they connect it with."""
    out = {"node": [], "links": [], "root": []}
    table = table.combine_chunks()
    block = table["block"][0].as_py()
    node, lives, copies, family, resident, visitor = (
        table[c].to_numpy() for c in ("node", "lives", "copies", "family", "resident", "visitor"))
    for at, x in _matrix(table["embedding"].chunk(0)):
        turned = _turned(x)
        parts = blocks(x.shape[1])
        first, end, budget = parts[block]
        home, other = np.flatnonzero(resident[at]), np.flatnonzero(visitor[at])
        near = turned[:, first:end]
        squares = (near * near).sum(axis=1)
        apart = squares[home][:, None] + squares[other][None, :] - 2 * near[home] @ near[other].T
        i, j = np.nonzero(apart <= budget + SLACK)
        i, j = home[i], other[j]
        # residents meet twice, once as visitors of each other
        once = (node[at[i]] != node[at[j]]) & (~lives[at[j]] | (node[at[i]] < node[at[j]])) & (family[at[i]] == family[at[j]])
        i, j = i[once], j[once]
        roots = {}
        for low in range(0, len(i), 65536):
            a, b = i[low:low + 65536], j[low:low + 65536]
            gap = (turned[a] - turned[b]) ** 2
            within = np.stack([gap[:, f:e].sum(axis=1) <= most for f, e, most in parts], 1)
            a, b = (c[within.argmax(axis=1) == np.where(within.any(axis=1), block, -1)] for c in (a, b))
            scale = np.abs(x).max(axis=1)
            p, q = x[a] / scale[a][:, None], x[b] / scale[b][:, None]
            linked = (p * q).sum(axis=1) >= COSINE * np.sqrt((p * p).sum(axis=1) * (q * q).sum(axis=1))
            a, b = at[a[linked]], at[b[linked]]
            out["node"] += [node[a], node[b]]
            out["links"] += [copies[b], copies[a]]
            roots[low] = a, b
        if roots:
            a, b = (np.concatenate([r[k] for r in roots.values()]) for k in (0, 1))
            label = node.copy()
            while True:  # least node of each component, inside the tile
                new = label.copy()
                np.minimum.at(new, a, label[b])
                np.minimum.at(new, b, label[a])
                if (new == label).all():
                    break
                label = new
            out["root"] += [x for low in roots for x in (label[roots[low][0]], label[roots[low][1]])]
    node, links, root = (np.concatenate([np.zeros(0, np.int64), *out[c]]) for c in ("node", "links", "root"))
    each, of = np.unique(node, return_inverse=True)
    least = np.full(len(each), np.iinfo(np.int64).max)
    np.minimum.at(least, of, root)
    return pa.table({"node": each, "links": np.bincount(of, links, len(each)).astype(np.int64), "root": least})


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    numbers = F.col("embedding").cast("array<double>")
    usable = (
        F.col("label").isNotNull() & (F.size(numbers) > 0)
        & F.forall(numbers, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(numbers, lambda v: v != 0)
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.when(F.coalesce(usable, F.lit(False)), numbers).alias("embedding"))
    identity = F.coalesce("vec_id", F.lit(2**62) + F.shiftrightunsigned(F.xxhash64("label", "embedding"), 2))
    groups = saved(
        rows.where("embedding IS NOT NULL").groupBy("label", "embedding").agg(F.min(identity).alias("node"), F.count("*").alias("copies")),
        "vector-groups",
    )
    nodes = groups.select("node", F.xxhash64("label", F.size("embedding")).alias("family"), "copies", "embedding")
    filed = saved(nodes.mapInArrow(_file, "node long, block int, cell long, lives boolean"), "vector-cells")
    tiles = lambda n: F.ceil(n / TILE).cast("int")
    crowds = (
        filed.groupBy("cell").agg(tiles(F.count("*")).alias("all_tiles"), tiles(F.sum(F.col("lives").cast("int"))).alias("home_tiles"))
        .where("home_tiles > 0")
    )
    placed = filed.join(crowds, "cell")
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = placed.withColumns({"own_home": part("home_tiles"), "own_other": part("all_tiles")})
    kept = ("node", "block", "cell", "lives", "own_home", "own_other")
    together = (
        own.where("lives").select(*kept, F.col("own_home").alias("home"), upto("all_tiles").alias("other"))
        .unionByName(own.select(*kept, upto("home_tiles").alias("home"), F.col("own_other").alias("other"))).distinct()
        .select("node", "block", "cell", "lives", "home", "other",
                (F.col("lives") & (F.col("own_home") == F.col("home"))).alias("resident"), (F.col("own_other") == F.col("other")).alias("visitor"))
    )
    found = saved(
        together.join(nodes, "node").groupBy("block", "cell", "home", "other").applyInArrow(_tile, "node long, links long, root long"),
        "vector-links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    # a node stands for the least id of its copies
    placed = rows.join(groups.select("label", "embedding", "node", "copies"), ["label", "embedding"], "left").join(links, "node", "left").join(
        classes.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    component = F.coalesce("component", "node", "vec_id")
    component = F.when(component < 2**62, component)
    return placed.select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
