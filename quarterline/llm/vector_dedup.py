"""Near-duplicate vectors of one label: a subspace pigeonhole join.

Unit vectors x and y with cosine >= c lie within the squared distance t = 2 - 2c. A rotation keeps distances. Cut the
rotated vectors into blocks of few dimensions and give a block of w of the d dimensions the budget t * w / d: a pair
within t is within the budget in at least one block, or its distances would add up to more than t. So each block is
range-joined for itself, and what any block finds is verified over all dimensions.

The rotated vectors are kept as 16-bit integers with a known rounding error. All range tests are on these integers,
with the error added to the budgets; so tasks agree on which block of a pair is the first within its budget, and that
block alone owns the pair: nothing is found twice and no list of pairs is made. A pair whose rounded distance lies
further from the threshold than the error is decided; the few others are decided on the vectors themselves, in double
precision.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.llm.common import BROADCAST_IDS, dealt, handed_back, record_batch, staged
from quarterline.llm.components import components
from quarterline.llm.vectors import matrices, unpacked

#: Dimensions of a block, and how many of them a block's cells are cut along.
WIDTH, GRID = 8, 2
#: Rows of a cell compared in one task; larger cells are dealt out as pairs of parts.
PART = 4096
#: Rotated components are rounded to multiples of 1 / SCALE.
SCALE = 1 << 14
#: Rows whose distances are held at a time, and pairs whose components are.
_STRIP, _PAIRS = 512, 1 << 15


@lru_cache(maxsize=4)
def rotation(d: int) -> np.ndarray:
    """A fixed random orthogonal matrix: it spreads what few components hold over all blocks."""
    q, r = np.linalg.qr(np.random.default_rng(7011).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def block_edges(d: int, width: int) -> np.ndarray:
    n = max(1, -(-d // width))
    return np.arange(n + 1) * d // n


def radii(d: int, width: int, least: float) -> list[int]:
    """Each block's budget as a distance of rounded vectors, the rounding error of both ends included."""
    w = np.diff(block_edges(d, width))
    return [math.ceil((math.sqrt((2 - 2 * least) * k / d) + 2 * _error(int(k))) * SCALE) for k in w]


def _error(d: int) -> float:
    """A bound on the distance between a rotated vector of d dimensions and its rounded form."""
    return 0.5 * math.sqrt(d) / SCALE * 1.001 + 1e-9


def rounded(vectors: np.ndarray) -> np.ndarray:
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.rint(x @ rotation(x.shape[1]) * SCALE).astype("<i2")


def _usable(vectors: DataFrame, dtype: str) -> DataFrame:
    """vec_id, label, dim, digest and vector of each row; the last two null where the row can't be linked."""
    schema = "vec_id long, label long, dim int, digest binary, vector binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digest, vector, dim = ([None] * b.num_rows for _ in range(3))
            known = b.column("vec_id").is_valid().to_numpy(False) & b.column("label").is_valid().to_numpy(False)
            labels = b.column("label").to_pylist()
            for rows, m in matrices(b.column("vector")):
                m += 0.0  # one zero
                for i in np.flatnonzero(known[rows] & np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)):
                    at = rows[i]
                    vector[at], dim[at] = m[i].astype(dtype).tobytes(), m.shape[1]
                    digest[at] = xxhash.xxh3_128_digest(labels[at].to_bytes(8, "little", signed=True) + vector[at])
            yield record_batch(schema, b.column("vec_id"), b.column("label"), dim, digest, vector)

    return vectors.mapInArrow(run, schema)


_CELL = ["label", "dim", "block", "cell"]


def cells(classes: DataFrame, width: int, grid: int, least: float, dtype: str, full: bool) -> DataFrame:
    """A row for each block of each class in its own cell, and as a visitor in each later cell within the block's budget.

    Cells are twice as wide as the budget, so only neighbours are in reach. Of two vectors within the budget the one
    in the earlier cell visits the other's.
    """
    schema = "label long, dim int, block int, cell long, visitor boolean" + (", digest binary, rep long, weight long, q binary" if full else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d in np.unique(batch.column("dim").to_numpy()):
                b = batch.filter(pa.array(batch.column("dim").to_numpy() == d))
                q = rounded(unpacked(b.column("vector"), dtype).astype(np.float64)).astype(np.int64)
                edges = block_edges(int(d), width)
                for k, radius in enumerate(radii(int(d), width, least)):
                    x = q[:, edges[k] : min(edges[k] + grid, edges[k + 1])]
                    home = x // (2 * radius)
                    place = 1 << (20 * np.arange(x.shape[1])[::-1])  # 2**20 cells a dimension
                    for step in itertools.product((0, -1, 1), repeat=x.shape[1]):
                        code = np.array(step) @ place
                        if code < 0:
                            continue
                        low = x - home * (2 * radius)
                        gap = np.where(np.array(step) < 0, low + 1, np.where(np.array(step) > 0, 2 * radius - low, 0))
                        at = np.flatnonzero((gap.astype(np.float64) ** 2).sum(axis=1) <= float(radius) ** 2)
                        if not len(at):
                            continue
                        t = b.take(pa.array(at))
                        cell = (home[at] + (1 << 19)) @ place + code
                        parts = [t.column("label"), np.full(len(at), d), np.full(len(at), k), cell, np.full(len(at), code > 0)]
                        if full:
                            parts += [t.column("digest"), t.column("rep"), t.column("weight"), [r.tobytes() for r in q[at].astype("<i2")]]
                        yield record_batch(schema, *parts)

    return classes.select("label", "dim", "vector", *(("digest", "rep", "weight") if full else ())).mapInArrow(run, schema)


def _tasks(placed: DataFrame, counted: DataFrame, part: int) -> DataFrame:
    """Each cell as one task (i, j) = (0, 0), or a cell of more than ``part`` rows as pairs of parts of its rows.

    In a task the rows of side 0 meet those of side 1, and each other where i = j.
    """
    sizes = counted.groupBy(*_CELL).agg(F.sum(F.when(F.col("visitor"), 0).otherwise(1)).alias("homes"), F.sum(F.when(F.col("visitor"), 1).otherwise(0)).alias("visitors"))
    large = staged(sizes.where(f"homes + visitors > {part}").select(
        *_CELL, F.ceil(F.col("homes") / part).cast("int").alias("h"), F.ceil(F.col("visitors") / part).cast("int").alias("v")), "vectors-large")
    few = large.count() <= BROADCAST_IDS
    rows = placed.join(F.broadcast(large) if few else large, _CELL, "left")
    own = "pmod(xxhash64(digest), if(visitor, v, h))"
    with_homes = f"transform(sequence(0, h - 1), j -> struct(greatest({own}, j) as i, least({own}, j) as j, if({own} < j, 1, 0) as side))"
    with_visitors = f"if(v > 0, transform(sequence(0, v - 1), j -> struct({own} as i, h + j as j, 0 as side)), array())"
    visits = f"if(h > 0, transform(sequence(0, h - 1), i -> struct(bigint(i) as i, h + {own} as j, 1 as side)), array())"
    plain = "array(struct(0L as i, 0L as j, int(visitor) as side))"
    kind = "array<struct<i:bigint,j:bigint,side:int>>"
    parts = f"case when h is null then cast({plain} as {kind}) when visitor then cast({visits} as {kind}) else concat(cast({with_homes} as {kind}), cast({with_visitors} as {kind})) end"
    return rows.withColumn("task", F.explode(F.expr(parts))).select(*_CELL, "task.*", "digest", "rep", "weight", "q")


def merged(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the sets of u and v in ``label``, where every member points to the first of its set."""
    while True:
        a, b = label[u], label[v]
        low = np.minimum(a, b)
        if (a == b).all():
            return
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label[:] = label[label]


class Block:
    """Compares rounded vectors in one block and keeps the pairs that this block owns."""

    def __init__(self, q: np.ndarray, block: int, width: int, least: float):
        d = q.shape[1]
        self.edges, self.block = block_edges(d, width), block
        self.budgets = np.array([float(r) ** 2 for r in radii(d, width, least)])
        self.q = q.astype(np.float64)  # sums of squares of these are exact
        self.part = np.ascontiguousarray(self.q[:, self.edges[block] : self.edges[block + 1]])
        self.squares = (self.part**2).sum(axis=1)
        far = math.sqrt(2 - 2 * least)
        self.sure, self.out = ((max(far + s * 2 * _error(d), 0) * SCALE) ** 2 for s in (-1, 1))
        self.all_sure = far > 2 * _error(d)

    def pairs(self, left: np.ndarray, right: np.ndarray, triangle: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(u, v, sure) of rows within reach, ``sure`` telling those certainly linked from those to be verified."""
        for lo in range(0, len(left), _STRIP):
            own = left[lo : lo + _STRIP]
            for at in range(lo if triangle else 0, len(right), 4 * _STRIP):
                other = right[at : at + 4 * _STRIP]
                near = self.squares[own][:, None] + self.squares[other] - 2 * (self.part[own] @ self.part[other].T) <= self.budgets[self.block]
                u, v = np.nonzero(near)
                u, v = own[u], other[v]
                if triangle:
                    u, v = u[u < v], v[u < v]
                for i in range(0, len(u), _PAIRS):
                    yield from self._owned(u[i : i + _PAIRS], v[i : i + _PAIRS])

    def _owned(self, u: np.ndarray, v: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        each = np.add.reduceat((self.q[u] - self.q[v]) ** 2, self.edges[:-1], axis=1)
        total = each.sum(axis=1)
        first = np.argmax(each <= self.budgets, axis=1)
        keep = (first == self.block) & (total <= self.out)
        if keep.any():
            yield u[keep], v[keep], (total[keep] <= self.sure) & self.all_sure


def _compared(tasks: DataFrame, width: int, least: float) -> DataFrame:
    """Of each task: a row per linked class with the weight of its partners and a link to the first of its set, and a
    row per pair that has to be verified (digest, other)."""
    schema = "digest binary, n long, rep long, root long, other binary"
    shape = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("rep", pa.int64()), ("root", pa.int64()), ("other", pa.binary())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, _, block, _, i, j = (x.as_py() for x in key)
        t = table.combine_chunks()
        q = unpacked(t.column("q"), "<i2")
        rep, weight, side = (t.column(c).to_numpy() for c in ("rep", "weight", "side"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
        unsure: list[np.ndarray] = []
        compare = Block(q, block, width, least)
        meets = [(left, left, True)] * (i == j) + [(left, right, False)]
        for a, b, triangle in meets:
            for u, v, sure in compare.pairs(a, b, triangle):
                np.add.at(found, u[sure], weight[v[sure]])
                np.add.at(found, v[sure], weight[u[sure]])
                merged(label, u[sure], v[sure])
                if not sure.all():
                    unsure.append(np.stack([u[~sure], v[~sure]]))
        some = np.flatnonzero(found)
        digest = t.column("digest")
        out = [pa.table([digest.take(pa.array(some)), pa.array(found[some]), pa.array(rep[some]), pa.array(rep[label[some]]), pa.nulls(len(some), pa.binary())], schema=shape)]
        for u, v in unsure:
            out.append(pa.table([digest.take(pa.array(u)), *(pa.nulls(len(u), pa.int64()) for _ in range(3)), digest.take(pa.array(v))], schema=shape))
        return pa.concat_tables(out)

    return tasks.groupBy(*_CELL, "i", "j").applyInArrow(run, schema)


def _verified(pairs: DataFrame, classes: DataFrame, least: float, dtype: str) -> DataFrame:
    """Of these pairs of classes those with the cosine ``least`` in double precision."""
    ends = [classes.select(F.col("digest").alias(k), F.col("rep").alias(f"rep_{k}"), F.col("weight").alias(f"weight_{k}"), F.col("vector").alias(f"v{k}"), *(["dim"] if k == "x" else []))
            for k in ("x", "y")]
    kept = ["x", "y", "rep_x", "rep_y", "weight_x", "weight_y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d in np.unique(batch.column("dim").to_numpy()):
                b = batch.filter(pa.array(batch.column("dim").to_numpy() == d))
                x, y = (unpacked(b.column(c), dtype).astype(np.float64) for c in ("vx", "vy"))
                x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
                cosine = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
                yield b.select(kept).filter(pa.array(cosine >= least))

    joined = pairs.join(ends[0], "x").join(ends[1], "y").select(*kept, "vx", "vy", "dim")
    return staged(joined.mapInArrow(run, "x binary, y binary, rep_x long, rep_y long, weight_x long, weight_y long"), "vectors-verified")


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                    width: int = WIDTH, grid: int = GRID, part: int = PART) -> DataFrame:
    """vec_id, n_links, component_id, kept: links join rows of equal label whose cosine is ``least`` or more.

    Equal vectors of a label are one class, compared once and counted by their number. n_links counts the other rows
    linked directly, component_id is the smallest id reachable over links, kept tells whether it is the row's own.

    A row whose id or label is null, or whose vector is null, empty, zero or holds a null, NaN or infinite component
    is linked with nothing and is its own component (a null id keeps a null component and is kept). Vectors of
    different length are not linked. Repeated rows come back as often as they came and count as rows; rows of one id
    are in one component. Other columns are not looked at. An empty table gives an empty result.
    """
    if not -1 <= least < 1 or not 1 <= grid <= 3:
        raise ValueError("the least cosine must be from -1 to below 1, the grid of 1 to 3 dimensions")
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    dtype = "<f4" if single else "<f8"
    taken = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                           F.col(vector_col).cast(f"array<{'float' if single else 'double'}>").alias("vector"))
    rows = staged(_usable(taken, dtype), "vectors-rows")
    known = rows.where("digest is not null")
    classes = staged(known.groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.min(F.struct("label", "dim", "vector")).alias("c")).select("digest", "rep", "weight", "c.*"), "vectors-classes")
    placed, counted = (cells(classes, width, grid, least, dtype, full) for full in (True, False))
    found = staged(_compared(_tasks(placed, counted, part), width, least), "vectors-found")
    linked = _verified(found.where("other is not null").select(F.col("digest").alias("x"), F.col("other").alias("y")), classes, least, dtype)
    partners = found.where("other is null").select("digest", "n").unionByName(
        linked.select(F.col("x").alias("digest"), F.col("weight_y").alias("n"))).unionByName(linked.select(F.col("y").alias("digest"), F.col("weight_x").alias("n")))
    counts = partners.groupBy("digest").agg(F.sum("n").alias("n"))
    info = classes.join(counts, "digest", "left").select("digest", "rep", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    # copies of one vector may be a large share of all rows: that side of the join can be split
    out = staged(known.select("vec_id", "digest").join(dealt(info, "digest"), "digest").select("vec_id", "rep", "n_links"), "vectors-links")
    edges = found.where("other is null").select(F.col("rep").alias("u"), F.col("root").alias("v")).unionByName(
        linked.select(F.col("rep_x").alias("u"), F.col("rep_y").alias("v"))).unionByName(out.select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    groups = components(edges)
    own = out.join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left").select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"))
    rest = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return own.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
