"""Hard negatives by a secondary sort: windows opened by positives, filled while a sorted stream passes.

Pairs of an anchor and a row are keyed (anchor, descending score, id), dealt by anchor and sorted within partitions;
an iterator then sees each anchor's rows from the highest score down. A positive opens a window of scores, all of it
below the positive, and the rows of other labels that follow fill it. Only the open windows are held.

Scores come from anchors against all rows, in blocks of both. Before the sort each block is combined: of a block of
rows an anchor needs no more than its own first positives, and, once these are known over all rows, the first rows in
each window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.common import record_batch, staged
from quarterline.llm.vectors import matrices, unpacked

#: Rows and anchors of a block; at 64 dimensions a block of either is some 3 MB.
BLOCK = 16_384
#: Scores held at a time in a task.
_SCORES = 1 << 21


def _whole(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, their components scaled and rounded down: vec_id, label, dim, q (16-bit, where a component
    needs it 64-bit numbers). A component whose scaled value does not fit 62 bits raises."""
    schema = "vec_id long, label long, dim int, q binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = b.column("vec_id").is_valid().to_numpy(False) & b.column("label").is_valid().to_numpy(False)
            for rows, m in matrices(b.column("vector")):
                keep = known[rows] & np.isfinite(m).all(axis=1)
                x = np.floor(scale * m[keep])
                if len(x) and np.abs(x).max() >= 2.0**62:
                    raise ArithmeticError("a scaled component does not fit 62 bits")
                small = (np.abs(x) < 1 << 15).all(axis=1)
                t = b.select(["vec_id", "label"]).take(pa.array(rows[keep]))
                yield record_batch(schema, t.column("vec_id"), t.column("label"), np.full(len(x), m.shape[1]),
                                   [r.astype("<i2" if s else "<i8").tobytes() for r, s in zip(x, small)])

    return vectors.mapInArrow(run, schema)


class Side:
    """The rows of a block, one per id (of repeated ids the row with the smallest label and vector), by id."""

    def __init__(self, t: pa.Table, dim: int):
        t = t.combine_chunks()
        t = t.filter(pa.array(t.column("dim").to_numpy() == dim)).combine_chunks()
        ids, labels, qs = t.column("vec_id").to_numpy(), t.column("label").to_numpy(), t.column("q").to_pylist()
        q = np.stack([np.frombuffer(x, "<i2" if len(x) == 2 * dim else "<i8") for x in qs]) if qs else np.zeros((0, dim), np.int64)
        order = np.lexsort((*(q.T[::-1] if len(np.unique(ids)) < len(ids) else ()), labels, ids))
        order = order[np.concatenate(([True], ids[order][1:] != ids[order][:-1]))] if len(order) else order
        self.ids, self.labels, self.q, self.rows = ids[order], labels[order], q[order], order
        self.table = t


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, exact."""
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if bound >= 1 << 62:
        raise ArithmeticError("inner products do not fit 62 bits")
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if bound < 1 << 53 else a.astype(np.int64) @ b.astype(np.int64).T


def _first(score: np.ndarray, may: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest scores of each row among those that may count; ties by column."""
    n = score.shape[1]
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = int(score.min(initial=0)), int(score.max(initial=0))
    if (high - low + 1) * n >= 1 << 62:
        score, low = np.unique(score, return_inverse=True)[1].reshape(score.shape), 0  # as good as the scores, and small
    place = (score - low) * n + np.arange(n - 1, -1, -1)  # score and column in one number
    place[~may] = -1
    top = np.argpartition(place, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), place.shape)
    row, at = np.nonzero(np.take_along_axis(place, top, axis=1) >= 0)
    return row, top[row, at]


def _blocks(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt to pairs of blocks: by a hash of the id, so that blocks are even and repeated ids meet."""
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    return (anchors.withColumn("a", deal(n_anchors, 1)).withColumn("r", every(n_rows)),
            rows.withColumn("r", deal(n_rows, 2)).withColumn("a", every(n_anchors)))


def _scored(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """anchor_id, score, id, of each pair of blocks. Anchors without ``windows``: their first rows of the same label.
    With: of each window (given by its positive's score) the first rows of other labels."""
    schema = "anchor_id long, score long, id long"
    windows = "windows" in anchors.columns
    a, r = _blocks(anchors, rows, n_anchors, n_rows)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [record_batch(schema, [], [], [])]
        for d in set(left.column("dim").to_pylist()) & set(right.column("dim").to_pylist()):
            x, y = Side(left, d), Side(right, d)
            step = max(1, _SCORES // max(1, len(y.ids)))
            opened = x.table.column("windows").to_pylist() if windows else []
            for lo in range(0, len(x.ids), step):
                ids, labels = x.ids[lo : lo + step], x.labels[lo : lo + step]
                score = scores(x.q[lo : lo + step], y.q)
                same = labels[:, None] == y.labels
                if not windows:
                    u, v = _first(score, same & (ids[:, None] != y.ids), positives)
                else:
                    lists = [opened[i] for i in x.rows[lo : lo + step]]
                    picked = []
                    for w in range(max(map(len, lists))):
                        # a window that an anchor lacks is empty: a negative score opens none
                        opens = np.array([p[w] if w < len(p) else -1 for p in lists], np.int64)[:, None]
                        inside = (low * opens <= 100 * score) & (100 * score <= high * opens) & (opens >= 0)
                        picked.append(np.stack(_first(score, inside & ~same, negatives)))
                    u, v = np.unique(np.concatenate(picked, axis=1), axis=1)
                out.append(record_batch(schema, ids[u], score[u, v], y.ids[v]))
        return pa.Table.from_batches(out)

    return a.groupBy("a", "r").cogroup(r.groupBy("a", "r")).applyInArrow(run, schema)


def _emitted(pairs: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Walk each anchor's sorted pairs once; hold its open windows only."""
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened, seen = None, [], 0
        for b in batches:
            out: list[tuple] = []
            for key, score, negative, other in zip(*(b.column(c).to_pylist() for c in ("anchor_id", "score", "negative", "id"))):
                if key != anchor:
                    anchor, opened, seen = key, [], 0
                if not negative:
                    seen += 1
                    if seen <= positives:
                        opened.append([other, score, 0])
                    continue
                for w in opened:
                    if low * w[1] <= 100 * score <= high * w[1]:
                        w[2] += 1
                        out.append((anchor, w[0], w[2], other, w[1], score))
                opened = [w for w in opened if w[2] < negatives and low * w[1] <= 100 * score]
            if out:
                yield record_batch(schema, *zip(*out))

    # as repartitionAndSortWithinPartitions: one shuffle by anchor, sorted on the way; at equal scores positives come first
    order = [F.col("anchor_id"), (-2 * F.col("score") + F.col("negative").cast("long")), F.col("id")]
    return pairs.repartition("anchor_id").sortWithinPartitions(*order).mapInArrow(run, schema)


def mined(vectors: DataFrame, anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
          id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 256, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its first ``positives`` other rows of its label; for each, the first ``negatives`` rows
    of other labels with low * positive score <= 100 * negative score <= high * positive score are returned. Scores
    are inner products of components scaled and rounded down; rows come by descending score, then id. ``anchor`` and
    ``label`` (instead of the column) are expressions over the input.

    Rows with a null id or label, a null or empty vector, or a null, NaN or infinite component take no part; vectors
    of different length do not meet. Of rows with one id the one with the smallest label and vector counts. Other
    columns are not looked at. Without rows or anchors the result is empty. ``high`` must be under 100: a window
    then lies below the score that opens it.
    """
    if not 0 <= low < high < 100:
        raise ValueError("0 <= low < high < 100")
    taken = vectors.select(F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col) if label is None else label).cast("long").alias("label"), F.col(vector_col).alias("vector"), anchor.alias("is_anchor"))
    asked = taken.where("is_anchor").select("vec_id").distinct()
    rows = staged(_whole(taken.select("vec_id", "label", "vector"), scale), "negatives-rows")
    anchors = staged(rows.join(asked, "vec_id", "left_semi"), "negatives-anchors")
    sizes = [max(1, -(-t.count() // block)) for t in (anchors, rows)]
    score = lambda a: _scored(a, rows, *sizes, positives, negatives, low, high)
    by = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    # an anchor has so many rows a block of rows here, not more
    first = staged(score(anchors).withColumn("n", F.row_number().over(by)).where(F.col("n") <= positives).drop("n"), "negatives-positives")
    windows = first.where("score >= 0").groupBy("anchor_id").agg(F.sort_array(F.collect_set("score"), asc=False).alias("windows"))
    opened = anchors.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    pairs = first.withColumn("negative", F.lit(False)).unionByName(score(opened).withColumn("negative", F.lit(True)))
    return _emitted(pairs, positives, negatives, low, high)
