"""Near-duplicates: many universal hash minima, banding, signature check, exact check, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import dealt, handed_back, record_batch, shingles, sliced, staged, utf8, with_ids, words
from quarterline.llm.components import components

#: 32 bands of 4 minima: at similarity 0.75 a pair misses every band with probability (1 - 0.75**4)**32 = 5e-6.
BANDS, ROWS = 32, 4
SHINGLE = 5
#: Links need 100 * intersection >= 75 * union.
PERCENT = 75
#: Pairs whose signatures agree in fewer minima are not checked: for a linked pair of 128 minima this is over five
#: standard deviations below the mean (probability under 1e-6).
LEAST_AGREEING = 0.55


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(9176)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted."""
    h, first = shingles(words(texts), size)
    return [np.unique(h[a:b]) for a, b in zip(first, first[1:])]


def minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """(sets, n) minima under n hash functions x -> (a * x + b) >> 32; no set may be empty."""
    a, b = _family(n)
    out = np.empty((len(sets), n), np.uint32)
    lo = 0
    while lo < len(sets):  # pieces that stay in the processor's cache
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= 30_000):
            total += len(sets[hi])
            hi += 1
        x = np.concatenate(sets[lo:hi])
        first = np.concatenate(([0], np.cumsum([len(s) for s in sets[lo : hi - 1]]))).astype(np.int64)
        for i in range(n):
            out[lo:hi, i] = np.minimum.reduceat(x * a[i] + b[i], first) >> np.uint64(32)
        lo = hi
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, size: int, order_col: str | None = None) -> DataFrame:
    """doc_id, age (the order column, or the id), n_shingles, set_hash (128 bits of the sorted set), signature (uint32 minima); the last two null for empty sets."""
    schema = "doc_id long, age long, n_shingles long, set_hash binary, signature binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text"):
            sets = shingle_sets(utf8(b.column("text")), size)
            full = [s for s in sets if len(s)]
            signatures = iter(minima(full, bands * rows)) if full else iter(())
            yield record_batch(
                schema, b.column("doc_id"), b.column("age"), [len(s) for s in sets],
                [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                [next(signatures).tobytes() if len(s) else None for s in sets])

    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(order_col or id_col).cast("long").alias("age"), F.col(text_col).alias("text"))
    return taken.mapInArrow(lambda b: handed_back(run(b)), schema)


def band_keys(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """key, rep, n_shingles for each band of each class: the key hashes the band's number and its minima."""
    schema = "key long, rep long, n_shingles long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                b = batch.slice(lo, 4096)
                parts = [x.tobytes() for x in np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint8).reshape(-1, 4 * rows)]
                keys = [xxhash.xxh3_64_intdigest(x, seed=i % bands) for i, x in enumerate(parts)]
                yield record_batch(
                    schema, np.array(keys, np.uint64).view(np.int64),
                    np.repeat(b.column("rep").to_numpy(), bands), np.repeat(b.column("n_shingles").to_numpy(), bands))

    return classes.select("rep", "n_shingles", "signature").mapInArrow(run, schema)


def _long_enough(a: str, b: str) -> F.Column:
    """Sets this different in size can't be linked."""
    return F.expr(f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})")


def _sets(docs: DataFrame, classes: DataFrame, reps: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """rep, shingles (sorted, 64 bits each) of these classes, from a document that has each: of one id with several
    texts the text whose set it is."""
    wanted = staged(classes.join(reps, "rep", "left_semi").select("rep", "set_hash", F.col("first").alias("doc_id")), "minhash-wanted")
    texts = with_ids(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), wanted.select("doc_id").distinct(), "doc_id")
    texts = texts.withColumn("digest", F.md5("text")).dropDuplicates(["doc_id", "digest"]).select("doc_id", "text")
    schema = "doc_id long, set_hash binary, shingles binary"

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text"):
            sets = [s.tobytes() for s in shingle_sets(utf8(b.column("text")), size)]
            yield record_batch(schema, b.column("doc_id"), [xxhash.xxh3_128_digest(s) for s in sets], sets)

    return staged(texts.mapInArrow(lambda b: handed_back(full(b)), schema).join(wanted, ["doc_id", "set_hash"]).select("rep", "shingles"), "minhash-sets")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Of the distinct pairs (x, y) those linked: first the signatures, then the full shingle sets are compared."""
    sides = [classes.select(F.col("rep").alias(k), F.col("signature").alias(f"s{k}")) for k in ("x", "y")]

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in ("sx", "sy"))
            yield b.select(["x", "y"]).filter(pa.array((left == right).mean(axis=1) >= LEAST_AGREEING))

    near = staged(pairs.join(sides[0], "x").join(sides[1], "y").select("x", "y", "sx", "sy").mapInArrow(agreeing, "x long, y long"), "minhash-pairs")
    sets = _sets(docs, classes, near.select(F.col("x").alias("rep")).union(near.select("y")).distinct(), id_col, text_col, size)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for p, q in zip(b.column("sx"), b.column("sy")):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (p, q))
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(p) + len(q) - common))
            yield b.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    both = near.join(sets.select(F.col("rep").alias("x"), F.col("shingles").alias("sx")), "x").join(
        sets.select(F.col("rep").alias("y"), F.col("shingles").alias("sy")), "y")
    return staged(both.select("x", "y", "sx", "sy").mapInArrow(lambda b: handed_back(linked(b)), "x long, y long"), "minhash-links", arrow_rows=200)


def shared_counts(sets: DataFrame) -> DataFrame:
    """rep, shared: how many of a set's shingles at least one other of these sets has too.

    No two of the sets can have more shingles in common than the smaller of these numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, data in zip(b.column("rep").to_pylist(), b.column("shingles").to_pylist()):
                own = np.frombuffer(data, np.int64)
                yield record_batch("rep long, shingle long", np.full(len(own), doc), own)

    each = staged(sets.mapInArrow(run, "rep long, shingle long"), "minhash-shingles", arrow_rows=200)
    common = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    return each.join(dealt(common, "shingle"), "shingle").groupBy("rep").agg(F.count("*").alias("shared"))


def _open_pairs(open_: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct (x, y) of different components that may be linked, among the members of each pivot's buckets.

    ``open_``: pivot, rep, n_shingles, component. Linked sets have at least T = 75 / 175 of their sizes' sum in common.
    Of that at most min(|x & p|, |y & p|) lies within the pivot p; so either that alone reaches T, or x and y share a
    shingle outside p. To share as many as x lacks, they must meet in one of x's rarest.
    """
    home = groups.select(F.col("node").alias("pivot"), F.col("component").alias("home"))
    member = open_.select("pivot", "rep", "n_shingles", "component").distinct().join(home, "pivot", "left")
    own, other = (sets.select(F.col("rep").alias(k), F.col("shingles").alias(f"s_{k}")) for k in ("rep", "pivot"))
    kept = ["pivot", "rep", "n_shingles", "component"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            outside = [np.setdiff1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(p.as_buffer(), np.uint64), assume_unique=True)
                       for x, p in zip(b.column("s_rep"), b.column("s_pivot"))]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), b.column("away"), pa.array([x.view(np.int64) for x in outside], pa.list_(pa.int64()))], names=[*kept, "away", "outside"])

    away = F.coalesce(F.col("component") != F.coalesce("home", "pivot"), F.lit(True)).alias("away")
    table = member.join(own, "rep").join(other, "pivot").select(*kept, away, "s_rep", "s_pivot")
    table = staged(table.mapInArrow(split, "pivot long, rep long, n_shingles long, component long, away boolean, outside array<long>").withColumn(
        "inside", F.col("n_shingles") - F.size("outside")), "minhash-outside", arrow_rows=200)

    def side(k: str) -> DataFrame:
        return table.select("pivot", F.col("rep").alias(k), F.col("n_shingles").alias(f"n{k}"), F.col("component").alias(f"c{k}"), F.col("inside").alias(f"i{k}"), F.col("away").alias(f"a{k}"))

    apart = (F.col("x") != F.col("y")) & (F.col("cx") != F.col("cy")) & _long_enough("nx", "ny")
    near = side("x").where("ax").join(side("y"), "pivot").where(apart).where(f"{100 + PERCENT} * least(ix, iy) >= {PERCENT} * (nx + ny)").select("x", "y")
    # how many of the members have a shingle outside the pivot
    each = table.select("pivot", "rep", "n_shingles", "component", "inside", "away", F.explode("outside").alias("shingle"))
    common = each.groupBy("pivot", "shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = staged(each.join(dealt(common, "pivot", "shingle"), ["pivot", "shingle"]), "minhash-common")
    smallest = open_.groupBy("pivot").agg(F.min("n_shingles").alias("least"))
    lists = shared.groupBy("pivot", "rep", "n_shingles", "component", "inside", "away").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("f"))
    # x needs to share so many outside the pivot even with the smallest partner
    lacks = F.ceil((F.col("n_shingles") + F.greatest("least", F.ceil(F.col("n_shingles") * (PERCENT / 100)))) * (PERCENT / (100 + PERCENT)) - F.col("inside") - 1e-6)
    lacks = F.greatest(lacks, F.lit(1)).cast("int")
    # one order for all lists, so that of what two have in common the rarest comes first in both
    first = lists.join(smallest, "pivot").withColumn("lacks", lacks).where("size(f) >= lacks")
    first = staged(first.select("pivot", "rep", "n_shingles", "component", "away", F.explode(F.slice("f", 1, F.size("f") - F.col("lacks") + 1)).alias("e")).select(
        "pivot", "rep", "n_shingles", "component", "away", F.col("e.shingle").alias("shingle")), "minhash-rarest")

    def entered(k: str) -> DataFrame:
        return first.select("pivot", "shingle", F.col("rep").alias(k), F.col("n_shingles").alias(f"n{k}"), F.col("component").alias(f"c{k}"), F.col("away").alias(f"a{k}"))

    met = dealt(entered("x").where("ax"), "shingle").join(entered("y"), ["pivot", "shingle"]).where(apart & _long_enough("nx", "ny")).select("x", "y")
    return near.unionByName(met).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE,
                    order_col: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links of 75 % and more), kept.

    Equal sets form a class; links are between classes, and ids are looked at only in the end: an id that comes with
    several texts joins their classes. Candidates are classes that share a band. Each is first
    checked against the pivot of its bucket, the member that shares the most buckets with others, of several the one
    that is first by ``order_col`` (the id), often the text that the others were made from; the links found are joined
    into components. Where a bucket then still holds several components, pairs between different components are checked too, unless their sizes, the numbers of their shingles that others have at all, or what they share
    with the pivot rule a link out (``_open_pairs``). So no candidate pair stays undecided unless it is connected
    already: a large group of near copies costs one check a member and band, not one a pair, and no link between
    components is lost.

    A null or wordless text has an empty set and is its own component. A row with a null id keeps a null component
    and is kept. Repeated rows come back as often as they came; equal ids share a component. Other columns are not
    looked at. An empty table gives an empty result.
    """
    sketch = staged(sketches(docs, id_col, text_col, bands, rows, size, order_col), "minhash-sketches")
    known = sketch.where("doc_id is not null and set_hash is not null")
    # one row per class, its smallest document; combined before the shuffle, so copies cost nothing
    classes = staged(known.groupBy("set_hash").agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("c"), F.min("age").alias("age")).select(
        "set_hash", F.monotonically_increasing_id().alias("rep"), F.col("c.doc_id").alias("first"), "age", "c.n_shingles", "c.signature"), "minhash-classes")
    keys = staged(band_keys(classes, bands, rows), "minhash-bands")
    buckets = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = staged(keys.join(dealt(buckets, "key"), "key"), "minhash-members")
    weight = members.groupBy("rep").agg(F.sum("n").alias("weight")).join(classes.select("rep", (-F.col("age")).alias("young")), "rep")
    pivots = members.join(weight, "rep").groupBy("key").agg(F.max(F.struct("weight", "young", "rep")).alias("p")).select("key", F.col("p.rep").alias("pivot"))
    members = staged(members.select("key", "rep", "n_shingles").join(dealt(pivots, "key"), "key"), "minhash-pivots")
    sizes = classes.select(F.col("rep").alias("y"), F.col("n_shingles").alias("ny"))
    stars = members.where("rep <> pivot").select(F.col("rep").alias("x"), F.col("pivot").alias("y"), "n_shingles").distinct()
    stars = stars.join(sizes, "y").where(_long_enough("n_shingles", "ny")).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    links = verified(stars, classes, docs, id_col, text_col, size)
    groups = components(links, "x", "y")
    # what is left: buckets of several components
    placed = staged(members.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", "pivot", "n_shingles", F.coalesce("component", "rep").alias("component")), "minhash-placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    open_ = staged(placed.join(dealt(mixed, "key"), "key").select("pivot", "rep", "n_shingles", "component").distinct(), "minhash-open")
    sets = _sets(docs, classes, open_.select("rep").distinct(), id_col, text_col, size)
    # x and y need 75 / 175 of their sizes' sum in common, and neither is under 75 % of the other
    open_ = staged(open_.where("rep <> pivot").join(shared_counts(sets), "rep").where(f"100 * shared >= {PERCENT} * n_shingles"), "minhash-open")
    found = verified(_open_pairs(open_, sets, groups), classes, docs, id_col, text_col, size)
    # classes that an id has in common
    several = known.groupBy("doc_id").agg(F.min(F.xxhash64("set_hash")).alias("lo"), F.max(F.xxhash64("set_hash")).alias("hi")).where("lo <> hi").select("doc_id")
    shared = known.join(several, "doc_id").join(classes.select("set_hash", "rep"), "set_hash").select("doc_id", "rep")
    same = staged(shared.join(shared.groupBy("doc_id").agg(F.min("rep").alias("y")), "doc_id").select(F.col("rep").alias("x"), "y"), "minhash-same")
    if not found.unionByName(same).isEmpty():
        groups = components(links.unionByName(found).unionByName(same), "x", "y")
    placed = classes.select("set_hash", "rep", "first").join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    of_set = placed.join(dealt(smallest, "component"), "component").select("set_hash", "component_id")
    # copies of one set may be a large share of all rows: that side of the join can be split
    out = known.select("doc_id", "n_shingles", "set_hash").join(dealt(of_set, "set_hash"), "set_hash").select("doc_id", "n_shingles", "component_id")
    out = staged(out, "minhash-components")
    rest = sketch.where("doc_id is null or set_hash is null").select("doc_id", "n_shingles")
    # an id may come with an empty text and another one
    also = with_ids(out, rest.where("doc_id is not null").select("doc_id").distinct(), "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    rest = rest.join(also, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
