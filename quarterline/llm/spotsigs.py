"""SpotSigs: chains of content words that follow common words, as a document's fingerprint.

A spot is an anchor (a common word of one of the languages) with the next two words that are no anchors. Where
anchors are lacking, before the first and from some words after the last one met, every word serves as one. A
fingerprint is the multiset of a text's spots (each with its number among equal ones), 32 bits each, sorted, in
base64. Two sets whose sizes differ by more than a wanted likeness allows need no comparing; in a join they are met
only within neighbouring classes of size.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import _STEP, mix, record_batch, shingles, sliced, staged, utf8, words

# Common words of English, German, French and Spanish.
ANCHORS = {
    "en": "the a an of to and in is it was that for on with by as at this be are from or",
    "de": "der die das und ist ein eine den dem zu von mit sich auf für im nicht es auch des",
    "fr": "le la les un une de des du et est en que qui pour dans par sur au pas avec",
    "es": "el los las una y del se no por con para su al lo como más pero sus",
}
CHAIN = 2
#: From so many words after an anchor on, until the next, every word serves as an anchor.
GAP = 12
#: Texts per task of the neighbour pass, in bytes.
PART_BYTES = 16 << 20

#: A word ends at ASCII that is no letter or digit; other bytes belong to words.
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct 32-bit features of each whole text; a text without words has none."""
    anchors = np.sort(words([w.encode() for x in ANCHORS.values() for w in x.split()], _APART).hashes)
    out: list[np.ndarray] = []
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= 1 << 20):
            size += len(texts[hi])
            hi += 1
        w = words(texts[lo:hi], _APART)
        h, n = w.hashes, len(w.hashes)
        if n:
            is_anchor = anchors[np.minimum(np.searchsorted(anchors, h), len(anchors) - 1)] == h
            doc = np.repeat(np.arange(hi - lo), np.diff(w.first))
            here = np.arange(n)
            last = np.maximum.accumulate(np.where(is_anchor, here, -1))
            content = np.flatnonzero(~is_anchor)
            at = np.flatnonzero(is_anchor | (last < w.first[doc]) | (here - last > GAP))
            k = np.searchsorted(content, at, "right")  # words after it
            whole = k + CHAIN <= len(content)
            at, k = at[whole], k[whole]
            whole = doc[content[k + CHAIN - 1]] == doc[at] if len(at) else whole[:0]
            at, k = at[whole], k[whole]
            spot = h[at] * _STEP[0]
            for j in range(CHAIN):
                spot = (spot ^ (spot >> np.uint64(29))) * _STEP[10] + h[content[k + j]] * _STEP[j + 1]
            first = np.searchsorted(doc[at], np.arange(hi - lo + 1))
            short, short_first = shingles(w, 1 + CHAIN)  # texts of fewer words have themselves
        for i in range(hi - lo):
            own = spot[first[i] : first[i + 1]] if n else np.zeros(0, np.uint64)
            if n and not len(own):
                own = short[short_first[i] : short_first[i + 1]]
            own = np.sort(own)
            new = np.concatenate(([True], own[1:] != own[:-1]))[: len(own)]
            number = np.arange(len(own)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(own) else np.zeros(0, np.int64)
            own = mix(own + number.astype(np.uint64) * _STEP[20])
            out.append(np.unique((own >> np.uint64(32)).astype(np.uint32)))
        lo = hi
    return out


def encoded(features: np.ndarray) -> str:
    return base64.b64encode(features.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two feature sets, 0 where their sizes alone rule out ``least``; 1 for two empty sets."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large or not small:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """The largest id of each range of ids; ranges hold about as many documents each. A number per task."""
    ranged = staged(docs.where("doc_id is not null").select("doc_id").repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()), "spots-ranges")
    return sorted(r[0] for r in ranged.groupBy("part").agg(F.max("doc_id")).select("max(doc_id)").collect())


def with_next(docs: DataFrame, each, schema: str, parts: int | None = None) -> DataFrame:
    """``each(ids, texts, next_texts)`` over ranges of documents in descending order of doc_id.

    The next of the last document is the first. Null ids come last, equal ids by their texts. Texts are shuffled once:
    the first document of each range also goes to the range before it, where it follows the last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if parts is None:
        parts = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES
    highs = _bounds(rows, int(parts))
    top = highs[-1] if highs else None

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text"):
            ids = b.column("doc_id")
            part = np.searchsorted(np.array(highs, np.int64), ids.fill_null(-(1 << 63)).to_numpy()) if highs else np.zeros(b.num_rows, np.int64)
            yield record_batch("part long, guest boolean, doc_id long, text string", part, np.zeros(b.num_rows, bool), ids, b.column("text"))
            for i, (k, doc) in enumerate(zip(part, ids.to_pylist())):
                if doc is not None and doc == highs[k]:  # the first of its range
                    yield record_batch("part long, guest boolean, doc_id long, text string", [0 if doc == top else k + 1], [True], [doc], b.column("text").slice(i, 1))

    def run(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t.column("guest").to_pylist(), t.column("doc_id").to_pylist(), t.column("text").to_pylist()),
                      key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2]))
        own = [r for r in rows if not r[0]]
        follow = [r for r in rows if r[0]][:1] or own[:1]
        texts = [r[2] for r in own]
        return each([r[1] for r in own], texts, [*texts[1:], *(r[2] for r in follow)][: len(texts)])

    return rows.mapInArrow(spread, "part long, guest boolean, doc_id long, text string").groupBy("part").applyInArrow(run, schema)


def with_edits(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text (its last third replaced by the start of the next document's),
    and how like they are. A null text is empty; an empty table gives an empty result; repeated rows come back each."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def each(ids: list, texts: list[str], after: list[str]) -> pa.Table:
        edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, after)]
        own = fingerprints([*(t.encode() for t in texts), *(t.encode() for t in after[-1:])])
        changed = fingerprints([t.encode() for t in edited])
        return pa.Table.from_batches([record_batch(
            schema, ids, [len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            [encoded(x) for x in own[: len(texts)]], [encoded(x) for x in changed],
            [likeness(a, b) for a, b in zip(own, changed)], [likeness(a, b) for a, b in zip(own, own[1:])])])

    return with_next(docs, each, schema, parts)


def _size_class(size: Column, least: float) -> Column:
    """Sets of a likeness of ``least`` or more lie in the same or in neighbouring classes."""
    return F.floor(F.log(size.cast("double")) / -F.log(F.lit(least)) + F.lit(1e-9)).cast("int")


def similar(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Pairs (x, y, likeness) of distinct fingerprints of a likeness of ``least`` or more, with x, y the smallest ids.

    Equal fingerprints are one class (their smallest id). Of a class's features, the rarest first, so many are
    entered that a pair of the wanted likeness can't miss each other; they are met in the same and the next class of
    size, and compared unless their sizes rule it out. So no pair is lost, and a feature that most texts share is
    hardly ever entered. Texts without words are alike to nothing. Null ids are left out.
    """
    schema = "doc_id long, n int, features binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text"):
            found = fingerprints(utf8(b.column("text")))
            yield record_batch(schema, b.column("doc_id"), [len(x) for x in found], [x.tobytes() for x in found])

    sets = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    classes = staged(sets.where("n > 0").groupBy("features").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "spots-classes")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, n, data in zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist(), b.column("features").to_pylist()):
                yield record_batch("feature long, doc_id long, n int", np.frombuffer(data, np.uint32).astype(np.int64), np.full(n, doc), np.full(n, n))

    each = staged(classes.select("doc_id", "n", "features").mapInArrow(listed, "feature long, doc_id long, n int"), "spots-features")
    rarity = staged(each.groupBy("feature").agg(F.count("*").alias("df")), "spots-rarity")
    ranked = each.join(rarity, "feature").groupBy("doc_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "feature"))).alias("f"))
    head = F.slice("f", 1, F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9).cast("int") + 1)
    entry = staged(ranked.select(F.explode(head).alias("h"), "doc_id", "n").select(F.col("h.feature").alias("feature"), "doc_id", "n").withColumn("size", _size_class(F.col("n"), least)), "spots-entries")
    near = entry.select("feature", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("size"), F.col("doc_id").alias("x"), F.col("n").alias("nx"), F.col("size").alias("own"))
    far = entry.select("feature", "size", F.col("doc_id").alias("y"), F.col("n").alias("ny"))
    pairs = near.join(far, ["feature", "size"]).where((F.col("own") < F.col("size")) | (F.col("x") < F.col("y"))).where(F.least("nx", "ny") >= least * F.greatest("nx", "ny"))
    pairs = staged(pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y").distinct(), "spots-pairs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            like = [likeness(np.frombuffer(p, np.uint32), np.frombuffer(q, np.uint32), least) for p, q in zip(b.column("fx").to_pylist(), b.column("fy").to_pylist())]
            yield record_batch("x long, y long, likeness double", b.column("x"), b.column("y"), like)

    sides = [classes.select(F.col("doc_id").alias(k), F.col("features").alias(f"f{k}")) for k in ("x", "y")]
    return pairs.join(sides[0], "x").join(sides[1], "y").select("x", "y", "fx", "fy").mapInArrow(compare, "x long, y long, likeness double").where(F.col("likeness") >= least)
