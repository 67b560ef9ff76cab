"""Alignment of two tokenizers over the same texts, by pointer jumping.

Both token rows cover the same bytes. Every token points to the token, of either row, that overlaps it and reaches
farthest to the right (itself if none reaches further; of two that end together the first row's). Doubling these
pointers, all at once for a slice of documents, converges to the last token of each connected run of overlapping
tokens; it labels the run. Runs end where tokens of both rows end together, and these two are linked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import dealt, handed_back, sliced, staged
from quarterline.llm.packing import Encoder

#: Bytes of text that are encoded and aligned side by side; a longer text is a slice of its own.
SLICE = 2 << 20
_ROW_GROUP = 16 << 20


class ByteLevel:
    """Ids and bytes of a byte-level BPE (a tokenizer file); strings of special tokens in a text are plain text."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.encoder.tokenizer.encode_special_tokens = True
        self.encoder.specials = []
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
        vocabulary = self.encoder.tokenizer.get_vocab(with_added_tokens=False)
        self.pieces = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.pieces[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, self.encoder.dtype)[:-1].astype(np.int64) for x in self.encoder.encode(texts)]


class Pieces:
    """Ids and bytes of a SentencePiece model with byte fallback; it adds a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The last token of the run that each token (of the first row, then of the second) belongs to.

    ``ends_a`` and ``ends_b`` rise strictly and have the same last value. Rounds: logarithm of the longest run.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the token that holds a token's last byte
    over_b = np.searchsorted(ends_a, ends_b)
    successor = np.concatenate([np.where(ends_b[over_a] > ends_a, over_a + n, np.arange(n)), over_b]) if n else np.zeros(0, np.int64)
    while True:
        doubled = successor[successor]
        if (doubled == successor).all():
            return successor
        successor = doubled


class Digits:
    """Decimal ids, each with one more byte, without a Python object per id."""

    def __init__(self, n: int):
        text = [str(i).encode() for i in range(n)]
        self.width = max(map(len, text), default=1) + 1
        self.bytes = np.frombuffer(b"".join(t.ljust(self.width) for t in text), np.uint8).reshape(n, self.width)
        self.length = np.array([len(t) for t in text], np.int64)

    def written(self, ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All ids, each followed by its byte of ``after``, and where each ends."""
        out = self.bytes[ids]
        length = self.length[ids]
        out[np.arange(len(ids)), length] = after
        return out[np.arange(self.width) <= length[:, None]].tobytes(), np.cumsum(length + 1)


class Aligner:
    """Aligns a slice of texts."""

    def __init__(self, byte_level: str, piece_model: str):
        self.sides = [ByteLevel(byte_level), Pieces(piece_model)]
        self.lengths = [np.array([len(p) for p in s.pieces], np.int64) for s in self.sides]
        self.digits = Digits(max(len(s.pieces) for s in self.sides))

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both rows per text; none of a text that is empty or that either row's bytes do not give back."""
        a, b = self.sides[0].encode([" " + t for t in texts]), self.sides[1].encode(texts)
        none = np.zeros(0, np.int64)
        for i, t in enumerate(texts):
            whole = (" " + t).encode() if t else None
            if any(b"".join([s.pieces[x] for x in ids[i].tolist()]) != whole or (n[ids[i]] == 0).any() for s, ids, n in zip(self.sides, (a, b), self.lengths)):
                a[i] = b[i] = none
        return a, b

    def align(self, texts: list[str]) -> dict:
        """Per text: n_a, n_b, n_groups, groups_sha256; and the links in text order as ``a``, ``b``, with their ``text``."""
        rows = self.tokens(texts)
        count = [np.array([len(x) for x in r], np.int64) for r in rows]
        a, b = (np.concatenate([np.zeros(0, np.int64), *r]) for r in rows)
        ends_a, ends_b = (np.cumsum(n[ids]) for n, ids in zip(self.lengths, (a, b)))
        last = terminals(ends_a, ends_b)
        of_a, of_b = last[: len(a)], last[len(a) :]
        terminal = np.flatnonzero(of_a == np.arange(len(a)))
        group_a, group_b = np.searchsorted(terminal, of_a), np.searchsorted(terminal, of_b)
        size_a, size_b = (np.bincount(g, minlength=len(terminal)) for g in (group_a, group_b))
        # places in the written form: a group's first row, then its second
        before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + (before_a + size_a)[group_b]
        ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        link_b = np.cumsum(size_b) - 1  # a group's last token of the second row ends with its terminal
        after[place_a[terminal]], after[place_b[link_b]] = ord("|"), ord(";")
        text, ends = self.digits.written(ids, after)
        until = np.concatenate(([0], ends))[np.cumsum(count[0] + count[1])]
        starts = np.concatenate(([0], until[:-1])) if len(until) else until
        owner = np.repeat(np.arange(len(texts)), count[0])[terminal]
        return {
            "n_a": count[0], "n_b": count[1], "n_groups": np.bincount(owner, minlength=len(texts)),
            "groups_sha256": [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(starts.tolist(), until.tolist())],
            "a": a[terminal], "b": b[link_b], "text": owner}


_DOCS = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
_SLICES = ("slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
           "groups_sha256 array<string>, links binary, pairs array<long>, n array<long>")


def slices(docs: DataFrame, byte_level: str, piece_model: str, id_col: str, text_col: str) -> DataFrame:
    """A row per slice of documents: its documents' counts, its distinct linked pairs (first id * 2**32 + second) with
    their numbers, and every link in text order as the number of its pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, at = Aligner(byte_level, piece_model), TaskContext.get().partitionId() << 32
        lists = [pa.list_(pa.int64())] * 5
        kinds = [pa.int64(), *lists, pa.list_(pa.string()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for b in sliced(batches, "text", SLICE):
            got = aligner.align([x or "" for x in b.column("text").to_pylist()])
            pairs, links, n = np.unique((got["a"] << 32) | got["b"], return_inverse=True, return_counts=True)
            n_links = np.bincount(got["text"], minlength=b.num_rows)
            values = [at, b.column("doc_id").to_pylist(), got["n_a"], got["n_b"], got["n_groups"], n_links, got["groups_sha256"], links.astype("<u4").tobytes(), pairs, n]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _SLICES.split(", ")])
            at += 1

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lambda b: handed_back(run(b)), _SLICES)


def linked(docs: DataFrame, byte_level: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document.

    Counts of linked id pairs are taken over all documents. They and the slices meet by joins on the pair and on the
    slice; a slice's pairs are counted before they are shuffled, and a pair that every slice has can be split.
    n_best: links whose pair is the most frequent of its second id, ties included; count_sum: the counts summed.

    A null or empty text and one that a tokenizer does not give back byte for byte have no tokens. Repeated rows and
    null ids come back as they came. Other columns are not looked at. An empty table gives an empty result.
    """
    table = staged(slices(docs, byte_level, piece_model, id_col, text_col), "alignment-slices", group_bytes=_ROW_GROUP)
    each = table.select("slice", F.posexplode(F.arrays_zip("pairs", "n"))).select("slice", "pos", F.col("col.pairs").alias("pair"), F.col("col.n").alias("n"))
    counts = staged(each.groupBy("pair").agg(F.sum("n").alias("count")), "alignment-counts")
    second = F.col("pair").bitwiseAND((1 << 32) - 1)
    best = counts.groupBy(second.alias("second")).agg(F.max("count").alias("best"))
    judged = staged(counts.withColumn("second", second).join(best, "second").select("pair", "count", (F.col("count") == F.col("best")).alias("best")), "alignment-best")
    found = each.select("slice", "pos", "pair").join(dealt(judged, "pair"), "pair")
    # a slice has no more pairs than links
    found = found.groupBy("slice").agg(F.collect_list(F.struct("pos", "count", "best")).alias("found"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    shape = pa.schema([pa.field(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                cells = {c: b.column(c).slice(i, 1).flatten() for c in (*_DOCS, "groups_sha256")}
                got = b.column("found").slice(i, 1).flatten()
                pos = got.field("pos").to_numpy()
                count, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
                count[pos], best[pos] = got.field("count").to_numpy(), got.field("best").to_numpy(zero_copy_only=False)
                links = np.frombuffer(b.column("links")[i].as_py(), "<u4")
                until = np.cumsum(cells["n_links"].to_numpy())
                sums = [np.diff(np.concatenate(([0], np.cumsum(x[links])))[np.concatenate(([0], until))]) for x in (best, count)]
                yield pa.RecordBatch.from_arrays([*(cells[c] for c in _DOCS), *map(pa.array, sums), cells["groups_sha256"]], schema=shape)

    rows = table.drop("pairs", "n").join(found, "slice", "left")
    return staged(rows.mapInArrow(lambda b: handed_back(run(b)), schema), "alignment-rows", arrow_rows=2)
