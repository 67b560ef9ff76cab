"""Concatenate and cut: all documents as one token stream, cut into fixed windows.

Pass 1 tokenizes each scan task's documents and writes the ids with their offset inside the task and the
task's number; pass 2 sums the tasks' totals (a prefix sum over one row per task) and cuts every document at
multiples of the window. No text or id is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.common import handed_back, record_batch, sliced, staged

class Encoder:
    """Token ids of whole texts as little-endian bytes, as the tokenizer of ``path`` gives them.

    A byte-level BPE is run by a faster library from the same file's vocabulary; in every slice some text is encoded
    both ways, and should the ids ever differ, or a text hold a special token's string, the tokenizer itself is used.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.zeros(1, self.dtype).tobytes()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if "ByteLevel(add_prefix_space=False" in str(self.tokenizer.pre_tokenizer) and self.tokenizer.normalizer is None:
            # printable characters stand for themselves, the other bytes for characters from 256 on
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
            ranks = {bytes(byte[c] for c in k): v for k, v in self.tokenizer.get_vocab(with_added_tokens=False).items() if k not in self.specials}
            self.fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _slow(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _quick(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.specials):
            return self._slow(text)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        sample = sorted(texts, key=len)[len(texts) // 2] if texts else ""
        use = self._quick if self._quick(sample) == self._slow(sample) else self._slow
        return [use(t) + self.end for t in texts]


def encoded(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """Pass 1: a row per document: task, start in the task, n_tokens (with the end token), ids."""
    schema = "doc_id long, task long, start long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at, task = Encoder(tokenizer), 0, TaskContext.get().partitionId()
        for b in sliced(batches, "text", 2 << 20):
            ids = encoder.encode([x or "" for x in b.column("text").to_pylist()])
            n = np.array([len(x) // encoder.dtype.itemsize for x in ids], np.int64)
            yield record_batch(schema, b.column("doc_id"), np.full(len(n), task), at + np.cumsum(n) - n, n, pa.array(ids, pa.binary()))
            at += int(n.sum())

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lambda b: handed_back(run(b)), schema)


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens; only the last sequence may be short.

    Every document's ids are followed by token 0. A null text is empty (one token); a null id stays null; repeated
    rows are packed as often as they come; an empty table gives no piece. Returns doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and the piece's ids (little-endian, 2 or 4 bytes an id).
    """
    from tokenizers import Tokenizer

    wide = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    table = staged(encoded(docs, tokenizer, id_col, text_col), "packing-ids")
    # one row per scan task: bounded by the number of input splits, whatever the rows hold; small enough to broadcast
    totals = table.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    starts = totals.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("task_start"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "ids", 4 << 20):
            out: list[tuple] = []
            for doc, at, n, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "at", "n_tokens", "ids"))):
                all_ids = np.frombuffer(ids, wide)
                edges = [at, *range((at // length + 1) * length, at + n, length), at + n]
                for lo, hi in zip(edges, edges[1:]):
                    piece = all_ids[lo - at : hi - at]
                    out.append((doc, lo - at, hi - lo, zlib.crc32(piece.astype("<u4").tobytes()), n, lo // length, lo % length, piece.tobytes()))
            yield record_batch(schema, *zip(*out))

    placed = table.join(F.broadcast(starts), "task").select("doc_id", (F.col("task_start") + F.col("start")).alias("at"), "n_tokens", "ids")
    return placed.mapInArrow(cut, schema)
