"""Sampled segmentations over a piece vocabulary, lossless to decode.

All ways to spell a text in pieces form a lattice. Forward filtering sums the weights of the paths to each place;
backward sampling walks from the end and takes each piece with its share of the sum. The draws are hashes of the row's
key, the word and the step, so a row's segmentation does not depend on where or with what it is run. No piece reaches
over the beginning of a word, so words are lattices of their own and equal words of a slice share one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import mix, sliced

BLANK = "▁"
SLICE_BYTES = 4 << 20


class Pieces:
    """A vocabulary with log-weights and its trie.

    Scores of a unigram model are log-probabilities. Those of a BPE model are ranks, taken as Zipf's law has it:
    weight 1 / (rank + 10). Characters without a piece are spelled in byte pieces, each as rare as the rarest.
    """

    def __init__(self, path: str, theta: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        score = np.array([sp.get_score(i) for i in ids])
        ranks = bool((score == np.round(score)).all())
        weight = theta * (-np.log(10 - score) if ranks else score)
        self.rare = float(weight.min())
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.text = {int(self.byte[b]): bytes([b]) for b in range(256)}
        names = [sp.id_to_piece(i) for i in ids]
        self.text |= {i: n.replace(BLANK, " ").encode() for i, n in zip(ids, names)}
        self.apart = not any(BLANK in n.lstrip(BLANK) for n in names)
        # the trie: a step is state * 2**21 + character
        steps: dict[int, int] = {}
        self.end_id, self.end_weight = [-1], [0.0]
        for i, n, w in zip(ids, names, weight):
            state = 0
            for c in n:
                state = steps.setdefault((state << 21) + ord(c), len(steps) + 1)
                if state == len(self.end_id):
                    self.end_id.append(-1)
                    self.end_weight.append(0.0)
            self.end_id[state], self.end_weight[state] = i, w
        self.end_id, self.end_weight = np.array(self.end_id), np.array(self.end_weight)
        self.steps, self.next = pd.Index(np.fromiter(steps.keys(), np.int64, len(steps))), np.fromiter(steps.values(), np.int64, len(steps))

    def words(self, text: str, own_blank: str) -> list[str]:
        """The parts of the text, each to be read with a BLANK before it; no piece reaches over their edges.
        ``own_blank`` stands for a BLANK that is in the text itself."""
        text = text.replace(BLANK, own_blank)
        parts = text.split(" ")
        if not self.apart:
            return [text.replace(" ", BLANK)]
        if "" in parts:
            parts = [w[1:] for w in re.findall(f"{BLANK}+[^{BLANK}]*", BLANK + text.replace(" ", BLANK))]
        return parts

    def lattice(self, spelled: list[str]) -> tuple[np.ndarray, ...]:
        """Edges of all words' lattices by their end: start, piece, and the share, of the paths to that end, of the
        end's edges up to this one; where each place's edges begin; and each word's first and last place."""
        code = np.frombuffer((BLANK + BLANK.join(spelled)).encode("utf-32-le"), np.uint32).astype(np.int64)
        length = np.array([len(w) + 1 for w in spelled])
        first = np.cumsum(length) - length
        word = np.repeat(np.arange(len(spelled), dtype=np.int32), length)
        left = np.repeat(first + length, length) - np.arange(len(code))  # characters to the word's end
        # places are numbered by their distance from the word's begin, so that one order serves both passes
        rank = np.empty(len(spelled), np.int32)
        rank[np.argsort(-length, kind="stable")] = np.arange(len(spelled))
        at_depth = np.concatenate((np.cumsum(np.bincount(length)[::-1])[::-1], [0]))  # words of this length or more
        offset = np.concatenate(([0], np.cumsum(at_depth))).astype(np.int32)
        depth = (np.arange(len(code)) - first[word]).astype(np.int32)
        place = offset[depth] + rank[word]
        begin = np.argsort(place, kind="stable")

        def reached(at: np.ndarray, size: int) -> np.ndarray:
            return offset[depth[at] + size] + rank[word[at]]

        starts, ends, ids, weights = [], [], [], []
        state, at, size = np.zeros(len(code), np.int64), begin, 0
        while len(at):
            size += 1
            i = self.steps.get_indexer((state << 21) + code[at + size - 1])
            hit = i >= 0
            at, state = at[hit], self.next[i[hit]]
            full = self.end_id[state] >= 0
            starts.append(place[at[full]])
            ends.append(reached(at[full], size))
            ids.append(self.end_id[state[full]])
            weights.append(self.end_weight[state[full]])
            more = left[at] > size
            at, state = at[more], state[more]
            if size == 1:  # characters without a piece of their own: bytes
                bare = np.ones(len(code), bool)
                bare[np.searchsorted(place[begin], starts[0])] = False
                bare = begin[bare]
                c = code[bare]
                starts.append(place[bare])
                ends.append(reached(bare, 1))
                ids.append(-1 - c)
                weights.append(self.rare * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)))
        start, end, piece, weight = (np.concatenate(x) for x in (starts, ends, ids, weights))
        order = np.argsort(end, kind="stable")
        start, end, piece, weight = start[order], end[order], piece[order], weight[order]
        group = np.concatenate(([0], np.flatnonzero(np.diff(end)) + 1))  # where each end's edges begin
        edges_of = np.diff(np.append(group, len(end)))
        lo = np.zeros(offset[-1] + 1, np.int64)
        lo[end[group]] = group
        forward = np.zeros(offset[-1] + 1)
        cuts = np.searchsorted(end, offset[1:])
        cuts = cuts[: np.searchsorted(cuts, len(end)) + 1]
        which = np.searchsorted(group, cuts)
        path = np.empty(len(start))
        for i, j, g, h in zip(cuts, cuts[1:], which, which[1:]):
            path[i:j] = forward[start[i:j]] + weight[i:j]
            forward[end[group[g:h]]] = np.logaddexp.reduceat(path[i:j], group[g:h] - i)
        share = np.exp(path - forward[end])
        sums = np.cumsum(share)
        up_to = sums - np.repeat(sums[group] - share[group], edges_of)
        up_to[group + edges_of - 1] = 2.0  # the last of each end takes what rounding leaves
        return start, piece, up_to, lo, rank, offset[length] + rank

    def sample(self, keys: list, texts: list[str], seed: int = 0) -> list[np.ndarray]:
        """Piece ids of one sampled segmentation of each text; an empty text has the blank's."""
        own_blank = BLANK
        if any(BLANK in t for t in texts):  # a character that no text holds
            own_blank = next(c for c in map(chr, range(0x10FFFF, 0xE000, -1)) if not any(c in t for t in texts))
        split = [self.words(t, own_blank) for t in texts]
        count = np.array([len(w) for w in split])
        found = pa.array([w for ws in split for w in ws], pa.string()).dictionary_encode()
        codes, spelled = found.indices.to_numpy(), found.dictionary.to_pylist()
        start, piece, up_to, begin, low, high = self.lattice(spelled)
        number = np.arange(len(codes)) - np.repeat(np.cumsum(count) - count, count)
        rows = np.array([xxhash.xxh64_intdigest(repr(k), seed=seed) for k in keys], np.uint64)
        state = mix(np.repeat(rows, count) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        live, place = np.arange(len(codes)), high[codes]
        taken, whose = [], []
        step = 0
        while len(live):
            u = (mix(state[live] + np.uint64(step * 0xD1B54A32D192ED03 & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            e = begin[place]
            on = np.flatnonzero(up_to[e] <= u)
            while len(on):
                e[on] += 1
                on = on[up_to[e[on]] <= u[on]]
            taken.append(piece[e])
            whose.append(live)
            place = start[e]
            more = place > low[codes[live]]
            live, place = live[more], place[more]
            step += 1
        pieces = np.bincount(np.concatenate(whose), minlength=len(codes))
        after = np.cumsum(pieces)
        out = np.empty(after[-1], np.int64)
        for k, (t, w) in enumerate(zip(taken, whose)):
            out[after[w] - 1 - k] = t
        edges = after[np.cumsum(count) - 1]
        return [self._spelled(out[a:b], own_blank) for a, b in zip(np.concatenate(([0], edges)), edges)]

    def _spelled(self, edges: np.ndarray, own_blank: str) -> np.ndarray:
        bare = edges < 0
        if not bare.any():
            return edges
        plain = bare & (edges >= -128)
        edges = np.where(plain, self.byte[np.where(plain, -1 - edges, 0)], edges)
        if not (edges < 0).any():
            return edges
        parts = [[e] if e >= 0 else self.byte[list((BLANK if chr(-1 - e) == own_blank else chr(-1 - e)).encode())] for e in edges]
        return np.concatenate(parts)

    def decode(self, ids: np.ndarray) -> str:
        """The text again; the blank before its first word is dropped."""
        return b"".join(map(self.text.__getitem__, ids.tolist())).decode()[1:]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, theta: float = 1.0) -> DataFrame:
    """doc_id, n_pieces, ids (array<int>), ids_crc32 (little-endian unsigned 32-bit ids), lossless: a sampled
    segmentation of each whole text, seeded by doc_id.

    ``theta`` flattens (below 1) or sharpens the distribution. A null text is empty; rows of equal id and text are
    segmented alike, also those of null id; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model, theta)
        for b in sliced(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in b.column("text").to_pylist()]
            ids = pieces.sample(b.column("doc_id").to_pylist(), texts, seed)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                 pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array([pieces.decode(x) == t for x, t in zip(ids, texts)])],
                names=["doc_id", "n_pieces", "ids", "ids_crc32", "lossless"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_pieces long, ids array<int>, ids_crc32 long, lossless boolean")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of a table (doc_id, ids); null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [None if x is None else pieces.decode(np.array(x)) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
