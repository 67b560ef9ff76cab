"""Probabilistic suffix tree over word classes, and its scores of whole texts.

A text is a sequence of tokens: its words and one end. Frequent words are classes of their own, the others share the
class of their longest frequent ending, and the end is a class. A token's probability is that of its class after the
classes before it, which the tree gives, times that of the word within its class (counts plus one, as in the base).

* A context, back to the text's start, is a candidate if at least ``min_count`` training tokens follow it (fewer on a
  small corpus: ``min_share`` of them). So contexts, classes and depth grow with the corpus. A candidate is kept if its
  next-class distribution diverges from its suffix's by ``divergence`` nats and by more than its own parameters cost.
  Suffixes of kept contexts stay.
* Contexts go by 64-bit hashes. Their counts and the tree are tables with a row per context. Every task knows the
  commonest contexts of the tree, of as many counts at any size of the corpus; a chunk of texts asks for the others it
  has by a join. Bit sets of fixed size only save asking for what is surely not there.
* Distributions are smoothed towards the suffix's with as much weight as they have distinct next classes.
* A token is scored in the longest kept suffix of what precedes it.
* Every task knows the counts of the commonest words, as many at any size of the corpus. A chunk of texts asks for those
  of its other words by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import discard, handed_back, mix, record_batch, sliced, staged, with_ids

#: Tokens that must follow a context, or on a corpus where that is less, this share of all.
MIN_COUNT, MIN_SHARE = 1000, 1e-4
DIVERGENCE = 0.005
#: Words and endings (of up to ENDING bytes) with this count, or share of a small corpus, are classes.
CLASS_COUNT, CLASS_SHARE = 10_000, 1e-3
ENDING = 3
END, START, OTHER = 0, 1, 2
BITS = 16
#: Contexts' bit sets have 2^SET_BITS bits at any size of the corpus, two for a context; two contexts of the same bits are
#: told apart by the tables.
SET_BITS = 24
#: Texts are indexed in chunks of about so many bytes and at most so many documents.
CHUNK_BYTES, CHUNK_ROWS = 8 << 20, 1 << 16
#: Tokens of a chunk whose contexts are held side by side.
PART_TOKENS = 1 << 19
#: Words, of up to COMMON_BYTES, whose counts every task has.
COMMON, COMMON_BYTES = 1 << 18, 64
#: Counts held per task before some are handed on: of contexts' classes, and half as many of chunks' words.
HELD_COUNTS = 1 << 21
#: Counts in the contexts that every task has.
KNOWN_COUNTS = 1 << 21
#: A task counts so many tokens for each context it may send, as far as that is not more than TASK_TOKENS.
CONTEXT_TOKENS, TASK_TOKENS = 1 << 10, 1 << 26


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in chunks: batches cut where they are larger, and put together where they are smaller."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for big in sliced(batches, "text", CHUNK_BYTES):
        for lo in range(0, big.num_rows, CHUNK_ROWS):
            b = big.slice(lo, CHUNK_ROWS)
            more = pc.sum(pc.binary_length(b.column("text"))).as_py() or 0
            if held and (rows + b.num_rows > CHUNK_ROWS or size + more > CHUNK_BYTES):
                yield pa.concat_batches(held)
                held, rows, size = [], 0, 0
            held.append(b)
            rows, size = rows + b.num_rows, size + more
    if held:
        yield pa.concat_batches(held)


def _tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Words of each text (how many), the code of each word, the distinct words, and which texts are held out."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(b.column("text"), "")))
    words = split.flatten()
    owner = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy())
    full = pc.binary_length(words).to_numpy() > 0  # nothing before a first blank or after a last one
    coded = words.filter(pa.array(full)).dictionary_encode()
    codes, found = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.binary())
    return np.bincount(owner[full], minlength=len(split)), codes, found, b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)


def vocabulary(rows: DataFrame) -> DataFrame:
    """word, c: how often the training texts hold each word of any text; the empty word is the end."""
    schema = "word binary, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            length, codes, found, held = _tokens(b)
            train = np.bincount(codes, np.repeat(~held, length), len(found)).astype(np.int64)
            yield record_batch(schema, found, train)
            yield record_batch(schema, [b""], [int((~held).sum())])

    return staged(rows.mapInArrow(lambda b: handed_back(run(b)), schema).groupBy("word").agg(F.sum("n").alias("c")), "lm-words")


def _at(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each word is among the others, -1 if it is not."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy(zero_copy_only=False).astype(np.int64)


class Classes:
    """Class numbers of words: frequent words, then frequent endings, the longest first."""

    def __init__(self, words: list[bytes], endings: list[bytes]):
        self.words, self.endings = pa.array(words, pa.binary()), pa.array(endings, pa.binary())
        self.n = OTHER + 1 + len(words) + len(endings)

    def of(self, words: pa.Array) -> np.ndarray:
        k = _at(words, self.words)
        for size in range(ENDING, 0, -1):
            e = _at(pc.binary_slice(words, -size), self.endings)
            k = np.where((k < 0) & (e >= 0), e + len(self.words), k)
        return np.where(pc.binary_length(words).to_numpy(zero_copy_only=False) == 0, END, np.where(k < 0, OTHER, k + OTHER + 1))


def support(total: int, count: int, share: float) -> float:
    """How often something must occur: ``count`` times, or ``share`` of a total where that is less."""
    return max(2.0, min(float(count), share * total))


def longest(total: int, least: float) -> int:
    """Classes in a context at most: one for each factor of ten from the least support to the corpus, and three anyway."""
    return max(3, math.ceil(math.log10(max(total / least, 1))))


def frequent(words: DataFrame, least: float) -> tuple[list[bytes], list[bytes]]:
    """The words and the endings that are classes, by the count each must have."""
    known = words.where("c > 0 and word <> X''")
    own = [bytes(r[0]) for r in known.where(F.col("c") >= least).select("word").collect()]
    ending = F.expr(f"explode(transform(sequence(1, {ENDING}), k -> substring(word, -k, k)))")
    ends = known.where(F.col("c") < least).select("c", ending.alias("e")).groupBy("e").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    return sorted(own), sorted(bytes(r[0]) for r in ends.select("e").collect())


def highest(rows: DataFrame, by: str, weight: Column, most: int) -> Column:
    """Which rows have the highest of the positive numbers ``by`` and weigh ``most`` together or somewhat less: by a
    histogram of the numbers to a ninth."""
    scale = F.floor(F.log2(by) * 8)
    least, so_far = math.inf, 0
    for r in rows.groupBy(scale.alias("scale")).agg(F.sum(weight).alias("weight")).orderBy(F.desc("scale")).collect():
        so_far += r["weight"]
        if so_far > most:
            break
        least = r["scale"]
    return scale >= F.lit(float(least))


def common(words: DataFrame) -> tuple[Column, DataFrame]:
    """Which rows of ``words`` are common, and these: about the COMMON words of the highest counts, no more."""
    short = (F.col("c") > 0) & (F.col("word") != F.lit(b"")) & (F.length("word") <= COMMON_BYTES)
    few = short & highest(words.where(short), "c", F.lit(1), COMMON)
    return few, words.where(few)


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _hash(classes: np.ndarray) -> np.ndarray:
    return mix((classes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _before(tokens: np.ndarray) -> np.ndarray:
    """How many classes precede each token in its text (the start is one)."""
    return np.arange(tokens.sum()) - np.repeat(np.cumsum(tokens) - tokens, tokens) + 1


def _longer(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Keys of the contexts that end in ``symbol`` after ``context``. A key is the sum of the hashes of the classes, the
    last one's as it is, the one's before it times _STEP and so on."""
    return _hash(symbol) + context.astype(np.uint64) * _STEP


def _contexts(classes: np.ndarray, before: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """Per depth from 0 the key of each token's context; those of texts that don't reach so far back say nothing."""
    hashes, start = _hash(classes), _hash(np.array([START]))[0]
    key, power = np.zeros(len(classes), np.uint64), np.uint64(1)
    yield key
    for d in range(1, depth + 1):
        previous = np.full(len(classes), start, np.uint64)
        previous[d:] = hashes[:-d]
        previous[before == d] = start
        key = key + previous * power
        power = np.uint64(int(power) * int(_STEP) & (1 << 64) - 1)
        yield key


def _bit(mixed: np.ndarray, second: bool) -> np.ndarray:
    """The first or the second bit of keys that are mixed."""
    return (mixed << np.uint64(SET_BITS * second) >> np.uint64(64 - SET_BITS)).astype(np.int64)


def _both(key: np.ndarray) -> np.ndarray:
    mixed = mix(key)
    return np.concatenate((_bit(mixed, False), _bit(mixed, True)))


def _bits(contexts: DataFrame, *more: int) -> np.ndarray | None:
    """The bit set of the keys in the column context, or where there is a column symbol of the contexts that end in it
    after these, and of ``more``; None if there are none."""
    columns = [c for c in contexts.columns if c in ("context", "symbol")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("context").to_numpy().view(np.uint64)
            if "symbol" in columns:
                key = _longer(key, b.column("symbol").to_numpy())
            yield record_batch("bit int", np.unique(_both(key)).astype(np.int32))

    at = contexts.select(*columns).mapInArrow(lambda b: handed_back(run(b)), "bit int").distinct().toPandas()["bit"].to_numpy(np.int64)
    out = np.zeros(1 << SET_BITS, bool)
    out[at] = True
    out[_both(np.array(more, np.uint64))] = True
    return np.packbits(out) if len(at) or more else None


def _among(key: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the bits of each key are set."""
    mixed, out = mix(key), np.zeros(len(key), bool)
    live = np.arange(len(key))
    for second in (False, True):
        at = _bit(mixed[live], second)
        live = live[(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)]
    out[live] = True
    return out


def _tasks(tokens: int, bits: np.ndarray | None, cores: int) -> int:
    """In how many tasks the contexts of these bits are counted. A context is sent by each task that has it, and a larger
    corpus has more contexts: so tasks become larger with them, and the rows sent stay in proportion to the tokens as far
    as tasks may become larger and hold the counts."""
    contexts = 1 if bits is None else sum(np.unpackbits(x).sum(dtype=np.int64) for x in np.array_split(bits, 16)) / 2
    return max(cores, math.ceil(tokens / min(CONTEXT_TOKENS * max(contexts, 1), TASK_TOKENS)))


def _parts(tokens: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Runs of texts of about PART_TOKENS tokens (one text at least): their texts and their tokens."""
    until = np.cumsum(tokens)
    lo = 0
    while lo < len(tokens):
        done = until[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(until, done + PART_TOKENS, "right")))
        yield slice(lo, hi), slice(int(done), int(until[hi - 1]))
        lo = hi


def _distinct(key: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one of each pair is, and how often it occurs."""
    at, _ = pd.factorize(_longer(key, symbol))
    n = np.bincount(at)
    where = np.empty(len(n), np.int64)
    where[at] = np.arange(len(at))
    return where, n


class SuffixTree:
    """Per depth: the kept contexts (their keys), their totals, how many classes follow each, and the counts of those
    by context's index and class. It may hold just the contexts of some texts, to score these; ``known`` are the levels
    from depth 1 of other contexts."""

    def __init__(self, levels: list[tuple], n_classes: int, known: list[tuple] = ()):
        self.levels, self.n_classes, self.known = levels, n_classes, known

    @classmethod
    def grown(cls, rows: list[pd.DataFrame], n_classes: int, divergence: float) -> SuffixTree:
        """The tree of few candidates in memory. ``rows``: per depth the columns context (its classes of BITS bits in
        one number), symbol, n; depth 0 is the root."""
        kept: list[np.ndarray] = [np.zeros(1, np.int64)]
        for d, r in enumerate(rows[1:], 1):
            total = r.groupby("context")["n"].transform("sum")
            above = rows[d - 1].assign(t=lambda x: x.groupby("context")["n"].transform("sum"))
            m = r.assign(total=total, suffix=r["context"] % (1 << BITS * (d - 1))).merge(
                above.rename(columns={"context": "suffix", "n": "m"}), on=["suffix", "symbol"])
            gain = (m["n"] * np.log(m["n"] / m["total"] / (m["m"] / m["t"]))).groupby(m["context"]).sum()
            size, n = m.groupby("context")["symbol"].count(), m.groupby("context")["n"].sum()
            kept.append(gain.index[(gain >= divergence * n) & (gain >= 0.5 * size * np.log(n.clip(2)))].to_numpy(np.int64))
        for d in range(len(kept) - 1, 1, -1):
            kept[d - 1] = np.union1d(kept[d - 1], kept[d] % (1 << BITS * (d - 1)))
        levels = []
        for d, r in enumerate(rows):
            r = r[r["context"].isin(kept[d])].sort_values(["context", "symbol"])
            contexts = np.sort(kept[d])
            at = pd.Index(contexts).get_indexer(r["context"])
            key = np.zeros(len(contexts), np.uint64)
            for j in reversed(range(d)):
                key = _longer(key, contexts >> (BITS * j) & ((1 << BITS) - 1))
            levels.append(cls.level(key, np.bincount(at, r["n"], len(contexts)), np.bincount(at, minlength=len(contexts)), at, r["symbol"].to_numpy(), r["n"].to_numpy()))
        return cls(levels, n_classes)

    @staticmethod
    def level(key: np.ndarray, total: np.ndarray, kinds: np.ndarray, at: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple:
        """The counts come by context's index and class."""
        return pd.Index(key), total, kinds, (at.astype(np.int64) << 32) + symbol, n.astype(np.float64)

    @staticmethod
    def _count(entries: np.ndarray, counts: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        if not len(entries):
            return np.zeros(len(at))
        wanted = (at << 32) + symbol
        i = np.minimum(np.searchsorted(entries, wanted), len(entries) - 1)
        return np.where(entries[i] == wanted, counts[i], 0.0)

    def log10(self, classes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """log10 probability of each token's class after what precedes it in its text."""
        before = _before(tokens)
        symbol = classes.astype(np.int64)
        _, total, _, entries, counts = self.levels[0]
        p = (self._count(entries, counts, np.zeros(len(symbol), np.int64), symbol) + 1) / (total.sum() + self.n_classes)
        live = np.arange(len(symbol))
        depth = max(len(self.levels) - 1, len(self.known))
        keys = _contexts(classes, before, depth)
        next(keys)
        for d in range(1, depth + 1):
            live = live[before[live] >= d]
            key, kept = next(keys)[live], np.zeros(len(live), bool)
            for contexts, total, kinds, entries, counts in [*self.levels[d : d + 1], *self.known[d - 1 : d]]:
                at = contexts.get_indexer(key)
                kept |= at >= 0
                own, at = live[at >= 0], at[at >= 0]
                p[own] = (self._count(entries, counts, at, symbol[own]) + kinds[at] * p[own]) / (total[at] + kinds[at])
            live = live[kept]
            if not len(live):
                break
        return np.log10(p)


def symbol_type(n_classes: int) -> type:
    return np.uint16 if n_classes <= 1 << 16 else np.uint32


def _index(rows: DataFrame, classes: Classes, known: pa.Array, values: list[np.ndarray]) -> DataFrame:
    """A row per chunk and distinct word that is not among the ``known`` ones: the word and its number in the chunk. A
    row without word tells the chunk's documents: ids, nulls, held out, token counts; all classes; of the numbered words
    their class, how often and in which document (its place, uint16) they occur; and the sums of the known words by
    document: how many, and of each of the ``values``."""
    schema = "chunk long, word binary, number int, about binary, classes binary, kinds binary, places binary, sums binary"
    width = symbol_type(classes.n)
    shared = rows.sparkSession.sparkContext.broadcast((classes, known, [np.append(x, 0.0) for x in values]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, known, values = shared.value
        number = TaskContext.get().partitionId() << 32
        for b in _chunks(batches):
            length, codes, found, held = _tokens(b)
            place = np.repeat(np.arange(len(length)), length)
            at, kind = _at(found, known), classes.of(found)
            sums = np.concatenate([np.bincount(place, x[codes], len(length)) for x in (at >= 0, *(v[at] for v in values))])
            asked = np.flatnonzero(at < 0)
            use = np.flatnonzero((at < 0)[codes])
            own = (np.cumsum(at < 0) - 1)[codes[use]]
            size = np.bincount(own, minlength=len(asked))
            n = len(asked)
            yield record_batch(schema, np.full(n, number), found.take(pa.array(asked)), np.arange(n), *[pa.nulls(n, pa.binary())] * 5)
            sequence = np.full(len(codes) + len(length), END, width)  # each text's end stays
            sequence[np.arange(len(codes)) + place] = kind[codes] if len(codes) else 0
            ids = b.column("doc_id")
            about = [pc.fill_null(ids, 0).to_numpy().astype(np.int64).tobytes(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                     held.astype(np.uint8).tobytes(), (length + 1).tobytes()]
            yield record_batch(schema, [number], [None], [None], [b"".join(about)], [sequence.tobytes()],
                               [np.concatenate((kind[asked], size)).astype(np.uint32).tobytes()], [place[use][np.argsort(own, kind="stable")].astype(np.uint16).tobytes()], [sums.tobytes()])
            number += 1

    return staged(rows.mapInArrow(lambda b: handed_back(run(b)), schema), "lm-index")


def _about(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // 18
    return tuple(np.frombuffer(data, kind, n, at * n) for kind, at in ((np.int64, 0), (np.uint8, 8), (np.uint8, 9), (np.int64, 10)))


def _sequence(about: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of a chunk's tokens, the lengths of its texts and which are held out."""
    _, _, held, tokens = _about(about)
    return np.frombuffer(data, np.uint32 if len(data) > 2 * tokens.sum() else np.uint16), tokens, held


def _strings(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """The values, ``size`` of them in each row, as binary."""
    offsets = np.concatenate(([0], np.cumsum(size))) * data.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _summed(key: np.ndarray, suffix: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """One of each pair of context and class, with the sum of its counts."""
    at, _ = pd.factorize(_longer(key, symbol))
    one = np.empty(at.max(initial=-1) + 1, np.int64)
    one[at] = np.arange(len(at))
    return key[one], suffix[one], symbol[one], np.bincount(at, n, len(one)).astype(np.int64)


def _rows(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys begins, and how long it is."""
    first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    return first, np.diff(first, append=len(key))


def _located(of: np.ndarray, each: np.ndarray, wanted: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the classes wanted in each row (``size`` of them), where they are among the row's sorted ones, and which are there."""
    row = np.arange(len(each)) << 32
    there, asked = np.repeat(row, each) + of, np.repeat(row, size) + wanted
    at = np.minimum(np.searchsorted(there, asked), len(there) - 1)
    return at, there[at] == asked


_NONE = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint16), np.zeros(0, np.uint32)]


def _sent(sequences: DataFrame, d: int, bits: np.ndarray | None) -> DataFrame:
    """context, suffix, symbols, counts: of each task's contexts of depth d that have their bits the classes that follow
    them in the training texts, and how often.

    A task sends a context's classes and counts in one row. Where it holds too many it hands on those of the contexts with
    the most classes, which are few, and goes on adding up the others.
    """
    sent = "context long, suffix long, symbols binary, counts binary"
    shared = sequences.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, width = [_NONE], np.uint16

        def add_up() -> None:
            key, suffix, symbol, n = _summed(*(np.concatenate(x) for x in zip(*held)))
            held[:] = [[key, suffix, symbol, n.astype(np.uint32)]]

        def flush(leave: int = 0) -> Iterator[pa.RecordBatch]:
            """Hands on contexts, those with the most classes first, until no more than ``leave`` counts are held."""
            every = held[0]
            context, _ = pd.factorize(every[0])
            size = np.bincount(context)
            first = np.argsort(-size, kind="stable")
            going = np.zeros(len(size), bool)
            going[first[: np.searchsorted(np.cumsum(size[first]), len(context) - leave) + 1]] = True
            going = going[context]
            held[:] = [[x[~going] for x in every]]
            key, suffix, symbol, n = (x[going] for x in every)
            order = np.lexsort((symbol, n, key))
            first, size = _rows(key[order])
            yield record_batch(sent, key[order][first].view(np.int64), suffix[order][first].view(np.int64),
                               _strings(symbol[order].astype(width), size), _strings(n[order], size))

        for b in batches:
            for about, data in zip(b.column("about").to_pylist(), b.column("classes").to_pylist()):
                every, lengths, held_out = _sequence(about, data)
                width = every.dtype
                for texts, own in _parts(lengths):
                    classes, tokens = every[own], lengths[texts]
                    before = _before(tokens)
                    suffix = key = np.zeros(0, np.uint64)
                    for x in _contexts(classes, before, d):
                        suffix, key = key, x
                    use = np.flatnonzero((before >= d) & np.repeat(held_out[texts] == 0, tokens))
                    if d:
                        use = use[_among(key[use], shared.value)]
                    where, n = _distinct(key[use], classes[use])
                    use = use[where]
                    held.append([key[use], suffix[use] if d else np.zeros(len(use), np.uint64), classes[use], n.astype(np.uint32)])
                    if sum(len(x[0]) for x in held) >= HELD_COUNTS:
                        add_up()
                        if len(held[0][0]) > HELD_COUNTS // 2:
                            yield from flush(HELD_COUNTS // 2)
        add_up()
        if len(held[0][0]):
            yield from flush()

    return sequences.mapInArrow(lambda b: handed_back(run(b)), sent)


def _counted(sequences: DataFrame, d: int, bits: np.ndarray | None) -> DataFrame:
    """context, suffix, total, kinds, after, n: a row per context of depth d that has its bits, with the classes that
    follow it in the training texts, in order, and their counts: what tasks send comes by context and is added up."""
    names, schema = ["context", "suffix", "total", "kinds", "after", "n"], "context long, suffix long, total long, kinds long, after array<int>, n array<long>"

    def shaped(key: np.ndarray, suffix: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        first, size = _rows(key)
        offsets = pa.array(np.append(first, len(key)).astype(np.int32))
        total = np.add.reduceat(n, first) if len(first) else n
        return pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(suffix[first]), pa.array(total), pa.array(size.astype(np.int64)),
                                           pa.ListArray.from_arrays(offsets, pa.array(symbol.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(n))], names)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [x.astype(np.int64) for x in _NONE]
        for b in batches:
            if not b.num_rows:
                continue
            symbols, counts = (b"".join(b.column(k).to_pylist()) for k in ("symbols", "counts"))
            n = np.frombuffer(counts, np.uint32)
            size = pc.binary_length(b.column("counts")).to_numpy() // 4
            new = [np.repeat(b.column(k).to_numpy(), size) for k in ("context", "suffix")] + [np.frombuffer(symbols, np.uint16 if len(symbols) < len(counts) else np.uint32), n]
            key, suffix, symbol, n = _summed(*(np.concatenate(x).astype(np.int64) for x in zip(last, new)))
            order = np.lexsort((symbol, key))
            done = int(np.searchsorted(key[order], key.max()))
            yield shaped(*(x[order[:done]] for x in (key, suffix, symbol, n)))
            last = [x[order[done:]] for x in (key, suffix, symbol, n)]
        yield shaped(*last)

    dealt = _sent(sequences, d, bits).repartition("context").sortWithinPartitions("context")
    return staged(dealt.mapInArrow(lambda b: handed_back(merged(b)), schema), f"lm-counts-{d}")


def _judged(contexts: DataFrame, divergence: float) -> DataFrame:
    """context, suffix, total, kinds, kept: whether what follows a context diverges enough from what follows its suffix
    (the classes above, their counts m and total t)."""
    schema = "context long, suffix long, total long, kinds long, kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            size, each = (pc.list_value_length(b.column(k)).to_numpy() for k in ("after", "above"))
            n, m = (b.column(k).flatten().to_numpy() for k in ("n", "m"))
            at, there = _located(b.column("above").flatten().to_numpy(), each, b.column("after").flatten().to_numpy(), size)
            row = np.repeat(np.arange(b.num_rows), size)[there]
            part = np.bincount(row, n[there] * np.log(n[there] / m[at[there]]), b.num_rows)
            total, kinds, t = (b.column(k).to_numpy() for k in ("total", "kinds", "t"))
            gain, cost = part - total * np.log(total / t), 0.5 * kinds * np.log(np.maximum(total, 2))
            yield record_batch(schema, *[b.column(k) for k in ("context", "suffix", "total", "kinds")], (gain >= divergence * total) & (gain >= cost))

    return contexts.mapInArrow(lambda b: handed_back(run(b)), schema)


def _pairs(counts: DataFrame) -> DataFrame:
    """context, symbol, n: a row per context and class."""
    return counts.select("context", F.col("after").alias("symbol"), "n").select("context", F.inline(F.arrays_zip("symbol", "n")))


def fit(index: DataFrame, tokens: int, depth: int, least: float, divergence: float) -> tuple[DataFrame, DataFrame, list[np.ndarray]]:
    """The root's counts; depth, context, total, kinds, symbols, counts of the kept contexts; and their bit sets by depth.
    ``tokens``: how many are counted.

    One depth a job: a candidate followed by a class often enough is a candidate of the next depth. Contexts are told
    from others of their bit by their own totals, so the bits change nothing but the work.
    """
    sequences, cores = index.where("classes is not null").select("about", "classes"), index.sparkSession.sparkContext.defaultParallelism
    counts = [_counted(sequences, 0, None)]
    judged: list[DataFrame] = []

    for d in range(1, depth + 1):
        more = []
        if d == 1 and not _pairs(counts[0]).where((F.col("symbol") == END) & (F.col("n") >= least)).isEmpty():  # every text has one start
            more = _hash(np.array([START])).tolist()
        bits = _bits(_pairs(counts[-1]).where((F.col("n") >= least) & (F.col("symbol") != END)).select("context", "symbol"), *more)
        if bits is None:
            break
        counts.append(_counted(sequences.coalesce(_tasks(tokens, bits, cores)), d, bits))
        candidates = counts[-1].where(F.col("total") >= least)
        above = with_ids(counts[-2].select(F.col("context").alias("suffix"), F.col("after").alias("above"), F.col("n").alias("m"), F.col("total").alias("t")),
                         candidates.select("suffix").distinct(), "suffix")
        judged.append(staged(_judged(candidates.join(above, "suffix"), divergence), f"lm-contexts-{d}", 256))
        discard(sequences.sparkSession)
    levels, bits, need, passed = [], [], None, []
    for d in range(len(judged), 0, -1):
        keep = judged[d - 1].where("kept").select("context")
        if need is not None:
            keep = keep.union(need).distinct()
        kept = staged(judged[d - 1].join(keep, "context", "left_semi"), f"lm-kept-{d}")
        passed.append(kept)
        need = kept.select(F.col("suffix").alias("context"))
        of = _bits(kept)
        if of is None and not bits:
            continue
        bits.insert(0, of)
        levels.append(with_ids(counts[d], kept.select("context"), "context").select(F.lit(d).alias("depth"), "context", "total", "kinds", "after", "n"))
    tree = counts[0].where("false").select(F.lit(0).alias("depth"), "context", "total", "kinds", "after", "n")
    for level in levels:
        tree = tree.union(level)
    tree = staged(tree, "lm-tree")
    discard(sequences.sparkSession, *counts[1:], *judged, *passed)
    return _pairs(counts[0]).select("symbol", "n"), tree, bits


def known_to_all(tree: DataFrame, depth: int) -> tuple[list[tuple], DataFrame]:
    """The levels from depth 1 of the commonest contexts, of KNOWN_COUNTS counts together, and the others."""
    often = highest(tree, "total", F.col("kinds"), KNOWN_COUNTS)
    table, levels = tree.where(often).toArrow(), []
    for d in range(1, depth + 1):
        t = table.filter(pc.equal(table.column("depth"), d)).combine_chunks()
        key, total, kinds = (t.column(k).to_numpy() for k in ("context", "total", "kinds"))
        symbol, n = (pc.list_flatten(t.column(k)).to_numpy() for k in ("after", "n"))
        levels.append(SuffixTree.level(key.view(np.uint64), total, kinds, np.repeat(np.arange(len(key)), kinds), symbol, n))
    return levels, tree.where(~often)


def found(index: DataFrame, tree: DataFrame, bits: list[np.ndarray], kept: list[np.ndarray], symbols: type, counts: type) -> DataFrame:
    """chunk, depth, context, total, kinds, and symbols with their counts: the contexts of each chunk that are in ``tree``,
    and of the classes that follow them in the chunk those that do so in the training texts. ``bits``: by depth of the
    contexts in ``tree`` (None: it has none), ``kept``: of all kept contexts. The last two are the numbers' types."""
    shared = tree.sparkSession.sparkContext.broadcast((bits, kept if any(x is not None for x in bits) else []))
    asked = "chunk long, depth int, context long, symbols binary"
    told = "chunk long, depth int, context long, total long, kinds long, symbols binary, counts binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, kept = shared.value
        for b in batches if kept else ():
            for chunk, about, data in zip(b.column("chunk").to_pylist(), b.column("about").to_pylist(), b.column("classes").to_pylist()):
                every, lengths, _ = _sequence(about, data)
                found: list[list] = [[] for _ in kept]
                for texts, own in _parts(lengths):
                    classes, before = every[own], _before(lengths[texts])
                    live = np.arange(len(classes))
                    for d, key in enumerate(_contexts(classes, before, len(found))):
                        if not d:
                            continue
                        live = live[before[live] >= d]
                        live = live[_among(key[live], kept[d - 1])]
                        if bits[d - 1] is not None:
                            one = live[_among(key[live], bits[d - 1])]
                            one = one[_distinct(key[one], classes[one])[0]]
                            found[d - 1].append((key[one], classes[one]))
                for d, parts in enumerate(found, 1):
                    if not parts:
                        continue
                    key, symbol = (np.concatenate(x) for x in zip(*parts))
                    one = _distinct(key, symbol)[0]
                    one = one[np.lexsort((symbol[one], key[one]))]
                    first, size = _rows(key[one])
                    yield record_batch(asked, np.full(len(first), chunk), np.full(len(first), d), key[one][first].view(np.int64), _strings(symbol[one], size))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            each = pc.binary_length(b.column("symbols")).to_numpy() // np.dtype(symbols).itemsize
            symbol = np.frombuffer(b"".join(b.column("symbols").to_pylist()), symbols).astype(np.int64)
            at, hit = _located(b.column("after").flatten().to_numpy(), pc.list_value_length(b.column("after")).to_numpy(), symbol, each)
            size = np.bincount(np.repeat(np.arange(b.num_rows), each)[hit], minlength=b.num_rows)
            yield record_batch(told, *[b.column(c) for c in ("chunk", "depth", "context", "total", "kinds")],
                               _strings(symbol[hit].astype(symbols), size), _strings(b.column("n").flatten().to_numpy()[at[hit]].astype(counts), size))

    asks = index.where("classes is not null").select("chunk", "about", "classes").mapInArrow(lambda b: handed_back(ask(b)), asked)
    joined = asks.join(tree, ["depth", "context"]).select("chunk", "depth", "context", "total", "kinds", "symbols", "after", "n")
    return staged(joined.mapInArrow(lambda b: handed_back(answer(b)), told), "lm-found")


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int | None = None, min_count: int = MIN_COUNT,
          min_share: float = MIN_SHARE, divergence: float = DIVERGENCE, class_count: int = CLASS_COUNT, class_share: float = CLASS_SHARE) -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    The tree and the unigram base learn from the rows that are not ``held_out`` (null: not held out). A null text is
    empty: one token, the end. Null ids stay null, repeated rows are learned and scored as often as they come, and
    an empty table gives an empty result; with nothing to learn from, all classes are equally likely. Contexts have at
    most ``depth`` classes (None: as many as the corpus supports, see longest()).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    words = vocabulary(rows)
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    own, endings = frequent(words, support(n, class_count, class_share))
    classes = Classes(own, endings)

    def with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield record_batch("class int, c long", classes.of(b.column("word")), b.column("c"))

    sizes = np.ones(classes.n)
    for r in words.mapInArrow(with_class, "class int, c long").groupBy("class").agg(F.sum("c").alias("c"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).collect():
        sizes[r["class"]] = r["c"] + r["v"] + 1
    end_count = next((r[0] for r in words.where("word = X''").select("c").collect()), 0)

    def valued(c: np.ndarray, kind: np.ndarray) -> list[np.ndarray]:
        """The words' log10 probabilities: in the base, and within their classes."""
        return [np.log10((c + 1) / (n + v + 1)), np.log10((c + 1) / sizes[kind])]

    is_common, few = common(words)
    table = few.select("word", "c").toArrow().combine_chunks()
    known = pa.concat_arrays(table.column("word").chunks or [pa.nulls(0, pa.binary())]).cast(pa.binary())
    index = _index(rows, classes, known, valued(table.column("c").to_numpy(), classes.of(known)))
    discard(spark)
    told = "chunk long, numbers binary, known binary"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of this task, put together by chunk."""
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            chunk, number, c = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in ("chunk", "number", "c"))
            held.clear()
            order = np.argsort(chunk, kind="stable")
            chunks, size = np.unique(chunk, return_counts=True)
            yield record_batch(told, chunks, _strings(number[order].astype(np.int32), size), _strings(c[order].astype(np.int64), size))

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= HELD_COUNTS // 2:
                yield from flush()
        if held:
            yield from flush()

    # both sides of the join are read from files, so it can split a word that every chunk has; words without a count need no answer
    others = words.where(~is_common & (F.col("c") > 0))
    joined = index.where("word is not null").select("chunk", "word", "number").join(others, "word")
    counts = staged(joined.select("chunk", "number", "c").mapInArrow(lambda b: handed_back(packed(b)), told), "lm-answers", 10_000)
    discard(spark, words)
    least = support(n, min_count, min_share)
    root, tree, bits = fit(index, n, longest(n, least) if depth is None else depth, least, divergence)
    first = root.toPandas()
    top = spark.sparkContext.broadcast(SuffixTree.level(np.zeros(1, np.uint64), np.array([first["n"].sum()]), np.array([len(first)]), np.zeros(len(first), np.int64), first["symbol"].to_numpy(np.int64), first["n"].to_numpy()))
    deep = len(bits)
    everywhere, rare = known_to_all(tree, deep)
    often = spark.sparkContext.broadcast(everywhere)
    symbols, amounts = symbol_type(classes.n), np.uint32 if (rare.agg(F.max("total")).first()[0] or 0) < 1 << 32 else np.int64
    abouts = index.where("classes is not null").drop("word", "number")
    replies = found(index, rare, [_bits(rare.where(F.col("depth") == d)) for d in range(1, deep + 1)], bits, symbols, amounts)
    discard(spark, tree)
    parts = abouts.unionByName(counts, allowMissingColumns=True).unionByName(replies.withColumnRenamed("kinds", "follow"), allowMissingColumns=True)
    n_classes = classes.n
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def together(t: pa.Table) -> pa.Table:
        about = t.filter(t.column("classes").is_valid())
        row = {k: about.column(k)[0].as_py() for k in ("about", "classes", "kinds", "places", "sums")}
        ids, null, held, tokens = _about(row["about"])
        levels, replies = [top.value], t.filter(t.column("depth").is_valid())
        for d in range(1, deep + 1):
            r = replies.filter(pc.equal(replies.column("depth"), d)).combine_chunks()
            each = pc.binary_length(r.column("symbols")).to_numpy() // np.dtype(symbols).itemsize
            levels.append(SuffixTree.level(
                r.column("context").to_numpy().view(np.uint64), r.column("total").to_numpy(), r.column("follow").to_numpy(), np.repeat(np.arange(len(each)), each),
                np.frombuffer(b"".join(r.column("symbols").to_pylist()), symbols), np.frombuffer(b"".join(r.column("counts").to_pylist()), amounts)))
        tree, model = np.zeros(len(ids)), SuffixTree(levels, n_classes, often.value)
        every = _sequence(row["about"], row["classes"])[0]
        for texts, own in _parts(tokens):
            log = model.log10(every[own], tokens[texts])
            tree[texts] = np.bincount(np.repeat(np.arange(len(tokens[texts])), tokens[texts]), log, len(tokens[texts]))
        kind, size = np.frombuffer(row["kinds"], np.uint32).reshape(2, -1)
        c = np.zeros(len(kind), np.int64)
        rest = t.filter(t.column("known").is_valid())
        for number, count in zip(rest.column("numbers").to_pylist(), rest.column("known").to_pylist()):
            c[np.frombuffer(number, np.int32)] = np.frombuffer(count, np.int64)
        place = np.frombuffer(row["places"], np.uint16)
        asked = [np.bincount(place, np.repeat(x, size), len(ids)) for x in (c > 0, *valued(c, kind))]
        known, base, within = np.frombuffer(row["sums"]).reshape(3, -1) + asked
        known, base, tree = known.astype(np.int64) + int(end_count > 0), base + np.log10((end_count + 1) / (n + v + 1)), tree + within
        return pa.Table.from_batches([record_batch(schema, pa.array(ids, mask=null.astype(bool)), held.astype(bool), tokens, known, np.full(len(ids), n), base, tree)])

    return parts.groupBy("chunk").applyInArrow(together, schema)
