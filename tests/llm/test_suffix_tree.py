import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm.cases import WORD, empty, lower, prose, texts, tricky

from quarterline.llm import suffix_tree as st

def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base(rows):
    tokens = [(i, [*WORD.findall(lower(t)), None]) for i, t in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted((i or -1, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)


def got(df):
    return sorted((r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in df.collect())


def test_base_and_cases(spark):
    df = st.score(tricky(spark), held_out())
    assert got(df) == base([r[:2] for r in texts()])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in df.collect())
    assert st.score(empty(spark), held_out()).count() == 0


def test_nothing_to_learn(spark):
    df = st.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), F.lit(True))
    assert all(math.isfinite(r["score"]) and r["n_known"] == 0 and r["train_tokens"] == 0 for r in df.collect())


def test_many_chunks_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i % 40, 30 + i)) for i in range(120)], "doc_id long, text string")
    one = {r["doc_id"]: r for r in st.score(docs.coalesce(1), held_out()).collect()}
    monkeypatch.setattr(st, "CHUNK_ROWS", 7)
    many = {r["doc_id"]: r for r in st.score(docs.repartition(5), held_out()).collect()}
    for i, r in one.items():
        assert abs(r["score"] - many[i]["score"]) < 1e-6 * abs(r["score"]) and abs(r["base_score"] - many[i]["base_score"]) < 1e-9 * abs(r["base_score"])


def test_small_batches_share_a_chunk():
    rows = [(i, prose(i, 30), i % 7 == 2) for i in range(50)]
    batches = pa.Table.from_pylist([dict(zip(("doc_id", "text", "held_out"), r)) for r in rows]).to_batches(max_chunksize=3)
    chunks = list(st._chunks(iter(batches)))
    assert len(batches) > 1 and len(chunks) == 1 and chunks[0].column("doc_id").to_pylist() == list(range(50))


def test_words_asked_for_count_like_those_every_task_knows(spark, monkeypatch):
    """Every task knows the commonest words, so that chunks ask for few; the sums are the same however many it knows."""
    docs = spark.createDataFrame([(i, f"{prose(i % 40, 30 + i)} once{i} {'x' * 70}") for i in range(120)] + [(None, None)], "doc_id long, text string")
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    words = st.vocabulary(rows)
    few = st.common(words)[1]
    assert few.where(F.length("word") > st.COMMON_BYTES).isEmpty() and few.where("c = 0 or word = X''").isEmpty()
    known = pa.array([bytes(r["word"]) for r in few.collect()], pa.binary())
    asked = {bytes(r["word"]) for r in st._index(rows, st.Classes([], []), known, []).where("word is not null").select("word").collect()}
    every = {bytes(r["word"]) for r in words.where("word <> X''").collect()}
    assert b"x" * 70 in asked and asked == every - set(known.to_pylist()) and len(known) > len(asked)
    one = {r["doc_id"]: r for r in st.score(docs, held_out()).collect()}
    for n in (0, 8):
        monkeypatch.setattr(st, "COMMON", n)
        assert st.common(words)[1].count() <= n
        for r in st.score(docs, held_out()).collect():
            o = one[r["doc_id"]]
            assert r["n_known"] == o["n_known"] and abs(r["base_score"] - o["base_score"]) < 1e-9 * abs(o["base_score"]) and abs(r["score"] - o["score"]) < 1e-9 * abs(o["score"])


def test_classes_are_the_word_or_its_longest_ending():
    classes = st.Classes([b"the", b"of"], [b"e", b"ing", b"n", b"ng"])
    found = classes.of(pa.array([b"", b"the", b"he", b"ng", b"sing", b"n", b"x", b"of", b"then"], pa.binary()))
    first = st.OTHER + 1
    assert found.tolist() == [st.END, first, first + 2, first + 5, first + 3, first + 4, st.OTHER, first + 1, first + 4]


def test_learns_order_that_the_base_can_not_see(spark):
    """Words that follow each other in a fixed order: held-out texts are far likelier than under the base."""
    docs = [(i, " ".join(f"w{(i + k) % 9}" for k in range(60))) for i in range(300)]
    rows = st.score(spark.createDataFrame(docs, "doc_id long, text string"), held_out()).where("held_out").collect()
    assert rows and all(r["score"] > r["base_score"] / 5 for r in rows)


def brute_tree(sequences, depth, share, divergence, n_classes):
    """Contexts by plain counting; scores by walking to the longest kept suffix."""
    count = Counter()
    for s in sequences:
        s = [st.START, *s]
        for i in range(1, len(s)):
            for d in range(min(depth, i) + 1):
                count[tuple(s[i - d : i]), s[i]] += 1
    total = Counter()
    for (c, _), n in count.items():
        total[c] += n
    least = max(2.0, share * total[()])
    candidates = {c for c in total if c and all(total[c[k:]] >= least for k in range(len(c))) and all(total[c[:k]] >= least for k in range(1, len(c)))}
    kept = {()}
    for c in candidates:
        after = {a: n for (x, a), n in count.items() if x == c}
        gain = sum(n * math.log(n / total[c] / (count[c[1:], a] / total[c[1:]])) for a, n in after.items())
        if gain >= divergence * total[c] and gain >= 0.5 * len(after) * math.log(max(total[c], 2)):
            kept |= {c[k:] for k in range(len(c) + 1)}

    def p(context, a):
        if not context:
            return (count[(), a] + 1) / (total[()] + n_classes)
        kinds = sum(1 for x, _ in count if x == context)
        return (count[context, a] + kinds * p(context[1:], a)) / (total[context] + kinds)

    def score(s):
        s, out = [st.START, *s], []
        for i in range(1, len(s)):
            d = max(k for k in range(min(depth, i) + 1) if tuple(s[i - k : i]) in kept)
            out.append(math.log10(p(tuple(s[i - d : i]), s[i])))
        return out

    return score, kept


def test_tree_against_brute_force():
    r = np.random.default_rng(3)
    sequences = []
    for _ in range(200):
        s = [int(r.integers(3, 6))]
        for _ in range(int(r.integers(1, 30))):
            s.append(int((s[-1] + 1) % 4 + 3) if len(s) > 1 and s[-2] == 4 else int(r.integers(3, 7)))
        sequences.append([*s, st.END])
    score, kept = brute_tree(sequences, 3, 0.01, 0.01, 8)
    rows = []
    least = 0.01 * sum(map(len, sequences))
    known = {0}
    for d in range(4):
        c = Counter()
        for s in sequences:
            s = [st.START, *s]
            for i in range(max(d, 1), len(s)):
                key = 0
                for k, x in enumerate(reversed(s[i - d : i])):
                    key |= x << (st.BITS * k)
                c[key, s[i]] += 1
        f = pd.DataFrame([(k, a, n) for (k, a), n in c.items()], columns=["context", "symbol", "n"])
        f = f[f["context"].isin(known)]
        rows.append(f.reset_index(drop=True))
        often = f[(f["n"] >= max(2.0, least)) & (f["symbol"] != st.END)]
        longer = {(int(c) << st.BITS) + int(a) for c, a in zip(often["context"], often["symbol"])} | ({st.START} if d == 0 else set())
        known = {x for x in longer if x % (1 << st.BITS * d) in known}
    tree = st.SuffixTree.grown(rows, 8, 0.01)
    assert sum(len(x[0]) for x in tree.levels) == len(kept)
    flat = np.array([x for s in sequences for x in s], np.uint16)
    assert np.allclose(tree.log10(flat, np.array([len(s) for s in sequences])), [x for s in sequences for x in score(s)])


def test_table_tree_against_brute_force(spark, monkeypatch):
    """The tree kept in tables, over several chunks and with all contexts on few bits, keeps and scores the same."""
    monkeypatch.setattr(st, "CHUNK_ROWS", 40)
    monkeypatch.setattr(st, "SET_BITS", 6)
    r = np.random.default_rng(5)
    docs = []
    for i in range(300):
        s = ["a"]
        for _ in range(int(r.integers(5, 40))):
            s.append("abcd"[(len(s) * 7 + ord(s[-5])) % 4] if len(s) > 5 and s[-3] == "b" else "abcd"[int(r.integers(4))])
        docs.append((i, " ".join(s)))
    df = st.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), F.col("doc_id") % 7 == 2, depth=5, min_count=20, min_share=0.5, divergence=0.01, class_count=20)
    number = {w: k for k, w in enumerate("abcd", st.OTHER + 1)}
    sequences = {i: [*[number[w] for w in t.split()], st.END] for i, t in docs}
    train = [s for i, s in sequences.items() if i % 7 != 2]
    n_classes = st.OTHER + 1 + 4
    score, kept = brute_tree(train, 5, 20 / sum(map(len, train)), 0.01, n_classes)
    assert max(map(len, kept)) > 3
    within = Counter(x for s in train for x in s)
    for row in df.collect():
        s = sequences[row["doc_id"]]
        own = sum(math.log10((within[x] + 1) / (within[x] + 2)) for x in s if x != st.END)
        assert abs(row["score"] - sum(score(s)) - own) < 1e-6, row


def test_contexts_and_classes_grow_with_the_corpus():
    """A context or word of fixed count stays as the corpus grows; a small corpus needs no more than its share."""
    assert st.support(5_000_000_000, st.MIN_COUNT, st.MIN_SHARE) == st.MIN_COUNT and st.support(10**9, st.CLASS_COUNT, st.CLASS_SHARE) == st.CLASS_COUNT
    assert st.support(400_000, st.MIN_COUNT, st.MIN_SHARE) == 40 and st.support(0, st.MIN_COUNT, st.MIN_SHARE) == 2
    assert st.longest(10**4, 2) == 4 and st.longest(10**10, 1000) == 7 and st.longest(0, 2) == 3


def test_no_context_of_a_ten_thousandth_is_lost():
    for n in (10**4, 10**6, 10**8, 10**10):
        assert st.support(n, st.MIN_COUNT, st.MIN_SHARE) <= max(2, 1e-4 * n)


def test_contexts_asked_for_count_like_those_every_task_knows(spark, monkeypatch):
    """Every task knows the commonest contexts, so that chunks ask for few; scores are the same however many it knows."""
    docs = spark.createDataFrame([(i, f"{prose(i % 40, 60)} once{i}") for i in range(120)] + [(None, None)], "doc_id long, text string").repartition(3)
    every, asked = st.found, []
    monkeypatch.setattr(st, "found", lambda *a: asked.append(every(*a)) or asked[-1])
    monkeypatch.setattr(st, "CHUNK_ROWS", 25)
    scores = []
    for n in (st.KNOWN_COUNTS, 0, 60):
        monkeypatch.setattr(st, "KNOWN_COUNTS", n)
        scores.append({r["doc_id"]: r["score"] for r in st.score(docs, held_out(), min_count=5).collect()})
        asked[-1] = asked[-1].count()
    assert asked[0] == 0 < asked[2] < asked[1]
    assert all(abs(s[i] - x) < 1e-9 * abs(x) for i, x in scores[0].items() for s in scores[1:])


def test_a_context_is_sent_once_a_task(spark, monkeypatch):
    """Counts go by context, not by context and class, and add up over tasks, batches and what a task hands on early."""
    docs = spark.createDataFrame([(i, prose(i % 10, 80)) for i in range(60)], "doc_id long, text string").repartition(4)
    rows = docs.select("doc_id", "text", F.lit(False).alias("held_out"))
    words = sorted({bytes(r["word"]) for r in st.vocabulary(rows).where("word <> X''").collect()})
    index = st._index(rows, st.Classes(words, []), pa.array([], pa.binary()), []).where("classes is not null").select("about", "classes")
    number = {w: k for k, w in enumerate(words, st.OTHER + 1)}
    count = Counter()
    for r in docs.collect():
        s = [st.START, *[number[w.encode()] for w in WORD.findall(lower(r["text"]))], st.END]
        count.update(zip(s, s[1:]))
    key = {int(k): c for c, k in zip([st.START, *number.values()], st._hash(np.array([st.START, *number.values()])).view(np.int64))}
    every = np.full(1 << st.SET_BITS >> 3, 255, np.uint8)
    for most in (st.HELD_COUNTS, 20):
        monkeypatch.setattr(st, "HELD_COUNTS", most)
        got = st._counted(index, 1, every).collect()
        assert len(got) == len({a for a, _ in count}) < len(count)
        assert {(key[r["context"]], a): n for r in got for a, n in zip(r["after"], r["n"])} == count
        assert all(r["total"] == sum(r["n"]) and r["kinds"] == len(r["n"]) and list(r["after"]) == sorted(r["after"]) for r in got)


def test_tasks_become_larger_with_the_contexts(spark, monkeypatch):
    """Each task sends each of its contexts: with more contexts fewer, larger tasks count them, to the same result."""
    docs = spark.createDataFrame([(i, prose(i % 40, 60)) for i in range(160)], "doc_id long, text string").repartition(20)
    every, split = st._counted, {}
    monkeypatch.setattr(st, "_counted", lambda sequences, d, bits: split.__setitem__(d, sequences.rdd.getNumPartitions()) or every(sequences, d, bits))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    scores = []
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        for tokens in (st.CONTEXT_TOKENS, 1):
            monkeypatch.setattr(st, "CONTEXT_TOKENS", tokens)
            scores.append(({r["doc_id"]: r["score"] for r in st.score(docs, held_out(), min_count=20).collect()}, dict(split)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    (one, few), (other, many) = scores
    assert few[0] >= 20 and all(few[d] <= spark.sparkContext.defaultParallelism < many[d] for d in (1, 2))
    assert all(abs(other[i] - x) < 1e-9 * abs(x) for i, x in one.items())


def test_rows_sent_keep_pace_with_the_tokens():
    """Twice the tokens with twice the contexts: as many tasks, so twice the rows, until a task has TASK_TOKENS."""
    def bits(n):
        return np.packbits(np.arange(1 << 20) < 2 * n)

    assert st._tasks(10**8, bits(1000), 4) == 2 * st._tasks(10**8, bits(2000), 4) == 98
    assert st._tasks(2 * 10**8, bits(2000), 4) == st._tasks(10**8, bits(1000), 4)
    assert st._tasks(10**12, bits(400_000), 4) == math.ceil(10**12 / st.TASK_TOKENS)
    assert st._tasks(100, bits(1000), 4) == 4 == st._tasks(0, None, 4)


def test_what_is_handed_on_early_are_contexts_with_many_classes(spark, monkeypatch):
    """A task that holds too many counts goes on adding up the contexts with few classes, and sends each of them once."""
    monkeypatch.setattr(st, "HELD_COUNTS", 600)
    monkeypatch.setattr(st, "PART_TOKENS", 50)
    r = np.random.default_rng(2)
    docs = [(i, " ".join(f"w{k} {'abcde'[k % 5]}" for k in r.integers(0, 60, 40))) for i in range(80)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).select("doc_id", "text", F.lit(False).alias("held_out"))
    words = [b"a", b"b", b"c", b"d", b"e", *(f"w{k}".encode() for k in range(60))]
    index = st._index(rows, st.Classes(words, []), pa.array([], pa.binary()), []).where("classes is not null").select("about", "classes")
    every = np.full(1 << st.SET_BITS >> 3, 255, np.uint8)
    sent = Counter(x["context"] for x in st._sent(index, 1, every).collect())
    got = {x["context"]: x for x in st._counted(index, 1, every).collect()}
    wide = {c for c, x in got.items() if x["kinds"] > 2}  # the letters and the start
    assert set(sent) == set(got) and len(wide) == 6 and len(got) == 66 and sum(x["total"] for x in got.values()) == 80 * 81
    assert max(sent.values()) > 1 and all(n == 1 for c, n in sent.items() if c not in wide)


def test_two_bits_tell_contexts_apart_that_one_does_not():
    key = st._hash(np.arange(200_000))
    bits = np.zeros(1 << st.SET_BITS, bool)
    bits[st._both(key[:20_000])] = True
    among = st._among(key, np.packbits(bits))
    assert among[:20_000].all() and among[20_000:].sum() < 20
