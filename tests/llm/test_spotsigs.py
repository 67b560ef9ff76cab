import base64
import hashlib

import numpy as np
from tests.llm.cases import empty, prose, texts, tricky

from quarterline.llm import spotsigs


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        out.append((i or -1, len(t), hashlib.sha256((t[: len(t) - cut] + n[:cut]).encode()).hexdigest()))
    return sorted(out)


def test_edits_follow_the_next_document(spark):
    rows = [r[:2] for r in texts()]
    for parts in (1, 3, 50):
        got = sorted((r["doc_id"] or -1, r["n_chars"], r["edited_sha256"]) for r in spotsigs.with_edits(tricky(spark).repartition(4), parts).collect())
        assert got == brute(rows)


def test_ids_alone_or_none(spark):
    one = spotsigs.with_edits(spark.createDataFrame([(7, "abcdef ghi")], "doc_id long, text string")).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"abcdef abc").hexdigest() and one["near_next"] == 1.0
    rows = [(None, "xyz abc"), (None, "bcd efg hij")]
    got = spotsigs.with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"], r["edited_sha256"]) for r in got) == brute(rows)
    assert spotsigs.with_edits(empty(spark)).count() == 0


def decode(s):
    return set(np.frombuffer(base64.b64decode(s), "<u4").tolist())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_equal_texts_edits_and_strangers(spark):
    filler = [w for w in prose(3, 4000).split()]
    common = "the of and der und le la el y".split()
    rows = [(i, " ".join(common[(i + k) % 9] if k % 4 == 0 else filler[(97 * i + k) % 4000] for k in range(120 + i))) for i in range(60)]
    rows += [(100, rows[5][1]), (101, None), (102, ""), (103, "heat " * 200), (104, "one")]
    got = {r["doc_id"]: r for r in spotsigs.with_edits(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got[5]["fingerprint"] == got[100]["fingerprint"] and got[101]["fingerprint"] == got[102]["fingerprint"] == ""
    for i in range(60):
        assert got[i]["near_edited"] > 0.35 and got[i]["near_next"] < 0.2
    assert got[103]["near_edited"] > 0.35
    for r in got.values():
        assert r["near_edited"] == jaccard(decode(r["fingerprint"]), decode(r["edited_fingerprint"]))


def test_likeness_prunes_by_size():
    a, b = np.arange(10, dtype=np.uint32), np.arange(40, dtype=np.uint32)
    assert spotsigs.likeness(a, b) == 0.25 and spotsigs.likeness(a, b, 0.5) == 0.0
    assert spotsigs.likeness(a[:0], a[:0]) == 1.0 and spotsigs.likeness(a, a[:0]) == 0.0


def test_similar_against_all_pairs(spark):
    base = prose(8, 150).split()
    rows = [(i, " ".join(base[: 150 - 3 * i] + prose(30 + i, 3 * i).split())) for i in range(25)] + [(50, " ".join(base)), (51, None), (None, "x y z")]
    sets = {i: x for (i, _), x in zip(rows, spotsigs.fingerprints([(t or "").encode() for _, t in rows]))}
    want = {}
    for x in range(25):
        for y in range(x + 1, 25):
            j = spotsigs.likeness(sets[x], sets[y])
            if j >= 0.5:
                want[x, y] = j
    got = {(r["x"], r["y"]): r["likeness"] for r in spotsigs.similar(spark.createDataFrame(rows, "doc_id long, text string"), 0.5).collect()}
    assert got == want and len(want) > 20
    assert spotsigs.similar(empty(spark)).count() == 0
