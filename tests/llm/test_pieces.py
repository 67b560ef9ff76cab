import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm.cases import empty, texts, tricky

from quarterline.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(PATH)


ODD = ["", " ", "   ", "a", "  a  b\n\n c\t ", "x ▁ y▁", "▁▁", "\U0001F600 日本 é́\U0010FFFF▁", "the the the", "a" * 3000, "\x00\x01", "<s> </s> <unk> <0x41>"]


def test_lossless(vocabulary):
    for seed in range(3):
        assert [vocabulary.decode(x) for x in vocabulary.sample(list(range(len(ODD))), ODD, seed)] == ODD


def test_seeded_by_the_row_alone(vocabulary):
    many = ODD + ["thanedble the anea " * 20] * 5
    together = vocabulary.sample(list(range(len(many))), many)
    for i, t in enumerate(many):
        assert (vocabulary.sample([i], [t])[0] == together[i]).all()
    assert not (len(together[-1]) == len(together[-2]) and (together[-1] == together[-2]).all())
    assert not all(len(a) == len(b) and (a == b).all() for a, b in zip(together, vocabulary.sample(list(range(len(many))), many, 1)))


def test_draws_follow_the_lattice():
    """Shares of the segmentations of a word against all of them, enumerated."""
    vocabulary = pieces.Pieces(PATH, theta=0.4)
    word = "▁thane"
    weight = {}
    names = {vocabulary.text[i].decode().replace(" ", "▁"): i for i in vocabulary.end_id[vocabulary.end_id >= 0].tolist()}
    log = dict(zip(vocabulary.end_id.tolist(), vocabulary.end_weight.tolist()))

    def walk(at, path, total):
        if at == len(word):
            weight[tuple(path)] = math.exp(total)
        for end in range(at + 1, len(word) + 1):
            i = names.get(word[at:end])
            if i is not None:
                walk(end, [*path, i], total + log[i])

    walk(0, [], 0.0)
    n = 20_000
    got = Counter(tuple(x.tolist()) for x in vocabulary.sample(list(range(n)), ["thane"] * n))
    assert set(got) <= set(weight)
    whole = sum(weight.values())
    chi = sum((got[p] - n * w / whole) ** 2 / (n * w / whole) for p, w in weight.items() if n * w / whole > 5)
    cells = sum(n * w / whole > 5 for w in weight.values())
    assert cells > 5 and chi < cells + 5 * math.sqrt(2 * cells)


def test_tricky_rows(spark):
    got = pieces.encode(tricky(spark).repartition(3), PATH)
    rows = got.collect()
    assert len(rows) == len(texts()) and all(r["lossless"] for r in rows)
    for r in rows:
        assert r["n_pieces"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    back = sorted((r["doc_id"] or -1, r["text"]) for r in pieces.decode(got, PATH).collect())
    assert back == sorted((i or -1, t or "") for i, t, *_ in texts())
    assert pieces.encode(empty(spark), PATH).count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first()["text"] is None
    assert got.select(F.countDistinct("doc_id", "ids_crc32")).first()[0] <= len(rows)
