import zlib

import numpy as np
import public_tokenizers
from tests.llm.cases import empty, texts, tricky
from tokenizers import Tokenizer

from quarterline.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected():
    t = Tokenizer.from_file(PATH)
    return [(i, [*t.encode(x or "", add_special_tokens=False).ids, 0]) for i, x, *_ in texts()]


def test_pieces_are_the_documents_cut(spark):
    got = packing.pack(tricky(spark).repartition(3), PATH, length=256).collect()
    whole = sorted((i is None, i or 0, ids) for i, ids in expected())
    by_doc = {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u2")
        assert r["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes()) and r["length"] == len(ids) and r["offset"] + r["length"] <= 256
        by_doc.setdefault((r["doc_id"], r["sequence_id"] * 256 + r["offset"] - r["start"]), []).append((r["start"], ids, r["doc_tokens"]))
    rebuilt = []
    for (doc, _), pieces in by_doc.items():
        pieces.sort(key=lambda p: p[0])
        ids = [int(x) for _, p, _ in pieces for x in p]
        assert [p[0] for p in pieces] == list(np.cumsum([0, *[len(p[1]) for p in pieces[:-1]]])) and len(ids) == pieces[0][2]
        rebuilt.append((doc is None, doc or 0, ids))
    assert sorted(rebuilt) == whole


def test_sequences_are_full_and_gapless(spark):
    rows = packing.pack(tricky(spark).repartition(4), PATH, length=128).orderBy("sequence_id", "offset").collect()
    at = 0
    for r in rows:
        assert r["sequence_id"] * 128 + r["offset"] == at
        at += r["length"]
    assert at == sum(len(ids) for _, ids in expected())


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0


def test_special_token_strings_follow_the_tokenizer():
    e = packing.Encoder(PATH)
    t = Tokenizer.from_file(PATH)
    for text in ["a<|endoftext|>b", "  x \n y", "don't 12ab z", ""]:
        assert list(np.frombuffer(e.encode([text])[0], e.dtype)) == [*t.encode(text, add_special_tokens=False).ids, 0]
