import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tests.llm.cases import empty, texts, tricky
from tokenizers import Tokenizer

from quarterline.llm import alignment

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute(rows):
    a_model = Tokenizer.from_file(A_PATH)
    a_model.encode_special_tokens = True
    b_model, byte = sentencepiece.SentencePieceProcessor(model_file=B_PATH), byte_of()
    docs, count = [], Counter()
    for doc, text in rows:
        a = b = []
        if text:
            a = [(i, bytes(byte[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(b_model.id_to_piece(i)[3:-1], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()) for i in b_model.encode(text)]
            if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                a = b = []
        ends = []
        for side in (a, b):
            at, out = 0, {}
            for i, x in side:
                at += len(x)
                out[at] = i
            ends.append(out)
        cuts = sorted(ends[0].keys() & ends[1].keys())
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        groups = ["|".join(",".join(str(i) for at, i in e.items() if lo < at <= hi) for e in ends) for lo, hi in zip([0, *cuts], cuts)]
        count.update(links)
        docs.append((doc, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(((doc, a, b, len(x), len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), sha) for doc, a, b, x, sha in docs), key=str)


EXTRA = [
    (50, "a<|endoftext|>b <s> </s> <unk> <0x0A>"), (51, "naïve café ½ ﬁ é   　x"), (52, " leading and trailing  "), (53, "▁"), (54, "tab\there\r\n\n\nnew"),
    (55, "\U0001F468‍\U0001F469‍\U0001F467 日本語テキスト 한국어 العربية"), (56, "\x00\x01\x7f"), (57, " "), (58, "internationalization " * 50), (59, "0123456789" * 30),
]


def got(df):
    return sorted(map(tuple, alignment.linked(df, A_PATH, B_PATH).collect()), key=str)


def test_tricky_rows_against_cuts(spark):
    rows = [r[:2] for r in texts() if len(r[1] or "") < 50_000]
    want = brute(rows)
    assert any(x[1] == 0 for x in want) and got(tricky(spark).where("text is null or length(text) < 50000").repartition(3)) == want


def test_odd_texts_in_many_slices(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 100)
    rows = EXTRA + [(100 + i, " ".join(random.Random(i).choices(["hello", "wörld", "tokens", "<|endoftext|>", "naïve", "12"], k=40))) for i in range(30)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_one_long_text(spark):
    text = " ".join(x for _, x, *_ in texts() if x)
    assert got(spark.createDataFrame([(1, text)], "doc_id long, text string")) == brute([(1, text)])


@pytest.mark.parametrize("seed", range(5))
def test_pointer_jumping_labels_the_overlap_graph(seed):
    r = np.random.default_rng(seed)
    n = 400
    a, b = (np.unique(np.append(r.choice(n, n // k, replace=False) + 1, n)) for k in (2, 7))
    want, label = np.isin(a, b), alignment.terminals(a, b)
    ends = np.concatenate([a, b])
    cut = a[want]
    assert (ends[label] == cut[np.searchsorted(cut, ends)]).all() and (label < len(a)).all()
    # the longest run that doubling has to follow: nothing but the last end is shared
    odd, even = np.append(np.arange(1, 2001, 2), 2002), np.arange(2, 2003, 2)
    assert (alignment.terminals(odd, even) == len(odd) - 1).all()


def test_empty_table(spark):
    assert got(empty(spark)) == []


def test_only_texts_without_tokens(spark):
    rows = [(1, None), (1, ""), (None, "▁")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
