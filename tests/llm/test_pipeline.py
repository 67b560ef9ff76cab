import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tests.llm.cases import empty, texts, tricky
from tests.llm.test_minhash import brute, shingles
from tokenizers import Tokenizer

from quarterline.llm import quality, secret_scan

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    docs = corpus_pipeline.documents(spark, sf_small)
    words = docs.where("doc_id = 1").first()["text"].split()
    own = []
    for i in range(3):
        random.Random(i).shuffle(words)
        own.append((90_000 + i, f"{' '.join(words)} token = 'abc{i}defghi' end", "en", "src1", 1))
    out, docs = {}, docs.unionByName(spark.createDataFrame(own, docs.schema))
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = corpus_pipeline.staged(stage(spark, docs, sf_small), f"test-{name}")
    return out


def ids(df):
    return {r[0] for r in df.select("doc_id").collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "secret_scans", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == COLUMNS


def test_clean_documents_stay(stages):
    clean = {r["doc_id"] for r in stages["documents"].collect() if len(r["text"].split()) > 3 and not any(c in r["text"] for c in "#*$%&|!") and r["text"].upper() != r["text"]}
    assert clean <= ids(stages["language_id"])
    words = {r["doc_id"]: r["text"].split() for r in stages["documents"].collect()}
    assert {i for i in clean if len(set(words[i])) > len(words[i]) / 3} <= ids(stages["quality_rules"])


def test_near_dedup_keeps_one_of_each_group(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["quality_rules"].collect()]
    groups = brute(rows)
    assert ids(stages["near_dedup"]) == {i for i, c in groups.items() if i == c}
    assert all(shingles(t) for _, t in rows)


def test_secrets_are_masked_and_nothing_else(stages):
    before = {r["doc_id"]: r for r in stages["near_dedup"].collect()}
    after = {r["doc_id"]: r for r in stages["secret_scans"].collect()}
    assert before.keys() == after.keys()
    found = secret_scan.with_forms(stages["near_dedup"]).collect()
    assert any(r["forms"] for r in found)
    for r in found:
        if r["forms"]:
            assert all(s["value"] not in after[r["doc_id"]]["text"] for s in r["forms"]) and after[r["doc_id"]]["n_chars"] == len(after[r["doc_id"]]["text"])
        elif "[SECRET]" not in after[r["doc_id"]]["text"]:
            assert after[r["doc_id"]] == before[r["doc_id"]]


def test_packing_holds_every_token(stages):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = stages["packing"].orderBy("doc_id", "start").collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u2").tolist())
    want = {r["doc_id"]: [*t.encode(r["text"], add_special_tokens=False).ids, 0] for r in stages["secret_scans"].collect()}
    assert got == want


def test_tricky_rows_pass_all_stages(spark, sf_small):
    docs = tricky(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns, name
        docs = corpus_pipeline.staged(out, f"tricky-{name}")
    kept = {r["doc_id"] for r in docs.collect()}
    assert {1, 10, 12} <= kept and not kept & {2, 3, 5, 6, 11, 17}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() >= len(kept)
    assert len(texts()) == tricky(spark).count() and quality.RULES


def test_empty_table_passes_all_stages(spark, sf_small):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
        assert docs.count() == 0


def test_decisions_hold_for_rows(spark, sf_small):
    """Repeated rows leave one, rows without an id are judged one by one, and columns with the stages' own names stay."""
    clean = [r["text"] for r in corpus_pipeline.documents(spark, sf_small).where("lang = 'en'").collect() if len(set(r["text"].split())) > 60][:6]
    rows = [(1, clean[0]), (1, clean[0]), (1, clean[1]), (None, clean[2]), (None, clean[2]), (None, clean[3]), (None, ""), (None, "x " * 400), (5, clean[4]), (4, clean[4]), (None, clean[5]), (9, clean[5])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "k", 3) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, place long")
    stage = dict(corpus_pipeline.STAGES)
    known = corpus_pipeline.staged(docs.repartition(3), "test-rows")
    after = corpus_pipeline.staged(stage["quality_rules"](spark, corpus_pipeline.staged(stage["language_id"](spark, known, sf_small), "test-rows"), sf_small), "test-rows")
    assert after.columns == docs.columns and {(r["doc_id"], r["text"]) for r in after.collect()} == {x for x in rows if len(set(x[1].split())) > 1}
    assert after.count() == len(rows) - 2
    left = stage["near_dedup"](spark, after, sf_small).collect()
    assert sorted((r["doc_id"] or 0, clean.index(r["text"])) for r in left) == [(0, 2), (0, 3), (1, 0), (1, 1), (4, 4), (9, 5)]
    assert all(r["kept"] == "k" and r["place"] == 3 for r in left)
