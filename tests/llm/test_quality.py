import math
from collections import Counter

from pyspark.sql import functions as F
from tests.llm.cases import WORD, empty, prose, texts, tricky

from quarterline.llm import quality


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    c = Counter(tri)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len({k + j for k, x in enumerate(tri) if c[x] > 1 for j in range(3)})


def test_measures(spark):
    rows = [r[:2] for r in texts()] + [(50, "a b c a b c a b"), (51, "a a a a"), (52, "a a a"), (53, "x y z w x y"), (54, "#$ <b> " * 9), (55, "\x0b a\x0cb \r\n c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in quality.measures(df).select(F.coalesce("doc_id", F.lit(-1)), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    assert got == sorted((-1 if i is None else i, *brute(t)) for i, t in rows)


def test_collisions_and_long_texts_are_counted_by_words(spark, monkeypatch):
    rows = [(i, prose(i, 60) + " " + prose(i, 20)) for i in range(20)]
    for bits in (62, 3):  # two hash bits: nearly everything collides; three position bits: every text is long
        monkeypatch.setattr(quality, "POSITION_BITS", bits)
        got = quality.measures(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_repeat_words").collect()
        assert {r[0]: r[1] for r in got} == {i: brute(t)[4] for i, t in rows}


def tail(n, k, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_binomial_tail(spark):
    cases = [(1, 0), (10, 0), (100, 0), (100, 1), (460, 1), (1000, 4), (1000, 9), (50, 50), (3000, 20)]
    got = spark.createDataFrame(cases, "n long, k long").select("n", "k", quality.binomial_tail("n", "k", 0.0125).alias("p")).collect()
    for r in got:
        want = 1.0 if r["k"] >= 0.0125 * r["n"] else tail(r["n"], r["k"], 0.0125)
        assert abs(r["p"] - want) < 1e-9


def corpus(spark, n):
    good = [(i, prose(i, 80), "en") for i in range(n)]
    bad = [(n + i, " ".join(w + "###" for w in prose(n + i, 80).split()), "en") for i in range(50)]
    rare = [(2 * n + i, " ".join(w + "###" for w in prose(5 * n + i, 80).split()), "fr") for i in range(5)]
    rows = good + bad + rare
    labels = [(i, int(i < n), 0) for i, _, _ in rows] + [(None, 1, 0), (1, None, 0), (3, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cutoffs_reject_junk_and_keep_good(spark):
    docs, labels = corpus(spark, 700)
    got = {r["doc_id"]: r for r in quality.judged(docs, labels, stratum=F.col("lang")).collect()}
    assert all(got[i]["kept"] for i in range(700)) and not any(got[700 + i]["kept"] for i in range(50))
    assert got[700]["failed_rules"] == "symbols" and all(got[1400 + i]["kept"] for i in range(5))  # no labelled French: no cutoff


def test_too_few_labels_give_no_cutoff(spark):
    docs, labels = corpus(spark, 100)
    assert all(r["kept"] for r in quality.judged(docs, labels, stratum=F.col("lang")).collect())


def test_tricky_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.judged(tricky(spark), labels, stratum=F.col("lang")).collect()
    want = Counter((i, brute(t)[0] < 50 or 100 * brute(t)[4] > 50 * brute(t)[0]) for i, t, *_ in texts())
    assert Counter((r["doc_id"], r["base_failed"]) for r in got) == want and all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.judged(empty(spark), labels).count() == 0


def test_cutoffs_are_the_strictest_that_the_tests_reach(spark):
    """Every (stratum, rule): tighten while the exact tail at the good documents holds, copies of a text counted once."""
    rows, labels = [], []
    for k, (lang, n) in enumerate((("en", 900), ("de", 520), ("fr", 60))):
        for j in range(n):
            i = 10_000 * k + j
            words = prose(i, 40).split()
            marked = min(j % 53, 40) if j % 9 == 0 else 0
            rows.append((i, " ".join(w + "#" * (x < marked) for x, w in enumerate(words)).replace("ba", "BA" if j % 31 == 0 else "ba"), lang))
            labels.append((i, 1, 0))
    rows += [(99_000 + j, rows[0][1], "en") for j in range(200)]  # copies
    labels += [(99_000 + j, 1, 0) for j in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = quality.measures(df, stratum=F.col("lang"))
    got = {(r["stratum"], r["rule"]): r["cutoff"] for r in quality.cutoffs(quality.staged(table, "test-measures"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    want, texts_of = {}, {lang: sorted({t for _, t, x in rows if x == lang}) for lang in ("en", "de", "fr")}
    for lang, own in texts_of.items():
        for rule, (_, grid) in quality.RULES.items():
            scores = []
            for t in own:
                n, chars, symbols, dup, repeat = brute(t)
                lines = len([x for x in t.split("\n") if WORD.search(x)])
                scores.append({"symbols": symbols / max(n, 1), "repeats": repeat / max(n, 1), "dup_lines": dup / max(lines, 1), "capitals": sum("A" <= c <= "Z" for c in t) / max(chars, 1)}[rule])
            for cutoff in grid:
                k = sum(x > cutoff for x in scores)
                if k >= 0.0125 * len(own) or tail(len(own), k, 0.0125) > 0.05 / 4 / 3:
                    break
                want[lang, rule] = cutoff
    assert got == want and {x for x, _ in want} == {"en", "de"} and len(set(want.values())) > 2
