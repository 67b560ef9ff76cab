import math
import random
from collections import Counter

from tests.llm.cases import empty, texts, tricky

from quarterline.llm import language

SYLLABLES = {"en": ["the", "ing", "wh", "ou"], "de": ["sch", "ung", "ei", "pf"], "fr": ["eau", "que", "oi", "é"]}


def say(lang, seed, n=40):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def corpus(spark):
    rows = []
    for i in range(240):
        lang = ("en", "de", "fr")[i % 3]
        declared = lang if i % 10 else ("de-AT" if lang == "de" else "xx")  # some declare nonsense
        rows.append((i, say(lang, i), declared, f"s{i % 3}" if i % 2 else "mixed"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), {i: ("en", "de", "fr")[i % 3] for i in range(240)}


def test_held_out_languages(spark):
    docs, truth = corpus(spark)
    got = language.identify(docs).collect()
    assert len(got) == 240 and all(r["kept"] and r["language"] == truth[r["doc_id"]] for r in got)


def test_priors_decide_where_the_text_does_not(spark):
    docs, _ = corpus(spark)
    more = spark.createDataFrame([(1000, "12345 678", None, "s1"), (1001, "12345 678", None, "s2"), (1002, "98765 432", "fr", None)], docs.schema)
    got = {r["doc_id"]: r["language"] for r in language.identify(docs.unionByName(more)).collect()}
    assert (got[1000], got[1001], got[1002]) == ("de", "fr", "fr")


def test_page_evidence(spark):
    pages = spark.createDataFrame([
        (1, "http://www.Host.example.de/en/7?x=1#t", '<html CLASS=a lang="de-AT"><p lang="fr">'), (2, "https://b.example.com/7.html", "<html>"), (3, "https://b.example.com/x", None),
        (4, None, None), (5, "https://u@c.example.fr:8080/en/9/", "<!doctype html><HTML lang=fr>"), (6, "nonsense 12", "<html lang='es'>"), (7, "http://d/" + "9" * 30, "")], "page_id long, url string, html string")
    got = {r["doc_id"]: tuple(r)[1:] for r in language.addresses(pages).collect()}
    assert got == {7: ("de-AT", "de", "host.example.de"), 9: ("fr", "fr", "c.example.fr")}


def test_host_prior_moves_documents_without_text_evidence(spark):
    docs, _ = corpus(spark)
    docs = docs.unionByName(spark.createDataFrame([(1000, "12345 678", None, "mixed")], docs.schema))
    pages = spark.createDataFrame([(i, f"https://{'fr' if i % 3 == 2 else 'rest'}.example.com/{i}", "<html>") for i in [*range(240)]] + [(1000, "https://fr.example.com/1000", "<html>")], "page_id long, url string, html string")
    assert {r["doc_id"]: r["language"] for r in language.identify(docs, pages).collect()}[1000] == "fr"


def test_tricky_rows(spark):
    got = language.identify(tricky(spark)).collect()
    assert len(got) == len(texts())
    blank = {i for i, t, *_ in texts() if len((t or "").encode()) < 3 and i is not None}
    assert all(not r["kept"] and r["text_language"] is None for r in got if r["doc_id"] in blank) and blank
    assert all(r["kept"] and r["language"] == "en" for r in got if r["doc_id"] in (1, 2, 3, 10))
    assert language.identify(empty(spark)).count() == 0


def test_nothing_declared(spark):
    got = language.identify(spark.createDataFrame([(1, "some text", None, None)], "doc_id long, text string, lang string, source string")).collect()
    assert got[0]["language"] is None and not got[0]["kept"]


def trigrams(text):
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
    return [(((x << 16 | y << 8 | z) * 0x9E3779B1 & 0xFFFFFFFF) >> 8) % language.BUCKETS for x, y, z in zip(b, b[1:], b[2:])]


def by_hand(docs, pages):
    """The posterior of every document, by plain counting: (language, confidence, text_language)."""
    primary = lambda c: c.strip().lower()[:2] if c else None
    declared = {i: primary(lang) for i, _, lang, _ in docs}
    langs = sorted({x for x in declared.values() if x})
    counts = {x: Counter(g for i, t, _, _ in docs if declared[i] == x for g in trigrams(t)) for x in langs}
    seen = {g for c in counts.values() for g in c}
    total = {x: sum(c.values()) + 0.5 * len(seen) for x, c in counts.items()}
    text_log = {i: {x: sum(math.log((counts[x][g] + 0.5) / total[x]) for g in trigrams(t) if g in seen) for x in langs} for i, t, _, _ in docs}
    verdict = {i: max(langs, key=lambda x: (text_log[i][x], -langs.index(x))) if any(g in seen for g in trigrams(t)) else None for i, t, _, _ in docs}
    markup, suffix, host = ({i: pages.get(i, (None,) * 3)[k] for i, *_ in docs} for k in range(3))
    declared = {i: primary(markup[i]) or declared[i] for i in declared}
    site = {i: s for i, _, _, s in docs}
    overall = Counter(v for v in verdict.values() if v)
    n, out = len(langs), {}

    def rest(of, i):
        """Verdicts of the other documents with the value of ``i``."""
        return Counter(verdict[j] for j in of if of[i] is not None and of[j] == of[i] and j != i and verdict[j])

    for i in text_log:
        score = {}
        for x in langs:
            corpus = (overall[x] + 1) / (n + sum(overall.values()))
            at_site, at_host = rest(site, i), rest(host, i)
            prior = (at_site[x] + 10 * corpus) / (sum(at_site.values()) + 10)
            prior = (at_host[x] + 10 * prior) / (sum(at_host.values()) + 10)
            score[x] = text_log[i][x] / 3 + math.log(prior)
            for of in (declared, suffix):
                if of[i] is not None:
                    score[x] += math.log((rest(of, i)[x] + 0.5) / (overall[x] + 1))
        best = max(langs, key=lambda x: (score[x], -langs.index(x)))
        out[i] = best, 1 / sum(math.exp(score[x] - score[best]) for x in langs), verdict[i]
    return out


def test_posteriors_by_hand(spark):
    docs = [(i, say(("en", "de", "fr")[i % 3], i, 2 + i % 4), (("en", "de-AT", "fr")[i % 3], None, "en")[min(i % 7, 2) if i % 7 < 3 else 0], f"s{i % 2}") for i in range(24)]
    docs += [(50, "0 1", None, "s0"), (51, "wh", "de", None), (52, "Sch WH", None, "s1")]
    site = {i: ("b.example.fr" if i % 5 == 2 else "a.example.de") for i in range(0, 24, 2)} | {50: "a.example.de"}
    pages = [(k, f"https://{h}/{i}", f"<html lang={'fr' if i % 6 == 0 else ''}>") for k, (i, h) in enumerate(site.items())]
    known = {i: ("fr" if i % 6 == 0 else None, h.rsplit(".", 1)[1], h) for i, h in site.items()}
    got = language.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    want = by_hand(docs, known)
    assert len(got) == len(docs) and len({r["language"] for r in got}) == 3
    for r in got:
        language_, confidence, text_language = want[r["doc_id"]]
        assert (r["language"], r["text_language"]) == (language_, text_language) and abs(r["confidence"] - confidence) < 1e-4, (r, want[r["doc_id"]])


def test_languages_of_rows_it_has_not_learned_from(spark):
    docs, truth = corpus(spark)
    fresh = [(5000 + i, say(("en", "de", "fr")[i % 3], 9000 + i, 8), None, None) for i in range(90)]
    got = {r["doc_id"]: r for r in language.identify(docs.unionByName(spark.createDataFrame(fresh, docs.schema))).collect()}
    right = sum(got[5000 + i]["language"] == ("en", "de", "fr")[i % 3] and got[5000 + i]["kept"] for i in range(90))
    assert right >= 88 and len(truth) == 240
