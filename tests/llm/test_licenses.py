import random
import re

import numpy as np
import pytest
from tests.llm.cases import empty, prose, texts, tricky

from quarterline.llm import licenses


def brute(text, least=0.75):
    """Licenses with a template whose share of shingles in some stretch of its own length or twice that is enough."""
    w = re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().lower())
    sh = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = set()
    for name, ts in licenses.TEMPLATES.items():
        for t in ts:
            tw = re.findall(rb"[a-z0-9\x80-\xff]+", t.encode().lower())
            want = {tuple(tw[i : i + 5]) for i in range(len(tw) - 4)}
            if any(len(want & set(sh[i : i + len(tw) - 4])) >= least * len(want) for i in range(len(sh))):
                out.add(name)
    return out


def documents():
    r, rows = random.Random(4), []
    flat = [(n, t) for n, ts in licenses.TEMPLATES.items() for t in ts]
    for i in range(120):
        name, t = flat[i % len(flat)]
        if i % 3 == 1 and len(t.split()) > 20:  # a changed word or two of a long notice
            words = t.split()
            words[r.randrange(3, len(words) - 3)] = "changed"
            t = " ".join(words)
        rows.append((i, f"{prose(i, r.randrange(0, 300))}\n{t.upper() if i % 5 == 0 else t}\n{prose(1000 + i, r.randrange(0, 300))}"))
    return rows + [(200 + i, prose(5000 + i, 400)) for i in range(20)] + [(300, "All rights reserved."), (301, "under the MIT License"), (302, "\n".join(t for _, t in flat))]


def test_against_brute_force(spark):
    rows = documents()
    got = {r["doc_id"]: r["found"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = brute(t)
        names = {m["license"] for m in got[i]}
        # half of the surroundings may lend shingles to a window, never to a stretch of the template's length
        assert want <= names and (names <= want or i == 302), (i, want, names)
        for m in got[i]:
            assert m["containment"] >= 0.75 and 0 <= m["first_word"] < m["end_word"]


def test_bands_are_likely_to_meet():
    for size in (1, 2, 4, 64):
        worst = licenses.LEAST * (size // 2 + 1) / (2 * size + size // 2 + 1)
        assert (1 - worst) ** licenses.BANDS < 1e-4


def test_tricky_rows(spark):
    got = licenses.scan(tricky(spark)).collect()
    assert len(got) == len(texts()) and all(r["found"] == [] for r in got)
    assert licenses.scan(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(tricky(spark), templates={"x": ["too short a text"]})


def test_blocks_do_not_cross_texts():
    notice = "Released under the MIT License."
    index = licenses.Index(licenses.TEMPLATES)
    found = index.matches([b"", notice[:16].encode(), notice[16:].encode(), notice.encode(), b"a b c"], 0.75)
    assert [[m[0] for m in x] for x in found] == [[], [], [], ["MIT"], []]
    assert np.isclose(found[3][0][3], 1.0)


def test_whole_texts_and_siblings(spark):
    whole = licenses.whole_texts()
    rows = [(name, f"{prose(i, 150)}\n{t}\n{prose(90 + i, 150)}") for i, (name, ts) in enumerate(whole.items()) for t in ts]
    rows += [("GPL-3.0", licenses.TEMPLATES["GPL-3.0"][0]), ("GPL-3.0", licenses.TEMPLATES["GPL-3.0"][1]), ("LGPL-3.0", licenses.TEMPLATES["LGPL-3.0"][0])]
    rows += [("GPL-2.0,GPL-3.0", whole["GPL-2.0"][2] + " " + prose(7, 40) + " " + licenses.TEMPLATES["GPL-3.0"][1])]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["found"] for r in licenses.scan(df).collect()}
    for i, (name, t) in enumerate(rows):
        assert ",".join(sorted({m["license"] for m in got[i]})) == name, (i, name, [m["license"] for m in got[i]])
    sizes = {name: max(m["end_word"] - m["first_word"] for m in got[i]) for i, (name, _) in reversed(list(enumerate(rows)))}
    assert sizes["Apache-2.0"] > 1000 and sizes["GPL-2.0"] > 2000


def test_whole_texts_against_brute_force(spark):
    """Edited whole licenses: of the templates contained in a stretch of the text the one with most shingles there is found."""
    r, whole, rows = random.Random(8), licenses.whole_texts(), []
    flat = [(n, t) for n, ts in whole.items() for t in ts]
    for i, (_, t) in enumerate(flat):
        words = t.split()
        for _ in range(len(words) // 60):
            words[r.randrange(len(words))] = f"edit{r.randrange(1000)}"
        rows.append((i, f"{prose(i, 80)} {' '.join(words)} {prose(70 + i, 90)}"))
    rows += [(100 + i, " ".join(t.split()[: len(t.split()) // 2])) for i, (_, t) in enumerate(flat) if len(t.split()) > 200]  # half a text is none

    def shingles(t):
        w = re.findall(rb"[a-z0-9\x80-\xff]+", t.encode().lower())
        return [tuple(w[k : k + 5]) for k in range(len(w) - 4)]

    want_of = [(n, shingles(t)) for n, t in flat]
    got = {x["doc_id"]: {m["license"] for m in x["found"]} for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=whole).collect()}
    for i, t in rows:
        own, best = shingles(t), {}
        for n, s in want_of:
            need = set(s)
            at = [k for k, x in enumerate(own) if x in need]
            common = len({own[k] for k in at if at and k < at[0] + 2 * len(s)})
            if common >= 0.75 * len(need):
                best[n] = max(best.get(n, 0), common)
        assert (max(best, key=best.get) in got[i] if best else got[i] == set()) and got[i] <= set(best), (i, best, got[i])


def test_templates_with_one_minimum_in_common():
    """Equal and nested templates, and more than a class's table is made for, are all looked up."""
    base = [f"w{i}" for i in range(40)]
    table = {f"same{i}": [" ".join(base)] for i in range(3)} | {f"other{i}": [" ".join(f"v{i}x{j}" for j in range(6 + i % 30))] for i in range(400)}
    index = licenses.Index(table)
    h, first = licenses.shingles(licenses.words([" ".join(base).encode(), table["other77"][0].encode()], licenses._APART), licenses.SHINGLE)
    met = {index.names[t] for _, _, t in index.candidates(h, first[:-1])}
    assert met == {"same0", "same1", "same2", "other77"}
