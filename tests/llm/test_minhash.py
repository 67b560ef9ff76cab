import random

from tests.llm.cases import WORD, empty, lower, prose, texts, tricky

from quarterline.llm import minhash
from quarterline.llm.components import components


def shingles(t, size=5):
    w = WORD.findall(lower(t))
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and any(p and q and 100 * len(p & q) >= 75 * len(p | q) for p in sets[a] for q in sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def check(spark, rows, df):
    want = brute(rows)
    got = minhash.near_duplicates(df).collect()
    sizes = sorted((i or -1, len(shingles(t))) for i, t in rows)
    assert sorted((r["doc_id"] or -1, r["n_shingles"]) for r in got) == sizes
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"]), r
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_tricky_rows(spark):
    check(spark, [r[:2] for r in texts()], tricky(spark))


def test_one_id_with_several_texts(spark):
    """Ids 1 (two texts), 2 (near the first) and 3 (near the second) are one component; so are ids that share an id."""
    a, b, c = (prose(90 + i, 120) for i in range(3))
    near = [" ".join([*t.split()[:-1], "tail"]) for t in (a, b, c)]
    rows = [(1, a), (1, b), (2, near[0]), (3, near[1]), (4, c), (5, near[2]), (5, prose(95, 90)), (6, prose(95, 90)), (7, ""), (7, near[2]), (8, prose(96, 90)), (3, near[1]), (1, a.upper())]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 4, 8: 8}
    check(spark, rows, spark.createDataFrame(rows, "doc_id long, text string"))


def test_chains_and_families(spark):
    """Copies of copies: the ends are not alike, and no member of a bucket stands for all."""
    r, rows, n = random.Random(5), [], 100
    for family in range(6):
        w = prose(50 + family, 120).split()
        for step in range(8):
            rows.append((n, " ".join(w)))
            n += 1
            for _ in range(3):
                w[r.randrange(len(w))] = f"new{n}x{r.random()}"
    r.shuffle(rows)
    check(spark, rows, spark.createDataFrame(rows, "doc_id long, text string"))


def test_large_group_of_near_copies(spark):
    r, base = random.Random(7), prose(9, 150).split()
    rows = []
    for i in range(300):
        w = list(base)
        w[r.randrange(len(w))] = f"n{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(200 + i, 100)) for i in range(20)]
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(300)) and all(got[1000 + i] == 1000 + i for i in range(20))


def test_empty_table(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 1), (10, 11), (11, 10), (7, 7), (None, 3), (20, 30), (30, 40), (40, 20), *[(100, 100 + i) for i in range(1, 50)]]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 20: 20, 30: 20, 40: 20, **{100 + i: 100 for i in range(50)}}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
