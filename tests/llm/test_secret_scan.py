import hashlib
import random
import re
import time

from pyspark.sql import functions as F
from tests.llm.cases import empty, prose, texts, tricky

from quarterline.llm import secret_scan as ss

ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(t):
    t = t or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


HARD = [
    "password=secret1", "Token : 'abc'", "token = secret: abcdef123", "API_KEY=abcdef apikey:\"ghijkl\"", "password=ab secret==xyzxyz", "passwd='1234567'",
    "é password=abcdef 日本 token=ghijkl\U0001F600secret:mnopqr", "AKIA" + "A" * 15, "AKIA" + "B" * 16, "xAKIAAKIA" + "C" * 16 + "AKIA", "0" * 23, "0" * 24, "g" + "f" * 30 + "g",
    "token=" + "a" * 30, "PASSWORD=" + "0123456789abcdef" * 2, "secret = = abcdef", "secret", "password:", "token=\npassword=abcdefg", "key=abcdefgh", "TOKEN\"  =  \"a.b-c_d/e+f=",
]


def test_forms_against_brute_force(spark):
    rows = [r[:2] for r in texts()] + [(100 + i, t) for i, t in enumerate(HARD)] + [(200, " ".join(HARD)), (201, prose(1, 50) + "\n".join(HARD * 20))]
    df = ss.with_forms(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r[0] or -1, r[1]) for r in df.select("doc_id", ss.listed(F.col("forms"))).collect())
    assert got == sorted((i or -1, brute(t)) for i, t in rows)


def random_key(r):
    return "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))


def labelled(spark):
    r = random.Random(2)
    rows = [(i, prose(i, 100) + f" token={random_key(r)}" * (i % 5 == 0)) for i in range(200)]
    return rows, r


def test_models_find_bare_random_strings(spark):
    rows, r = labelled(spark)
    key = random_key(r)
    rows += [(500, f"so {key} ta"), (501, "lomikebanutarisolomikebanutariso ta"), (502, prose(999, 300))]
    got = {x["doc_id"]: x["s"] for x in ss.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", ss.listed(F.col("spans")).alias("s")).collect()}
    assert got[500] == "random:3:35" and got[501] == "" and got[502] == ""
    for i, t in rows[:200]:
        assert got[i] == brute(t)  # the models add nothing to values that the forms hold


def test_held_out_accuracy(spark):
    rows, r = labelled(spark)
    model = ss.train(ss.labelled_samples(ss.with_forms(spark.createDataFrame(rows, "doc_id long, text string"))))
    strings = [(random_key(r), True) for _ in range(200)] + [("".join(prose(7000 + i, 12).split())[:32], False) for i in range(200)]
    out = spark.createDataFrame(strings, "v string, random boolean").select("random", (ss.ratio(F.col("v"), model) > ss.THRESHOLD).alias("said")).collect()
    assert sum(x["random"] != x["said"] for x in out) <= 4


def test_no_samples(spark):
    got = ss.scan(spark.createDataFrame([(1, "only prose here")], "doc_id long, text string")).collect()
    assert got[0]["spans"] == []
    assert ss.train(spark.createDataFrame([], "value string, random boolean")) is None


def test_redaction(spark):
    rows = [(i, t) for i, t in enumerate([*HARD, None, "", "é password=abcdef é"])]
    df = ss.with_forms(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in df.withColumn("masked", ss.redacted(F.col("text"), F.col("forms"))).collect():
        if r["text"] is None:
            assert r["masked"] is None
            continue
        covered, out = [False] * len(r["text"]), ""
        for s in r["forms"]:
            covered[s["start"] : s["end"]] = [True] * (s["end"] - s["start"])
        starts = set()
        at = 0
        for s in r["forms"]:
            if s["start"] >= at:
                starts.add(s["start"])
            at = max(at, s["end"])
        for i, c in enumerate(r["text"]):
            out += ("[SECRET]" if i in starts else "") + ("" if covered[i] else c)
        assert r["masked"] == out


def test_tricky_rows(spark):
    got = ss.scan(tricky(spark).select("doc_id", "text")).select(F.sha2(ss.listed(F.col("forms")), 256).alias("h")).collect()
    assert all(r["h"] == hashlib.sha256(b"").hexdigest() for r in got) and len(got) == len(texts())
    assert ss.scan(empty(spark)).count() == 0


def best_stretches(v, model, threshold):
    """Whether any stretch between separators is over the threshold, and the best one's score."""
    def score(a, b):
        codes = [0, *map(ord, v[a:b]), 0]
        return sum(model[x * ss.ALPHABET + y] for x, y in zip(codes, codes[1:]))

    starts = [i for i in range(len(v)) if i == 0 or v[i - 1] in "+/=_-"]
    ends = [j for j in range(1, len(v) + 1) if j == len(v) or v[j] in "+/=_-"]
    return {(a, b): score(a, b) for a in starts for b in ends if b - a >= 16 and score(a, b) > threshold}


def test_stretches_against_brute_force(spark):
    rows, r = labelled(spark)
    model = [round(x, 4) for x in ss.train(ss.labelled_samples(ss.with_forms(spark.createDataFrame(rows, "doc_id long, text string"))))]
    words = prose(77, 400).split()
    values = []
    for _ in range(300):
        parts = [r.choice(words) if r.random() < 0.6 else random_key(r)[: r.randrange(4, 33)] for _ in range(r.randrange(1, 9))]
        values.append("".join(p + r.choice("+/=_-") * r.randrange(1, 3) for p in parts)[: r.randrange(10, 200)])
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", ss.stretches(F.col("v"), model).alias("s")).collect()
    hits = 0
    for row in got:
        want, found = best_stretches(row["v"], model, ss.THRESHOLD), [(s["start"], s["end"]) for s in row["s"]]
        assert bool(want) == bool(found) and set(found) <= set(want), row
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
        hits += bool(found)
        assert all(any(a < f and e < b for e, f in found) for a, b in want), row  # nothing is lost
    assert 30 < hits < 300


def test_secrets_joined_to_ordinary_characters_are_found(spark):
    rows, r = labelled(spark)
    joined = ["session_lomikebanu=", "lomikebanu/tarisolomi/kebanutaso/", "lomi-kebanu_"]
    rows += [(500 + i, f"so {p}{random_key(r)} ta") for i, p in enumerate(joined)] + [(510, f"so {random_key(r)}/lomikebanutariso/lomikebanutarisolomike ta")]
    rows += [(511, f"so {'0123456789abcdef' * 2}/{random_key(r)} ta"), (512, "so lomikebanu/tarisolomi/kebanutaso ta")]
    got = {x["doc_id"]: x["s"] for x in ss.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", ss.listed(F.col("spans")).alias("s")).collect()}
    for i, p in enumerate(joined):
        assert got[500 + i] == f"random:{3 + len(p)}:{35 + len(p)}"
    assert got[510] == "random:3:35" and got[512] == ""
    assert got[511] in ("hex:3:35,random:35:68", "hex:3:35,random:36:68")  # what a form leaves of a run is judged


def test_texts_with_many_matches_take_linear_time(spark):
    """200,000 matches in one text, and twice as many in another: no more than in proportion, with all spans right."""
    def text(n):
        return " ".join(f"x{i} token=abc{i:06d}" for i in range(n))

    took = {}
    for n in (20_000, 200_000, 400_000):
        df = spark.createDataFrame([(1, text(n))], "doc_id long, text string")
        start = time.monotonic()
        forms = ss.with_forms(df).select("text", "forms")
        row = forms.select(F.sha2(ss.listed(F.col("forms")), 256).alias("h"), F.md5(ss.redacted(F.col("text"), F.col("forms"))).alias("m"), F.size("forms").alias("n")).first()
        took[n] = time.monotonic() - start
        assert row["n"] == n and row["h"] == hashlib.sha256(brute(text(n)).encode()).hexdigest()
        assert row["m"] == hashlib.md5(" ".join(f"x{i} [SECRET]" for i in range(n)).encode()).hexdigest()
    assert took[400_000] < 3 * took[200_000] + 5 and took[200_000] < 60


def test_running_sums_and_pieces(spark):
    r = random.Random(4)
    for n in (0, 1, ss.PART - 1, ss.PART, ss.PART + 1, 5 * ss.PART + 3):
        values = [r.randrange(100) for _ in range(n)]
        df = spark.createDataFrame([(values,)], "v array<int>")
        got = df.select(ss.running(F.col("v"), lambda x, y: x + y).alias("s"), ss.running(F.col("v"), F.greatest).alias("m")).first()
        assert got["s"] == [sum(values[: i + 1]) for i in range(n)] and got["m"] == [max(values[: i + 1]) for i in range(n)]
    text = "".join(r.choice("aé日\U0001F600\n ") for _ in range(3 * ss.BLOCK + 7))
    cuts = [(0, 0), (0, len(text)), (5, 5), (ss.BLOCK - 1, ss.BLOCK + 1), (ss.BLOCK, 2 * ss.BLOCK), (len(text) - 1, len(text)), *[tuple(sorted((r.randrange(len(text)), r.randrange(len(text))))) for _ in range(30)]]
    rows = spark.createDataFrame([(text, a, b) for a, b in cuts], "t string, a int, b int")
    got = rows.select("a", "b", ss.piece(ss.blocks(F.col("t")), F.col("a"), F.col("b")).alias("p")).collect()
    assert all(x["p"] == text[x["a"] : x["b"]] for x in got)


def test_one_long_run_of_many_stretches(spark):
    rows, r = labelled(spark)
    model = [round(x, 4) for x in ss.train(ss.labelled_samples(ss.with_forms(spark.createDataFrame(rows, "doc_id long, text string"))))]
    keys = [random_key(r) for _ in range(300)]
    value = "lomikebanutaso" + "".join(f"/lomikebanutarisolomikebanutariso/{k}" for k in keys)
    found = spark.createDataFrame([(value,)], "v string").select(ss.stretches(F.col("v"), model).alias("s")).first()["s"]
    assert len(found) > 290 and all(a["end"] <= b["start"] for a, b in zip(found, found[1:]))
    assert {value[s["start"] : s["end"]] for s in found} <= set(keys) | {value[s["start"] : s["end"]] for s in found if any(k in value[s["start"] : s["end"]] for k in keys)}
