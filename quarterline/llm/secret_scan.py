"""Secret scan: fixed forms, and strings that read as random rather than as identifiers.

Two character Markov models, one of random strings and one of ordinary identifiers, are counted from labelled
samples; a string, or a stretch of it between separators, is a secret if its log-likelihood ratio is over a threshold.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import fraction, staged

#: kind, pattern, group whose length counts, least length. Matches are leftmost and do not overlap within a kind.
#: A run that is too short for access or hex can't hold a longer one, so their patterns state the length.
FORMS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
RANDOM = "random"
#: Strings of this alphabet and length are judged by the models, and so are their stretches of that length.
SHORTEST = 16
CANDIDATE = rf"[A-Za-z0-9+/=_-]{{{SHORTEST},}}"
#: What other characters may be joined to a secret by: a stretch starts after one and ends before one.
SEPARATORS = "+/=_-"
#: Identifiers that the model of ordinary strings is counted from.
ORDINARY = r"[A-Za-z0-9+/=_-]{8,}"
#: At most about so many documents (chosen by a hash) give the labelled samples.
FIT_DOCUMENTS = 50_000
#: Nats by which a string must be likelier as random: odds of a million to one against an ordinary string.
THRESHOLD = math.log(1e6)
#: Observations that a symbol's own frequency counts for beside the transitions seen.
SMOOTHING = 10.0
#: ASCII; 0 stands for the start and the end.
ALPHABET = 128

SEPARATED = [ord(c) for c in SEPARATORS]
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


#: Elements that an array grows by one at a time; longer ones are put together from parts of this size.
PART = 128
#: Code points of a block of a text; what lies far back in a text is found from its block, not from its start.
BLOCK = 1024


def _bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def running(values: Column, op, kind: str = "int") -> Column:
    """Running sums, or what else the associative ``op`` gives, of an array: part by part, then over the parts' last."""
    empty = F.array().cast(f"array<{kind}>")

    def within(part: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            return F.concat(acc, F.array(F.when(F.size(acc) == 0, x).otherwise(op(F.element_at(acc, -1), x))))

        return F.aggregate(part, empty, step)

    def joined(parts: Column) -> Column:
        last = within(F.transform(parts, lambda p: F.element_at(p, -1)))
        return _bound(last, lambda t: F.flatten(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.transform(p, lambda x: op(F.get(t, i - 1), x))))))

    def cut(x: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / PART).cast("int")), lambda i: within(F.slice(x, (i * PART + 1).cast("int"), PART)))
        return F.when(F.size(x) == 0, empty).otherwise(_bound(parts, joined))

    return _bound(values, cut)


def blocks(text: Column) -> Column:
    """The text in blocks of BLOCK code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def piece(of: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to before ``end`` of a text given by its blocks, without a walk from its start."""
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor((end - 1) / BLOCK).cast("int")
    inside = F.array_join(F.slice(of, first + 1, last - first + 1), "")
    return F.when(end <= start, F.lit("")).otherwise(F.substring(inside, start - first * BLOCK + 1, end - start))


def uncovered(spans: Column, length: Column) -> Column:
    """What spans (sorted by start) leave of a text: from, to; one entry before each stretch that they cover without a
    break, maybe empty, and one after the last."""
    def cut(x: Column) -> Column:
        return _bound(running(F.transform(x, lambda s: s["end"]), F.greatest), lambda reach: F.concat(
            F.filter(F.transform(x, lambda s, i: F.struct(F.when(i == 0, F.lit(0)).otherwise(F.get(reach, i - 1)).alias("from"), s["start"].alias("to"))), lambda g: g["from"] <= g["to"]),
            F.array(F.struct(F.when(F.size(x) == 0, F.lit(0)).otherwise(F.element_at(reach, -1)).alias("from"), length.alias("to")))))

    return _bound(spans, cut)


def _matches(text: Column, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind in code points, from the lengths of the texts between the matches and of the matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.struct(whole.alias("whole"), F.split(text, pattern, -1).alias("gaps"), *([F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")] if group else []))

    def located(p: Column) -> Column:
        lengths = F.zip_with(F.slice(p["gaps"], 1, F.size(p["whole"])), p["whole"], lambda g, w: F.length(g) + F.length(w))

        def span(end: Column, i: Column) -> Column:
            return F.struct((end - F.length(F.get(p["whole"], i))).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
                            F.get(p["value" if group else "whole"], i).alias("value"))

        return F.filter(F.transform(running(lengths, lambda x, y: x + y), span), lambda s: F.length(s["value"]) >= least).cast(_SPANS)

    return F.when(text.rlike(pattern), _bound(parts, located)).otherwise(F.array().cast(_SPANS))


def with_forms(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``forms``: the spans of the fixed forms, by start and kind. A null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("forms", F.array_sort(F.concat(*[_matches(text, k, i, *rest) for i, (k, *rest) in enumerate(FORMS)])))


def labelled_samples(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """value, random: values of the fixed forms, and the identifiers of documents without any."""
    random = scanned.select(F.explode("forms.value").alias("value"), F.lit(True).alias("random"))
    ordinary = scanned.where(F.size("forms") == 0).select(
        F.explode(F.regexp_extract_all(text_col, F.lit(ORDINARY), F.lit(0))).alias("value"), F.lit(False).alias("random"))
    return random.unionByName(ordinary)


def _codes(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.least(F.ascii(c), F.lit(ALPHABET - 1)))


def train(samples: DataFrame) -> list[float] | None:
    """Log-likelihood ratios of the transitions a -> b at a * ALPHABET + b; None without samples of both kinds.

    Transitions are smoothed towards their target's own frequency as by SMOOTHING observations, and that by a half in
    each cell. Only the (bounded) transition counts reach the driver.
    """
    steps = samples.where("value <> ''").select("random", F.explode(F.arrays_zip(
        F.concat(F.array(F.lit(0)), _codes(F.col("value"))).alias("a"), F.concat(_codes(F.col("value")), F.array(F.lit(0))).alias("b"))).alias("s"))
    counts = {True: {}, False: {}}
    for r in steps.groupBy("random", F.col("s.a").alias("a"), F.col("s.b").alias("b")).count().collect():
        counts[r["random"]][r["a"], r["b"]] = r["count"]
    if not counts[True] or not counts[False]:
        return None
    symbols = range(ALPHABET)
    out = [0.0] * ALPHABET**2
    for sign, c in ((1, counts[True]), (-1, counts[False])):
        target = [sum(c.get((a, b), 0) for a in symbols) + 0.5 for b in symbols]
        whole = sum(target)
        for a in symbols:
            row = sum(c.get((a, b), 0) for b in symbols)
            for b in symbols:
                out[a * ALPHABET + b] += sign * math.log((c.get((a, b), 0) + SMOOTHING * target[b] / whole) / (row + SMOOTHING))
    return out


def _table(model: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{x:.6g}" for x in model)), ",").cast("array<double>")


def ratio(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string, random against ordinary."""
    table = _table(model)
    return F.aggregate(
        F.concat(_codes(value), F.array(F.lit(0))), F.struct(F.lit(0).alias("a"), F.lit(0.0).alias("sum")),
        lambda acc, b: F.struct(b.alias("a"), (acc["sum"] + F.get(table, acc["a"] * ALPHABET + b)).alias("sum")), lambda acc: acc["sum"])


def stretches(value: Column, model: list[float], threshold: float = THRESHOLD) -> Column:
    """Stretches (start, end) of a string, of SHORTEST or more between separators or its ends, whose ratio() is over the
    threshold: the best of those that overlap or are joined by less than the threshold takes away, so that every such
    stretch overlaps one found. In one pass over the ends, with the best start so far; ``next`` is the best start after
    the stretch found last, and none begins before ``floor``, the end of the one before that."""
    none = F.lit(float("-inf"))
    kind = "array<struct<start:int,end:int>>"

    def kept(x: Column, span: Column) -> tuple[Column, Column]:
        """What is found, with one more: full parts, and the part that grows."""
        full = F.size(x["out"]) >= PART
        return (F.when(full, F.concat(x["parts"], F.array(x["out"]))).otherwise(x["parts"]).alias("parts"),
                F.when(full, F.array(span)).otherwise(F.concat(x["out"], F.array(span))).cast(kind).alias("out"))

    def run(given: Column) -> Column:
        codes, table = given["codes"], given["table"]

        def step(x: Column, j: Column) -> Column:
            i = j - (SHORTEST - 1)
            moved = F.when(j == 0, F.lit(0.0)).otherwise(x["sum"] + F.get(table, F.get(codes, j - 1) * ALPHABET + F.get(codes, j)))
            lagged = F.when(i <= 0, F.lit(0.0)).otherwise(x["lag"] + F.get(table, F.get(codes, i - 1) * ALPHABET + F.get(codes, i)))
            begins = (i == 0) | ((i > 0) & F.get(codes, i - 1).isin(*SEPARATED))
            ends = (j == F.size(codes) - 1) | F.get(codes, j + 1).isin(*SEPARATED)

            def entered(y: Column) -> Column:
                value = F.when(begins, F.get(table, F.get(codes, i)) - y["lag"]).otherwise(none)
                better, later = (value > x["best"]) & (i >= x["floor"]), (value > x["next"]) & (i >= x["end"])
                return F.struct(
                    y["sum"].alias("sum"), y["lag"].alias("lag"), F.when(better, value).otherwise(x["best"]).alias("best"), F.when(better, i).otherwise(x["at"]).alias("at"),
                    F.when(later, value).otherwise(x["next"]).alias("next"), F.when(later, i).otherwise(x["next_at"]).alias("next_at"))

            def judged(y: Column) -> Column:
                last = F.when(ends, y["sum"] + F.get(table, F.get(codes, j) * ALPHABET)).otherwise(none)
                score, other = y["best"] + last, y["next"] + last
                found = (score > threshold) & (score > x["score"])
                second = (x["end"] > 0) & (other > threshold)
                closed = (x["end"] > 0) & (y["best"] + y["sum"] <= x["score"] - threshold)
                span = F.struct(x["start"].alias("start"), x["end"].alias("end"))
                return (F.when(found, F.struct(
                    y["sum"].alias("sum"), y["lag"].alias("lag"), y["best"].alias("best"), y["at"].alias("at"), none.alias("next"), F.lit(0).alias("next_at"),
                    y["at"].alias("start"), (j + 1).alias("end"), score.alias("score"), x["floor"].alias("floor"), x["parts"].alias("parts"), x["out"].alias("out")))
                    .when(second, F.struct(
                        y["sum"].alias("sum"), y["lag"].alias("lag"), y["next"].alias("best"), y["next_at"].alias("at"), none.alias("next"), F.lit(0).alias("next_at"),
                        y["next_at"].alias("start"), (j + 1).alias("end"), other.alias("score"), x["end"].alias("floor"), *kept(x, span)))
                    .when(closed, F.struct(
                        y["sum"].alias("sum"), y["lag"].alias("lag"), y["next"].alias("best"), y["next_at"].alias("at"), none.alias("next"), F.lit(0).alias("next_at"),
                        F.lit(0).alias("start"), F.lit(0).alias("end"), none.alias("score"), x["end"].alias("floor"), *kept(x, span)))
                    .otherwise(F.struct(
                        y["sum"].alias("sum"), y["lag"].alias("lag"), y["best"].alias("best"), y["at"].alias("at"), y["next"].alias("next"), y["next_at"].alias("next_at"),
                        x["start"].alias("start"), x["end"].alias("end"), x["score"].alias("score"), x["floor"].alias("floor"), x["parts"].alias("parts"), x["out"].alias("out"))))

            return _bound(_bound(F.struct(moved.alias("sum"), lagged.alias("lag")), entered), judged)

        zero = F.struct(
            F.lit(0.0).alias("sum"), F.lit(0.0).alias("lag"), none.alias("best"), F.lit(0).alias("at"), none.alias("next"), F.lit(0).alias("next_at"),
            F.lit(0).alias("start"), F.lit(0).alias("end"), none.alias("score"), F.lit(0).alias("floor"), F.array().cast(f"array<{kind}>").alias("parts"), F.array().cast(kind).alias("out"))
        last = F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step)
        over = lambda x: F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))).cast(kind)
        return _bound(last, lambda x: F.concat(F.flatten(x["parts"]), x["out"], F.when(x["end"] > 0, over(x)).otherwise(F.array().cast(kind))))

    return F.when(F.length(value) < SHORTEST, F.array().cast(kind)).otherwise(_bound(F.struct(_codes(value).alias("codes"), _table(model).alias("table")), run))


def _masked(text: Column, forms: Column) -> Column:
    """The text with blanks for what forms cover: as long, and its candidates are what the forms leave of them."""
    def blanked(x: Column) -> Column:
        after = lambda i: F.coalesce(F.get(x["left"], i + 1)["from"], F.get(x["left"], i)["to"])
        return F.array_join(F.transform(x["left"], lambda g, i: F.concat(piece(x["blocks"], g["from"], g["to"]), F.repeat(F.lit(" "), after(i) - g["to"]))), "")

    return F.when(F.size(forms) == 0, text).otherwise(_bound(F.struct(blocks(text).alias("blocks"), uncovered(forms, F.length(text)).alias("left")), blanked))


def _fold(text_col: str) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(2))


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", fit_documents: int = FIT_DOCUMENTS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``forms`` and ``spans`` (start, rank, end, kind, value; code points, end exclusive).

    ``spans`` are the forms and, of kind random, the stretches over the threshold of what the forms leave of the
    candidates. A null or empty text has none. The models come from this table's own labelled samples, in two halves by
    a hash of the text: each half is judged by the other's models, so that no string testifies for itself. Where a
    half lacks samples of a kind, the other keeps its forms alone. Equal texts get equal spans; other columns are
    passed on, unless they are named forms, spans or candidates.
    """
    scanned = with_forms(docs, text_col)
    chosen = docs.where(fraction(fit_documents / max(docs.count(), 1), id_col, text_col)).select(F.col(text_col).alias("text"))
    sample = staged(with_forms(chosen), "secrets-sample")
    models = [train(labelled_samples(sample.where(_fold("text") != k))) for k in (0, 1)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = _matches(_masked(text, F.col("forms")), RANDOM, len(FORMS), CANDIDATE, 0, SHORTEST)

    def judged(model: list[float] | None) -> Column:
        if model is None:
            return F.array().cast(_SPANS)
        return F.flatten(F.transform("candidates", lambda c: _bound(blocks(c["value"]), lambda of: F.transform(stretches(c["value"], model, threshold), lambda s: F.struct(
            (c["start"] + s["start"]).alias("start"), F.lit(len(FORMS)).alias("rank"), (c["start"] + s["end"]).alias("end"), F.lit(RANDOM).alias("kind"),
            piece(of, s["start"], s["end"]).alias("value"))))))

    extra = F.when(F.size("candidates") == 0, F.array().cast(_SPANS)).when(_fold(text_col) == 0, judged(models[0])).otherwise(judged(models[1]))
    return scanned.withColumn("candidates", found).withColumn("spans", F.array_sort(F.concat("forms", extra))).drop("candidates")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch covered by spans (sorted by start) replaced by ``mark``."""
    def done(x: Column) -> Column:
        return F.array_join(F.transform(x["left"], lambda g: piece(x["blocks"], g["from"], g["to"])), mark)

    return F.when(F.size(spans) == 0, text).otherwise(_bound(F.struct(blocks(text).alias("blocks"), uncovered(spans, F.length(text)).alias("left")), done))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
