"""Quality rules whose cutoffs carry a guarantee: how many good documents they may reject, per stratum.

For each rule and stratum a cutoff is tightened step by step as long as the exact binomial bound of the labelled
holdout still shows, at a corrected level, that at most ``risk`` of the good documents lie beyond it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterline.llm.common import SPACE, staged

SYMBOLS = "#*$%&|<>"
#: Positions of windows take this many low bits of a sort key; longer texts are compared by their words.
POSITION_BITS = 20

#: rule: (score, cutoffs from the most lenient to the strictest). A document fails where the score is over the cutoff.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", [2.0, 1.0, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05, 0.02]),
    "repeats": ("n_repeat_words / n_words", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05]),
    "dup_lines": ("n_dup_lines / n_lines", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05]),
    "capitals": ("n_capitals / word_chars", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
}


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _covered(sorted_keys: str, same: str, position: str) -> str:
    """SQL for how many words lie in windows equal to a neighbour among the sorted windows ``s``."""
    return f"""get(transform(array({sorted_keys}), s -> size(array_distinct(flatten(transform(
        filter(sequence(0, size(s) - 2), j -> {same.format(a='s[j]', b='s[j + 1]')}),
        j -> array({', '.join(f'{position.format(s)} + {k}' for s in ('s[j]', 's[j + 1]') for k in range(3))})))))), 0)"""


def repeated_words() -> Column:
    """Words of ``w`` (an array column) in windows of three found twice or more, each word once.

    The windows are sorted by a key of 44 hash bits and the position. Where neighbours of one hash differ in their
    words (a collision), or the text is too long for the position's bits, the words themselves are sorted.
    """
    at = "sequence(0, size(w) - 3)"
    keys = f"sort_array(transform({at}, i -> shiftleft(shiftright(xxhash64(w[i], w[i + 1], w[i + 2]), {POSITION_BITS}), {POSITION_BITS}) | i))"
    mask = (1 << POSITION_BITS) - 1
    hashed = _covered("keys", f"shiftright({{a}}, {POSITION_BITS}) = shiftright({{b}}, {POSITION_BITS})", f"cast({{0}} & {mask} AS INT)")
    exact = _covered(f"sort_array(transform({at}, i -> struct(concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g, i AS i)))", "{a}.g = {b}.g", "{0}.i")
    clash = f"""exists(filter(sequence(0, size(keys) - 2), j -> shiftright(keys[j], {POSITION_BITS}) = shiftright(keys[j + 1], {POSITION_BITS})),
        j -> exists(sequence(0, 2), k -> w[cast(keys[j] & {mask} AS INT) + k] <> w[cast(keys[j + 1] & {mask} AS INT) + k]))"""
    with_keys = f"get(transform(array({keys}), keys -> CASE WHEN size(keys) < 2 THEN 0 WHEN {clash} THEN {exact} ELSE {hashed} END), 0)"
    return F.expr(f"CAST(CASE WHEN size(w) < 4 THEN 0 WHEN size(w) > {1 << POSITION_BITS} THEN {exact} ELSE {with_keys} END AS BIGINT)")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: Column | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, stratum and the counts the rules use, of whole texts. A null text has no words; a null stratum is ''."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(stratum if stratum is not None else F.lit(""), F.lit("")).alias("stratum"), text.alias("text"), *carried)
    with_word = F.filter(F.split("text", "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    base = base.withColumns({"w": F.array_remove(F.split("text", SPACE), ""), "ln": with_word})
    t = F.col("text")
    return base.select(
        "doc_id", "stratum", *carried, F.md5("text").alias("digest"), F.size("w").cast("long").alias("n_words"),
        _without(t, " \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (F.length(t) - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("ln") - F.size(F.array_distinct("ln"))).cast("long").alias("n_dup_lines"),
        F.size("ln").cast("long").alias("n_lines"),
        repeated_words().alias("n_repeat_words"),
        (F.length(t) - _without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_capitals"))


def _score(rule: str) -> Column:
    top, bottom = RULES[rule][0].split(" / ")
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def binomial_tail(n: str, k: str, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed term by term in logarithms; under ``level`` exactly where the
    Clopper-Pearson upper bound of k in n at that level is under p."""
    return F.expr(f"""CASE WHEN {k} >= {n} * {p!r}D THEN 1D ELSE exp(aggregate(sequence(0, cast({k} AS INT)),
        named_struct('term', cast(null AS DOUBLE), 'total', cast(null AS DOUBLE)),
        (acc, j) -> CASE WHEN j = 0 THEN named_struct('term', {n} * {math.log1p(-p)!r}D, 'total', {n} * {math.log1p(-p)!r}D)
            ELSE get(transform(array(acc.term + ln(({n} - j + 1) / cast(j AS DOUBLE)) + {math.log(p / (1 - p))!r}D),
                t -> named_struct('term', t, 'total', greatest(acc.total, t) + log1p(exp(-abs(acc.total - t))))), 0) END,
        acc -> acc.total)) END""")


def cutoffs(scored: DataFrame, labels: DataFrame, risk: float = 0.05, level: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff): the strictest cutoffs whose false rejections are shown to be limited.

    All rules together may reject at most ``risk`` of a stratum's good documents, so each has an equal share. The
    chance that any stated bound is wrong is at most ``level``: it is divided by strata times rules, and along a
    rule's cutoffs the tests stop at the first that fails, which needs no further correction. Strata with too few
    labelled rows get no cutoff. A document labelled more than once counts as good only if all its labels say so.
    Copies of a text are no independent trials: a text counts once in its stratum.
    """
    label = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = scored.join(label.where("quality = 1"), "doc_id").dropDuplicates(["stratum", "digest"])
    counts = staged(good.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.sum((_score(r) > c).cast("long")).alias(f"{r}_{i}") for r, (_, grid) in RULES.items() for i, c in enumerate(grid)]), "quality-counts")
    strata = max(counts.count(), 1)
    steps = F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("i"), F.lit(float(c)).alias("cutoff"), F.col(f"{r}_{i}").alias("k"))
        for r, (_, grid) in RULES.items() for i, c in enumerate(grid)])
    tests = counts.select("stratum", "n", F.explode(steps).alias("s")).select("stratum", "n", "s.*")
    shown = binomial_tail("n", "k", risk / len(RULES)) <= level / len(RULES) / strata
    so_far = Window.partitionBy("stratum", "rule").orderBy("i")
    return tests.withColumn("holds", F.min(shown.cast("int")).over(so_far)).where("holds = 1").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: Column | None = None,
           min_words: int = 50, max_repeat_percent: int = 50, risk: float = 0.05, level: float = 0.05, carried: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs``: the measures, base_failed, failed_rules (the names, comma-joined) and kept.

    base_failed: fewer than ``min_words`` words, or over ``max_repeat_percent`` per cent of them in repeated windows.
    kept: not base_failed, and within every cutoff of the document's stratum. Null texts have no words; null ids and
    repeated rows are judged like others; without labels no cutoff holds and the base rules alone decide.
    """
    table = staged(measures(docs, id_col, text_col, stratum, carried), "quality-measures")
    limits = cutoffs(table, labels, risk, level).groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"most_{r}") for r in RULES])
    limits = staged(limits, "quality-cutoffs")
    # a row per stratum; broadcast only if that is few
    joined = table.join(F.broadcast(limits) if limits.count() <= 10_000 else limits, "stratum", "left")
    failed = F.concat_ws(",", *[F.when(_score(r) > F.col(f"most_{r}"), F.lit(r)) for r in RULES])
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return joined.withColumn("base_failed", base).withColumn("failed_rules", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("failed_rules") == "")).drop("digest", *[f"most_{r}" for r in RULES])
