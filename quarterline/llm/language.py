"""Language ID by fusing evidence: text likelihood, declared language, address suffix and host prior.

log P(l | all) = w * log P(text | l) + log P(declared | l) + log P(suffix | l) + log P(l | host) + constant

The text model is naive Bayes over hashed byte trigrams. How far the other sources can be believed is counted in
the corpus against the text's own verdict. The host prior is smoothed towards the site's, and that towards the
corpus's; a document's own verdict is left out of its host's counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import _LOWER, fraction, handed_back, record_batch, sliced, staged, utf8

BUCKETS = 1 << 14
#: At most about so many labelled rows (chosen by a hash of the id) fit the trigram model.
FIT_ROWS = 20_000
#: Neighbouring trigrams overlap, so each counts for a third.
TEXT_WEIGHT = 1 / 3
#: Pseudo-documents by which a host's counts are smoothed towards its site's, and a site's towards the corpus's.
HOST_WEIGHT = SITE_WEIGHT = 10.0
#: Documents whose best language has less of the posterior are rejected.
LEAST_CONFIDENCE = 0.5


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams (BUCKETS: none, at a text's end) and where each text's begin."""
    buf = _LOWER[np.frombuffer(b"".join(t + b"\n\n\n" for t in texts), np.uint8)].astype(np.uint32)
    code = np.full(len(buf), BUCKETS, np.int64)
    code[:-2] = ((buf[:-2] << 16 | buf[1:-1] << 8 | buf[2:]) * np.uint32(0x9E3779B1) >> np.uint32(8)) % BUCKETS
    first = np.concatenate(([0], np.cumsum([len(t) + 3 for t in texts])))
    for k in (1, 2, 3, 4, 5):  # trigrams that reach over the end; those of texts of one or two bytes too
        at = first[1:] - k
        code[np.maximum(at, first[:-1])] = BUCKETS
    return code, first[:-1]


def primary(code: Column) -> Column:
    """The primary subtag of a language code, or null: two small letters."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(code)), "^([a-z]{2})(?:[-_].*)?$", 1), F.lit(""))


def fit(evidence: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (languages, BUCKETS + 1) from rows with a declared language.

    The result is bounded by the two-letter codes times the buckets, whatever the rows.
    """
    labelled = evidence.where("declared is not null")
    total = labelled.count()
    sample = labelled.where(fraction(fit_rows / max(total, 1), "doc_id", "declared"))
    schema = "lang string, bucket int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text", 1 << 20):
            langs, of = np.unique(np.array(b.column("declared").to_pylist(), object), return_inverse=True)
            code, first = _trigrams(utf8(b.column("text")))
            lang = np.repeat(of, np.diff(np.append(first, len(code))))
            n = np.bincount(lang * (BUCKETS + 1) + code, minlength=len(langs) * (BUCKETS + 1)).reshape(len(langs), -1)[:, :BUCKETS]
            i, j = np.nonzero(n)
            yield record_batch(schema, list(langs[i]), j, n[i, j])

    rows = sample.select("declared", "text").mapInArrow(count, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS + 1))
    if langs:
        counts[np.searchsorted(langs, rows["lang"]), rows["bucket"]] = rows["n"]
    seen = counts.sum(axis=0) > 0
    counts[:, seen] += 0.5
    logs = np.log(counts.clip(1e-300) / counts.sum(axis=1, keepdims=True).clip(1e-300))
    logs[:, ~seen] = 0  # a trigram that no language has says nothing
    return langs, logs.astype(np.float32)


def _array(values: list[Column]) -> Column:
    return F.array(*values).cast("array<double>")


def _counted(table: DataFrame, key: str, n: int) -> DataFrame:
    """A row per value of ``key``: how many of its documents the text puts into each language."""
    own = [F.sum((F.col("text_at") == i).cast("double")) for i in range(n)]
    return staged(table.where(F.col(key).isNotNull()).groupBy(key).agg(_array(own).alias(f"{key}_n")), f"language-{key}")


def addresses(pages: DataFrame) -> DataFrame:
    """doc_id, markup, suffix, host of the pages whose address ends in a document's number; of several the first page.

    markup: the lang of the html tag, suffix: the last label of the host. Each is null where the page says nothing.
    """
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    number = F.regexp_extract("url", r"/([0-9]{1,18})(?:\.html?)?/?(?:[?#].*)?$", 1)
    markup = F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    found = pages.select(
        F.try_to_number(F.nullif(number, F.lit("")), F.lit("9" * 18)).cast("long").alias("doc_id"), "page_id",
        F.nullif(markup, F.lit("")).alias("markup"), F.nullif(host, F.lit("")).alias("host"))
    found = found.withColumn("suffix", F.nullif(F.regexp_extract("host", r"\.([a-z][a-z0-9-]*)$", 1), F.lit("")))
    first = F.min_by(F.struct("markup", "suffix", "host"), F.struct("page_id", "host"))
    return found.where("doc_id is not null").groupBy("doc_id").agg(first.alias("a")).select("doc_id", "a.*")


def identify(docs: DataFrame, pages: DataFrame | None = None, declared: str = "lang", site: str = "source",
             fit_rows: int = FIT_ROWS, least_confidence: float = LEAST_CONFIDENCE, carried: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text, the declared language, the site), with what ``pages`` say of it.

    A page's markup language goes before the declared one. Returns doc_id, language, confidence, text_language,
    declared, and kept: the posterior of the best language is ``least_confidence`` or more and there is a text.
    Missing evidence says nothing. Null and empty texts, those of one or two bytes and those without any known trigram
    have no text evidence and are rejected; ties go to the alphabetically first language. Without any declared
    language nothing can be told: language null, nothing kept. Repeated rows are judged alike; a null doc_id has no
    page. Columns named in ``carried`` come back beside each row's verdict.
    """
    evidence = docs.select("doc_id", "text", primary(F.col(declared)).alias("declared"), F.col(site).alias("site"), *carried)
    langs, logs = fit(evidence, fit_rows)
    n = len(langs)
    if not n:
        return evidence.select("doc_id", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"),
                               F.lit(None).cast("string").alias("text_language"), "declared", F.lit(False).alias("kept"), *carried)
    shared = evidence.sparkSession.sparkContext.broadcast(logs)  # (languages, BUCKETS + 1) floats
    fields = ["doc_id", "declared", "site", *carried]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text", 1 << 20):
            code, first = _trigrams(utf8(b.column("text")))
            sums = np.stack([np.add.reduceat(x[code].astype(np.float64), first) for x in shared.value], axis=1)
            grams = np.add.reduceat(shared.value[0][code] != 0, first, dtype=np.int64)
            best = np.where(grams > 0, sums.argmax(axis=1), -1)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in fields), pa.array(list(sums), pa.list_(pa.float64())), pa.array(best, pa.int32())],
                names=[*fields, "text_log", "text_at"])

    kinds = dict(evidence.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in fields) + ", text_log array<double>, text_at int"
    table = evidence.select(*fields, "text").mapInArrow(lambda b: handed_back(score(b)), schema)
    if pages is None:
        table = table.withColumns({c: F.lit(None).cast("string") for c in ("markup", "suffix", "host")})
    else:  # the texts stay behind: only their likelihoods are joined
        table = staged(table, "language-likelihood").join(staged(addresses(pages), "language-addresses"), "doc_id", "left")
    table = staged(table.withColumn("declared", F.coalesce(primary(F.col("markup")), "declared")), "language-text")

    overall = _totals(table, n)
    # a row per two-letter code or address suffix; few, but checked
    for key in ("declared", "suffix"):
        counts = _counted(table, key, n)
        table = table.join(F.broadcast(counts) if counts.count() <= 10_000 else counts, key, "left")
    # hosts may be many and one may hold a third of all rows: both sides are read from files, so a join can split it
    for key in ("site", "host"):
        table = table.join(_counted(table, key, n), key, "left")
    values = F.sequence(F.lit(0), F.lit(n - 1))

    def at(name: str, i: Column) -> Column:
        return F.coalesce(F.get(F.col(name), i), F.lit(0.0))

    def own(i: Column) -> Column:
        return (F.col("text_at") == i).cast("double")

    def likelihood(name: str, value: str):
        """log P(value | language), counted without the document itself; 0 where there is no value."""
        return lambda i: F.when(F.col(value).isNull(), 0.0).otherwise(
            F.log((F.greatest(at(name, i) - own(i), F.lit(0.0)) + 0.5) / (F.get(overall, i) + 1.0)))

    def rest(key: str, i: Column) -> Column:
        return F.greatest(at(f"{key}_n", i) - own(i), F.lit(0.0))

    def size(key: str) -> Column:
        return F.aggregate(F.transform(values, lambda i: rest(key, i)), F.lit(0.0), lambda a, x: a + x)

    def prior(i: Column) -> Column:
        corpus = (F.get(overall, i) + 1.0) / (F.lit(float(n)) + F.aggregate(overall, F.lit(0.0), lambda a, x: a + x))
        site = (rest("site", i) + SITE_WEIGHT * corpus) / (size("site") + SITE_WEIGHT)
        return F.log((rest("host", i) + HOST_WEIGHT * site) / (size("host") + HOST_WEIGHT))

    declared, suffix = likelihood("declared_n", "declared"), likelihood("suffix_n", "suffix")
    fused = table.withColumn("log_posterior", F.transform(
        values, lambda i: F.lit(TEXT_WEIGHT) * F.get("text_log", i) + declared(i) + suffix(i) + prior(i)))
    top = F.array_max("log_posterior")
    share = F.lit(1.0) / F.aggregate(F.transform("log_posterior", lambda x: F.exp(x - F.array_max("log_posterior"))), F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(x) for x in langs])
    return fused.withColumn("confidence", share).select(
        "doc_id", F.get(names, (F.array_position("log_posterior", top) - 1).cast("int")).alias("language"), "confidence",
        F.when(F.col("text_at") >= 0, F.get(names, F.col("text_at"))).alias("text_language"), "declared", *carried,
    ).withColumn("kept", (F.col("confidence") >= least_confidence) & F.col("text_language").isNotNull())


def _totals(table: DataFrame, n: int) -> Column:
    """How many documents the text puts into each language: one row, held as a constant."""
    row = table.agg(*[F.sum((F.col("text_at") == i).cast("double")) for i in range(n)]).first()
    return _array([F.lit(float(x or 0.0)) for x in row])
