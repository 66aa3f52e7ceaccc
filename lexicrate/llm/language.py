"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the page's text under
character trigram models of labelled documents, the declared markup language,
the address suffix (the last label of the host), and a prior of the host.  All
but the trigrams are learned from the pages themselves by grouped aggregation:
every page spreads its text posterior over the languages, and the soft counts
by (declared language, language), (suffix, language) and (host, language) give
smoothed conditionals.  Host priors are smoothed hierarchically: host towards
its domain, domain towards the whole.  A page's own count is taken out of its
prior, and the suffix evidence is relative to the prior of the whole.

Soft counts are partial sums before any shuffle, so a host with a third of all
pages costs a row per task.  The joins back are on hosts, domains, suffixes
and declared languages; hot keys are joined apart (``spread_join``).

Defined results: a null or empty page has flat text likelihood and is judged
by the other evidence; a missing declaration, address or suffix is a value of
its own; without labelled documents there are no languages and ``lang`` is
null; rows that share an id are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicrate.session import store

#: Size of the trigram table and bound of labelled documents of a language.
TRIGRAMS, PER_LANGUAGE = 1 << 15, 1000
#: Trigrams that a whole text counts for at most: neighbouring ones depend on each other.
WEIGHT = 40
#: Strength of the smoothing of host towards domain, domain towards whole, and of the conditionals.
HOST, DOMAIN, CONDITIONAL = 4.0, 8.0, 2.0
#: Keys with over a HOT-th of all pages are joined apart.
HOT = 1024
#: Fixed patterns: what of the markup is no text.
NO_TEXT = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;")
DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)"
ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def trigrams(text: bytes) -> np.ndarray:
    """Table positions of all byte trigrams of a text in lower case."""
    b = np.frombuffer(b" " + text.decode(errors="replace").lower().encode() + b" ", np.uint8).astype(np.uint32)
    b = b[~((b == 32) & np.append(False, b[:-1] == 32))]
    return ((b[:-2] * 65599 + b[1:-1]) * 65599 + b[2:]) % np.uint32(TRIGRAMS)


def page_text(html: str | None) -> bytes:
    return re.sub(rb"\s+", b" ", NO_TEXT.sub(b" ", (html or "").encode()))


def fit_text(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of their trigrams, from up to
    PER_LANGUAGE documents of a language in hash order of their ids (rows with
    one id are drawn together).  Every label is a language, at 128 KB of model
    on the driver and in each worker."""
    named = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("_id"))
    known = named.groupBy("lang").count()
    first = Window.partitionBy("lang").orderBy(F.xxhash64("_id"), "_id")
    # thinned to some four times the bound before the rows of a language meet
    thin = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < float(1 << 30) * (4 * PER_LANGUAGE) / F.col("count")
    chosen = named.join(F.broadcast(known), "lang").where(thin).withColumn("k", F.row_number().over(first)).where(F.col("k") <= PER_LANGUAGE)
    chosen = chosen.select("_id").distinct()  # at most PER_LANGUAGE ids of a language
    rows = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")

    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(TRIGRAMS, np.int64)
        for t in pdf["text"]:
            total += np.bincount(trigrams((t or "").encode()), minlength=TRIGRAMS)
        p = (total + 0.5) / (total.sum() + 0.5 * TRIGRAMS)
        return pd.DataFrame({"lang": [key[0]], "logs": [np.log(p).astype(np.float32).tobytes()]})

    found = sorted(rows.where(F.col("lang").isNotNull()).groupBy("lang").applyInPandas(count, "lang string, logs binary").collect(), key=lambda r: r["lang"])
    return [r["lang"] for r in found], np.array([np.frombuffer(r["logs"], np.float32) for r in found], np.float32).reshape(len(found), TRIGRAMS)


def text_posteriors(pages: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, declared, host, domain, suffix, ll`` with the tempered log
    likelihood of each language, and ``p``, its softmax."""
    shared = pages.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model[1].T))
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), ADDRESS, 1))
    labels = F.split(host, r"\.")
    cols = pages.select(F.col(id_col).alias("page_id"), F.lower(F.regexp_extract(F.coalesce(html_col, F.lit("")), DECLARED, 1)).alias("declared"),
                        host.alias("host"), F.array_join(F.slice(labels, -F.least(F.lit(2), F.size(labels)), F.lit(2)), ".").alias("domain"),
                        F.element_at(labels, -1).alias("suffix"), F.col(html_col).alias("html"))
    id_type = cols.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for b in batches:
            lls = []
            for html in b.column("html").to_pylist():
                t = trigrams(page_text(html))
                lls.append(logs[t].mean(0, dtype=np.float64) * min(len(t), WEIGHT) if len(t) else np.zeros(logs.shape[1]))
            lls = np.array(lls).reshape(b.num_rows, logs.shape[1])
            e = np.exp(lls - lls.max(1, keepdims=True)) if logs.shape[1] else lls
            p = e / e.sum(1, keepdims=True) if logs.shape[1] else e
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(list(lls), pa.list_(pa.float64())), pa.array(list(p), pa.list_(pa.float64()))],
                                             [*b.schema.names[:-1], "ll", "p"])

    return cols.mapInArrow(run, f"page_id {id_type}, declared string, host string, domain string, suffix string, ll array<double>, p array<double>")


def spread_join(rows: DataFrame, table: DataFrame, on: str, values: list[str], pages: int) -> DataFrame:
    """Join a table of one row for each key with its count ``n``.  Keys with
    over a HOT-th of all pages (fewer than HOT keys) are broadcast; the rows
    of all others meet the rest of the table in a shuffle that no hot key enters."""
    hot = table.where(F.col("n") > pages / HOT).select(F.col(on).alias("_h"), *[F.col(v).alias(f"_h_{v}") for v in values])
    cold = table.where(F.col("n") <= pages / HOT).select(F.col(on).alias("_c"), *[F.col(v).alias(f"_c_{v}") for v in values])
    out = rows.join(F.broadcast(hot), F.col(on) == F.col("_h"), "left")
    key = F.when(F.col("_h").isNull(), F.col(on)).otherwise(F.concat(F.lit("\0"), F.xxhash64("page_id").cast("string")))
    out = out.withColumn("_key", key).join(cold, F.col("_key") == F.col("_c"), "left")
    return out.select(*rows.columns, *[F.coalesce(f"_h_{v}", f"_c_{v}").alias(v) for v in values])


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, lang, score`` (its posterior), ``text_lang``, ``declared``,
    ``suffix``, ``host`` of every page."""
    languages, logs = fit_text(docs)
    if not languages:
        return pages.select(F.col(id_col).alias("page_id"), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("score"),
                            *[F.lit(None).cast("string").alias(c) for c in ("text_lang", "declared", "suffix", "host")])
    n = len(languages)
    rows = store(text_posteriors(pages, (languages, logs), id_col, url_col, html_col), "page-evidence")
    at = range(n)

    def soft(*by: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.array(*[F.sum(F.col("p")[i]) for i in at]).alias("c"))

    def total(c: Column) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda s, x: s + x)

    whole = rows.agg(F.array(*[F.sum(F.col("p")[i]) for i in at])).first()[0] or [1.0] * n  # one row
    whole = np.array([x or 0.0 for x in whole]) + 1.0
    prior = F.array(*[F.lit(float(x)) for x in whole / whole.sum()])
    weight = F.array(*[F.lit(float(x)) for x in whole])

    # conditionals: P(value | language), smoothed by the value's share of all pages
    def conditional(by: str) -> DataFrame:
        c = soft(by).withColumn("share", total(F.col("c")) / float(whole.sum()))
        return c.select(by, F.transform(F.arrays_zip(F.col("c").alias("c"), weight.alias("w")),
                                        lambda z: z["c"] / z["w"]).alias("raw"), "share", weight.alias("w")).select(
            by, F.zip_with("raw", F.transform("w", lambda w: w), lambda r, w: (r * w) / (w + CONDITIONAL)).alias("part"),
            F.transform("w", lambda w: F.lit(CONDITIONAL) / (w + CONDITIONAL)).alias("back"), "share").select(
            by, (F.col("share") * float(whole.sum())).alias("n"),
            F.zip_with("part", F.zip_with("back", F.array_repeat("share", n), lambda b, s: b * s), lambda a, b: a + b).alias(f"p_{by}"))

    hosts = soft("domain", "host").withColumnRenamed("c", "c_host")
    domains = soft("domain").withColumnRenamed("c", "c_domain")
    hosts = store(hosts.join(domains, "domain").select("host", "c_host", "c_domain", total(F.col("c_host")).alias("n")), "host-counts")

    pages_n = rows.count()
    out = spread_join(rows, hosts, "host", ["c_host", "c_domain"], pages_n)
    out = spread_join(out, conditional("declared"), "declared", ["p_declared"], pages_n)
    out = spread_join(out, conditional("suffix"), "suffix", ["p_suffix"], pages_n)

    def smoothed(counts: Column, towards: Column, strength: float) -> Column:
        """(counts - own + strength * towards) / (total - 1 + strength)"""
        rest = F.zip_with(counts, F.col("p"), lambda c, p: F.greatest(c - p, F.lit(0.0)))
        sized = F.transform(F.array(F.struct(rest.alias("r"), total(rest).alias("t"))), lambda s: s)[0]
        return F.zip_with(F.zip_with(sized["r"], towards, lambda r, q: r + strength * q), F.array_repeat(sized["t"] + strength, n), lambda x, t: x / t)

    out = out.withColumn("p_in_domain", smoothed(F.col("c_domain"), prior, DOMAIN))
    out = out.withColumn("p_in_host", smoothed(F.col("c_host"), F.col("p_in_domain"), HOST))
    # the suffix belongs to the domain that the prior has counted: half its weight
    post = F.zip_with(F.zip_with("ll", "p_in_host", lambda l, p: l + F.log(p)),
                      F.zip_with("p_declared", "p_suffix", lambda d, s: F.log(d) + 0.5 * F.log(s)), lambda a, b: a + b)
    out = out.withColumn("post", post)
    out = out.withColumn("top", F.array_max("post"))
    out = out.withColumn("best", F.array_position(F.col("post"), F.col("top")).cast("int"))
    names = F.array(*[F.lit(x) for x in languages])
    spread = F.zip_with("post", F.array_repeat("top", n), lambda x, m: F.exp(x - m))
    return out.select("page_id", F.element_at(names, F.col("best")).alias("lang"), (F.lit(1.0) / total(spread)).alias("score"),
                      F.element_at(names, F.array_position(F.col("p"), F.array_max("p")).cast("int")).alias("text_lang"), "declared", "suffix", "host")
