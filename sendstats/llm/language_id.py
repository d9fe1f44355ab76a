"""Language of web pages by fusing evidence from text, markup, address and host.

With equal languages as a start, the posterior is the product of
- the likelihood of the text: byte trigrams, learned from documents of known language;
- the likelihood of the declared markup language and of the address suffix, given the
  language: counted over all pages, weighted by what the text alone says;
- the prior of the host, smoothed by that of its parent domains up to the corpus.
All counts are grouped aggregations over all pages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendstats.llm.common import materialize

# Labelled documents that the trigrams are learned from, at most.
MAX_SAMPLE = 20_000
MAX_LANGUAGES = 64
BUCKETS = 1 << 15
# Text is no sum of independent trigrams: its log likelihood is worth so much of that sum.
TEMPER = 0.1
# Pages' worth of the wider evidence that is added at each step of smoothing.
STRENGTH = 5.0
NONE = "-"


def visible(page: Column) -> Column:
    """A page's text without scripts, styles, comments and tags."""
    raw = F.regexp_replace(page, "(?is)<(script|style)\\b.*?</\\1\\s*>|<!--.*?-->", " ")
    return F.btrim(F.regexp_replace(F.regexp_replace(raw, "<[^>]*>", " "), "&[#\\w]+;?|\\s+", " "))


def evidence(pages: DataFrame) -> DataFrame:
    """What each page says of itself: declared language, address suffix, host and its parents."""
    declared = F.regexp_extract("html", "(?i)<html\\b[^>]*?\\slang\\s*=\\s*[\"']?([a-z]{2,3})\\b", 1)
    host = F.lower(F.regexp_extract("url", "(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    path = F.lower(F.regexp_extract("url", "(?i)^[a-z][a-z0-9+.-]*://[^/?#]*/([a-z]{2})(?:[-_][a-z]{2})?(?=[/?#]|$)", 1))
    known = lambda c: F.when(F.coalesce(c, F.lit("")) == "", F.lit(NONE)).otherwise(c)
    top = F.element_at(F.split("host", "\\."), -1)
    found = pages.withColumns({"declared": known(F.lower(declared)), "host": known(host)})
    site = F.array_join(F.slice(F.split("host", "\\."), -2, 2), ".")
    return found.withColumns({
        # A language code that leads the path is as much of a suffix as the top domain.
        "suffix": F.concat_ws("/", known(top), known(path)),
        "site": F.when(F.size(F.split("host", "\\.")) > 1, site).otherwise(F.col("host")),
    })


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of a text's byte trigrams, with their counts."""
    b = np.frombuffer((" " + text.lower() + " ").encode(errors="replace"), dtype=np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) + (b[1:-1] << np.uint32(8)) + b[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - 15)
    counts = np.bincount(bucket, minlength=BUCKETS)
    seen = np.flatnonzero(counts)
    return seen, counts[seen]


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log probability of each trigram bucket in them.

    Counts are summed by Spark; the driver gets one number per bucket and language.
    """
    ids = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_SAMPLE)
    sample = docs.join(ids, "doc_id").where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                seen, n = trigram_counts(text)
                sums.setdefault(lang, np.zeros(BUCKETS))[seen] += n
        for lang, total in sums.items():
            seen = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": seen, "n": total[seen]})

    summed = materialize(sample.mapInPandas(count, "lang string, bucket bigint, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    largest = summed.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    langs = sorted(r["lang"] for r in largest.collect())
    table = np.full((len(langs), BUCKETS), 0.5)
    rows = summed.where(F.col("lang").isin(langs)).toPandas()
    place = {lang: i for i, lang in enumerate(langs)}
    np.add.at(table, (rows["lang"].map(place).to_numpy(dtype=np.int64), rows["bucket"].to_numpy(dtype=np.int64)), rows["n"].to_numpy())
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def _normal(logs: str) -> str:
    """SQL for the probabilities of an array of log weights."""
    parts = f"transform({logs}, x -> exp(x - array_max({logs})))"
    return f"transform({parts}, x -> x / aggregate({parts}, 0D, (a, y) -> a + y))"


def _sums(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The text posteriors summed by ``keys``: expected pages of each language."""
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.col("p")[i]) for i in range(n)]).alias("m"))


def _smoothed(table: DataFrame, parent: DataFrame, key: str, n: int) -> DataFrame:
    """Shares by ``key`` (with their ``up`` key), each pulled to the parent's by ``STRENGTH`` pages."""
    up = parent.select(F.col("key").alias("up"), F.col("share").alias("wide"))
    joined = table.join(up, "up")
    total = "aggregate(m, 0D, (a, y) -> a + y)"
    return joined.select(F.col(key).alias("key"), F.expr(
        f"transform(m, (x, i) -> (x + {STRENGTH}D * wide[i]) / ({total} + {STRENGTH}D))").alias("share"))


def languages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, url, lang, score, text_lang) of every row of ``pages`` (page_id, url, html).

    ``score`` is the probability of ``lang``, ``text_lang`` what the text alone says. NULL and
    empty pages are decided by their address and host, without either by the corpus. Without
    documents of known language, ``lang`` is NULL and ``score`` 0. Repeated rows stay apart, an
    empty table gives no rows, ties go to the first code, and other columns are not carried.
    """
    langs, table = train(docs.select("doc_id", "text", "lang"))
    n = len(langs)
    own = pages.select("page_id", "url", "html")
    if not n:
        return own.selectExpr("page_id", "url", "CAST(NULL AS string) AS lang", "0D AS score", "CAST(NULL AS string) AS text_lang")

    def likelihood(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for frame in frames:
            out = []
            for text in frame:
                seen, counts = trigram_counts(text or "")
                out.append(TEMPER * (table[:, seen] @ counts))
            yield pd.Series(out)

    text_logs = F.pandas_udf(likelihood, "array<double>")
    read = evidence(own).select("page_id", "url", "declared", "suffix", "host", "site", text_logs(visible(F.col("html"))).alias("text"))
    known = materialize(read.withColumn("p", F.expr(_normal("text"))), "evidence")

    corpus = _sums(known, [], n).withColumns({"up": F.lit(""), "key": F.lit("")})
    even = corpus.select(F.lit("").alias("key"), F.array(*[F.lit(1.0 / n)] * n).alias("share"))
    everywhere = _smoothed(corpus, even, "key", n)
    tops = _smoothed(_sums(known, ["suffix"], n).withColumn("up", F.lit("")), everywhere, "suffix", n)
    sites = _smoothed(_sums(known, ["site", "suffix"], n).withColumn("up", F.col("suffix")).withColumn("site", F.concat_ws(" ", "site", "suffix")), tops, "site", n)
    hosts = _smoothed(
        _sums(known, ["host", "site", "suffix"], n).withColumns({"up": F.concat_ws(" ", "site", "suffix"), "host": F.concat_ws(" ", "host", "suffix")}), sites, "host", n,
    )
    # How often a language declares itself so, against all declarations of that language.
    said = _sums(known, ["declared"], n).crossJoin(F.broadcast(_sums(known, [], n).select(F.col("m").alias("all"))))
    said = said.select(F.col("declared").alias("_declared"), F.expr("transform(m, (x, i) -> ln((x + 0.1D) / (all[i] + 1D)))").alias("tells"))
    joined = known.withColumn("_key", F.concat_ws(" ", "host", "suffix")).join(
        hosts.select(F.col("key").alias("_key"), F.col("share").alias("prior")), "_key", "left"
    ).join(said, F.col("declared") == F.col("_declared"), "left")
    fused = joined.withColumn("logs", F.expr("transform(text, (x, i) -> x + tells[i] + ln(prior[i]))"))
    ranked = fused.withColumn("post", F.expr(_normal("logs"))).withColumn("best", F.array_max("post"))
    code = F.array(*[F.lit(x) for x in langs])
    first = lambda values: F.element_at(code, F.array_position(F.col(values), F.array_max(values)).cast("int"))
    return ranked.select("page_id", "url", first("post").alias("lang"), F.col("best").alias("score"), first("p").alias("text_lang"))
