"""Quality rules whose limits come from quantile sketches per language and source.

The sketch is a log-linear histogram: whole-number measures are cut to their six
leading bits, and each sketch is its rows (group, measure, bin, count). Sketches
merge by adding counts, which is how those of a language and of the corpus are
made from those of its sources, and a quantile is off by 1/32 of itself at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sendstats.llm.common import materialize, once, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Documents a group's own sketch must have; below, its language's is used, then the corpus's.
MIN_GROUP = 50
# A limit lies so many interquartile ranges outside the quartiles.
FENCE = 4
# Measures in thousandths (of a character for the mean word length), and the least
# interquartile range that is taken for each.
MEASURES = {
    "symbols": ("n_symbols * 1000 div n_words", 20),
    "repeats": ("n_repeat_words * 1000 div n_words", 100),
    "dup_lines": ("n_dup_lines * 1000 div greatest(n_lines, 1)", 100),
    "word_length": ("word_chars * 1000 div n_words", 300),
}
GROUP = ["lang", "source"]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: str) -> Column:
    """Words that lie in a three-word window found at least twice in the text."""
    n = f"size({words})"
    windows = (
        f"transform(sequence(0, {n} - 3), i -> "
        f"struct(xxhash64({words}[i], {words}[i + 1], {words}[i + 2]) AS h, i AS i))"
    )
    return F.expr(f"CASE WHEN {n} < 4 THEN CAST(array() AS array<struct<h: bigint, i: int>>) ELSE sort_array({windows}) END")


def with_base(docs: DataFrame) -> DataFrame:
    """Add the base counts and ``base_failed`` to each row; NULL text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = once(docs, "_words", words_of(F.col("text")))
    out = once(out, "_windows", _repeat_words("_words"))
    # Windows are sorted by hash, so that equal ones are neighbours.
    same = (
        "filter(_windows, (w, j) -> (j > 0 AND _windows[j - 1].h = w.h) OR "
        "(j + 1 < size(_windows) AND _windows[j + 1].h = w.h))"
    )
    out = once(out, "_same", F.expr(same))
    out = out.withColumn(
        "n_repeat_words",
        F.expr("size(array_distinct(flatten(transform(_same, w -> array(w.i, w.i + 1, w.i + 2)))))").cast("long"),
    )
    out = out.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return out.withColumn("base_failed", failed).drop("_words", "_windows", "_same", "_lines")


def _bin(value: str) -> str:
    """The lower end of a whole number's bin: its six leading bits."""
    shift = f"greatest(length(bin({value})) - 6, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketches(measured: DataFrame) -> DataFrame:
    """One sketch per language and source: rows (lang, source, measure, bin, n)."""
    good = measured.where(~F.col("base_failed"))
    pairs = ", ".join(f"struct('{name}' AS measure, {_bin(f'({sql})')} AS bin)" for name, (sql, _) in MEASURES.items())
    flat = good.select(*GROUP, F.explode(F.expr(f"array({pairs})")).alias("m"))
    return flat.groupBy(*GROUP, "m.measure", "m.bin").agg(F.count(F.lit(1)).alias("n"))


def limits(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Low and high limits of every measure by ``keys``, from the merged sketches."""
    merged = sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys, "measure").orderBy("bin")
    whole = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    quartile = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bin")))
    found = ranked.groupBy(*keys, "measure").agg(
        quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("total").alias("total")
    )
    least = F.create_map(*[F.lit(x) for name, (_, width) in MEASURES.items() for x in (name, width)])
    reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), least[F.col("measure")])
    bounds = found.select(*keys, "measure", "total", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    return bounds.groupBy(*keys).agg(
        F.max("total").alias("n_docs"),
        *[F.max(F.when(F.col("measure") == m, F.struct("low", "high"))).alias(m) for m in MEASURES],
    )


def _applied(measured: DataFrame) -> DataFrame:
    sketch = materialize(sketches(measured), "sketches")
    levels = [(GROUP, "own"), (["lang"], "language"), ([], "corpus")]
    out = measured
    for keys, level in levels:
        found = limits(sketch, keys).select(
            *[F.col(k).alias(f"_{k}") for k in keys], "n_docs", F.struct("n_docs", *MEASURES).alias(f"_{level}")
        )
        if keys:
            # A narrow table with a row for each group; a group too small for limits of its own has none.
            found = found.where(F.col("n_docs") >= MIN_GROUP).drop("n_docs")
            on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            out = out.join(found, on, "left").drop(*[f"_{k}" for k in keys])
        else:
            # A single row: an aggregate without keys.
            out = out.join(F.broadcast(found.drop("n_docs")), F.lit(True), "left")
    chosen = F.coalesce("_own", "_language", "_corpus")
    out = out.withColumn("_limits", chosen)
    inside = F.lit(True)
    for name, (sql, _) in MEASURES.items():
        value = F.expr(sql)
        inside &= (value >= F.col(f"_limits.{name}.low")) & (value <= F.col(f"_limits.{name}.high"))
    kept = ~F.col("base_failed") & F.coalesce(F.when(~F.col("base_failed"), inside), F.lit(False))
    return out.withColumn("kept", kept).drop("_own", "_language", "_corpus", "_limits")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Base counts and verdict of every row of ``docs`` (doc_id, text, lang, source).

    Repeated rows stay apart. NULL languages and sources are groups like any other.
    NULL and empty texts have no words and fail the base rules. An empty table gives
    no rows. Other columns are not carried.
    """
    measured = with_base(docs.select("doc_id", "text", "lang", "source")).drop("text")
    # Counts are needed for the sketches and for the verdicts; they are made once.
    return _applied(materialize(measured, "measures")).select(
        "doc_id", *BASE, "base_failed", "kept"
    )


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns."""
    columns = docs.columns
    kept = with_base(docs.select(F.struct(*columns).alias("row"), "text", "lang", "source")).drop("text")
    return _applied(materialize(kept, "measures")).where("kept").select("row.*")
