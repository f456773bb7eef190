"""Quality rules whose thresholds follow the corpus: quantile sketches per language and source."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import stored

# ASCII white space and the characters counted as symbols.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATISTICS = [*BASE, "n_lines"]
#: A metric is an integer in steps of 1/1000 so that sketches are exact about their bins.
METRICS = {
    "symbols": ("high", "1000 * n_symbols div nullif(n_words, 0)"),
    "dup_lines": ("high", "1000 * n_dup_lines div nullif(n_lines, 0)"),
    "repeats": ("high", "1000 * n_repeat_words div nullif(n_words, 0)"),
    "word_length": ("both", "1000 * word_chars div nullif(n_words, 0)"),
}
SIGNIFICANT_BITS = 5
#: Least spread per metric: a uniform group tolerates that much, times ``REACH``, around its median.
LEAST_SPREAD = {"symbols": 25, "dup_lines": 125, "repeats": 125, "word_length": 500}
REACH = 4.0
#: Rows of about 100 bytes.
BROADCAST_GROUPS = 50_000
SALTS = 32
LEAST_GROUP = 100


def text_statistics(text: str | None) -> tuple[int, ...]:
    """STATISTICS of one whole text; all zero for null and for texts without a word."""
    if not text:
        return (0,) * len(STATISTICS)
    words = text.encode().split()
    n = len(words)
    n_lines = n_dup = 0
    seen = set()
    for line in text.split("\n"):
        if line.strip(WHITE):
            n_lines += 1
            if line in seen:
                n_dup += 1
            else:
                seen.add(line)
    return (
        n, len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), n_dup, _repeated(words, n), n_lines,
    )


def _repeated(words: list[bytes], n: int) -> int:
    """Words that lie in a window of three words found at least twice."""
    if n < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total = end = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def with_statistics(docs: DataFrame, text: str, names: dict[str, str], keep_text: bool) -> DataFrame:
    """Adds the statistics as columns called ``names[...]``; the text itself stays only on demand."""
    kept = [c for c in docs.columns if keep_text or c != text]
    at = docs.columns.index(text)
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(names[s], T.LongType()) for s in STATISTICS])
    places = [docs.columns.index(c) for c in kept]

    def measure(batches):
        for batch in batches:
            rows = [text_statistics(t) for t in batch.column(at).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in places] + columns, [*kept, *(names[s] for s in STATISTICS)])

    return docs.mapInArrow(measure, schema)


def bin_of(value: Column) -> Column:
    """Lower end of a value's bin: exact below 2**SIGNIFICANT_BITS, then that many leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - SIGNIFICANT_BITS, F.lit(0))
    step = F.pow(F.lit(2.0), shift)
    return (F.floor(value / step) * step).cast("long")


def sketches(stats: DataFrame, groups: list[str]) -> DataFrame:
    """Quantile sketch per group and metric: (groups..., metric, bin, n).

    A sketch is a histogram over logarithmic bins of integers (relative error 2**-5 at most).
    Two sketches merge by adding counts, so the result does not depend on how rows are
    partitioned, and a group with a third of all rows sends a few bins per task.
    """
    entries = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), bin_of(F.expr(e).cast("long")).cast("long").alias("bin"))
        for m, (_, e) in METRICS.items()
    ]))
    return stats.filter("n_words > 0").select(*groups, entries.alias("e")).select(*groups, "e.metric", "e.bin") \
        .groupBy(*groups, "metric", "bin").agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches of coarser groups, merged from finer ones."""
    return sketch.groupBy(*groups, "metric", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, groups: list[str], points: dict[str, float]) -> DataFrame:
    """Per group and metric the bin at each point, and the group's size ``total``."""
    by = Window.partitionBy(*groups, "metric")
    ranked = sketch.withColumns({
        "upto": F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "total": F.sum("n").over(by),
    })
    return ranked.groupBy(*groups, "metric").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("bin"))).alias(name) for name, q in points.items()],
    )


def thresholds(stats: DataFrame, lang: str, source: str, reach: float = REACH, least_group: int = LEAST_GROUP) -> DataFrame:
    """Bounds per (lang, source): median plus and minus ``reach`` times the spread.

    The spread is the distance from the median to the quartile on its clean side (for a metric
    that is bad when high, the lower one), and at least ``LEAST_SPREAD``: junk of up to half a
    group does not widen the bounds.  A group below ``least_group`` documents takes the merged
    sketch of its language, and a language below it that of all documents.
    """
    fine = sketches(stats.select(F.col(lang).alias("lang"), F.col(source).alias("source"), *STATISTICS), ["lang", "source"])
    fine = stored(fine, "sketches")
    by_lang, all_docs = merge(fine, ["lang"]), merge(fine, [])
    points = {"q1": 0.25, "q2": 0.5, "q3": 0.75}

    def level(sketch, groups, tag):
        q = quantiles(sketch, groups, points)
        return q.select(*groups, "metric", *[F.col(c).alias(f"{tag}_{c}") for c in ("total", *points)])

    levels = level(fine, ["lang", "source"], "s") \
        .join(level(by_lang, ["lang"], "l").withColumnRenamed("lang", "_lang").withColumnRenamed("metric", "_metric"),
              F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("metric") == F.col("_metric"))) \
        .drop("_lang", "_metric").join(level(all_docs, [], "a"), "metric")

    def chosen(q):
        return F.when(F.col("s_total") >= least_group, F.col(f"s_{q}")) \
            .when(F.col("l_total") >= least_group, F.col(f"l_{q}")).otherwise(F.col(f"a_{q}"))

    def per_metric(values):
        return F.element_at(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))]), F.col("metric"))

    two_sided = per_metric({m: side == "both" for m, (side, _) in METRICS.items()})
    spread = F.greatest(
        per_metric(LEAST_SPREAD).cast("double"),
        F.when(two_sided, F.greatest(chosen("q3") - chosen("q2"), chosen("q2") - chosen("q1")))
        .otherwise(chosen("q2") - chosen("q1")).cast("double"),
    )
    bounds = levels.select(
        "lang", "source", "metric", (chosen("q2") + reach * spread).alias("high"),
        F.when(two_sided, chosen("q2") - reach * spread).otherwise(F.lit(-1.0)).alias("low"))
    return bounds.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{m}_{side}") for m in METRICS for side in ("low", "high")])


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def assess(stats: DataFrame, bounds: DataFrame, lang: str, source: str, failed: str, kept: str) -> DataFrame:
    """Joins the bounds of a row's group and adds the two verdicts.

    ``bounds`` has a row per (lang, source).  Up to ``BROADCAST_GROUPS`` rows it is broadcast, so texts
    are not moved; beyond that every group is dealt to ``SALTS`` places.  Null
    languages and sources are groups like others.
    """
    bounds = stored(bounds, "bounds")
    small = bounds.count() <= BROADCAST_GROUPS
    b = bounds.select(F.col("lang").alias("b_lang"), F.col("source").alias("b_source"),
                      F.struct(*[c for c in bounds.columns if c not in ("lang", "source")]).alias("b_bounds"))
    inside = F.lit(True)
    for m, (_, e) in METRICS.items():
        value = F.expr(e)
        inside = inside & (value >= F.col(f"b_bounds.{m}_low")) & (value <= F.col(f"b_bounds.{m}_high"))
    same = stats[lang].eqNullSafe(F.col("b_lang")) & stats[source].eqNullSafe(F.col("b_source"))
    if small:
        joined = stats.join(F.broadcast(b), same, "left")
    else:
        atomic = [F.col(f.name) for f in stats.schema if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]
        salted = stats.withColumn("b_salt", F.pmod(F.xxhash64(*atomic), F.lit(SALTS)).cast("int"))
        places = b.withColumn("b_place", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(places, same & (F.col("b_salt") == F.col("b_place")), "left").drop("b_salt", "b_place")
    return joined.withColumns({
        failed: base_failed(),
        kept: ~base_failed() & F.coalesce(inside, F.lit(False)),
    }).drop("b_lang", "b_source", "b_bounds")


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per document the statistics of the whole text, ``base_failed`` and ``kept``.

    A document is kept when it passes the base rule and all its metrics lie within the bounds
    of its (lang, source) group.  Null and empty texts have no words and fail the base rule.
    Repeated rows are judged each on its own; other columns are dropped; an empty table gives
    no rows.  The statistics are stored once, without the texts, and serve sketch and verdict.
    """
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"),
                         F.col(lang).alias("lang"), F.col(source).alias("source"))
    stats = stored(with_statistics(narrow, "text", {s: s for s in STATISTICS}, keep_text=False), "statistics")
    return assess(stats, thresholds(stats, "lang", "source"), "lang", "source", "base_failed", "kept") \
        .select("doc_id", "lang", "source", *STATISTICS, "base_failed", "kept")


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents ``quality_report`` keeps, with all their columns, whatever these are called."""
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    at = {c: f"c{columns.index(c)}" for c in (text, lang, source)}
    slim = plain.select(*[F.col(c) for c in dict.fromkeys(at.values())])
    stats = stored(with_statistics(slim, at[text], {s: s for s in STATISTICS}, keep_text=False), "statistics")
    bounds = thresholds(stats, at[lang], at[source])
    full = with_statistics(plain, at[text], {s: s for s in STATISTICS}, keep_text=True)
    kept = assess(full, bounds, at[lang], at[source], "base_failed", "kept").filter("kept")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
