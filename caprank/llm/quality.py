"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the
raw corpus, with SQL functions only.

Tokens are maximal runs of letters and digits, and maximal runs of other
characters than white space.  Unigrams and bigrams are hashed into ``buckets``
counters.  Two multinomials are estimated over them with add-one smoothing, one
from the trusted documents and one from all, and a document's score is the mean
of log(p_trusted / p_raw) over its n-grams.  It is kept if the base rules pass
and the score is at least ``threshold`` - a fixed number, so the same text always
gets the same verdict from the same counts.

Trusted documents are those that ``labels`` calls quality 1 and toxic 0; where
no document is so labelled, those that pass the base rules.  Counting is one
combining aggregate with at most ``buckets`` groups, whatever the input; the table
of ratios is a scalar subquery of that many doubles.

Base rules: see ``base_columns``.  Defined results: null and empty texts have no
words and fail the base rules; a text without n-grams scores 0; documents are
rows, so repeated ones are judged alike; a score equal to the threshold is kept; very
long texts are judged whole (their n-grams are an array of the row); null ids are kept
as they are and are never trusted; an empty table has no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.llm.common import documents, small_side, written

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
BUCKETS = 10_000
THRESHOLD = -0.25
WINDOW = 8


def words_of(text: Column) -> Column:
    """Words, in order; an empty array for a text without any."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def with_windows(docs: DataFrame) -> DataFrame:
    """``windows``: hash of the window of eight words at each start, empty for
    fewer than nine words.  Three doublings, each a column of its own, so that
    none is computed twice."""
    h = F.transform("words", lambda w: F.xxhash64(w))
    d = docs.withColumn("_w0", F.when(F.size("words") > WINDOW, h).otherwise(F.array().cast("array<bigint>")))
    for k, step in enumerate((1, 2, 4)):
        c = F.col(f"_w{k}")
        d = d.withColumn(f"_w{k + 1}", F.zip_with(F.slice(c, 1, F.greatest(F.size(c) - step, F.lit(0))), F.slice(c, step + 1, F.size(c) + 1),
                                                  lambda a, b: F.xxhash64(a, b))).drop(f"_w{k}")
    return d.withColumnRenamed("_w3", "windows")


def covered(windows: Column) -> Column:
    """Words covered by windows (hashes, one for each start) found again: sort
    by hash, take the starts of equal neighbours, add up the union."""
    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    n = F.size(windows)
    twice = F.zip_with(F.slice(by_hash, 1, n - 1), F.slice(by_hash, 2, n),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull()))))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(starts, zero, lambda acc, s: F.struct(
        (acc["n"] + (s + WINDOW - F.greatest(s, acc["end"]))).cast("bigint").alias("n"),
        (s + WINDOW).cast("int").alias("end")), lambda acc: acc["n"])


def base_columns(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed for each row; a null text as the empty one."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    d = with_windows(d.select("*", words_of(text).alias("words")))
    d = d.select("doc_id", "text", F.size("words").cast("long").alias("n_words"), "windows",
                 F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                 (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"), lines.alias("lines"))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.select("doc_id", "text", "n_words", "word_chars", "n_symbols",
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.when(again, covered(F.col("windows"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def grams(text: Column, buckets: int) -> Column:
    """Buckets of the unigrams and bigrams of a text."""
    h = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))
    return h, lambda col: F.concat(
        F.transform(col, lambda x: F.pmod(x, F.lit(buckets)).cast("int")),
        F.zip_with(F.slice(col, 1, F.greatest(F.size(col) - 1, F.lit(0))), F.slice(col, 2, F.greatest(F.size(col), F.lit(1))),
                   lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int")))


def with_grams(docs: DataFrame, buckets: int) -> DataFrame:
    h, both = grams(F.col("text"), buckets)
    return docs.withColumn("_h", h).withColumn("grams", both(F.col("_h"))).drop("_h")


def log_ratios(docs: DataFrame, buckets: int) -> DataFrame:
    """One row, one array: log(p_trusted / p_raw) of each bucket, from (text,
    trusted)."""
    spark = docs.sparkSession
    tokens = docs.select(F.col("trusted").cast("long").alias("t"), F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)).alias("a"))
    # a row for each token and the one behind it: plain generated code, no boxed arrays
    behind = F.slice("a", 2, F.greatest(F.size("a"), F.lit(1)))
    rows = tokens.select("t", F.explode(F.arrays_zip(F.col("a").alias("a"), behind.alias("b"))).alias("x")).select(
        "t", F.xxhash64("x.a").alias("u"), F.when(F.col("x.b").isNotNull(), F.xxhash64("x.b")).alias("v"))
    size = F.lit(buckets)
    both = F.array(F.pmod("u", size).cast("int"), F.when(F.col("v").isNotNull(), F.pmod(F.xxhash64("u", "v"), size)).cast("int"))
    counts = (rows.select("t", F.explode(both).alias("g")).where("g is not null")
              .groupBy("g").agg(F.count("*").alias("raw"), F.sum("t").alias("good")))
    counts = written(counts, "gram-counts")
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("all_raw"), F.coalesce(F.sum("good"), F.lit(0)).alias("all_good"))
    full = (spark.range(buckets).join(counts, F.col("id") == F.col("g"), "left").join(F.broadcast(total))
            .select("id", F.when(F.col("all_good") == 0, 0.0).otherwise(
                F.log((F.coalesce("good", F.lit(0)) + 1.0) / (F.col("all_good") + float(buckets)))
                - F.log((F.coalesce("raw", F.lit(0)) + 1.0) / (F.col("all_raw") + float(buckets)))).alias("r")))
    return written(full.agg(F.sort_array(F.collect_list(F.struct("id", "r"))).alias("rows"))
                   .select(F.col("rows.r").alias("ratios")), "ratios")


def judged(docs: DataFrame, trusted: DataFrame | None, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Base columns, score and kept of each row.  ``trusted``: doc_ids of the
    target corpus; None: the documents that pass the base rules."""
    if trusted is None:
        train = base_columns(docs).select("text", (~F.col("base_failed")).alias("trusted"))
    else:
        t = trusted.select(F.col("doc_id").cast("long").alias("_good")).distinct()
        train = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
                 .join(small_side(written(t, "trusted")), F.col("doc_id") == F.col("_good"), "left")
                 .select("text", F.col("_good").isNotNull().alias("trusted")))
    ratios = log_ratios(train, buckets)
    d = with_grams(base_columns(docs), buckets).withColumn("ratios", ratios.scalar())
    total = F.aggregate("grams", F.lit(0.0), lambda acc, g: acc + F.get(F.col("ratios"), g))
    d = d.withColumn("score", F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(0.0))
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).drop("grams", "ratios", "text")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 and coalesce(toxic, 0) = 0")
    return judged(docs, labels if labels.limit(1).count() else None).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
