"""Quality rules: base counts of a text and a hashed n-gram likelihood ratio.

Words and pairs of adjacent words are hashed into a fixed number of bins. One
multinomial over the bins is estimated from documents labelled as trusted, one
from the whole corpus, both smoothed. A document's score is the logarithm of the ratio of both
likelihoods, divided by its number of n-grams; it is kept when the score
reaches a threshold and no base rule fails. Everything is a DataFrame
expression; the only shuffle is that of the bin counts.

Null and empty texts have no words, fail the base rules and score 0. Repeated
rows are judged alike. Documents without an id are judged but cannot be
trusted. Without a trusted document all bins weigh 0, so that the base rules
alone decide. Other columns are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_RUN, doc_texts, words

BINS = 1 << 16
# Log ratio per n-gram that a document must reach.
THRESHOLD = -0.15
# Pseudo-count of a bin, added to the trusted count and to the count that the
# corpus would lead to expect, so that rare n-grams weigh little.
SMOOTHING = 4.0
# Trusted ids that are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def ngram_bins(w: Column, bins: int = BINS) -> Column:
    """Bins of all words and of all pairs of adjacent words."""
    bin_of = lambda *x: F.pmod(F.xxhash64(*x), F.lit(bins)).cast("int")
    singles = F.transform(w, lambda x: bin_of(x))
    pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: bin_of(a, b))
    return F.concat(singles, pairs)


def log_ratios(docs: DataFrame, trusted: DataFrame, bins: int = BINS, smoothing: float = SMOOTHING) -> list[float]:
    """One weight per bin, from the counts of all documents and of the trusted ones.

    ``trusted`` has a column ``doc_id``. The result has ``bins`` numbers whatever
    the size of the corpus.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = doc_texts(docs).join(ids.withColumn("is_trusted", F.lit(1)), "doc_id", "left")
    counts = (
        texts.select(words(F.col("text")).alias("w"), F.coalesce("is_trusted", F.lit(0)).alias("is_trusted"))
        .select(F.explode(ngram_bins(F.col("w"), bins)).alias("bin"), "is_trusted")
        .groupBy("bin", "is_trusted").count()
        .groupBy("bin")
        .agg(F.sum("count").alias("corpus"), F.sum(F.col("count") * F.col("is_trusted")).alias("target"))
    )
    # One row of ``bins`` entries, whatever the size of the corpus.
    model = counts.sparkSession.range(bins).join(counts, F.col("id") == F.col("bin"), "left").agg(
        F.sort_array(F.collect_list(F.struct(
            "id", F.coalesce("target", F.lit(0)).alias("target"), F.coalesce("corpus", F.lit(0)).alias("corpus")))).alias("e"))
    summed = lambda name: F.aggregate("e", F.lit(0).cast("long"), lambda s, x: s + x[name])
    model = model.select("e", summed("target").alias("targets"), summed("corpus").alias("corpora"))
    expected = lambda x: x["corpus"] * F.col("targets") / F.col("corpora")
    weights = F.when(F.col("targets") > 0, F.transform(
        "e", lambda x: F.round(F.log((x["target"] + smoothing) / (expected(x) + smoothing)), 4)))
    return model.select(weights.alias("weights")).first()["weights"] or [0.0] * bins


def base_counts(docs: DataFrame) -> DataFrame:
    """The word, symbol and repetition counts of every document.

    Adds ``w`` (the words) for the score. Windows are compared by 64-bit hashes
    within one text.
    """
    has_word = lambda line: line.rlike("[^\\x20\\x09-\\x0D]")
    df = doc_texts(docs).select(
        "row", "doc_id", "text", words(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n", -1), has_word).alias("lines"),
    )
    n = F.size("w")
    df = df.select(
        "*",
        F.when(n >= REPEAT_WINDOW, F.transform(
            F.sequence(F.lit(1), n - REPEAT_WINDOW + 1),
            lambda i: F.xxhash64(F.slice("w", i, REPEAT_WINDOW)),
        )).alias("windows"),
    )
    df = df.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    # Windows in the order of their hashes, only where some window comes twice.
    df = df.withColumn("ordered", F.when(F.col("repeats"), F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.get("ordered", k)["h"] == x["h"]
    df = df.withColumn("starts", F.sort_array(F.transform(
        F.filter("ordered", lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False))),
        lambda x: x["i"])))
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("total"), F.lit(-REPEAT_WINDOW).alias("last")),
        lambda a, p: F.struct((a["total"] + F.least(F.lit(REPEAT_WINDOW), p - a["last"])).alias("total"), p.alias("last")),
        lambda a: a["total"],
    )
    chars = F.char_length("text")
    return df.select(
        "row", "doc_id", "w",
        n.cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("text", BLANK_RUN, "")).cast("long").alias("word_chars"),
        (chars - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("repeats"), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _judged(docs: DataFrame, trusted: DataFrame, threshold: float, bins: int) -> DataFrame:
    weights = log_ratios(docs, trusted, bins)
    # The table of weights is a constant of the plan, folded once.
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    df = base_counts(docs).withColumn("bins", ngram_bins(F.col("w"), bins))
    total = F.aggregate("bins", F.lit(0.0), lambda s, b: s + F.get(table, b))
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    score = F.when(F.size("bins") > 0, total / F.size("bins")).otherwise(0.0)
    df = df.select("row", "doc_id", *COUNTS, failed.alias("base_failed"), score.alias("score"))
    kept = (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept")
    # The always true condition is not deterministic, so that no filter on the
    # verdict moves below the steps above and multiplies their work.
    verdict = F.when(F.monotonically_increasing_id() >= 0, F.struct(*COUNTS, "base_failed", kept, "score"))
    return df.select("row", "doc_id", verdict.alias("verdict"))


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, bins: int = BINS) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``score`` of every document."""
    return _judged(docs, trusted, threshold, bins).select("doc_id", "verdict.*")


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, bins: int = BINS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return _judged(docs, trusted, threshold, bins).filter("verdict.kept").select("row.*")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The documents that the labels mark as good."""
    return labels.filter("quality = 1").select("doc_id")
