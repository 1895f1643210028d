"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio of trusted against raw text.

The raw multinomial counts the hashed words and word pairs of every document, the target multinomial those of the
trusted documents. A document's score is its mean log ratio over its n-grams; the threshold is a constant.
DataFrame functions only: each document is judged inside its own row, so no word is ever shuffled.

Defined results: null, empty or blank text has no words and fails the base rules; without trusted documents all
ratios are 0 and only the base rules decide; repeated rows are judged alike, each in its own row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import BLANKS, let, words

BUCKETS = 1 << 14
#: Trusted documents that the target is fitted on, at most (of all labelled ones, by the smallest hash of their id).
TRUSTED_ROWS = 50_000
SMOOTHING = 5.0
THRESHOLD = -0.1
WINDOW = 8
SYMBOLS = "#*$%&|<>"


def word_codes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def ngram_buckets(codes: Column, n: Column, buckets: int) -> Column:
    """Buckets of the words and of the pairs of adjacent words."""
    single = F.transform(codes, lambda c: F.pmod(c, F.lit(buckets)).cast("int"))
    pairs = F.transform(
        F.slice(codes, 1, F.greatest(n - 1, F.lit(0))),
        lambda c, i: F.pmod(F.xxhash64(c, F.get(codes, i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.concat(single, pairs)


def fit_ratios(documents: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS, rows: int = TRUSTED_ROWS, smoothing: float = SMOOTHING) -> list[float]:
    """log(target / raw) for each bucket; `buckets` numbers whatever the input.

    trusted: ids of trusted documents; the `rows` ids of the smallest hash are used (16 bytes each, so they are broadcast).
    """
    picked = trusted.select(F.col(key).alias("key_")).filter("key_ is not null").distinct().orderBy(F.xxhash64("key_"), "key_").limit(rows)
    marked = documents.select(F.col(key).alias("key_"), text).join(F.broadcast(picked.withColumn("trusted_", F.lit(1))), "key_", "left")
    coded = marked.select(F.coalesce("trusted_", F.lit(0)).alias("trusted"), word_codes(F.col(text)).alias("codes"))
    grams = coded.select("trusted", F.explode(ngram_buckets(F.col("codes"), F.size("codes"), buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target")).collect()
    raw, target = [smoothing] * buckets, [smoothing] * buckets
    for row in counts:
        raw[row.bucket] += row.raw
        target[row.bucket] += row.target
    if sum(target) <= smoothing * buckets * (1 + 1e-12):
        return [0.0] * buckets
    log_raw, log_target = math.log(sum(raw)), math.log(sum(target))
    return [round((math.log(t) - log_target) - (math.log(r) - log_raw), 9) for t, r in zip(target, raw, strict=True)]


def repeated_words(codes: Column, n: Column) -> Column:
    """Words inside an 8-word window that the text holds twice or more."""

    def covered(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(
            placed,
            lambda s: F.filter(
                s,
                lambda x, k: (F.get(s, k - 1).getField("h") == x.getField("h")) | (F.get(s, k + 1).getField("h") == x.getField("h")),
            ),
        )
        starts = F.array_sort(F.transform(again, lambda x: x.getField("i")))
        return let(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("bigint"),
                lambda total, size: total + size,
            ),
        )

    windows = F.transform(F.slice(codes, 1, F.greatest(n - (WINDOW - 1), F.lit(0))), lambda _, i: F.xxhash64(F.slice(codes, i + 1, F.lit(WINDOW))))
    none = F.lit(0).cast("bigint")
    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(covered(w)))


def base_statistics(text: Column) -> dict[str, Column]:
    """Statistics that need no words: characters in words, symbols, lines that repeat an earlier line."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    return {
        "word_chars": F.length(F.translate(whole, BLANKS, "")).cast("bigint"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
    }


def judge(documents: DataFrame, ratios: list[float], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`documents` without the text, with the base statistics, base_failed, llr and kept."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    coded = documents.withColumns({**base_statistics(F.col(text)), "codes_": word_codes(F.col(text))}).drop(text)
    counted = coded.withColumn("n_words", F.size("codes_").cast("bigint"))
    size = F.size("codes_")
    total = F.aggregate(
        ngram_buckets(F.col("codes_"), size, len(ratios)),
        F.lit(0.0),
        lambda acc, b: acc + F.get(table, b),
    )
    scored = counted.withColumns(
        {
            "n_repeat_words": repeated_words(F.col("codes_"), size),
            "llr": F.round(F.coalesce(total / F.nullif(2 * size - 1, F.lit(-1)), F.lit(0.0)), 9),
        }
    ).drop("codes_")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
