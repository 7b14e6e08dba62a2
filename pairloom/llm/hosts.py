"""Host-level quality rules, in DataFrame functions alone.

Every document is measured whole. Each rule's failures are summed by host; a
host's failure rate is drawn towards the mean of all hosts by a beta prior whose
strength is estimated from how far hosts differ (method of moments). A host
whose shrunk rate of any rule is above `max_rate` is rejected with all of its
documents. Documents that fail a base rule themselves are rejected on any host.

A null text has no words and fails the base rules. A null host is a host of its
own. Repeated rows count as often as they stand there. An empty table gives an
empty result. Other columns are ignored. A host may own any share of the rows:
sums are combined before the shuffle and verdicts are joined back to the measures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows that stand in the text twice or more.

    Windows are compared by a 64-bit hash, sorted with their places; equal neighbours repeat.
    """

    def count(own: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(own) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(own, i), F.get(own, i + 1), F.get(own, i + 2)).alias("h"), i.alias("at")
            ),
        )

        def covered(ordered: Column) -> Column:
            twice = F.filter(
                ordered,
                lambda x, i: F.coalesce(x["h"] == F.get(ordered, i - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(ordered, i + 1)["h"], F.lit(False)),
            )
            places = F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2))
            return F.size(F.array_distinct(F.flatten(places)))

        return F.when(F.size(own) >= 4, _let(F.sort_array(windows), covered)).otherwise(0)

    return _let(words, count)


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """`doc_id, host`, the five counts, and the number of lines with a word."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spoken = docs.select("doc_id", F.col(host).alias("host"), text.alias("body")).withColumns(
        {
            "words": F.regexp_extract_all("body", F.lit(WORD), F.lit(0)),
            "lines": F.filter(F.split("body", "\n"), lambda x: F.rlike(x, F.lit(WORD))),
        }
    )
    count = lambda c: c.cast("long")
    return spoken.select(
        "doc_id",
        "host",
        count(F.size("words")).alias("n_words"),
        count(F.length(F.translate("body", _SPACES, ""))).alias("word_chars"),
        count(F.length("body") - F.length(F.translate("body", _SYMBOLS, ""))).alias("n_symbols"),
        count(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        count(_repeated_words(F.col("words"))).alias("n_repeat_words"),
        count(F.size("lines")).alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def host_rules() -> dict[str, Column]:
    """Rule name to the condition under which a measured document fails it."""
    words = F.col("n_words")
    return {
        "few_words": words < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "repeated_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * words) | (F.col("word_chars") > 12 * words),
    }


def host_verdicts(measured: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """`host, host_docs`, the shrunk rate of each rule, and `host_kept`."""
    rules = host_rules()
    sums = checkpointed(
        measured.groupBy("host").agg(
            F.count("*").alias("host_docs"), *(F.sum(fails.cast("long")).alias(name) for name, fails in rules.items())
        )
    )
    docs = F.col("host_docs")
    # One row: for each rule the pooled rate, and the sum of squares about it that beta-binomial hosts would show.
    pooled = sums.agg(F.sum("host_docs").alias("n"), F.count("*").alias("hosts"), *(F.sum(r).alias(r) for r in rules)).head()
    rates = {r: (pooled[r] or 0) / (pooled["n"] or 1) for r in rules}
    spread = sums.agg(
        F.sum(docs * docs).alias("squares"),
        *(F.sum(docs * F.pow(F.col(r) / docs - rates[r], F.lit(2.0))).alias(r) for r in rules),
    ).head()
    shrunk = {}
    for r, m in rates.items():
        noise = m * (1 - m)
        effective = (pooled["n"] or 0) - (spread["squares"] or 0) / (pooled["n"] or 1)
        extra = ((spread[r] or 0.0) - (pooled["hosts"] - 1) * noise) / effective if effective > 0 else 0.0
        strength = min(max(noise / extra - 1, 1.0), 1e6) if extra > 0 else 1e6
        shrunk[r] = (F.col(r) + m * strength) / (docs + strength)
    rated = sums.select("host", "host_docs", *(rate.alias(f"{r}_rate") for r, rate in shrunk.items()))
    worst = F.greatest(*(F.col(f"{r}_rate") for r in rules))
    return rated.withColumn("host_kept", worst <= max_rate)


def host_quality(docs: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """Measures of every document with `base_failed`, `host_kept` and `kept`."""
    measured = checkpointed(measure(docs, host))
    verdicts = host_verdicts(measured, max_rate).select(F.col("host").alias("__host"), "host_kept")
    joined = measured.join(verdicts, F.col("host").eqNullSafe(F.col("__host")), "left").drop("__host")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
