"""Pairwise text metrics as arithmetic on counts computed once per pair."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.constants import TASK_METRICS
from pairloom.functions.pair_stats import FIELDS, OVERLAPS, Thesaurus, pair_stats
from pairloom.functions.text import is_blank, strip
from pairloom.functions.tokens import Tokenizer, whitespace_tokens

#: Rows and characters of a thesaurus up to which every worker gets it whole.
THESAURUS_ROWS, THESAURUS_CHARS = 1_000_000, 32 << 20


def _zero() -> Column:
    return F.lit(0.0)


def exact_match(prediction: Column, reference: Column) -> Column:
    return (F.lower(strip(prediction)) == F.lower(strip(reference))).cast("double")


def token_f1(overlap: Column, n_pred: Column, n_ref: Column) -> Column:
    """2c / (|p| + |r|), which is the harmonic mean of precision and recall."""
    return F.when(overlap == 0, _zero()).otherwise(2.0 * overlap / (n_pred + n_ref))


def bleu(overlaps: list[Column], n_pred: Column, n_ref: Column) -> Column:
    """Sentence BLEU, one reference, four orders, with the length-scaled smoothing of
    Chen & Cherry (2014): the i-th order without a match counts ln|p| / (5 * 2**i) matches.

    0 without a unigram match and for one-token predictions, where it is undefined.
    """
    log_sum = F.lit(0.0)
    for n, matched in enumerate(overlaps, 1):
        zeros = sum(((m == 0).cast("int") for m in overlaps[:n]), F.lit(0))
        smoothed = F.log(F.greatest(n_pred, F.lit(2)).cast("double")) / (5.0 * F.pow(F.lit(2.0), zeros))
        possible = F.greatest(F.lit(1), n_pred - (n - 1))
        count = F.when(matched > 0, matched.cast("double")).otherwise(smoothed)
        log_sum = log_sum + F.log(count / possible)
    brevity = F.when(n_pred > n_ref, F.lit(1.0)).otherwise(F.exp(1.0 - n_ref / F.greatest(n_pred, F.lit(1))))
    return F.when((overlaps[0] == 0) | (n_pred <= 1), _zero()).otherwise(brevity * F.exp(log_sum / len(overlaps)))


def rouge_recall(found: Column, possible: Column, blank: Column) -> Column:
    return F.when(blank | (possible <= 0), _zero()).otherwise(found / F.greatest(possible, F.lit(1)))


def meteor(matches: Column, chunks: Column, n_pred: Column, n_ref: Column) -> Column:
    """Recall-weighted mean (alpha 0.9) less the fragmentation penalty 0.5 * (chunks / matches)**3."""
    precision, recall = matches / n_pred, matches / n_ref
    fmean = precision * recall / (0.9 * precision + 0.1 * recall)
    penalty = 0.5 * F.pow(chunks / matches, F.lit(3.0))
    return F.when(matches == 0, _zero()).otherwise((1.0 - penalty) * fmean)


@dataclass(frozen=True)
class Metric:
    """Named scores over a featured pair frame; `features` says which counts they read."""

    name: str
    scores: Callable[[], dict[str, Column]]
    features: frozenset[str] = frozenset()


SCORE = "score"


def _overlaps(n: int) -> list[Column]:
    return [F.col(f"stats.{m}") for m in OVERLAPS[:n]]


def _rouge() -> dict[str, Column]:
    blank = is_blank("prediction") | is_blank("reference")
    m1, m2 = _overlaps(2)
    n_ref = F.col("n_ref")
    return {
        "rouge-1": rouge_recall(m1, n_ref, blank),
        "rouge-2": rouge_recall(m2, n_ref - 1, blank),
        "rouge-l": rouge_recall(F.col("stats.lcs"), n_ref, blank),
    }


_REGISTRY: dict[str, Metric] = {
    m.name: m
    for m in (
        Metric("exact_match", lambda: {SCORE: exact_match(F.col("prediction"), F.col("reference"))}),
        Metric(
            "f1_score",
            lambda: {SCORE: token_f1(*_overlaps(1), F.col("n_pred"), F.col("n_ref"))},
            frozenset({"m1"}),
        ),
        Metric(
            "bleu",
            lambda: {SCORE: bleu(_overlaps(4), F.col("n_pred"), F.col("n_ref"))},
            frozenset(OVERLAPS),
        ),
        Metric("rouge", _rouge, frozenset({"m1", "m2", "lcs"})),
        Metric(
            "meteor",
            lambda: {
                SCORE: meteor(F.col("stats.matches"), F.col("stats.chunks"), F.col("n_pred"), F.col("n_ref"))
            },
            frozenset({"aligned"}),
        ),
        Metric(
            "bert_score",
            lambda: {part: F.col(part) for part in ("precision", "recall", "f1")},
            frozenset({"vectors"}),
        ),
    )
}


BUILT_IN = frozenset(_REGISTRY)


def register_metric(name: str, fn: Callable[[Column, Column], Column | dict[str, Column]]) -> None:
    """Add a metric: a function of the normalised texts to one column, or to named sub-scores.

    The built-in names are taken; a name of one's own may be registered anew.
    """
    if name in BUILT_IN:
        raise ValueError(f"{name!r} is a built-in metric")

    def scores() -> dict[str, Column]:
        made = fn(F.col("prediction"), F.col("reference"))
        return made if isinstance(made, dict) else {SCORE: made}

    _REGISTRY[name] = Metric(name, scores)


def metric(name: str) -> Metric:
    if name not in _REGISTRY:
        raise ValueError(f"unknown metric {name!r}; known: {sorted(_REGISTRY)}")
    return _REGISTRY[name]


def metrics_for(task: str) -> tuple[str, ...]:
    """Metric names preset for a task."""
    if task not in TASK_METRICS:
        raise ValueError(f"unknown task {task!r}; known: {sorted(TASK_METRICS)}")
    return TASK_METRICS[task]


def with_token_counts(pairs: DataFrame, tokenizer: Tokenizer = whitespace_tokens) -> DataFrame:
    """Tokenise both sides once: `p_tokens`, `r_tokens`, `n_pred`, `n_ref`."""
    return (
        pairs.withColumns({"p_tokens": tokenizer(F.col("prediction")), "r_tokens": tokenizer(F.col("reference"))})
        .withColumns({"n_pred": F.size("p_tokens"), "n_ref": F.size("r_tokens")})
    )


def with_synonyms(pairs: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Add `p_synonyms`, one list per prediction token, from a `(word, syn)` table. Needs a unique `id`."""
    folded = synonyms.select(F.lower("word").alias("word"), F.lower("syn").alias("syn"))
    thesaurus = folded.groupBy("word").agg(F.collect_set("syn").alias("syns"))
    words = pairs.select("id", F.explode(F.array_distinct(F.transform("p_tokens", F.lower))).alias("word"))
    known = words.join(thesaurus, "word")
    per_pair = known.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("word", "syns"))).alias("__known"))
    nothing = F.array().cast("array<string>")
    return (
        pairs.join(per_pair, "id", "left")
        .withColumn(
            "p_synonyms",
            F.transform(
                "p_tokens", lambda t: F.coalesce(F.try_element_at(F.col("__known"), F.lower(t)), nothing)
            ),
        )
        .drop("__known")
    )


def small_thesaurus(synonyms: DataFrame) -> Thesaurus | None:
    """A `(word, syn)` table as a sparse matrix, or None where it is above the measured bound."""
    table = synonyms.select(F.lower("word").alias("word"), F.lower("syn").alias("syn")).distinct()
    chars = F.sum(F.coalesce(F.octet_length("word"), F.lit(0)) + F.coalesce(F.octet_length("syn"), F.lit(0)))
    rows, size = table.agg(F.count("*"), chars).head()
    return None if rows > THESAURUS_ROWS or (size or 0) > THESAURUS_CHARS else Thesaurus.of(table.toArrow())


def with_features(
    pairs: DataFrame,
    features: set[str] | frozenset[str],
    tokenizer: Tokenizer = whitespace_tokens,
    stem: Callable[[str], str] | None = None,
    synonyms: DataFrame | None = None,
) -> DataFrame:
    """Add `stats`, holding only the counts the metrics need, from one Python pass.

    A thesaurus of measured size is looked up by the distinct words of a batch;
    a larger one is joined to the words of the pairs.
    """
    counted = features & set(FIELDS)
    if not counted:
        return pairs
    out = with_token_counts(pairs, tokenizer)
    arguments, shared, joined = ["p_tokens", "r_tokens"], None, False
    if "aligned" in counted and synonyms is not None:
        matrix = small_thesaurus(synonyms)
        if matrix is not None:
            shared = pairs.sparkSession.sparkContext.broadcast(matrix)
        else:
            out, joined = with_synonyms(out, synonyms), True
            arguments.append("p_synonyms")
    return out.withColumn("stats", pair_stats(counted, stem, joined, shared)(*map(F.col, arguments)))
