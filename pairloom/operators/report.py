"""Per-example scores and their averages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.tokens import Tokenizer, whitespace_tokens
from pairloom.operators.metrics import metric, with_features
from pairloom.operators.pairing import normalize_pairs
from pairloom.operators.soft_align import Encoder, soft_alignment, soft_scores


def _scored(
    pairs: DataFrame,
    metrics: Sequence[str],
    vectors: DataFrame | None,
    tokenizer: Tokenizer,
    stem: Callable[[str], str] | None,
    synonyms: DataFrame | None,
    on_null: str,
    encoder: Callable[[], Encoder] | None = None,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """A frame with `id`, `keep` and one column per score, and what each column holds."""
    chosen = [metric(name) for name in dict.fromkeys(metrics)]
    if not chosen:
        raise ValueError("name at least one metric")
    features = frozenset().union(*(m.features for m in chosen))
    featured = with_features(
        normalize_pairs(pairs, on_null).select("id", "prediction", "reference"), features, tokenizer, stem, synonyms
    )
    layout, texts, soft = [], [], []
    for m in chosen:
        for part, score in m.scores().items():
            layout.append((m.name, part, f"s{len(layout)}"))
            (soft if "vectors" in m.features else texts).append(score.cast("double").alias(layout[-1][2]))
    if soft and (vectors is None) == (encoder is None):
        raise ValueError("bert_score needs an encoder, or else a vectors frame (id, side, pos, vec)")
    if soft and encoder is not None:
        scored = soft_scores(encoder)(F.col("prediction"), F.col("reference"))
        staged = featured.select("id", *keep, *texts, scored.alias("__soft"))
        names = [c for c in staged.columns if c != "__soft"]
        return staged.select(*names, "__soft.*").select(*names, *soft), layout
    wide = featured.select("id", *keep, *texts)
    if soft:
        # Only ids and finished scores meet the aligned vectors.
        wide = wide.join(soft_alignment(vectors), "id", "left").select(*wide.columns, *soft)
    return wide, layout


def _lines(
    layout: list[tuple[str, str, str]],
    extra: Sequence[Column] = (),
    counted: Callable[[str], Column] | None = None,
) -> Column:
    own = lambda c: [counted(c).alias("n")] if counted else list(extra)
    return F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.lit(part).alias("sub_metric"), F.col(c).alias("score"), *own(c))
            for name, part, c in layout
        ]
    )


def score_examples(
    pairs: DataFrame,
    metrics: Sequence[str],
    vectors: DataFrame | None = None,
    tokenizer: Tokenizer = whitespace_tokens,
    stem: Callable[[str], str] | None = None,
    synonyms: DataFrame | None = None,
    on_null: str = "error",
    encoder: Callable[[], Encoder] | None = None,
) -> DataFrame:
    """`(id, metric, sub_metric, score)`, one row per example and score."""
    wide, layout = _scored(pairs, metrics, vectors, tokenizer, stem, synonyms, on_null, encoder)
    return wide.select("id", F.explode(_lines(layout)).alias("line")).select("id", "line.*")


def score_texts(
    pairs: DataFrame,
    metrics: Sequence[str],
    vectors: DataFrame | None = None,
    tokenizer: Tokenizer = whitespace_tokens,
    stem: Callable[[str], str] | None = None,
    synonyms: DataFrame | None = None,
    on_null: str = "error",
    encoder: Callable[[], Encoder] | None = None,
) -> DataFrame:
    """`(id, prediction, reference, scores)`: the normalised texts with all their scores, a row per example.

    `scores` is an array of `(metric, sub_metric, score)`; `listed_scores` makes a row of each.
    """
    texts = ("prediction", "reference")
    wide, layout = _scored(pairs, metrics, vectors, tokenizer, stem, synonyms, on_null, encoder, texts)
    return wide.select("id", *texts, _lines(layout).alias("scores"))


def listed_scores(scored: DataFrame) -> DataFrame:
    """`(id, metric, sub_metric, score)` from a table of `score_texts`."""
    return scored.select("id", F.explode("scores").alias("line")).select("id", "line.*")


def evaluate(
    pairs: DataFrame,
    metrics: Sequence[str],
    vectors: DataFrame | None = None,
    tokenizer: Tokenizer = whitespace_tokens,
    stem: Callable[[str], str] | None = None,
    synonyms: DataFrame | None = None,
    on_null: str = "error",
    n_predictions: int | None = None,
    encoder: Callable[[], Encoder] | None = None,
) -> DataFrame:
    """Mean scores: `(metric, sub_metric, score, n)`; no rows when there are no pairs.

    Averages are taken over the wide frame, so only one partial row per task is
    shuffled. `n_predictions` divides by the number of predictions instead of
    pairs, as a positional pairing of unequal sides does. Otherwise `n` counts the
    pairs that have the score: a pair without vectors has no soft-alignment score.
    With an `encoder` soft alignment is scored from the texts, in the same pass.
    """
    wide, layout = _scored(pairs, metrics, vectors, tokenizer, stem, synonyms, on_null, encoder)
    n = F.lit(n_predictions).cast("long") if n_predictions is not None else F.col("n")
    counts = [F.count(c).alias(f"n_{c}") for _, _, c in layout]
    sums = wide.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for _, _, c in layout], *counts).where(F.col("n") > 0)
    per_score = None if n_predictions is not None else lambda c: F.col(f"n_{c}")
    return sums.select(F.explode(_lines(layout, [n.alias("n")], per_score)).alias("line")).select(
        "line.metric", "line.sub_metric", F.try_divide("line.score", "line.n").alias("score"), "line.n"
    )


def average(scores: DataFrame, n_predictions: int | None = None) -> DataFrame:
    """The same report from a table of per-example scores."""
    sums = scores.groupBy("metric", "sub_metric").agg(F.sum("score").alias("total"), F.count("score").alias("rows"))
    n = F.lit(n_predictions).cast("long") if n_predictions is not None else F.col("rows")
    return sums.select("metric", "sub_metric", F.try_divide(F.col("total"), n).alias("score"), n.alias("n"))


def format_report(report: DataFrame) -> DataFrame:
    """Add the line the report prints: four decimals."""
    label = F.when(F.col("sub_metric") == "score", F.col("metric")).otherwise(
        F.concat_ws(" ", "metric", "sub_metric")
    )
    return report.withColumn("line", F.format_string("Average %s: %.4f", label, F.col("score")))
