"""Matching predictions with references, and normalising both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.constants import NO_ANSWER, NO_ANSWER_VARIANT
from pairloom.functions.text import normalize_text
from pairloom.operators.ordered import file_places, file_positions, ordered_positions


def pair(
    predictions: DataFrame,
    references: DataFrame,
    on: str = "id",
    prediction: str = "prediction",
    reference: str = "reference",
    allow_repeats: bool = False,
) -> DataFrame:
    """`(id, prediction, reference)` for the keys both sides have; null keys have no partner.

    A key that repeats on a side is an error, found while the sides are grouped by
    the key that they are joined on; `allow_repeats` pairs every such row with every other.
    """

    def side(df: DataFrame, column: str, name: str) -> DataFrame:
        named = df.select(F.col(on).alias("id"), F.col(column).alias(name)).where(F.col("id").isNotNull())
        if allow_repeats:
            return named
        repeated = F.raise_error(F.concat(F.lit("repeated key "), F.first("id").cast("string")))
        held = F.when(F.count("*") > 1, repeated).otherwise(F.first(F.struct(name)))
        return named.groupBy("id").agg(held.alias("held")).select("id", f"held.{name}")

    return side(predictions, prediction, "prediction").join(side(references, reference, "reference"), "id", "inner")


def unmatched(predictions: DataFrame, references: DataFrame, on: str = "id") -> DataFrame:
    """Rows of each side without a partner: `(side, n_unmatched)`, one row per side.

    Both sides are counted by key in one aggregation, combined before the shuffle.
    Rows with a null key have no partner.
    """
    rows = lambda df, p, r: df.select(F.col(on).alias("id"), F.lit(p).alias("p"), F.lit(r).alias("r"))
    by_key = rows(predictions, 1, 0).unionByName(rows(references, 0, 1)).groupBy("id").agg(F.sum("p").alias("p"), F.sum("r").alias("r"))
    alone = lambda other: (F.col(other) == 0) | F.col("id").isNull()
    lone = lambda n, other: F.coalesce(F.sum(F.when(alone(other), F.col(n))), F.lit(0)).cast("long")
    return by_key.agg(lone("p", "r").alias("prediction"), lone("r", "p").alias("reference")).unpivot(
        [], ["prediction", "reference"], "side", "n_unmatched"
    )


def several_files(df: DataFrame) -> bool:
    return df.select(F.input_file_name().alias("file")).distinct().limit(2).count() > 1


def pair_by_position(
    predictions: DataFrame,
    references: DataFrame,
    prediction: str = "prediction",
    reference: str = "reference",
    order_by: str | list[str] | None = None,
) -> DataFrame:
    """The n-th prediction with the n-th reference, `id` being n from 0; stops at the shorter side.

    `order_by` names the columns both frames are ordered by; a null in them is an
    error. Without it rows count in the order of their input files, by path, and of
    the lines in them. A side that was read from several files but no longer knows
    which (after a shuffle, say) is an error.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    if not order:
        for side, df in (("predictions", predictions), ("references", references)):
            if file_places(df) is None and several_files(df):
                raise ValueError(f"{side} come from several files: pairing them by position needs order_by")

    def placed(df: DataFrame, column: str, name: str) -> DataFrame:
        if not order:
            return file_positions(df.select(F.col(column).alias(name))).select(F.col("pos").alias("id"), name)
        text = df.select(*order, F.col(column).alias(name))
        return text.join(ordered_positions(df, order), order).select(F.col("pos").alias("id"), name)

    return placed(predictions, prediction, "prediction").join(placed(references, reference, "reference"), "id")


def normalize_pairs(
    pairs: DataFrame,
    on_null: str = "error",
    phrase: str = NO_ANSWER_VARIANT,
    canonical: str = NO_ANSWER,
) -> DataFrame:
    """Normalise both texts. A null text is an error, or empty with `on_null="empty"`."""
    if on_null not in ("error", "empty"):
        raise ValueError(f"on_null must be 'error' or 'empty', not {on_null!r}")

    def clean(name: str) -> Column:
        missing = F.raise_error(F.lit(f"null {name}")).cast("string") if on_null == "error" else F.lit("")
        text = F.when(F.col(name).isNull(), missing).otherwise(F.col(name))
        return normalize_text(text, phrase, canonical)

    return pairs.withColumns({"prediction": clean("prediction"), "reference": clean("reference")})
