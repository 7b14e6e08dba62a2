"""Wide and nested task tables to long ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.constants import SUMMARY_TYPES
from pairloom.schemas import QUESTION_ANSWER

LAYOUTS = ("auto", "wide", "long")


def is_unflattened(df: DataFrame, layout: str, expected: tuple[str, ...]) -> bool:
    """Resolve a layout argument; `auto` compares the frame's ordered columns to `expected`."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    return layout == "wide" or (layout == "auto" and tuple(df.columns) == expected)


def unpivot_targets(
    df: DataFrame,
    id_columns: list[str],
    value_columns=SUMMARY_TYPES,
    name_column: str = "type",
    value_column: str = "summary",
) -> DataFrame:
    """One row per value column; null values stay."""
    return df.unpivot(id_columns, list(value_columns), name_column, value_column)


def flatten_qa(
    df: DataFrame,
    context: str = "context",
    factual: str = "factual_questions",
    unanswerable: str = "unanswerable_question",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Each factual pair as a row in list order, then the unanswerable one.

    Columns: `keep`, `context`, `question_no` (from 0), `question`, `answer`.
    """
    no_pairs = F.array().cast(f"array<{QUESTION_ANSWER.simpleString()}>")
    named = lambda s: F.struct(s["question"].alias("question"), s["answer"].alias("answer"))
    pairs = F.concat(
        F.coalesce(F.transform(F.col(factual), named), no_pairs),
        F.array(named(F.col(unanswerable))),
    )
    return df.select(*keep, F.col(context).alias("context"), F.posexplode(pairs).alias("question_no", "qa")).select(
        *keep, "context", "question_no", "qa.question", "qa.answer"
    )
