"""Task tables to training pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.constants import NESTED_MRC_COLUMNS, PAGE_MARKERS, SUMMARY_TEMPLATES, SUMMARY_TYPES, WIDE_SUMMARY_COLUMNS
from pairloom.operators.filters import drop_incomplete, drop_marked, to_pairs
from pairloom.operators.prompts import choice_prompt, mrc_prompt, render_templates
from pairloom.operators.reshape import flatten_qa, is_unflattened, unpivot_targets


def summary_pairs(
    df: DataFrame,
    templates: DataFrame | dict[str, str] = SUMMARY_TEMPLATES,
    layout: str = "auto",
    markers=PAGE_MARKERS,
    drop_nulls: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Summary tables to pairs. The marker filter applies to the wide layout only."""
    if is_unflattened(df, layout, WIDE_SUMMARY_COLUMNS):
        df = unpivot_targets(drop_marked(df, "context", markers), [*keep, "context"], SUMMARY_TYPES)
    if drop_nulls:
        df = drop_incomplete(df, ["context", "summary"])
    return to_pairs(render_templates(df, templates), "prompt", "summary", keep)


def choice_pairs(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Question-matching rows to pairs; the target is the number as text."""
    return to_pairs(df, choice_prompt("inputs", "main_question.formal"), F.col("target").cast("string"), keep)


def mrc_pairs(df: DataFrame, layout: str = "auto", keep: tuple[str, ...] = ()) -> DataFrame:
    """Reading-comprehension tables, nested or flat, to pairs; incomplete rows are dropped."""
    if is_unflattened(df, layout, NESTED_MRC_COLUMNS):
        df = flatten_qa(df, keep=keep)
        keep = (*keep, "question_no") if keep else ()
    complete = drop_incomplete(df.select(*keep, "context", "question", "answer"))
    return to_pairs(complete, mrc_prompt(), "answer", keep)
