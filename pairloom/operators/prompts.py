"""Prompt construction from template tables and task rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.constants import CHOICE_INTRO, MRC_INTRO, SUMMARY_TEMPLATES
from pairloom.functions.text import strip
from pairloom.schemas import TEMPLATE

CHOICES = 5


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SUMMARY_TEMPLATES.items()), TEMPLATE)


def render_templates(
    df: DataFrame,
    templates: DataFrame | dict[str, str],
    key: str = "type",
    slot: str = "context",
    out: str = "prompt",
) -> DataFrame:
    """Fill `{slot}` of the template chosen by `key`; an unknown key is an error.

    The filled-in text is not scanned again, so braces in it are safe. A null
    slot value gives a null prompt. A dictionary is looked up in place; a table is
    joined, broadcast or not as its size has it.
    """
    if isinstance(templates, dict):
        held = F.create_map(*(F.lit(x) for line in templates.items() for x in line))
        chosen = df.withColumn("__template", F.try_element_at(held, F.col(key)))
    else:
        chosen = df.join(templates.select(key, F.col("template").alias("__template")), key, "left")
    unknown = F.raise_error(F.concat(F.lit("no template for "), F.coalesce(F.col(key), F.lit("null"))))
    template = F.when(F.col("__template").isNull(), unknown.cast("string")).otherwise(F.col("__template"))
    return chosen.withColumn(out, F.replace(template, F.lit("{" + slot + "}"), F.col(slot))).drop("__template")


def choice_prompt(
    candidates: str | Column = "inputs",
    target_question: str | Column = "main_question.formal",
    intro: str = CHOICE_INTRO,
) -> Column:
    """Five numbered candidates and the target question.

    Later candidates are ignored; fewer than five fail with an out-of-bounds error.
    """
    candidates = F.col(candidates) if isinstance(candidates, str) else candidates
    target = F.col(target_question) if isinstance(target_question, str) else target_question
    short = F.raise_error(F.lit(f"fewer than {CHOICES} candidates")).cast("string")
    question = lambda i: F.when(F.size(candidates) < CHOICES, short).otherwise(
        F.get(candidates, F.lit(i))["question"]
    )
    lines = [F.concat(F.lit(f"{i + 1}. "), question(i), F.lit("\n")) for i in range(CHOICES)]
    return strip(
        F.concat(F.lit(intro + "\n\n"), *lines, F.lit("\nTarget: "), target, F.lit("\n\nNumber:"))
    )


def mrc_prompt(context: str | Column = "context", question: str | Column = "question", intro: str = MRC_INTRO) -> Column:
    """Instruction, text and question; the ends of the prompt are trimmed."""
    context = F.col(context) if isinstance(context, str) else context
    question = F.col(question) if isinstance(question, str) else question
    return strip(F.concat(F.lit(intro + "\n\nText: "), context, F.lit("\nQuestion: "), question))
