"""Batch scoring with a predictor the user supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Predictor = Callable[..., list[str]]


def batch_generate(
    df: DataFrame,
    prompt: str,
    make_predictor: Callable[[], Predictor],
    batch_size: int = 16,
    out: str = "generated_text",
    partitions: int | None = None,
    **sampling,
) -> DataFrame:
    """Add the text `predictor(list_of_prompts, **sampling)` returns for each prompt.

    `make_predictor` runs once per task, on the executor, so a model is loaded
    there and reused for all its batches. Only the prompt column crosses to
    Python. `partitions` spreads rows evenly when the input has few partitions.
    Sampling doesn't repeat itself, so the column is declared non-deterministic:
    filters stay above it. Write the result before using it twice.
    """

    @F.pandas_udf("string")
    def generate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predictor = make_predictor()
        for prompts in batches:
            texts: list[str] = []
            for at in range(0, len(prompts), batch_size):
                chunk = prompts.iloc[at : at + batch_size].tolist()
                replies = list(predictor(chunk, **sampling))
                if len(replies) != len(chunk):
                    raise ValueError(f"predictor returned {len(replies)} texts for {len(chunk)} prompts")
                texts += replies
            yield pd.Series(texts, dtype=object)

    spread = df.repartition(partitions) if partitions else df
    return spread.withColumn(out, generate.asNondeterministic()(F.col(prompt)))
