"""From raw documents to packed token windows, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; results are written and read again between stages. A row whose text has no
letter, or is like no learned language, goes in the first stage; rows scored as
toxic go in the second; of each group of near duplicates the row with the
smallest doc_id stays; the mix emits documents by source weight; the last stage
returns pieces of token windows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.jaccard import nearest_kept
from pairloom.llm.language import UNDETERMINED, learn_prototypes, least_likeness, length_class, predict_language
from pairloom.llm.mixing import emit_mix
from pairloom.llm.packing import pack_documents
from pairloom.llm.text import fold
from pairloom.llm.toxicity import fit_toxicity, score_toxicity
from pairloom.session import scratch_path

def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under names that clash with none of a stage's own, and the names they stand for."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is like one of the languages that documents are marked with.

    Learned from documents of two thirds of the ids. Null, empty and letterless texts
    are of no language and go; without any language learned all do. Short texts need
    less likeness than long ones. Repeated rows stay, an empty table stays empty, and
    columns may have any name.
    """
    plain, names = _plain(docs)
    text, lang, held = names["text"], names["lang"], tuple(names.values())
    train = fold(F.col(names["doc_id"]), 3) != 1
    languages, prototypes = learn_prototypes(plain.where(train), text, lang)
    predict = lambda rows, keep: predict_language(rows, languages, prototypes, text, keep, ("own_lang", "own_score"))
    learned = plain.where(train & F.col(lang).isNotNull()).select(text, length_class(F.col(text)).alias("length"))
    scores = predict(learned, ("length",)).where(F.col("own_lang") != UNDETERMINED)
    least = least_likeness(scored=scores.select("length", F.col("own_score").alias("score")), dims=prototypes.shape[1])
    # A length that no learned text has is judged as the longest that one has.
    usual = least[max(least)] if least else 1.0
    limit = F.lit(usual)
    for length, own in least.items():
        limit = F.when(length_class(F.col(text)) == length, own).otherwise(limit)
    kept = predict(plain, held).where((F.col("own_lang") != UNDETERMINED) & (F.col("own_score") >= limit))
    return kept.select(*held).toDF(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't scored as toxic.

    Learned from labelled documents of four fifths of the ids. Null and empty texts have
    no votes and stay; without labels of both classes all stay. Repeated rows are
    judged alike, an empty table stays empty, and columns may have any name.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels, fold(F.col("doc_id"), 5) != 0)
    plain, names = _plain(docs)
    scored = score_toxicity(plain, model, tuple(names.values()), names["text"], ("own_score", "own_toxic"))
    return scored.where("own_toxic = 0").select(*names.values()).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id, null last.

    Wordless texts are like nothing and all stay; of equal rows one stays. An empty table
    stays empty, and columns may have any name.
    """
    plain, names = _plain(docs)
    kept = nearest_kept(plain.withColumnsRenamed({names[c]: c for c in ("doc_id", "text")}))
    return kept.toDF(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight wants them.

    Texts without a word have size 0 and aren't taken. An empty table stays empty, and
    columns may have any name.
    """
    return emit_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of at most 2,048 tokens, every token of every document in exactly one.

    Null texts are empty and have their end alone. An empty table gives no piece.
    """
    pieces = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: The trained stages and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
