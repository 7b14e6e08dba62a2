"""Declared schemas of the shapes operators exchange."""

from pyspark.sql import types as T

PAIR = T.StructType([T.StructField("inputs", T.StringType()), T.StructField("targets", T.StringType())])

PROMPT_PAIR = T.StructType([*PAIR.fields, T.StructField("prompt", T.StringType())])

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)

QUESTION_ANSWER = T.StructType(
    [T.StructField("question", T.StringType()), T.StructField("answer", T.StringType())]
)
NESTED_MRC = T.StructType(
    [
        T.StructField("context", T.StringType()),
        T.StructField("factual_questions", T.ArrayType(QUESTION_ANSWER)),
        T.StructField("unanswerable_question", QUESTION_ANSWER),
    ]
)

TEMPLATE = T.StructType([T.StructField("type", T.StringType()), T.StructField("template", T.StringType())])
