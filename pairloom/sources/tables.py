"""CSV, JSON Lines and Parquet, with the options text columns need."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from pairloom.constants import CSV_NA_VALUES
from pairloom.functions.text import missing_to_null
from pairloom.schemas import PROMPT_PAIR
from pairloom.session import checkpointed
from pairloom.sources.files import write_jsonl_files  # noqa: F401

# Doubled quotes, embedded newlines and outer blanks must survive a round trip.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_pairs_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    na_values=CSV_NA_VALUES,
) -> DataFrame:
    """CSV with a header, every column as text; `na_values` become null.

    Quoted newlines make a single file unsplittable: give many files, or convert
    to Parquet once.
    """
    # With its own null mark an unquoted empty field is null and a quoted one is "".
    reader = spark.read.options(**_CSV, multiLine=True, enforceSchema=False, nullValue="\0")
    read = reader.csv(path)
    return read.select(*[missing_to_null(c, na_values).alias(c) for c in columns or read.columns])


def write_responses_csv(df: DataFrame, path: str) -> None:
    """`user` and `assistant` columns (or whatever the frame holds) with a header and no index."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


def _plain(kind: T.DataType) -> T.DataType:
    """A type of the union of files: numbers that differ are doubles, and what has no common type is text."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    return kind


def _merged_schema(found: str) -> StructType:
    """The schema that `schema_of_variant_agg` found, with plain types."""
    # Names are in back quotes where they aren't plain words; only type names are changed.
    quoted = re.split(r"(`(?:[^`]|``)*`)", found)
    ddl = "".join(part if part.startswith("`") else part.replace("OBJECT<", "STRUCT<") for part in quoted)
    if not ddl.startswith("STRUCT<"):
        raise ValueError(f"a line that is no JSON object; the lines are {found}")
    return _plain(T.DataType.fromDDL(ddl))


def read_jsonl_dir(
    spark: SparkSession, path: str, schema: StructType | str | None = None, pattern: str = "*.jsonl"
) -> DataFrame:
    """Union of every `.jsonl` file directly in a folder; rows with any null are dropped.

    Columns and types are merged over the files: whole numbers with fractions are
    doubles, types with nothing in common are text, and a file that lacks a column
    loses its rows. Lines are read once, as variants, and kept in a checkpoint from
    which both the schema and the rows are taken; with a `schema` they are read into
    it directly. A malformed line is an error, and so is a folder without such files;
    files without lines give an empty frame.
    """
    files = spark.read.option("pathGlobFilter", pattern)
    if files.format("binaryFile").load(path).select("path").isEmpty():
        raise FileNotFoundError(f"no {pattern} file in {path}")
    files = spark.read.option("pathGlobFilter", pattern).option("mode", "FAILFAST")
    if schema is not None:
        return files.schema(schema).json(path).dropna(how="any")
    lines = checkpointed(files.option("singleVariantColumn", "line").json(path))
    found = lines.agg(F.schema_of_variant_agg("line")).head()[0]
    if found == "VOID":
        return spark.createDataFrame([], StructType([]))
    merged = _merged_schema(found)
    row = F.variant_get("line", "$", merged.simpleString()).alias("row")
    return lines.select(row).select("row.*").dropna(how="any")


def write_splits_jsonl(df: DataFrame, path: str) -> None:
    """One folder of JSON Lines per value of `split`, non-ASCII as is, nulls written out."""
    df.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", False).json(path)


def load_splits(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """`(train, test)` as `write_splits_jsonl` laid them out; the test frame may be empty.

    Without a schema all columns keep the types of the files, which costs one more reading.
    """
    both = (spark.read.schema(schema) if schema is not None else spark.read).json(path)
    if "split" not in both.columns:
        raise FileNotFoundError(f"no split=... folder in {path}")
    part = lambda name: both.where(F.col("split") == name).drop("split")
    return part("train"), part("test")


def load_split_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str = PROMPT_PAIR,
    train: str = "train_dataset.json",
    test: str = "test_dataset.json",
) -> tuple[DataFrame, DataFrame]:
    """The same from one JSON Lines file per split; the test file is optional."""
    part = lambda name: spark.read.schema(schema).option("pathGlobFilter", name).json(path)
    return part(train), part(test)


def write_scores(df: DataFrame, path: str) -> None:
    """Per-example scores as Parquet, replacing an older table."""
    df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Average scores as JSON Lines, replacing an older report."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_blocks(df: DataFrame, path: str) -> None:
    """Packed token blocks as Parquet."""
    df.write.mode("overwrite").parquet(path)
