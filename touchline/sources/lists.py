"""Link lists: text files with one URL per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.names import list_stem, shown_name
from touchline.functions.text import strip
from touchline.operators.keys import first_per_key


def any_case(text: str) -> str:
    """The text as a file glob that ignores letter case."""
    return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in text)


def clean_lines(lines: DataFrame, column: str = "value", name: str = "url") -> DataFrame:
    """Stripped lines; blank lines and lines whose first character is ``#`` are dropped.

    A ``#`` behind leading blanks is no comment.
    """
    text = F.col(column)
    kept = lines.where((strip(text) != "") & ~text.startswith("#"))
    return kept.withColumn(column, strip(text)).withColumnRenamed(column, name)


def read_lists(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """URLs of every ``.txt`` file below the paths, with file name and stem.

    In a folder ``stem=...`` that ``write_links`` wrote, the folder tells the stem.
    """
    lines = (
        spark.read.option("pathGlobFilter", any_case("*.txt"))
        .text(paths)
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"))
    )
    return clean_lines(lines).withColumn("stem", stem_of(F.col("path")))


def stem_of(path: Column) -> Column:
    """The stem of a list, from its path."""
    name = shown_name(path)
    return F.when(path.rlike("/stem=[^/]*/part-[0-9]{5,}-[^/]*$"), name).otherwise(list_stem(name))


def list_files(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """Paths in a folder that end in the suffix in any letter case. File contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", any_case("*" + suffix))
        .load(folder)
        .select("path")
    )


def first_paths(paths: DataFrame, path: str, order: Column) -> DataFrame:
    """Each path once, at the place it was first seen."""
    return first_per_key(paths, [path], [order])
