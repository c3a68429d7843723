"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.sources.tables import table, write_table

#: Everything but space, tab, line feed, vertical tab, form feed and carriage return is part of a word.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, name, *cols)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the cluster's shared folder and read again: cuts lineage, survives lost executors."""
    return write_table(df, f"llm-{name}")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def content_hash(docs: DataFrame) -> Column:
    """A hash of a whole row; rows that agree in it and in doc_id are copies of each other."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if not re.search("map<|variant", kind)])
