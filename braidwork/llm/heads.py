"""One row for each document and one for each distinct text, without the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST = (1 << 63) - 1  # stands for a null doc_id, which counts as the largest


def text_key(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes that name a text."""
    t = F.coalesce(text, F.lit(""))
    return F.xxhash64(t), F.xxhash64(F.lit(17), t)


def order_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name), F.lit(LAST))


def distinct_texts(heads: DataFrame) -> DataFrame:
    """t1, t2, the smallest order id of the text and the number of its rows."""
    return heads.groupBy("t1", "t2").agg(F.min("ord").alias("ord"), F.count("*").alias("copies"))


def texts_with(docs: DataFrame, groups: DataFrame, places: DataFrame) -> DataFrame:
    """t1, ord, text and places of one row of each distinct text that has places.

    ``places`` has t1 and an array. Only the row with the text's smallest id takes part,
    so copies of a text never meet in one task.
    """
    t1, _ = text_key(F.col("text"))
    wanted = places.join(groups.select("t1", "ord"), "t1")
    rows = docs.select(order_id().alias("ord"), t1.alias("t1"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # Rows equal in id and text are one here; the keys are those of the join.
    return rows.join(wanted, ["t1", "ord"]).select("t1", "ord", "text", "places").dropDuplicates(["t1", "ord"])
