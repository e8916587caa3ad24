"""Small helpers shared by the corpus operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ids of rows without one are made from their text and lie above all real ids.
NO_ID = 1 << 62


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {name.lower() for name in df.columns}
    name = f"__{base}"
    while name in taken:
        name += "_"
    return name


def documents_of(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id``, ``text`` and named columns only; whatever else a table has can't clash."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), *others)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The id, or for rows without one a number made from the text.

    Rows without id and of the same text share their key.
    """
    made = F.lit(NO_ID).bitwiseOR(F.xxhash64(F.col(text)).bitwiseAND(F.lit(NO_ID - 1)))
    return F.coalesce(F.col(doc_id).cast("long"), made)


def key_to_id(key: Column) -> Column:
    """The id of a key; null for keys made from a text."""
    return F.when(key < F.lit(NO_ID), key)
