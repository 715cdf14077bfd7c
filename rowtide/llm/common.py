"""What the operators of this package share: words, documents, settled frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.lineage import settle

#: White space that parts words, as a pattern and as characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["LOWER", "SPACE", "SPACE_CHARS", "UPPER", "documents", "let", "lower_ascii", "settle", "text_of", "tokenizer_file", "words"]


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column, a null being empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text: what stands between runs of ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; texts of ASCII alone take the fast way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once a row.

    A lambda that looks into an array expression would otherwise have it made anew for
    each element, as the optimizer puts a column that is named once in its place.
    """
    return F.get(F.transform(F.array(value), body), 0)


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
