"""What several operators share: written intermediate tables, word extraction, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.scratch import scratch_path, stage  # noqa: F401 - for the operators

#: Shingle length and similarity of near duplicates, unless an operator is told otherwise.
SHINGLE_WORDS, SIMILARITY = 5, 0.8

#: Bytes of words are digits, lower-case ASCII letters and everything above ASCII; A-Z are lower-cased.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8: maximal runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever columns a table carries."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name
