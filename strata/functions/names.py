"""Column naming: safe names, renames of present columns, alias resolution."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

# Characters that may not appear in a stored column name.
UNSAFE_CHARACTERS = " ,;{}()\n\t="


def safe_name(name: str) -> str:
    """Trim, then put an underscore in place of every unsafe character."""
    return "".join("_" if ch in UNSAFE_CHARACTERS else ch for ch in name.strip())


def with_safe_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to safe names in one projection; two names that collapse into one are an error."""
    names = [safe_name(c) for c in df.columns]
    if names == df.columns:
        return df
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"Column names collide once made safe: {clashes}")
    return df.toDF(*names)


def rename_existing(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present and leave the rest of the mapping unused."""
    present = {old: new for old, new in mapping.items() if old in df.columns and old != new}
    return df.withColumnsRenamed(present) if present else df


def resolve_alias(columns: Iterable[str], aliases: Iterable[str], target: str) -> str:
    """The first alias that matches a column, ignoring case."""
    columns = list(columns)
    by_lower = {c.lower(): c for c in columns}
    for alias in aliases:
        if alias.lower() in by_lower:
            return by_lower[alias.lower()]
    raise ValueError(f"none of the columns {columns} can serve as {target}; rename one or extend the aliases")


def with_alias(df: DataFrame, target: str, aliases: Iterable[str]) -> DataFrame:
    """Rename whichever alias is present to ``target``."""
    found = resolve_alias(df.columns, aliases, target)
    return df if found == target else df.withColumnRenamed(found, target)
