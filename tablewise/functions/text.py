"""Text expressions kept JVM-side (regex and string built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters folded by normalisation and used as
# token separators -- space, tab, carriage return, line feed.
WHITESPACE_CLASS = "[ \t\r\n]+"


def fold_whitespace(text: Column) -> Column:
    """Lower-case, collapse runs of whitespace to one space, trim the ends."""
    return F.trim(F.regexp_replace(F.lower(text), WHITESPACE_CLASS, " "))


def content_key(text: Column) -> Column:
    """md5 of the folded text: equal for texts that differ only in case and
    whitespace."""
    return F.md5(fold_whitespace(text))


def tokens(text: Column) -> Column:
    """Lower-cased tokens split on whitespace, empty strings removed; the
    whole text is split, never a prefix."""
    return F.filter(F.split(F.lower(text), WHITESPACE_CLASS), lambda t: t != F.lit(""))


def token_rows(df, keep: list[str], text_col: str, out: str = "token"):
    """One row per token of the whole text (lower-cased, split on
    whitespace), keeping the ``keep`` columns.

    `explode_outer` plus a row filter for empty tokens: the filter runs in
    generated code, and unlike `explode` it does not make the optimizer add a
    `size(tokens) > 0` pre-filter that splits every text a second time.
    """
    parts = F.explode_outer(F.split(F.lower(F.col(text_col)), WHITESPACE_CLASS)).alias(out)
    return df.select(*keep, parts).where(F.col(out) != F.lit(""))
