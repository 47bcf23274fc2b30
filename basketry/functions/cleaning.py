"""Casts and predicates for dirty text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.schemas import CSV_NULL_TOKENS


def null_tokens(text: Column) -> Column:
    """Missing-value texts of a CSV file as null (compared before trimming)."""
    return F.when(~text.isin(*CSV_NULL_TOKENS), text)


def to_number(text: Column) -> Column:
    """Number or null; a Java type suffix as in ``12d`` is not a number."""
    value = F.when(~text.rlike("[dDfF]\\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def to_key(text: Column) -> Column:
    """Whole-number key or null; fractions are cut off.

    Long texts of digits go straight to BIGINT so that no digit is lost on the
    way through DOUBLE.
    """
    return F.coalesce(text.try_cast("bigint"), to_number(text).try_cast("bigint"))


def clean_text(text: Column) -> Column:
    """Trimmed text; ``nan`` in any case is null."""
    trimmed = F.trim(text)
    return F.when(F.lower(trimmed) != "nan", trimmed)


def parse_timestamp(text: Column) -> Column:
    """Timestamp without zone from ``2026-01-06 00:51:47`` or ISO ``T`` text.

    The date must be spelled out: a lone clock time would be read against the
    day of the run.
    """
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz"))


def in_range(value: Column, low: float, high: float) -> Column:
    """Closed range test; null counts as outside."""
    return F.coalesce(value.between(low, high), F.lit(False))


def in_domain(value: Column, domain) -> Column:
    """Membership test; null counts as outside."""
    return F.coalesce(value.isin(*domain), F.lit(False))


def positive(value: Column) -> Column:
    """Greater than zero; null counts as not."""
    return F.coalesce(value > 0, F.lit(False))


def plausible_age(age: Column, low: float = 0, high: float = 110) -> Column:
    """Ages outside the closed range become null."""
    return F.when(age.between(low, high), age)
