"""Interaction scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.schemas import IMPLICIT_SCORES

# Fixed values of the affinity formula.
DECAY_DAYS = 30.0
IMPLICIT_SHARE, RATING_SHARE, RECENCY_SHARE = 0.3, 0.5, 0.2
RATING_LOW, RATING_HIGH = 1.0, 5.0


def implicit_score(view_mode: Column) -> Column:
    """Weight of an interaction type; unknown types give null."""
    chain = None
    for mode, weight in IMPLICIT_SCORES.items():
        chain = (F.when(view_mode == mode, weight) if chain is None
                 else chain.when(view_mode == mode, weight))
    return chain


def whole_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days from ``start`` to ``end``, rounded down."""
    gap = end - start
    days = F.extract(F.lit("DAY"), gap)
    back = gap < F.make_dt_interval(days)
    return F.when(back, days - 1).otherwise(days).cast("int")


def recency_weight(days: Column) -> Column:
    """exp(-days / 30): e-folding after 30 days, not a half-life."""
    return F.exp(-days / F.lit(DECAY_DAYS))


def rating_to_unit(rating: Column) -> Column:
    """Ratings 1..5 onto 0..1."""
    return (rating - F.lit(RATING_LOW)) / F.lit(RATING_HIGH - RATING_LOW)


def affinity(implicit: Column, rating_unit: Column, recency: Column) -> Column:
    """Blend of interaction type, rating and recency."""
    return (implicit / F.lit(3.0) * IMPLICIT_SHARE
            + rating_unit * RATING_SHARE
            + recency * RECENCY_SHARE)


def unit_to_rating(value: Column) -> Column:
    """Affinity 0..1 onto the 1..5 scale of the factor model."""
    return value * F.lit(RATING_HIGH - RATING_LOW) + F.lit(RATING_LOW)


def clamp_rating(value: Column) -> Column:
    """Estimate limited to the rating scale."""
    return F.least(F.lit(RATING_HIGH), F.greatest(F.lit(RATING_LOW), value))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """part / whole, zero where whole is not positive."""
    return F.when(whole > 0, part / F.nullif(whole, F.lit(0))).otherwise(F.lit(0.0))
