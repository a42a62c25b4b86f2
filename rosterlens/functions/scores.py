"""Score expressions: tolerant numbers, bands, and their text forms."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, LongType, StringType

from rosterlens.functions.text import MISSING

BANDS = ["High", "Medium", "Low"]
NO_BAND = "Not Available"

# Wording of the five score grades.
SCORE_DESCRIPTIONS = {
    "1": "Performing Greatly Below Benchmark",
    "2": "Performing Below Benchmark",
    "3": "Performing at Benchmark",
    "4": "Performing Above Benchmark",
    "5": "Performing Greatly Above Benchmark",
    "Not Available": "Not Available",
}


def number(col: Column) -> Column:
    """Read a number from text; text that is no number, and NaN, become null.

    Spark orders NaN above every number, so a NaN left in place would count as High. It also
    reads ``4d`` and ``4f``, which are no numbers here.
    """
    text = col.cast("string")
    value = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def whole_number(col: Column) -> Column:
    """Read an identifier or count from text such as ``6037`` or ``6037.0``.

    A number with a fraction is none: rounding it would name something else.
    """
    value = F.trim(col).try_cast("decimal(38,10)")
    return F.when(value == F.floor(value), value).try_cast("bigint")


def as_type(col: Column, found: DataType, wanted: DataType) -> Column:
    """A value in the declared type, whatever type the file stores it with.

    A number without a fraction is a whole number and is written as one; NaN and what cannot be
    read are null. A column that has the declared type already stays as it is, so that filters
    on it reach the file.
    """
    if found == wanted:
        return col
    whole = whole_number(col) if isinstance(found, StringType) else col.try_cast("bigint")
    if isinstance(found, FractionalType):
        number_ = col if isinstance(found, DecimalType) else F.when(~F.isnan(col), col)
        whole = F.when(number_ == F.floor(number_), number_).try_cast("bigint")
        col = number_
    if isinstance(wanted, LongType):
        return whole
    if isinstance(wanted, StringType) and isinstance(found, FractionalType):
        return F.coalesce(whole.cast("string"), col.cast("string"))
    return col.try_cast(wanted)


def score_band(score: Column) -> Column:
    """Band of a 1-5 cost or quality score."""
    return (
        F.when(score >= 4, "High")
        .when(score > 2, "Medium")
        .when(score <= 2, "Low")
        .otherwise(NO_BAND)
    )


def utilization_band(score: Column) -> Column:
    """Band of a 0-100 utilization score."""
    return (
        F.when(score >= 80, "High")
        .when(score <= 40, "Low")
        .when(score > 40, "Medium")
        .otherwise(NO_BAND)
    )


def score_text(score: Column) -> Column:
    return F.coalesce(score.cast("string"), F.lit(MISSING))


def score_key(provider_type: Column, specialty: Column) -> Column:
    """PCPs are scored as one specialty; everyone else by the listed specialty."""
    return F.when(provider_type == "PCP", F.lit("PCP")).otherwise(specialty)


def score_description(grade: Column) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain(*SCORE_DESCRIPTIONS.items())])
    return F.try_element_at(table, grade)
