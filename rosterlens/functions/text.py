"""Text expressions: title case, keys, and the wording used in export files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A letter that follows a character which is neither letter nor blank, and its place.
_INNER_LETTER = r"[^\p{LC} ]\p{LC}"
_INNER_WORD = r"(?<=[^\p{LC} ])(?=\p{LC})"
# Set there for a moment to make a word start; a private-use character and a blank.
_MARK = "\ue000 "

# Texts that stand for "no value" in the source files.
MISSING_TEXTS = ["", "nan", "None", "NaN"]

MISSING = "NA"


def title_case(col: Column) -> Column:
    """Capitalise every letter that follows a non-letter and lower the rest.

    ``initcap`` only looks at blanks, so words inside ``o'neil-smith`` are marked first.
    """
    marked = F.regexp_replace(col, F.lit(_INNER_WORD), F.lit(_MARK))
    cased = F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
    return F.when(col.rlike(_INNER_LETTER), cased).otherwise(F.initcap(col))


def match_key(col: Column) -> Column:
    """Key for matching free text: trimmed and upper-cased."""
    return F.upper(F.trim(col))


def text_or_missing(col: Column) -> Column:
    """Null, empty and not-a-number texts become ``NA``."""
    return F.when(col.isNull() | col.isin(MISSING_TEXTS), F.lit(MISSING)).otherwise(col)


def title_or_missing(col: Column) -> Column:
    """Title case; null and empty texts become ``NA``, but a name may well be ``Nan``."""
    return F.when(col.isNull() | (col == ""), F.lit(MISSING)).otherwise(title_case(col))


def group_name(col: Column) -> Column:
    return text_or_missing(F.trim(col))


def group_tin(col: Column) -> Column:
    """Whole-number text without a decimal part; ``NA`` when it is not a number."""
    number = F.trim(col).try_cast("decimal(20,0)")
    return F.coalesce(number.cast("string"), F.lit(MISSING))


def confidence_label(col: Column) -> Column:
    """A colour label, or ``NA`` for null and any spelling of 'not available'."""
    unknown = col.isNull() | (F.lower(F.trim(col)) == "not available")
    return F.when(unknown, F.lit(MISSING)).otherwise(col)


def specialty_flag(col: Column) -> Column:
    return text_or_missing(F.coalesce(col, F.lit("Not Applicable")))
