"""Identifiers and labels of networks and pairings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlens.functions.scores import whole_number


def network_id(org_id: Column, plan_type_id: Column) -> Column:
    return F.concat_ws("_", org_id, plan_type_id)


def network_name(org_name: Column, plan_type: Column) -> Column:
    return F.concat_ws(" ", org_name, plan_type)


def pairing_label(pair_idx: Column, is_base: Column) -> Column:
    """``Compare_<i>`` for the compared network, ``base_Compare_<i>`` for the base."""
    label = F.concat(F.lit("Compare_"), pair_idx.cast("string"))
    return F.when(is_base, F.concat(F.lit("base_"), label)).otherwise(label)


def yes_no(flag: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), F.lit("Y")).otherwise(F.lit("N"))


def trimmed_list(text: Column, separator: str) -> Column:
    """Split on a separator pattern and trim each part."""
    return F.transform(F.split(text, separator), lambda part: F.trim(part))


def whole_numbers(text: Column) -> Column:
    """Comma list to distinct numbers; parts that are no number become null."""
    return F.array_distinct(
        F.transform(trimmed_list(text, ","), lambda part: whole_number(part))
    )
