from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rosterlens.functions import labels, scores, text


def values(spark, expression, inputs, kind="string"):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r["y"] for r in table.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_title_case_follows_python(spark):
    names = [
        "3RD o'neil-smith",
        "st.MARY of  the HILL",
        "JOSÉ ÉLAN o'neil 3rd",
        "a\tb\nc-d",
        "x1y2z3",
        "",
        " leading and trailing ",
        "中a bc",
        "supplier#000000001",
    ]
    assert values(spark, text.title_case, names) == [n.title() for n in names]


def test_missing_texts(spark):
    assert values(spark, text.text_or_missing, [None, "", "nan", "None", "NaN", "x"]) == [
        "NA", "NA", "NA", "NA", "NA", "x",
    ]
    assert values(spark, text.title_or_missing, [None, "", "NAN", "o'hara"]) == [
        "NA", "NA", "Nan", "O'Hara",
    ]
    assert values(spark, text.group_name, [" Group 1 ", "  ", None, " nan"]) == [
        "Group 1", "NA", "NA", "NA",
    ]
    assert values(spark, text.specialty_flag, ["Primary", None, ""]) == [
        "Primary", "Not Applicable", "NA",
    ]


def test_group_tin(spark):
    tins = ["700000", "700000.0", "10000000", "x", None, "", " 12 "]
    assert values(spark, text.group_tin, tins) == [
        "700000", "700000", "10000000", "NA", "NA", "NA", "12",
    ]


def test_confidence_label(spark):
    labels_in = ["Green", "Not available", "NOT AVAILABLE", None]
    assert values(spark, text.confidence_label, labels_in) == ["Green", "NA", "NA", "NA"]


def test_number_is_tolerant(spark):
    assert values(spark, scores.number, ["4.5", "", "n/a", "NaN", None, "1e1"]) == [
        4.5, None, None, None, None, 10.0,
    ]


def test_whole_number(spark):
    assert values(spark, scores.whole_number, ["6037", " 6037.0 ", "x", "", None]) == [
        6037, 6037, None, None, None,
    ]


@pytest.mark.parametrize(
    "band, cases",
    [
        (
            scores.score_band,
            {4.0: "High", 3.99: "Medium", 2.01: "Medium", 2.0: "Low", -1.0: "Low"},
        ),
        (
            scores.utilization_band,
            {80.0: "High", 79.99: "Medium", 40.01: "Medium", 40.0: "Low", 0.0: "Low"},
        ),
    ],
)
def test_bands(spark, band, cases):
    assert values(spark, band, list(cases), "double") == list(cases.values())
    assert values(spark, band, [None], "double") == ["Not Available"]


def test_score_text(spark):
    found = values(spark, scores.score_text, [3.0, 74.6, 100.0, None, 0.07], "double")
    assert found == ["3.0", "74.6", "100.0", "NA", "0.07"]


def test_score_text_of_all_two_decimal_scores(spark):
    hundredths = spark.range(0, 10001).select(
        "id", scores.score_text(F.col("id") / F.lit(100.0)).alias("t")
    )
    assert all(r["t"] == str(r["id"] / 100.0) for r in hundredths.collect())


def test_score_description(spark):
    found = values(spark, scores.score_description, ["1", "5", "Not Available", "6", None])
    assert found == [
        "Performing Greatly Below Benchmark",
        "Performing Greatly Above Benchmark",
        "Not Available",
        None,
        None,
    ]


def test_score_key(spark):
    table = spark.createDataFrame(
        [("PCP", "Family Medicine"), ("Other Providers", "Nurse"), ("PCP", None)], "t string, s string"
    )
    keys = table.select(scores.score_key(F.col("t"), F.col("s")).alias("k")).collect()
    assert [r["k"] for r in keys] == ["PCP", "Nurse", "PCP"]


def test_lists_and_labels(spark):
    assert values(spark, labels.whole_numbers, ["1, 2,2 ,3.0", "1,x"]) == [[1, 2, 3], [1, None]]
    row = (
        spark.range(1)
        .select(
            labels.pairing_label(F.lit(2), F.lit(True)).alias("base"),
            labels.pairing_label(F.lit(2), F.lit(False)).alias("compare"),
            labels.network_id(F.lit("1"), F.lit("3")).alias("id"),
            labels.network_name(F.lit("Org A"), F.lit("HMO")).alias("name"),
            labels.yes_no(F.lit(None).cast("boolean")).alias("no"),
            labels.yes_no(F.lit(True)).alias("yes"),
        )
        .first()
    )
    assert tuple(row) == ("base_Compare_2", "Compare_2", "1_3", "Org A HMO", "N", "Y")
