"""What the physical plans look like, and that hot keys are split."""

from __future__ import annotations

import re
from contextlib import contextmanager

import build
import pytest
from pyspark.sql import functions as F

from rosterlens.operators import counts, exports, indicators, membership, scoring
from rosterlens.plans.comparison import compare_networks
from rosterlens.session import prepare
from rosterlens.sources import sample

OUTPUTS = [
    "provider_counts",
    "specialty_counts",
    "performance_indicators",
    "organization_export",
    "individual_export",
]

COUNTIES = ", ".join(str(c[0]) for c in sample.COUNTIES)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", plan(df)))


def many_pairs(spark, pairs):
    compares = [(str(i), f"Org {i}", "100002") for i in range(2, pairs + 2)]
    return build.requests(spark, build.request(compares=compares, counties=COUNTIES))


@contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def inputs(spark):
    return sample.sample_inputs(spark)


@pytest.mark.parametrize("name", OUTPUTS)
def test_no_cross_joins_no_python_and_a_fixed_number_of_shuffles(spark, inputs, name):
    one = compare_networks(inputs, many_pairs(spark, 1))[name]
    many = compare_networks(inputs, many_pairs(spark, 30))[name]
    text = plan(many)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window"):
        assert bad not in text, bad
    assert exchanges(one) == exchanges(many)


def test_counts_shuffle_the_providers_once(spark, inputs):
    # Once by provider, then twice on grouped rows; pairings add no exchange.
    assert exchanges(counts.individual_counts(inputs.individuals, many_pairs(spark, 5))) == 3


def test_keys_are_not_grouped_again_for_their_pairings(spark, inputs):
    key = membership.ORGANIZATION_COUNTY_NAME_KEY
    presence = membership.provider_presence(inputs.organizations, key, many_pairs(spark, 5))
    assert "keys=[npi" in plan(presence)
    assert "keys=[req_id" not in plan(presence)


def test_the_scan_reads_only_the_needed_columns(spark, tmp_path):
    people = build.individuals(spark, dict(npi=1))
    people.write.parquet(str(tmp_path / "people"))
    rows = spark.read.parquet(str(tmp_path / "people"))
    requests = build.requests(spark, build.request(counties=COUNTIES))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(counts.individual_counts(rows, requests)))
    read = {c.split(":")[0] for c in schema.group(1).split(",")}
    assert read == {"raw_network_id", "npi", "state", "fips", "provider_type"}


def hot_people(spark, n=40_000):
    """A third of all rows belong to one provider, with a new address each."""
    i = F.col("id")
    return build.individuals(spark, dict(npi=0)).join(
        spark.range(n).select(
            F.when(i % 3 == 0, 7).otherwise(i).cast("bigint").alias("hot_npi"),
            F.concat(i.cast("string"), F.lit(" Main St")).alias("hot_address"),
        ),
        F.lit(True),
        "cross",
    ).withColumn("npi", F.col("hot_npi")).withColumn("address", F.col("hot_address")).drop(
        "hot_npi", "hot_address"
    )


SMALL_PARTITIONS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def test_hot_provider_is_split_in_the_export_join(spark, tmp_path):
    prepare(spark)
    requests = build.requests(spark, build.request(client="8"))
    hot_people(spark).repartition(16).write.parquet(str(tmp_path / "people"))
    people = spark.read.parquet(str(tmp_path / "people"))
    scores = build.individual_scores(spark, dict(npi=7, quality="4"))
    with settings(spark, **SMALL_PARTITIONS):
        rows = exports.individual_rows(people, scores, requests)
        # The addresses keep the rows apart, or they would compress to almost nothing.
        total = rows.groupBy("Quality Score").agg(F.count("*").alias("n"), F.max("Address First Line"))
        found = {r["Quality Score"]: r["n"] for r in total.collect()}
        assert "skew=true" in plan(total)
    hot = len(range(0, 40_000, 3))
    assert found["4.0"] == hot + 1 - (7 % 3 == 0)
    assert sum(found.values()) == 40_000


def test_exports_collapse_rows_before_pairings(spark, tmp_path):
    """Addresses a client is not shown are gone before the shuffle; nothing follows the pairings."""
    prepare(spark)
    hot_people(spark).repartition(16).write.parquet(str(tmp_path / "people"))
    people = spark.read.parquet(str(tmp_path / "people"))
    scores = build.individual_scores(spark, dict(npi=7, quality="4"))
    none = build.organizations(spark), build.organization_scores(spark), build.hospital_names(spark)
    found = {}
    for limit in (1_000_000, 0):
        requests = build.requests(
            spark, build.request("A", client="8"), build.request("B", client="1"), broadcast_rows=limit
        )
        hospitals = exports.hospital_rows(*none, requests)
        export = exports.individual_export(people, scores, hospitals, requests)
        text = plan(export)
        # The plan is printed from its end: all grouping of rows lies below the pairings.
        assert "Join" in text[: text.index("Aggregate")]
        assert "partial_collect_set" in text
        found[limit] = sorted(map(tuple, export.collect()), key=str)
    assert found[1_000_000] == found[0]
    rows = [r for r in found[0] if r[0] == "A"]
    hidden = [r for r in found[0] if r[0] == "B"]
    assert len(rows) == 40_000
    assert len(hidden) == people.select("npi").distinct().count()


def test_hot_key_is_split_in_the_score_join(spark, tmp_path):
    prepare(spark)
    hot_people(spark).repartition(16).write.parquet(str(tmp_path / "people"))
    people = spark.read.parquet(str(tmp_path / "people"))
    scores = build.individual_scores(spark, dict(npi=7, quality="4"), dict(npi=8, quality="1"))
    with settings(spark, **SMALL_PARTITIONS):
        scored = scoring.score_individuals(people, scores)
        # The addresses keep the rows apart, or they would compress to almost nothing.
        scored = scored.groupBy("quality").agg(F.count("*").alias("n"), F.max("address"))
        found = {r["quality"]: r["n"] for r in scored.collect()}
        assert "skew=true" in plan(scored)
    assert sum(found.values()) == 40_000


def test_hot_provider_is_one_row_per_task_in_the_counts(spark, tmp_path):
    """Partial aggregation shrinks a hot provider before it is shuffled."""
    hot_people(spark).repartition(16).write.parquet(str(tmp_path / "people"))
    people = spark.read.parquet(str(tmp_path / "people"))
    requests = build.requests(spark, build.request())
    found = {
        (r["network_id"], r["common_unique"]): r["npi_count"]
        for r in counts.individual_counts(people, requests).collect()
    }
    assert "partial_collect_set" in plan(counts.individual_counts(people, requests))
    distinct = people.select("npi").distinct().count()
    assert found == {("1_2", "unique"): distinct}
    rows = indicators.individual_bands(
        people, build.individual_scores(spark, dict(npi=7, quality="4")), requests
    )
    assert {r["band"]: r["quality"] for r in rows.collect()} == {"High": 1, "Medium": 0, "Low": 0}


def test_providers_are_not_exchanged_by_network_or_county(spark, inputs):
    """Also where the request tables and the lists are too long for one broadcast."""
    wanted = build.request(counties=COUNTIES)
    short = build.requests(spark, wanted)
    with settings(spark, **{k: v for k, v in SMALL_PARTITIONS.items() if "Broadcast" in k}):
        long = build.requests(spark, wanted, broadcast_rows=0, block_rows=1)
        rows = long.restrict(inputs.individuals)
        text = plan(rows)
        assert "hashpartitioning(raw_network_id" not in text and "hashpartitioning(fips" not in text
        assert text.count("BroadcastHashJoin") > 2
        found = sorted(map(tuple, rows.collect()), key=str)
    assert found == sorted(map(tuple, short.restrict(inputs.individuals).collect()), key=str) and found


def test_pruning_holds_for_many_networks(spark):
    raw = ",".join(str(i) for i in range(1, 20_001))
    requests = build.requests(spark, build.request(base=("1", "Org A", raw)))
    assert len(requests.raw_network_ids()) == 20_001
