"""Canonical provider tables derived from the star-schema and event tables.

Customers act as individual providers (one row per order), suppliers as organizations
(one row per line item), events as score rows, and order priorities and return flags as
raw networks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.functions.scores import score_band
from rosterlens.sources import canonical
from rosterlens.sources.files import Inputs
from rosterlens.sources.requests import Requests

# Order priorities 1-5 are the raw networks; networks 3 and 4 have no organizations.
SUPPRESSED_NETWORKS = [4]
EXCLUDED_PART_SIZES = [3, 9, 14, 27, 41]
LISTED_SPECIALTIES = ["s1", " S3 ", "S5"]


_opened: dict[tuple[SparkSession, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its file is looked up once per session."""
    key = (spark, f"{sf_dir}/{name}.parquet")
    if key not in _opened:
        _opened[key] = spark.read.parquet(key[1])
    return _opened[key]


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey",
        F.col("n_nationkey").cast("bigint").alias("fips"),
        F.col("n_name").alias("county_name"),
        F.col("r_name").alias("state"),
    )


def _provider_type(segment: Column) -> Column:
    return (
        F.when(segment == "AUTOMOBILE", "PCP")
        .when(segment == "BUILDING", "Physician Specialists")
        .when(segment.isin("FURNITURE", "HOUSEHOLD"), "Other Providers")
        .otherwise("Not Classified")
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    places = _places(spark, sf_dir)
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "provider_type", _provider_type(F.col("c_mktsegment"))
    )


def _specialty(number: Column) -> Column:
    return F.when(F.col("provider_type") == "PCP", "PCP").otherwise(
        F.concat(F.lit("S"), (number % 7).cast("string"))
    )


def raw_individuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = _customers(spark, sf_dir)
    price = F.col("o_totalprice")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("raw_network_id"),
        F.col("c_custkey").alias("npi"),
        F.lit("Individual").alias("type"),
        F.lower("c_name").alias("presentation_name"),
        F.col("c_name").alias("first_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("last_name"),
        F.concat_ws(" ", F.col("c_custkey").cast("string"), F.lower("c_mktsegment"), F.lit("st."))
        .alias("address"),
        F.lit("Org").alias("parent_org"),
        F.when(F.col("o_orderstatus") == "F", "High")
        .when(F.col("o_orderstatus") == "O", "Low")
        .otherwise("Not Reviewed")
        .alias("location_confidence"),
        F.when(price >= 400000, "HIGH").when(price >= 100000, "low")
        .alias("location_confidence_address"),
        F.col("c_mktsegment").alias("specialty_category"),
        F.lit(None).cast("string").alias("specialty_name"),
        F.lit(None).cast("string").alias("specialty_subspecialty"),
        (F.col("o_orderkey") % 7).cast("string").alias("specialty_code"),
        F.when(price >= 250000, "Primary").alias("specialty_flag"),
        "provider_type",
        F.lower("county_name").alias("city"),
        "state",
        F.lpad((F.col("fips") * 37).cast("string"), 5, "0").alias("zip_code"),
        "county_name",
        "fips",
        _specialty(F.col("o_orderkey")).alias("specialty"),
        F.lit("N").alias("is_dual_provider"),
        F.when(price >= 300000, F.concat((F.col("fips") + 700000).cast("string"), F.lit(".0")))
        .when(price >= 200000, "unknown")
        .alias("group_tin"),
        F.when(price >= 300000, F.concat(F.lit(" Group "), F.col("fips").cast("string")))
        .when(price >= 200000, " nan ")
        .alias("group_name"),
    )


def raw_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    places = _places(spark, sf_dir)
    suppliers = supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    flag = F.col("l_returnflag")
    return lineitem.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.when(flag == "A", 1).when(flag == "N", 2).otherwise(5).cast("bigint")
        .alias("raw_network_id"),
        F.col("s_suppkey").alias("npi"),
        F.lit("Organization").alias("type"),
        F.concat(F.lit(" "), F.lower("s_name")).alias("presentation_name"),
        F.lit(None).cast("string").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.when(flag == "A", F.concat(F.lower("s_name"), F.lit(" ")))
        .otherwise(F.col("s_name"))
        .alias("address"),
        F.lit("Org").alias("parent_org"),
        F.lit("Acute").alias("specialty_category"),
        F.lit("Acute Care").alias("specialty_name"),
        F.lit(None).cast("string").alias("specialty_subspecialty"),
        F.when(F.col("l_tax") > 0, F.col("l_partkey").cast("string")).alias("specialty_code"),
        F.when(F.col("l_discount") == 0, "None")
        .when(F.col("l_quantity") < 10, "Ancillary")
        .otherwise(canonical.HOSPITAL)
        .alias("provider_type"),
        F.lower("county_name").alias("city"),
        "state",
        F.lpad((F.col("fips") * 37).cast("string"), 5, "0").alias("zip_code"),
        "county_name",
        "fips",
        F.lit("Acute Care").alias("specialty"),
        F.when(F.col("l_linestatus") == "O", "Active").otherwise("Closed").alias("status"),
        F.lit(None).cast("string").alias("group_tin"),
        F.lit(None).cast("string").alias("group_name"),
    )


def individuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.clean_individuals(raw_individuals(spark, sf_dir))


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.clean_organizations(raw_organizations(spark, sf_dir))


def raw_individual_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score rows as texts, with unreadable and not-a-number values among them."""
    events = table(spark, sf_dir, "events")
    customers = _customers(spark, sf_dir)
    value = F.floor("value")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("double")
    return events.join(customers, F.col("user_id") == F.col("c_custkey")).select(
        F.col("user_id").alias("npi"),
        "provider_type",
        "fips",
        _specialty(F.col("event_id")).alias("specialty"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise((value / 100.0).cast("string"))
        .alias("quality"),
        F.when(F.col("event_type") == "signup", "NaN")
        .otherwise((k * 5 / 100.0).cast("string"))
        .alias("cost"),
        k.cast("string").alias("ma_util"),
        F.floor(F.col("value") / 5.0).cast("double").cast("string").alias("ffs_util"),
        ((500 - value) / 100.0).cast("string").alias("npi_score"),
        F.when(F.col("event_type").isin("view", "purchase"), "Green")
        .when(F.col("event_type") == "click", "Yellow")
        .when(F.col("event_type") == "signup", "Not available")
        .alias("colour"),
    )


def individual_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.individual_scores(raw_individual_scores(spark, sf_dir))


def raw_organization_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score rows of suppliers; those of suppliers of one region have no key, so nothing meets them."""
    supplier = table(spark, sf_dir, "supplier")
    places = _places(spark, sf_dir)
    step = F.floor(F.col("s_acctbal") / 20.0)
    return (
        supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("state") != "ASIA", F.col("s_suppkey")).alias("npi"),
            F.concat(F.lit(" "), F.lower("s_name")).alias("address"),
            "state",
            "fips",
            F.when(F.col("s_acctbal") < 0, "n/a")
            .otherwise((step / 100.0).cast("string"))
            .alias("quality"),
            ((500 - step) / 100.0).cast("string").alias("cost"),
            F.floor(F.col("s_acctbal") / 100.0).cast("double").cast("string").alias("ma_util"),
            F.floor(F.col("s_acctbal") / 200.0).cast("double").cast("string").alias("ffs_util"),
        )
    )


def organization_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.organization_scores(raw_organization_scores(spark, sf_dir))


def specialties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allow-list, written with stray case and blanks as in a hand-kept file."""
    listed = spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in LISTED_SPECIALTIES])).alias("name")
    )
    return canonical.specialty_list(listed)


def hospital_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return canonical.hospital_names(
        supplier.select(
            F.when(F.col("s_acctbal") >= 3000, F.concat(F.lower("s_name"), F.lit(" "))).alias("name"),
            F.concat(F.lit(" Facility "), F.col("s_suppkey").cast("string"), F.lit(" ")).alias(
                "facility"
            ),
        )
    )


def excluded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes to leave out: the parts of a few sizes."""
    part = table(spark, sf_dir, "part")
    return part.where(F.col("p_size").isin(EXCLUDED_PART_SIZES)).select(
        F.col("p_partkey").cast("string").alias("code")
    )


def _benchmark(rows: DataFrame, fips: str, balance: str) -> DataFrame:
    """Benchmark counts per county, type and balance band, as texts like in the files."""
    amount = F.col(balance)
    return (
        rows.withColumn("Scoring Category", score_band(F.when(amount >= 0, amount / 2000.0)))
        .groupBy(
            "state",
            "county_name",
            F.col("fips").cast("string").alias(fips),
            F.col("provider_type").alias("New Flag"),
            "Scoring Category",
        )
        .agg(
            F.count("*").cast("string").alias("Quality Score"),
            F.count(F.when(amount >= 3000, 1)).cast("string").alias("Cost Score"),
            F.count(F.when(amount < 8000, 1)).cast("string").alias("MA Utilization Score"),
            F.lit("0").alias("FFS Utilization Score"),
        )
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers(spark, sf_dir)
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(_places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("provider_type", F.lit(canonical.HOSPITAL))
    )
    return canonical.market_rows(
        _benchmark(customers, "FIPS State County Code", "c_acctbal"),
        _benchmark(suppliers, "FIPS County Code", "s_acctbal"),
    )


def _network(raw_networks: str) -> str:
    return (
        '{"parentOrganization":"Org","planBidIds":"H0000_001_0","networkIds":"' + raw_networks + '"}'
    )


# id, client, base (org id, name, raw networks), compares, region left out of the counties
_REQUESTS = [
    ("Req_1", 8, ("1", "Org A", "1"), [("2", "Org B", "2"), ("5", "Org E", "5")], "EUROPE"),
    ("Req_2", 45, ("3", "Org C", "3, 4"), [("1", "Org A", "1,2")], "AFRICA"),
    ("Req_3", 5, ("5", "Org E", "5"), [("4", "Org D", "4"), ("2", "Org B", "2")], "ASIA"),
    ("Req_4", 7, ("4", "Org D", "4"), [("3", "Org C", "3")], "AMERICA"),
]


def request_row(request_id, client_id, base, compares, counties: Column) -> list[Column]:
    """One request as the thirteen request texts."""
    texts = {
        "county": counties,
        "id": request_id,
        "filespath": "",
        "clientID": str(client_id),
        "userID": "",
        "base": '{"%s":%s}' % (base[0], _network(base[2])),
        "compare": "{%s}" % ",".join('"%s":%s' % (c[0], _network(c[2])) for c in compares),
        "baseParentOrg": base[1],
        "compareParentOrg": "|".join(c[1] for c in compares),
        "baseParentOrgId": base[0],
        "compareParentOrgId": ",".join(c[0] for c in compares),
        "planType": "HMO",
        "planTypeId": "2",
    }
    return [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in texts.items()]


def requests(spark: SparkSession, sf_dir: str) -> Requests:
    """Four requests: several compares, networks of several raw networks, four clients."""
    raw = None
    for request_id, client_id, base, compares, left_out in _REQUESTS:
        places = _places(spark, sf_dir).where(F.col("state") != left_out)
        row = places.agg(F.sort_array(F.collect_list("fips")).alias("fips"))
        counties = F.array_join(F.transform("fips", lambda f: f.cast("string")), ", ")
        one = row.select(*request_row(request_id, client_id, base, compares, counties))
        raw = one if raw is None else raw.unionByName(one)
    return Requests(raw)


def read_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        individuals=individuals(spark, sf_dir),
        organizations=organizations(spark, sf_dir),
        individual_scores=individual_scores(spark, sf_dir),
        organization_scores=organization_scores(spark, sf_dir),
        specialties=specialties(spark, sf_dir),
        hospital_names=hospital_names(spark, sf_dir),
        market=market(spark, sf_dir),
    )
