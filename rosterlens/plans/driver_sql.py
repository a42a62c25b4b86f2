"""The driver queries as SQL for another engine, written pairing by pairing.

The statements follow the definitions directly: both networks of a pairing are put
together, and a provider is common if two networks list it. They share no logic with the
Spark plans, which group providers before pairings are applied.
"""

from __future__ import annotations

_PLACES = """
places AS (
  SELECT n_nationkey, CAST(n_nationkey AS BIGINT) AS fips, n_name AS county_name, r_name AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_CUST = """
cust AS (
  SELECT c.*, p.fips, p.county_name, p.state,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'PCP' WHEN 'BUILDING' THEN 'Physician Specialists'
      WHEN 'FURNITURE' THEN 'Other Providers' WHEN 'HOUSEHOLD' THEN 'Other Providers'
      ELSE 'Not Classified' END AS provider_type
  FROM customer c JOIN places p ON c_nationkey = n_nationkey)"""

_IND = """
raw_ind AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS raw_network_id, c_custkey AS npi,
    'Individual' AS type, lower(c_name) AS presentation_name, c_name AS first_name,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS last_name,
    CAST(c_custkey AS VARCHAR) || ' ' || lower(c_mktsegment) || ' st.' AS address,
    CASE o_orderstatus WHEN 'F' THEN 'High' WHEN 'O' THEN 'Low' ELSE 'Not Reviewed' END
      AS location_confidence,
    CASE WHEN o_totalprice >= 400000 THEN 'HIGH' WHEN o_totalprice >= 100000 THEN 'low' END
      AS location_confidence_address,
    CASE WHEN o_totalprice >= 250000 THEN 'Primary' END AS specialty_flag,
    provider_type, lower(county_name) AS city, state,
    lpad(CAST(fips * 37 AS VARCHAR), 5, '0') AS zip_code, county_name, fips,
    CASE WHEN provider_type = 'PCP' THEN 'PCP'
      ELSE 'S' || CAST(o_orderkey % 7 AS VARCHAR) END AS specialty,
    CASE WHEN o_totalprice >= 300000 THEN CAST(fips + 700000 AS VARCHAR) || '.0'
      WHEN o_totalprice >= 200000 THEN 'unknown' END AS group_tin,
    CASE WHEN o_totalprice >= 300000 THEN ' Group ' || CAST(fips AS VARCHAR)
      WHEN o_totalprice >= 200000 THEN ' nan ' END AS group_name
  FROM orders JOIN cust ON o_custkey = c_custkey),
ind AS (
  SELECT * FROM raw_ind
  WHERE location_confidence IN ('Low', 'Medium', 'High', 'LOCATION CONFIDENCE NOT AVAILABLE')
    AND provider_type IN ('PCP', 'Physician Specialists', 'Other Providers')
    AND npi IS NOT NULL AND state IS NOT NULL AND fips IS NOT NULL)"""

_ORG = """
raw_org AS (
  SELECT CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 5 END AS BIGINT)
      AS raw_network_id,
    s_suppkey AS npi, 'Organization' AS type, ' ' || lower(s_name) AS presentation_name,
    CASE l_returnflag WHEN 'A' THEN lower(s_name) || ' ' ELSE s_name END AS address,
    upper(trim(s_name)) AS address_key, 'Org' AS parent_org,
    CASE WHEN l_tax > 0 THEN CAST(l_partkey AS VARCHAR) END AS specialty_code,
    CASE WHEN l_discount = 0 THEN 'None' WHEN l_quantity < 10 THEN 'Ancillary'
      ELSE 'Hospital' END AS provider_type,
    lower(county_name) AS city, state, lpad(CAST(fips * 37 AS VARCHAR), 5, '0') AS zip_code,
    county_name, fips, 'Acute Care' AS specialty,
    CASE l_linestatus WHEN 'O' THEN 'Active' ELSE 'Closed' END AS status
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN places ON s_nationkey = n_nationkey),
org AS (
  SELECT * FROM raw_org
  WHERE upper(status) = 'ACTIVE' AND provider_type <> 'None'
    AND specialty_code IS NOT NULL AND address IS NOT NULL)"""

_IND_SCORES = """
raw_ind_scores AS (
  SELECT user_id AS npi, provider_type, fips,
    CASE WHEN provider_type = 'PCP' THEN 'PCP'
      ELSE 'S' || CAST(event_id % 7 AS VARCHAR) END AS score_key,
    CASE WHEN event_type <> 'error' THEN floor(value) / 100.0::DOUBLE END AS quality,
    CASE WHEN event_type <> 'signup' THEN k * 5 / 100.0::DOUBLE END AS cost,
    k AS ma_util, floor(value / 5.0::DOUBLE) AS ffs_util,
    (500 - floor(value)) / 100.0::DOUBLE AS npi_score,
    CASE event_type WHEN 'view' THEN 'Green' WHEN 'purchase' THEN 'Green'
      WHEN 'click' THEN 'Yellow' WHEN 'signup' THEN 'Not available' END AS colour
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k FROM events)
    JOIN cust ON user_id = c_custkey),
ind_scores AS (
  SELECT npi, provider_type, fips, score_key, quality, cost, ma_util, ffs_util, npi_score, colour
  FROM raw_ind_scores
  QUALIFY row_number() OVER (PARTITION BY npi, provider_type, fips, score_key
    ORDER BY quality DESC NULLS LAST, cost DESC NULLS LAST, ma_util DESC NULLS LAST,
      ffs_util DESC NULLS LAST, npi_score DESC NULLS LAST, colour DESC NULLS LAST) = 1)"""

_ORG_SCORES = """
org_scores AS (
  SELECT s_suppkey AS npi, upper(s_name) AS address_key, state, fips,
    CASE WHEN s_acctbal >= 0 THEN step / 100.0::DOUBLE END AS quality,
    (500 - step) / 100.0::DOUBLE AS cost, floor(s_acctbal / 100.0::DOUBLE) AS ma_util,
    floor(s_acctbal / 200.0::DOUBLE) AS ffs_util
  FROM (SELECT *, floor(s_acctbal / 20.0::DOUBLE) AS step FROM supplier)
    JOIN places ON s_nationkey = n_nationkey
  WHERE state <> 'ASIA')"""

_NAMES = """
names AS (
  SELECT upper(s_name) AS name_key, min('Facility ' || CAST(s_suppkey AS VARCHAR)) AS facility
  FROM supplier WHERE s_acctbal >= 3000 GROUP BY 1)"""

# The four requests; each leaves the counties of one region out.
_REQ = """
req(req_id, client_id, left_out) AS (
  VALUES ('Req_1', 8, 'EUROPE'), ('Req_2', 45, 'AFRICA'), ('Req_3', 5, 'ASIA'),
    ('Req_4', 7, 'AMERICA')),
counties AS (SELECT req_id, fips FROM req JOIN places ON state <> left_out),
members(req_id, network_id, network_name, raw_network_id) AS (
  VALUES ('Req_1', '1_2', 'Org A HMO', 1), ('Req_1', '2_2', 'Org B HMO', 2),
    ('Req_1', '5_2', 'Org E HMO', 5), ('Req_2', '3_2', 'Org C HMO', 3),
    ('Req_2', '3_2', 'Org C HMO', 4), ('Req_2', '1_2', 'Org A HMO', 1),
    ('Req_2', '1_2', 'Org A HMO', 2), ('Req_3', '5_2', 'Org E HMO', 5),
    ('Req_3', '4_2', 'Org D HMO', 4), ('Req_3', '2_2', 'Org B HMO', 2),
    ('Req_4', '4_2', 'Org D HMO', 4), ('Req_4', '3_2', 'Org C HMO', 3)),
pairs(req_id, pair_idx, base_id, compare_id) AS (
  VALUES ('Req_1', 1, '1_2', '2_2'), ('Req_1', 2, '1_2', '5_2'), ('Req_2', 1, '3_2', '1_2'),
    ('Req_3', 1, '5_2', '4_2'), ('Req_3', 2, '5_2', '2_2'), ('Req_4', 1, '4_2', '3_2'))"""


def _paired(name: str, rows: str) -> str:
    """Both networks of every pairing put together, in the requested counties."""
    return f"""
{name} AS (
  SELECT p.req_id, p.pair_idx, p.base_id, p.compare_id, m.network_id, m.network_name,
    CASE WHEN m.network_id = p.base_id THEN 'base_' ELSE '' END
      || 'Compare_' || CAST(p.pair_idx AS VARCHAR) AS base_compare, r.*
  FROM pairs p
    JOIN members m ON m.req_id = p.req_id AND m.network_id IN (p.base_id, p.compare_id)
    JOIN {rows} r ON r.raw_network_id = m.raw_network_id
    JOIN counties c ON c.req_id = p.req_id AND c.fips = r.fips)"""


_IND_KEY = "npi, state, fips, provider_type"
_ORG_KEY = "npi, state, fips, address_key, provider_type, specialty_code"
_IND_COUNTY_KEY = "npi, state, county_name, provider_type"
_ORG_COUNTY_KEY = "npi, state, county_name, address_key, provider_type, specialty_code"


def _flagged(name: str, rows: str, key: str) -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN count(DISTINCT network_id) OVER (PARTITION BY req_id, pair_idx, {key}) > 1
    THEN 'common' ELSE 'unique' END AS common_unique
  FROM {rows})"""


def _members(name: str, rows: str, key: str) -> str:
    """Y/N flags: in two networks, or listed by this very network."""
    many = f"count(DISTINCT network_id) OVER (PARTITION BY req_id, pair_idx, {key}) > 1"
    return f"""
{name} AS (
  SELECT *,
    CASE WHEN {many} OR network_id = base_id THEN 'Y' ELSE 'N' END AS in_base,
    CASE WHEN {many} OR network_id = compare_id THEN 'Y' ELSE 'N' END AS in_compare
  FROM {rows})"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + select


_IND_ALL = (_PLACES, _CUST, _IND)
_ORG_ALL = (_PLACES, _ORG)
_PAIRED_IND = (*_IND_ALL, _REQ, _paired("paired_ind", "ind"))
_PAIRED_ORG = (*_ORG_ALL, _REQ, _paired("paired_org", "org"))
_LISTED = """
listed_ind AS (SELECT * FROM ind WHERE upper(specialty) IN ('S1', 'S3', 'S5'))"""


def _counts(rows: str, flag: str, counted: str) -> str:
    """Distinct providers per county, added up over counties."""
    return f"""
SELECT req_id, network_id, network_name, common_unique, base_compare, flag,
  CAST(sum(n) AS BIGINT) AS npi_count
FROM (
  SELECT req_id, network_id, network_name, common_unique, base_compare, {flag} AS flag,
    state, fips, count(DISTINCT {counted}) AS n
  FROM {rows} GROUP BY ALL)
GROUP BY ALL"""


_IND_COUNTS = _counts("flagged_ind", "provider_type", "npi")
_ORG_COUNTS = _counts("flagged_org", "provider_type", "(npi, address_key, specialty_code)")
_FLAGGED_IND = _flagged("flagged_ind", "paired_ind", _IND_KEY)
_FLAGGED_ORG = _flagged("flagged_org", "paired_org", _ORG_KEY)

_SUPPRESSED = """
SELECT req_id, network_id, network_name, CAST(NULL AS VARCHAR) AS common_unique, base_compare,
  'Hospital' AS flag, CAST(NULL AS BIGINT) AS npi_count
FROM (VALUES ('Req_3', '4_2', 'Org D HMO', 'Compare_1'),
    ('Req_4', '4_2', 'Org D HMO', 'base_Compare_1'))
  AS s(req_id, network_id, network_name, base_compare)"""

_BLANK = """
SELECT 'Req_4' AS req_id, network_id, network_name, common_unique, base_compare,
  'Hospital' AS flag, CAST(NULL AS BIGINT) AS npi_count
FROM (VALUES ('4_2', 'Org D HMO', 'base_Compare_1'), ('3_2', 'Org C HMO', 'Compare_1'))
    AS s(network_id, network_name, base_compare)
  CROSS JOIN (VALUES ('common'), ('unique')) AS k(common_unique)
WHERE NOT EXISTS (SELECT 1 FROM flagged_org WHERE req_id = 'Req_4')"""


def _band(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 4 THEN 'High' WHEN {score} > 2 THEN 'Medium' "
        f"WHEN {score} <= 2 THEN 'Low' ELSE 'Not Available' END"
    )


_UTIL_BAND = (
    "CASE WHEN ma_util >= 80 THEN 'High' WHEN ma_util <= 40 THEN 'Low' "
    "WHEN ma_util > 40 THEN 'Medium' ELSE 'Not Available' END"
)
_BANDS = (
    f"{_band('quality')} AS quality_band, {_band('cost')} AS cost_band, "
    f"{_UTIL_BAND} AS utilization_band"
)

_IND_SCORE_JOIN = """LEFT JOIN ind_scores s ON i.npi = s.npi
    AND i.provider_type = s.provider_type AND i.fips = s.fips
    AND CASE WHEN i.provider_type = 'PCP' THEN 'PCP' ELSE i.specialty END = s.score_key"""
_ORG_SCORE_JOIN = """LEFT JOIN org_scores s ON i.npi = s.npi AND i.address_key = s.address_key
    AND i.state = s.state AND i.fips = s.fips"""


def _band_table(bands: str, group: str, names: tuple[str, str, str]) -> str:
    """One grouped query per band, put together."""
    return " UNION ALL ".join(
        f"""
SELECT {group},
  count(*) FILTER (WHERE quality_band = '{band}') AS "{names[0]}",
  count(*) FILTER (WHERE cost_band = '{band}') AS "{names[1]}",
  count(*) FILTER (WHERE utilization_band = '{band}') AS "{names[2]}", '{band}' AS band
FROM {bands} GROUP BY ALL"""
        for band in ("High", "Medium", "Low")
    )


_NETWORK_ROWS = """
net_ind AS (
  SELECT DISTINCT m.req_id, m.network_id, m.network_name, i.npi, i.state, i.fips,
    i.provider_type, i.specialty, i.location_confidence
  FROM members m JOIN ind i ON i.raw_network_id = m.raw_network_id
    JOIN counties c ON c.req_id = m.req_id AND c.fips = i.fips),
net_org AS (
  SELECT DISTINCT m.req_id, m.network_id, m.network_name, i.npi, i.state, i.fips,
    i.provider_type, i.address_key, i.specialty_code
  FROM members m JOIN org i ON i.raw_network_id = m.raw_network_id
    JOIN counties c ON c.req_id = m.req_id AND c.fips = i.fips
  WHERE i.provider_type = 'Hospital')"""

_NETWORK_BANDS = f"""
network_bands AS (
  SELECT i.req_id, i.network_id, i.network_name, i.provider_type, {_BANDS}
  FROM net_ind i {_IND_SCORE_JOIN}
  UNION ALL
  SELECT i.req_id, i.network_id, i.network_name, i.provider_type, {_BANDS}
  FROM net_org i {_ORG_SCORE_JOIN})"""


def _benchmark(rows: str, balance: str, provider_type: str) -> str:
    amount = f"CASE WHEN {balance} >= 0 THEN {balance} / 2000.0::DOUBLE END"
    return f"""
  SELECT fips, {provider_type} AS provider_type, {_band(amount)} AS band,
    count(*) AS quality, count(*) FILTER (WHERE {balance} >= 3000) AS cost,
    count(*) FILTER (WHERE {balance} < 8000) AS utilization
  FROM {rows} GROUP BY ALL"""


_MARKET = f"""
market AS ({_benchmark("cust", "c_acctbal", "provider_type")}
  UNION ALL {_benchmark("supplier JOIN places ON s_nationkey = n_nationkey", "s_acctbal", "'Hospital'")}),
benchmark_totals AS (
  SELECT req_id, provider_type, band, CAST(sum(quality) AS BIGINT) AS quality,
    CAST(sum(cost) AS BIGINT) AS cost, CAST(sum(utilization) AS BIGINT) AS utilization,
    '' AS network_id, 'Common Counties' AS network_name
  FROM market JOIN counties USING (fips) WHERE band <> 'Not Available'
  GROUP BY req_id, provider_type, band)"""


def _title(col: str) -> str:
    runs = f"regexp_extract_all({col}, '([A-Za-z]+|[^A-Za-z]+)')"
    return (
        f"array_to_string(list_transform({runs}, "
        f"lambda r: upper(r[1:1]) || lower(r[2:])), '')"
    )


def _title_na(col: str) -> str:
    return f"CASE WHEN {col} IS NULL OR {col} = '' THEN 'NA' ELSE {_title(col)} END"


def _text_na(col: str) -> str:
    return f"CASE WHEN {col} IS NULL OR {col} IN ('', 'nan', 'None', 'NaN') THEN 'NA' ELSE {col} END"


def _score(col: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), 'NA')"


_TIN = "coalesce(CAST(CAST(TRY_CAST(group_tin AS DOUBLE) AS BIGINT) AS VARCHAR), 'NA')"
_CONFIDENCE = (
    "CASE WHEN colour IS NULL OR lower(colour) = 'not available' THEN 'NA' ELSE colour END"
)
_FLAG = _text_na("coalesce(specialty_flag, 'Not Applicable')")

_EXPORT_ROWS = (
    _members("member_ind", "paired_ind", _IND_COUNTY_KEY)
    + ","
    + _members("member_org", "paired_org", _ORG_COUNTY_KEY)
    + f""",
export_ind AS (
  SELECT i.req_id, i.pair_idx, type AS "Type", i.npi AS "NPI",
    {_title_na("first_name")} AS "First Name", {_title_na("last_name")} AS "Last Name",
    {_title_na("presentation_name")} AS "Presentation Name",
    {_title_na("address")} AS "Address First Line", zip_code AS "Zip Code",
    {_title_na("city")} AS "City", i.state AS "State", {_title_na("county_name")} AS "County",
    i.fips AS "FIPS State County Code",
    {_title_na("location_confidence_address")} AS "Location Confidence Address level",
    {_title("location_confidence")} AS "Location Confidence County Level",
    i.provider_type AS "Provider Type", i.specialty AS "Specialty Name",
    {_FLAG} AS "Specialty Flag", {_TIN} AS "Group TIN",
    {_text_na("trim(group_name)")} AS "Group Name",
    in_base AS "In Base Network", in_compare AS "In Compare Network",
    {_score("npi_score")} AS "NPI Score", {_score("cost")} AS "Cost Score",
    {_score("quality")} AS "Quality Score", {_score("ffs_util")} AS "FFS Utilization Score",
    {_score("ma_util")} AS "MA Utilization Score", {_CONFIDENCE} AS "NPI Score Confidence"
  FROM member_ind i {_IND_SCORE_JOIN}),
export_org AS (
  SELECT i.req_id, i.pair_idx, type AS "Type", i.npi AS "NPI",
    coalesce(facility, {_title("upper(trim(presentation_name))")}) AS "Presentation Name",
    {_title_na("trim(address)")} AS "Address First Line", address AS raw_address,
    zip_code AS "Zip Code", {_title_na("city")} AS "City", i.state AS "State",
    {_title_na("county_name")} AS "County", i.fips AS "FIPS State County Code",
    i.provider_type AS "Provider Type", i.specialty AS "Specialty Name",
    in_base AS "In Base Network", in_compare AS "In Compare Network",
    {_score("cost")} AS "Cost Score", {_score("quality")} AS "Quality Score",
    {_score("ffs_util")} AS "FFS Utilization Score",
    {_score("ma_util")} AS "MA Utilization Score", 'NA' AS "NPI Score Confidence"
  FROM member_org i {_ORG_SCORE_JOIN}
    LEFT JOIN names ON upper(trim(presentation_name)) = name_key
  WHERE i.provider_type = 'Hospital'),
export_all AS (
  SELECT * FROM export_ind
  UNION ALL BY NAME
  SELECT * EXCLUDE (raw_address), 'NA' AS "First Name", 'NA' AS "Last Name",
    'High' AS "Location Confidence Address level", 'High' AS "Location Confidence County Level",
    'Not Applicable' AS "Specialty Flag", 'NA' AS "Group TIN", 'NA' AS "Group Name",
    'NA' AS "NPI Score"
  FROM export_org)"""
)

_EXPORT_PARTS = (
    _PLACES,
    _CUST,
    _IND,
    _ORG,
    _IND_SCORES,
    _ORG_SCORES,
    _NAMES,
    _REQ,
    _paired("paired_ind", "ind"),
    _paired("paired_org", "org"),
    _EXPORT_ROWS,
)

_FRONT = ["Type", "NPI"]
_PERSON = ["First Name", "Last Name"]
_WHERE = ["Zip Code", "City", "State", "County", "FIPS State County Code"]
_KIND = ["Provider Type", "Specialty Name"]
_COUNTY_CONFIDENCE = ["Location Confidence County Level"]
_GROUP = ["Group TIN", "Group Name"]
_FOUR_SCORES = ["Cost Score", "Quality Score", "FFS Utilization Score", "MA Utilization Score"]
_CONF = ["NPI Score Confidence"]

_CLIENT_COLUMNS = {
    8: (
        [*_FRONT, *_PERSON, "Presentation Name", "Address First Line", *_WHERE]
        + ["Location Confidence Address level", *_COUNTY_CONFIDENCE, *_KIND, "Specialty Flag"]
        + _GROUP,
        ["NPI Score", *_FOUR_SCORES, *_CONF],
    ),
    45: (
        [*_FRONT, *_PERSON, "Presentation Name", *_WHERE, *_COUNTY_CONFIDENCE, *_KIND]
        + ["Specialty Flag"],
        ["NPI Score", *_FOUR_SCORES, *_CONF],
    ),
    5: (
        [*_FRONT, *_PERSON, "Presentation Name", *_WHERE, *_COUNTY_CONFIDENCE, *_KIND]
        + ["Specialty Flag", *_GROUP],
        ["NPI Score", *_FOUR_SCORES, *_CONF],
    ),
    7: (
        [*_FRONT, *_PERSON, "Presentation Name", *_WHERE, *_KIND],
        ["NPI Score", *_CONF],
    ),
}


def _client_view(client_id: int, req_id: str, pair_idx: int, base: str, compare: str) -> str:
    front, scores = _CLIENT_COLUMNS[client_id]
    columns = ", ".join(f'"{c}"' for c in front)
    score_columns = ", ".join(f'"{c}"' for c in scores)
    return f"""
SELECT DISTINCT {columns}, "In Base Network" AS "{base}", "In Compare Network" AS "{compare}",
  {score_columns}
FROM export_all WHERE req_id = '{req_id}' AND pair_idx = {pair_idx}"""


_ALL_COLUMNS = [*_CLIENT_COLUMNS[8][0], "In Base Network", "In Compare Network"] + (
    _CLIENT_COLUMNS[8][1]
)


def _batch_export() -> str:
    """The rows of each request in the columns of its client, other columns null."""
    parts = []
    for req_id, client_id in (("Req_1", 8), ("Req_2", 45), ("Req_3", 5), ("Req_4", 7)):
        shown = [*_CLIENT_COLUMNS[client_id][0], *_CLIENT_COLUMNS[client_id][1]]
        columns = ", ".join(
            f'"{c}"' if c in shown or c.startswith("In ") else f'CAST(NULL AS VARCHAR) AS "{c}"'
            for c in _ALL_COLUMNS
        )
        parts.append(
            f"""
SELECT req_id, pair_idx, CAST({client_id} AS INTEGER) AS client_id, {columns},
  bool_or("Quality Score" <> 'NA' OR "Cost Score" <> 'NA') AS is_scored
FROM (SELECT *, "Cost Score" AS c, "Quality Score" AS q FROM export_all)
WHERE req_id = '{req_id}' GROUP BY ALL"""
        )
    return " UNION ALL ".join(parts)


_ORG_COLUMNS = [*_FRONT, "Presentation Name", "Address First Line", *_WHERE, *_KIND]


def _organization_batch() -> str:
    columns = ", ".join(f'"{c}"' for c in _ORG_COLUMNS)
    utilization = ", ".join(
        f'CASE WHEN client_id IN (45, 8, 5) THEN "{c}" END AS "{c}"'
        for c in ("FFS Utilization Score", "MA Utilization Score")
    )
    return f"""
SELECT DISTINCT req_id, pair_idx, client_id, {columns}, "In Base Network", "In Compare Network",
  "Cost Score", "Quality Score", {utilization}, "NPI Score Confidence",
  "Quality Score" <> 'NA' OR "Cost Score" <> 'NA' AS is_scored
FROM export_org JOIN req USING (req_id)"""


_ORG_VIEW = f"""
SELECT DISTINCT {", ".join(f'"{c}"' for c in _ORG_COLUMNS)},
  "In Base Network" AS "Org E HMO", "In Compare Network" AS "Org B HMO",
  {", ".join(f'"{c}"' for c in _FOUR_SCORES)}, "NPI Score Confidence"
FROM export_org WHERE req_id = 'Req_3' AND pair_idx = 2"""


def _presence(rows: str, key: str) -> str:
    return f"SELECT DISTINCT req_id, pair_idx, {key}, in_base, in_compare FROM {rows}"


def _flag_rows(rows: str, key: str) -> str:
    return f"""
SELECT DISTINCT req_id, pair_idx, {key}, network_id, network_name, base_compare, common_unique
FROM {rows}"""


_BANDED_NETWORKS = f"""
banded AS (
  SELECT i.raw_network_id, i.provider_type, {_BANDS}
  FROM (SELECT DISTINCT raw_network_id, npi, provider_type, fips, specialty FROM ind) i
    {_IND_SCORE_JOIN})"""
_BANDED = (_PLACES, _CUST, _IND, _IND_SCORES, _BANDED_NETWORKS)
_NUMBERS = ("quality", "cost", "utilization")

ORACLE_SQL: dict[str, str] = {
    "scan_individuals": _with(
        *_IND_ALL,
        select="""
SELECT raw_network_id, npi, state, fips, county_name, provider_type, specialty,
  location_confidence, zip_code, group_tin FROM ind""",
    ),
    "scan_organizations": _with(
        *_ORG_ALL,
        select="""
SELECT raw_network_id, npi, address_key, state, fips, provider_type, specialty_code, status,
  parent_org, specialty, CAST(NULL AS VARCHAR) AS group_tin FROM org""",
    ),
    "exclude_codes": _with(
        *_ORG_ALL,
        select="""
SELECT raw_network_id, npi, specialty_code, provider_type FROM org
WHERE specialty_code NOT IN (
  SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size IN (3, 9, 14, 27, 41))""",
    ),
    "request_parse": """
SELECT 'R' || CAST(o_orderkey AS VARCHAR) AS req_id,
  CASE WHEN o_orderstatus = 'P' THEN 'compare ids and names differ in length'
    ELSE 'accepted' END AS outcome,
  substr(o_orderpriority, 1, 1) || '_2' AS base_id,
  CASE WHEN o_orderstatus <> 'P' THEN '7_2|8_2' END AS compare_ids,
  CAST(CASE WHEN o_custkey = o_orderkey THEN 1 ELSE 2 END AS BIGINT) AS n_counties,
  CAST(CASE WHEN o_orderstatus <> 'P' THEN 5 END AS BIGINT) AS n_raw_networks,
  CASE WHEN o_orderstatus <> 'P'
    THEN 'Org ' || substr(o_orderpriority, 1, 1) || ' HMO|Org G HMO|Org H HMO' END
    AS network_names
FROM orders""",
    "request_members": _with(
        *_IND_ALL,
        _REQ,
        select="""
SELECT m.req_id, m.network_id, m.network_name, CAST(m.raw_network_id AS BIGINT) AS raw_network_id,
  count(*) AS n_rows
FROM members m JOIN ind i ON i.raw_network_id = m.raw_network_id
  JOIN counties c ON c.req_id = m.req_id AND c.fips = i.fips
GROUP BY ALL""",
    ),
    "county_filter": _with(
        *_ORG_ALL,
        _REQ,
        select="""
SELECT raw_network_id, fips, count(*) AS n_rows FROM org
WHERE fips IN (SELECT fips FROM counties)
  AND raw_network_id IN (SELECT raw_network_id FROM members)
GROUP BY ALL""",
    ),
    "specialty_filter": _with(
        *_IND_ALL, _LISTED, select="\nSELECT raw_network_id, npi, fips, specialty FROM listed_ind"
    ),
    "score_dedup": _with(_PLACES, _CUST, _IND_SCORES, select="\nSELECT * FROM ind_scores"),
    "score_dedup_organization": _with(
        _PLACES, _ORG_SCORES, select="\nSELECT * FROM org_scores"
    ),
    "score_join_individual": _with(
        *_IND_ALL,
        _IND_SCORES,
        select=f"""
SELECT i.npi, i.provider_type, i.fips,
  CASE WHEN i.provider_type = 'PCP' THEN 'PCP' ELSE i.specialty END AS score_key,
  i.raw_network_id, i.specialty, quality, cost, ma_util, ffs_util, npi_score, colour
FROM (SELECT DISTINCT raw_network_id, npi, provider_type, fips, specialty FROM ind) i
  {_IND_SCORE_JOIN}""",
    ),
    "score_join_organization": _with(
        *_ORG_ALL,
        _ORG_SCORES,
        select=f"""
SELECT i.npi, i.address_key, i.state, i.fips, i.raw_network_id, i.specialty_code,
  quality, cost, ma_util, ffs_util
FROM (SELECT DISTINCT raw_network_id, npi, address_key, state, fips, specialty_code FROM org) i
  {_ORG_SCORE_JOIN}""",
    ),
    "facility_lookup": _with(
        *_ORG_ALL,
        _NAMES,
        select=f"""
SELECT DISTINCT npi,
  coalesce(facility, {_title("upper(trim(presentation_name))")}) AS display_name
FROM org LEFT JOIN names ON upper(trim(presentation_name)) = name_key
WHERE provider_type = 'Hospital'""",
    ),
    "flag_individual": _with(
        *_PAIRED_IND, _FLAGGED_IND, select=_flag_rows("flagged_ind", _IND_KEY)
    ),
    "flag_organization": _with(
        *_PAIRED_ORG, _FLAGGED_ORG, select=_flag_rows("flagged_org", _ORG_KEY)
    ),
    "flag_specialty": _with(
        *_IND_ALL,
        _REQ,
        _LISTED,
        _paired("paired_listed", "listed_ind"),
        _flagged("flagged_listed", "paired_listed", _IND_KEY),
        select=_flag_rows("flagged_listed", _IND_KEY),
    ),
    "membership_individual": _with(
        *_PAIRED_IND,
        _members("member_ind", "paired_ind", _IND_COUNTY_KEY),
        select="\n" + _presence("member_ind", _IND_COUNTY_KEY),
    ),
    "membership_organization": _with(
        *_PAIRED_ORG,
        _members("member_org", "paired_org", _ORG_COUNTY_KEY),
        select="\n" + _presence("member_org", _ORG_COUNTY_KEY),
    ),
    "membership_full_outer": _with(
        *_PAIRED_IND,
        _members("member_ind", "paired_ind", _IND_COUNTY_KEY),
        select="\n" + _presence("member_ind", _IND_COUNTY_KEY),
    ),
    "common_semi_unique_anti": _with(
        *_PAIRED_IND,
        _FLAGGED_IND,
        select=f"""
SELECT DISTINCT req_id, pair_idx, {_IND_KEY}, common_unique FROM flagged_ind
WHERE network_id = base_id""",
    ),
    "individual_counts": _with(*_PAIRED_IND, _FLAGGED_IND, select=_IND_COUNTS),
    "organization_counts": _with(*_PAIRED_ORG, _FLAGGED_ORG, select=_ORG_COUNTS),
    "provider_counts": _with(
        *_PAIRED_IND,
        _FLAGGED_IND,
        _ORG,
        _paired("paired_org", "org"),
        _FLAGGED_ORG,
        select=f"{_IND_COUNTS} UNION ALL {_ORG_COUNTS} UNION ALL {_SUPPRESSED}",
    ),
    "specialty_counts": _with(
        *_IND_ALL,
        _REQ,
        _LISTED,
        _paired("paired_listed", "listed_ind"),
        _flagged("flagged_listed", "paired_listed", _IND_KEY),
        select=_counts("flagged_listed", "specialty", "npi"),
    ),
    "count_grid": _with(
        *_PAIRED_ORG, _FLAGGED_ORG, select=f"{_ORG_COUNTS} UNION ALL {_BLANK}"
    ),
    "suppressed_placeholder": _with(
        *_PAIRED_ORG, _FLAGGED_ORG, select=f"{_ORG_COUNTS} UNION ALL {_SUPPRESSED}"
    ),
    "score_bands": _with(
        _PLACES,
        _CUST,
        _IND_SCORES,
        select=f"\nSELECT npi, provider_type, fips, score_key, {_BANDS} FROM ind_scores",
    ),
    "band_counts": _with(
        *_BANDED,
        select="\nSELECT raw_network_id, provider_type, "
        + ", ".join(
            f"count(*) FILTER (WHERE {m}_band = '{b}') AS \"{m}_{b}\""
            for m in _NUMBERS
            for b in ("High", "Medium", "Low")
        )
        + " FROM banded GROUP BY ALL",
    ),
    "band_long": _with(
        *_BANDED, select=_band_table("banded", "raw_network_id, provider_type", _NUMBERS)
    ),
    "market_benchmark": _with(
        _PLACES,
        _CUST,
        _REQ,
        _MARKET,
        select="""
SELECT req_id, provider_type, band, quality, cost, utilization, network_id, network_name
FROM benchmark_totals""",
    ),
    "performance_indicators": _with(
        _PLACES,
        _CUST,
        _IND,
        _ORG,
        _IND_SCORES,
        _ORG_SCORES,
        _REQ,
        _NETWORK_ROWS,
        _NETWORK_BANDS,
        _MARKET,
        ' report AS ('
        + _band_table(
            "network_bands",
            'req_id, network_id, network_name, provider_type AS "New Flag"',
            ("Quality Score", "Cost Score", "Utilization Score"),
        )
        + ")",
        select="""
SELECT req_id, network_id, network_name, "Quality Score", "Cost Score", "Utilization Score",
  "New Flag", band AS "Scoring Category" FROM report
UNION ALL
SELECT req_id, network_id, network_name, quality, cost, utilization, provider_type, band
FROM benchmark_totals""",
    ),
    "organization_export": _with(*_EXPORT_PARTS, select=_organization_batch()),
    "individual_export": _with(*_EXPORT_PARTS, select=_batch_export()),
    "export_client_8": _with(
        *_EXPORT_PARTS, select=_client_view(8, "Req_1", 2, "Org A HMO", "Org E HMO")
    ),
    "export_client_45": _with(
        *_EXPORT_PARTS, select=_client_view(45, "Req_2", 1, "Org C HMO", "Org A HMO")
    ),
    "export_client_5": _with(
        *_EXPORT_PARTS, select=_client_view(5, "Req_3", 2, "Org E HMO", "Org B HMO")
    ),
    "export_client_other": _with(
        *_EXPORT_PARTS, select=_client_view(7, "Req_4", 1, "Org D HMO", "Org C HMO")
    ),
    "organization_export_client_5": _with(*_EXPORT_PARTS, select=_ORG_VIEW),
    "title_case": f"""
SELECT p_partkey,
  {_title("p_name || '-' || p_type || '-' || CAST(p_size AS VARCHAR) || p_brand")} AS title
FROM part""",
    "text_normalise": _with(
        *_IND_ALL,
        select=f"""
SELECT fips, {_TIN} AS group_tin, {_text_na("trim(group_name)")} AS group_name,
  {_FLAG} AS specialty_flag, {_title_na("last_name")} AS last_name,
  {_title_na("location_confidence_address")} AS confidence, {_text_na("zip_code")} AS zip_code,
  count(*) AS n_rows
FROM raw_ind GROUP BY ALL""",
    ),
    "score_text": _with(
        _PLACES,
        _CUST,
        _IND_SCORES,
        select=f"""
SELECT npi, {_score("quality")} AS quality, {_score("cost")} AS cost, {_CONFIDENCE} AS colour,
  count(*) AS n_rows
FROM raw_ind_scores GROUP BY ALL""",
    ),
    "score_descriptions": """
SELECT l_returnflag, CASE l_linenumber WHEN 1 THEN 'Performing Greatly Below Benchmark'
    WHEN 2 THEN 'Performing Below Benchmark' WHEN 3 THEN 'Performing at Benchmark'
    WHEN 4 THEN 'Performing Above Benchmark' WHEN 5 THEN 'Performing Greatly Above Benchmark'
  END AS description, count(*) AS n_rows
FROM lineitem GROUP BY ALL""",
    "pairing_labels": _with(
        *_PAIRED_IND,
        select="""
SELECT req_id, base_compare, raw_network_id, count(*) AS n_rows FROM paired_ind GROUP BY ALL""",
    ),
    "sources_of_requests": _with(
        _PLACES,
        _CUST,
        _IND,
        _ORG,
        _REQ,
        select="""
SELECT s.source, CAST(a.raw_network_id AS BIGINT) AS raw_network_id,
  count(h.source) AS n_rows, count(*) FILTER (WHERE h.ok) AS n_reportable,
  count(*) FILTER (WHERE h.ok AND h.no_key) AS n_without_key,
  CASE WHEN count(h.source) = 0 THEN 'missing' ELSE 'read' END AS status
FROM (SELECT DISTINCT raw_network_id FROM members) a
  CROSS JOIN (VALUES ('individual'), ('organization')) AS s(source)
  LEFT JOIN (
    SELECT 'individual' AS source, raw_network_id,
      location_confidence IN ('Low', 'Medium', 'High', 'LOCATION CONFIDENCE NOT AVAILABLE')
        AND provider_type IN ('PCP', 'Physician Specialists', 'Other Providers') AS ok,
      npi IS NULL OR state IS NULL OR fips IS NULL OR provider_type IS NULL AS no_key
    FROM raw_ind
    UNION ALL
    SELECT 'organization', raw_network_id, upper(status) = 'ACTIVE' AND provider_type <> 'None',
      npi IS NULL OR state IS NULL OR fips IS NULL OR address_key IS NULL
        OR specialty_code IS NULL
    FROM raw_org) h ON h.raw_network_id = a.raw_network_id AND h.source = s.source
GROUP BY ALL""",
    ),
}
