"""Comparison requests as tables: one job evaluates every request and pairing.

A request names a base network, one or more compare networks and a set of counties. Its
texts are parsed with column expressions only, so a table of requests of any length is
handled like any other table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.labels import (
    network_id,
    network_name,
    trimmed_list,
    whole_numbers,
)
from rosterlens.functions.scores import whole_number
from rosterlens.operators.broadcast import BLOCK_ROWS, ROW_LIMIT, blocks, keep_listed, small_side
from rosterlens.operators.lineage import cut_lineage

_NETWORKS = "map<string, struct<parentOrganization:string, planBidIds:string, networkIds:string>>"

# A release is a folder below the data root and nothing else.
_NO_FOLDER = r"(^|/)\.\.?(/|$)|[:*?\[\]{}\\]|^/"


def _holds_null(array) -> F.Column:
    return F.exists(array, lambda x: x.isNull())


def _networks(ids, names, members) -> F.Column:
    """Array of networks from parallel arrays of ids and names and the map of members."""

    def network(pair):
        entry = F.try_element_at(members, pair["id"])
        return F.struct(
            network_id(pair["id"], F.col("plan_type_id")).alias("network_id"),
            network_name(pair["name"], F.col("plan_type")).alias("network_name"),
            whole_numbers(entry["networkIds"]).alias("raw_network_ids"),
        )

    zipped = F.arrays_zip(ids.alias("id"), names.alias("name"))
    return F.transform(zipped, network)


def _merged(networks) -> F.Column:
    """One entry per network id: first name given, all raw networks of the id."""
    ids = F.array_distinct(F.transform(networks, lambda n: n["network_id"]))

    def merge(one_id):
        same = F.filter(networks, lambda n: n["network_id"] == one_id)
        return F.struct(
            one_id.alias("network_id"),
            F.element_at(same, 1)["network_name"].alias("network_name"),
            F.array_distinct(
                F.flatten(F.transform(same, lambda n: n["raw_network_ids"]))
            ).alias("raw_network_ids"),
        )

    return F.transform(ids, merge)


def parse_requests(raw: DataFrame) -> DataFrame:
    """Parsed requests, one row each; ``reason`` tells why a request was rejected.

    A request listed twice counts once; two different requests under one id are rejected.
    """
    row = F.struct(*[c for c in raw.columns if c != "id"])
    parsed = (
        raw.groupBy("id")
        .agg(F.min(row).alias("row"), F.max(row).alias("last"))
        .select("id", "row.*", (F.col("row") != F.col("last")).alias("ambiguous"))
        .select(
            F.col("id").alias("req_id"),
            whole_number(F.col("clientID")).try_cast("int").alias("client_id"),
            F.coalesce(F.trim("filespath"), F.lit("")).alias("release"),
            F.trim("planTypeId").alias("plan_type_id"),
            F.col("planType").alias("plan_type"),
            whole_numbers(F.col("county")).alias("counties"),
            F.array(F.trim("baseParentOrgId")).alias("base_ids"),
            F.array(F.trim("baseParentOrg")).alias("base_names"),
            trimmed_list(F.col("compareParentOrgId"), ",").alias("compare_ids"),
            trimmed_list(F.col("compareParentOrg"), r"\|").alias("compare_names"),
            F.from_json("base", _NETWORKS).alias("base_map"),
            F.from_json("compare", _NETWORKS).alias("compare_map"),
            "ambiguous",
        )
        .withColumn(
            "same_length", F.size("compare_ids") == F.size("compare_names")
        )
        .withColumn("base", _networks(F.col("base_ids"), F.col("base_names"), F.col("base_map")))
        .withColumn(
            "compares",
            _networks(F.col("compare_ids"), F.col("compare_names"), F.col("compare_map")),
        )
        .withColumn("networks", F.concat("base", "compares"))
    )

    def unusable(network):
        members = network["raw_network_ids"]
        return members.isNull() | (F.size(members) == 0) | _holds_null(members)

    reason = (
        F.when(F.col("req_id").isNull(), "request id is missing")
        .when(F.col("ambiguous"), "request id is used twice")
        .when(F.col("client_id").isNull(), "client is not a number")
        .when(F.col("plan_type_id").isNull() | (F.col("plan_type_id") == ""), "plan type is missing")
        .when(F.col("counties").isNull() | _holds_null(F.col("counties")), "county is not a number")
        .when(F.col("base_map").isNull() | F.col("compare_map").isNull(), "networks are not JSON")
        .when(F.col("release").rlike(_NO_FOLDER), "data release is not a folder name")
        .when(F.col("compare_ids").isNull(), "compare ids are missing")
        .when(F.exists("compare_ids", lambda i: i == ""), "compare id is blank")
        .when(F.col("compare_names").isNull(), "compare names are missing")
        .when(~F.col("same_length"), "compare ids and names differ in length")
        .when(F.exists("networks", unusable), "network has no usable member ids")
    )
    return parsed.select(
        "req_id",
        "client_id",
        "release",
        "counties",
        _merged(F.col("networks")).alias("networks"),
        F.col("base")[0]["network_id"].alias("base_id"),
        F.transform("compares", lambda n: n["network_id"]).alias("compare_ids"),
        reason.alias("reason"),
    )


def _of_releases(parsed: DataFrame, releases: DataFrame) -> DataFrame:
    """Requests with the root of their release; a release with two roots is no release."""
    roots = (
        releases.groupBy(F.trim("release").alias("named"))
        .agg(F.min("root").alias("root"), F.max("root").alias("other"))
        .where("root = other")
        .drop("other")
    )
    joined = parsed.join(roots, parsed["release"] == roots["named"], "left").drop("named")
    unknown = F.when(F.col("root").isNull(), "data release is unknown")
    return joined.withColumn("reason", F.coalesce("reason", unknown))


def _listed(table: DataFrame, column: str) -> list[int]:
    """The distinct values of a column, in order, for a static filter."""
    return sorted(row[column] for row in table.select(column).distinct().collect())


class Requests:
    """The request tables of one job.

    ``releases`` names the data releases the requests are about, with their root folders as
    ``release, root``; requests about others are rejected. Without it any release is accepted.

    ``pairs``     req_id, pair_idx, client_id, base and compare id, name, raw networks, counties
    ``members``   req_id, network_id, network_name, raw_network_id
    ``sides``     req_id, pair_idx, raw_network_id, in_base, in_compare, two_networks
    ``counties``  req_id, fips
    ``rejected``  req_id, reason
    """

    def __init__(
        self,
        raw: DataFrame,
        broadcast_rows: int = ROW_LIMIT,
        block_rows: int = BLOCK_ROWS,
        releases: DataFrame | None = None,
    ):
        # Parsed once for the several tables below, which keeps their plans short as well.
        parsed = parse_requests(raw)
        if releases is not None:
            parsed = _of_releases(parsed, releases)
        self._set(cut_lineage(parsed), broadcast_rows, block_rows)

    def _set(self, parsed: DataFrame, broadcast_rows: int, block_rows: int) -> None:
        self._parsed = parsed
        self._limit = broadcast_rows
        self._block_rows = block_rows
        self.accepted = parsed.where(F.col("reason").isNull()).drop("reason")
        self.rejected = parsed.where(F.col("reason").isNotNull()).select("req_id", "reason")
        self.spark = parsed.sparkSession

    def _with(self, parsed: DataFrame) -> Requests:
        other = object.__new__(Requests)
        other._set(parsed, self._limit, self._block_rows)
        return other

    def of_release(self, release: str) -> Requests:
        """The accepted requests about one data release."""
        wanted = F.col("reason").isNull() & (F.col("release") == release)
        return self._with(self._parsed.where(wanted))

    def of_request(self, req_id: str) -> Requests:
        """One accepted request; only its networks, counties and column set are then asked for."""
        return self._with(self._parsed.where(F.col("reason").isNull() & (F.col("req_id") == req_id)))

    def reject_releases(self, releases: list[str], reason: str) -> Requests:
        """These requests, those about the given releases rejected."""
        if not releases:
            return self
        refused = F.col("reason").isNull() & F.col("release").isin(releases)
        return self._with(self._parsed.withColumn("reason", F.when(refused, reason).otherwise(F.col("reason"))))

    def release_roots(self) -> dict[str, str | None]:
        """The data releases of the accepted requests, each one folder, and their roots if given."""
        root = F.col("root") if "root" in self.accepted.columns else F.lit(None).cast("string")
        found = self.accepted.groupBy("release").agg(F.min(root).alias("root"))
        return {row["release"]: row["root"] for row in found.orderBy("release").collect()}

    @cached_property
    def pairs(self) -> DataFrame:
        def network(one_id):
            return F.element_at(F.filter("networks", lambda n: n["network_id"] == one_id), 1)

        return self.accepted.select(
            "req_id",
            "client_id",
            "base_id",
            "networks",
            "counties",
            F.posexplode("compare_ids").alias("pos", "compare_id"),
        ).select(
            "req_id",
            (F.col("pos") + 1).alias("pair_idx"),
            "client_id",
            "base_id",
            network(F.col("base_id"))["network_name"].alias("base_name"),
            network(F.col("base_id"))["raw_network_ids"].alias("base_raw"),
            "compare_id",
            network(F.col("compare_id"))["network_name"].alias("compare_name"),
            network(F.col("compare_id"))["raw_network_ids"].alias("compare_raw"),
            "counties",
        )

    @cached_property
    def members(self) -> DataFrame:
        return self.accepted.select("req_id", F.inline("networks")).select(
            "req_id",
            "network_id",
            "network_name",
            F.explode("raw_network_ids").alias("raw_network_id"),
        )

    @cached_property
    def sides(self) -> DataFrame:
        raw_networks = F.array_union("base_raw", "compare_raw")
        return self.pairs.select(
            "req_id",
            "pair_idx",
            (F.col("base_id") != F.col("compare_id")).alias("two_networks"),
            "base_raw",
            "compare_raw",
            F.explode(raw_networks).alias("raw_network_id"),
        ).select(
            "req_id",
            "pair_idx",
            "raw_network_id",
            F.array_contains("base_raw", F.col("raw_network_id")).alias("in_base"),
            F.array_contains("compare_raw", F.col("raw_network_id")).alias("in_compare"),
            "two_networks",
        )

    @cached_property
    def counties(self) -> DataFrame:
        return self.accepted.select("req_id", F.explode("counties").alias("fips"))

    @cached_property
    def rows(self) -> int:
        """Row count of the largest request table, measured once in one small job."""
        networks = F.size("compare_ids") * F.aggregate(
            "networks", F.lit(0), lambda n, network: n + F.size(network["raw_network_ids"])
        )
        counties = F.size("counties")
        total = self.accepted.agg(
            F.sum(networks.cast("bigint")).alias("networks"),
            # A pairing carries the counties of its request.
            F.sum((F.size("compare_ids") * counties).cast("bigint")).alias("counties"),
        ).first()
        return max(total["networks"] or 0, total["counties"] or 0)

    @property
    def are_small(self) -> bool:
        """Whether all request tables are small enough to be sent to every task."""
        return self.rows <= self._limit

    def small(self, table: DataFrame) -> DataFrame:
        """Hint a broadcast of a request table if all request tables are small."""
        return small_side(table, self.rows, self._limit)

    def raw_network_ids(self) -> list[int]:
        """Distinct raw networks, each the name of a folder whose files are to be read."""
        return _listed(self.members, "raw_network_id")

    def county_codes(self) -> list[int]:
        """Distinct counties, of which a country has some thousands, to skip row groups by."""
        return _listed(self.counties, "fips")

    @cached_property
    def raw_networks(self) -> DataFrame:
        """The distinct raw networks as a table, which readers join instead of collecting them."""
        return self._wanted[0]

    def restrict(self, rows: DataFrame) -> DataFrame:
        """Rows of requested raw networks in requested counties; the rows are never exchanged.

        Networks and counties are few and hot, so the lists go to the rows, whatever their length.
        Where networks are folders, the broadcast also tells the scan which of them to read.
        """
        return self.in_counties(keep_listed(rows, self._blocks[0], "raw_network_id"))

    def in_counties(self, rows: DataFrame) -> DataFrame:
        """Rows in requested counties, by a broadcast that is never larger than a block."""
        return keep_listed(rows, self._blocks[1], "fips")

    @cached_property
    def _wanted(self) -> tuple[DataFrame, DataFrame]:
        """The distinct raw networks and counties of all requests, found and written in one job.

        The kind that tells them apart is a filter on what is broadcast, and Spark prunes folders
        by a join only if it sees one.
        """
        networks = self.members.select(F.lit("network").alias("kind"), F.col("raw_network_id").alias("id"))
        counties = self.counties.select(F.lit("county").alias("kind"), F.col("fips").alias("id"))
        both = cut_lineage(networks.unionByName(counties).where("id is not null").distinct())

        def of(kind: str, name: str) -> DataFrame:
            return both.where(F.col("kind") == kind).select(F.col("id").alias(name))

        return of("network", "raw_network_id"), of("county", "fips")

    @cached_property
    def _blocks(self) -> tuple[list[DataFrame], list[DataFrame]]:
        """The distinct raw networks and counties in blocks of checked size."""
        networks, counties = self._wanted
        return (
            blocks(networks, "raw_network_id", self._block_rows),
            blocks(counties, "fips", self._block_rows),
        )
