"""Bill dimensions: bills, sponsors, subjects, committees.

The parts of a bill are JSON texts, or variants where :func:`hemicycle.plans.staging.stage_parsed_bills` made them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.json import array_at, is_variant, scalar_at
from hemicycle.functions.keys import bill_name, bill_url, surrogate_key
from hemicycle.operators.dedupe import top_per_group


def _version_order(bills: DataFrame) -> list[Column]:
    area = F.to_json("policyArea") if is_variant(bills, "policyArea") else F.col("policyArea")
    return [
        F.desc_nulls_last("updateDateIncludingText"),
        F.desc_nulls_last("updateDate"),
        F.asc_nulls_first("title"),
        F.asc_nulls_first("introducedDate"),
        area.asc_nulls_first(),
    ]


def dim_bills(bills: DataFrame) -> DataFrame:
    """Latest version of each bill, with name and link."""
    narrow = bills.select(
        "bill_key", "number", "type", "congress", "title", "policyArea", "updateDate", "updateDateIncludingText",
        "introducedDate",
    )
    return top_per_group(narrow, ["bill_key"], _version_order(bills)).select(
        "bill_key",
        bill_name("type", "number").alias("bill_name"),
        "number",
        "type",
        "title",
        F.expr("try_cast(congress as bigint)").alias("congress"),
        bill_url("congress", "type", "number").alias("url"),
        scalar_at(bills, "policyArea", "$.name").alias("policyArea"),
        "updateDateIncludingText",
        F.expr("try_cast(introducedDate as date)").alias("introducedDate"),
    )


def _items(bills: DataFrame, col: str, path: str = "$.item") -> DataFrame:
    return bills.select("bill_key", F.explode(array_at(bills, col, path)).alias("item"))


def dim_sponsors(bills: DataFrame) -> DataFrame:
    """Member and role per bill. A member may hold both roles; each role is listed once."""

    def role(col: str, name: str) -> Column:
        return F.transform(array_at(bills, col, "$.item"), lambda item: F.struct(item.alias("item"), F.lit(name).alias("sponsor_type")))

    # Both roles in one pass over the bills, which are wide or made from texts; a part that is missing is null.
    roles = F.flatten(F.filter(F.array(role("sponsors", "Sponsor"), role("cosponsors", "Cosponsor")), lambda r: r.isNotNull()))
    items = bills.select("bill_key", F.explode(roles).alias("held")).select("bill_key", "held.*")
    return items.select("bill_key", scalar_at(items, "item", "$.bioguideId").alias("bioguideID"), "sponsor_type").distinct()


def dim_bill_subjects(bills: DataFrame) -> DataFrame:
    items = _items(bills, "subjects", "$.legislativeSubjects.item")
    return items.select("bill_key", scalar_at(items, "item", "$.name").alias("subject")).distinct()


def dim_committees(bills: DataFrame) -> DataFrame:
    items = _items(bills, "committees")
    named = items.select(*[scalar_at(items, "item", f"$.{c}").alias(c) for c in ("chamber", "name", "systemCode")])
    return named.distinct().withColumn("committee_key", surrogate_key("name"))


def bill_committee_bridge(bills: DataFrame) -> DataFrame:
    items = _items(bills, "committees")
    named = items.select("bill_key", *[scalar_at(items, "item", f"$.{c}").alias(c) for c in ("chamber", "name")])
    return named.distinct().withColumn("committee_key", surrogate_key("name"))
