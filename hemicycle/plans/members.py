"""Member dimensions: terms, parties, members, districts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.votes import party_group
from hemicycle.operators.dedupe import open_end_last, top_per_group
from hemicycle.operators.joins import override

#: Columns that settle which of several terms with equal years is taken.
_TERM_TIES = ("congress", "chamber", "stateCode", "district", "memberType", "stateName")


def dim_terms(terms: DataFrame) -> DataFrame:
    """One row per member, start year and chamber: the open term, else the one that ends last."""
    ties = [F.desc_nulls_last(c) for c in _TERM_TIES if c in terms.columns]
    return top_per_group(terms, ["bioguideID", "term_start_year", "chamber"], [open_end_last("term_end_year"), *ties])


def dim_party_history(members: DataFrame) -> DataFrame:
    history = members.select(F.col("bioguideId").alias("bioguideID"), F.explode("partyHistory").alias("p"))
    return history.select(
        "bioguideID", "p.partyName", "p.startYear", "p.endYear", party_group("p.partyName").alias("partyGrouped")
    ).distinct()


def most_recent_party(history: DataFrame) -> DataFrame:
    order = [F.desc_nulls_last("startYear"), F.asc_nulls_first("partyGrouped")]
    return top_per_group(history, ["bioguideID"], order).select("bioguideID", "partyGrouped")


def most_recent_chamber(terms: DataFrame, members: DataFrame) -> DataFrame:
    """The term that tells a member's chamber: latest start if serving, else latest end.

    Both candidates of a member come from one aggregate with map-side combine, before the
    join that says who is serving; the semi and anti join of the two cases become one
    outer join of frames with one row per member. Terms without a member id are left out.
    """
    # The columns that rank the terms come first, each once: the structs are sorted, so they stay narrow.
    years = ["term_start_year", "term_end_year"]
    others = [c for c in terms.columns if c not in ("bioguideID", *years, *_TERM_TIES)]
    by_start, by_end = (F.struct(*first, *_TERM_TIES, *others) for first in (years, years[::-1]))
    picked = (
        terms.filter(F.col("bioguideID").isNotNull())
        .groupBy("bioguideID")
        .agg(F.max(by_start).alias("s"), F.max(by_end).alias("e"))
    )
    serving = (
        members.filter("currentMember").select(F.col("bioguideId").alias("bioguideID"))
        .distinct().withColumn("serving", F.lit(True))
    )
    chosen = [F.when(F.col("serving"), F.col(f"s.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in terms.columns if c != "bioguideID"]
    return picked.join(serving, "bioguideID", "left").select("bioguideID", *chosen)


def senate_ids(ids: DataFrame, overrides: DataFrame) -> DataFrame:
    """Senator ids with the hand-kept corrections put in."""
    return override(ids, overrides, "bioguideID", "lisid").distinct()


def dim_members(
    members: DataFrame, terms: DataFrame, ids: DataFrame, overrides: DataFrame, history: DataFrame
) -> DataFrame:
    """Latest row of each member with chamber, Senate id and party.

    Every input is brought to one row per member before the joins, so none of them fans
    out. Of several Senate ids the smallest is kept.
    """
    latest = top_per_group(
        members.select(
            F.col("bioguideId").alias("bioguideID"), "firstName", "lastName", "invertedOrderName",
            F.col("depiction.imageUrl").alias("imageURL"), "birthYear", "deathYear", "currentMember", "updateDate",
        ),
        ["bioguideID"],
        [
            F.desc_nulls_last("updateDate"),
            *[F.asc_nulls_first(c) for c in ("invertedOrderName", "imageURL", "birthYear", "deathYear", "currentMember")],
        ],
    )
    chamber = most_recent_chamber(terms, members).select("bioguideID", F.col("chamber").alias("mostRecentChamber"))
    lisids = senate_ids(ids, overrides).groupBy("bioguideID").agg(F.min("lisid").alias("lisid"))
    party = most_recent_party(history).withColumnRenamed("partyGrouped", "mostRecentParty")
    joined = latest.join(chamber, "bioguideID", "left").join(lisids, "bioguideID", "left").join(party, "bioguideID", "left")
    return joined.select(
        "bioguideID", "firstName", "lastName", "invertedOrderName", "imageURL", "birthYear", "deathYear",
        "mostRecentChamber", "currentMember", "lisid", "mostRecentParty", "updateDate",
    )


def dim_congressional_districts(zones: DataFrame, states: DataFrame) -> DataFrame:
    """State name and district of each zip code area."""
    named = states.select(F.col("Name").alias("state"), F.trim("Abbreviation").alias("__abbr"))
    return zones.join(named, F.col("state_abbr") == F.col("__abbr")).select(
        F.col("zcta").alias("zip_code"), "state", F.col("cd").alias("congressional_district")
    )
