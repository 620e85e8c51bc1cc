"""Landing frames to staging frames. All are lazy projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.json import array_at, json_scalar, list_at, parse_parts
from hemicycle.functions.keys import congress_bill_key
from hemicycle.functions.votes import chamber_name
from hemicycle.operators.merge import filter_new_votes
from hemicycle.operators.nested import flatten, unnest
from hemicycle.session import stored
from hemicycle.sources.schemas import RECORDED_VOTE


def stage_bills(bills: DataFrame) -> DataFrame:
    return bills.withColumn("bill_key", congress_bill_key())


#: Parts of a bill that the models look into.
JSON_PARTS = ["policyArea", "sponsors", "cosponsors", "subjects", "committees", "actions"]


def stage_parsed_bills(bills: DataFrame) -> DataFrame:
    """:func:`stage_bills` with the JSON parts parsed into variants and stored: one parse serves all models."""
    return stored(stage_bills(parse_parts(bills, JSON_PARTS)), "parsed_bills")


def stage_house_votes(votes: DataFrame) -> DataFrame:
    return flatten(votes.select("rollcall_vote", "bill_number", "bill_type"), "rollcall_vote")


def stage_senate_votes(votes: DataFrame) -> DataFrame:
    return votes


def stage_members(members: DataFrame) -> DataFrame:
    return members


def stage_terms(members: DataFrame) -> DataFrame:
    """One row per member and term."""
    terms = members.select(F.col("bioguideId").alias("bioguideID"), F.explode("terms").alias("term"))
    return terms.select("bioguideID", "term.*").withColumnsRenamed(
        {"startYear": "term_start_year", "endYear": "term_end_year"}
    )


def stage_senate_ids(ids: DataFrame) -> DataFrame:
    """One row per senator and Senate id."""
    named = ids.select(
        json_scalar("full_name", "$.first_name").alias("first_name"),
        json_scalar("full_name", "$.last_name").alias("last_name"),
        "state",
        F.col("bioguide").alias("bioguideID"),
        "lisid",
    )
    return unnest(named, "lisid", "lisid")


def recorded_votes(bills: DataFrame, mark: Column | str | DataFrame | None = None) -> DataFrame:
    """Roll calls named in the actions of bills, optionally from the mark on.

    An action may name one vote as an object or several as a list.
    """
    number = [c for c in ("number", "billNumber") if c in bills.columns]
    actions = bills.select(
        F.coalesce(*[F.col(c) for c in number]).alias("bill_number"),
        F.col("type").alias("bill_type"),
        F.explode(array_at(bills, "actions", "$.item")).alias("action"),
    )
    votes = (
        actions.select(
            "bill_number", "bill_type",
            F.explode(list_at(actions, "action", "$.recordedVotes.recordedVote", f"struct<{RECORDED_VOTE}>")).alias("vote"),
        )
        .select("bill_number", "bill_type", "vote.*")
        .withColumn("chamber", chamber_name("chamber"))
    )
    return votes if mark is None else filter_new_votes(votes, mark)
