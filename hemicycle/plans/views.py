"""Reporting views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.votes import PARTY_LETTERS, member_label
from hemicycle.operators.joins import in_either
from hemicycle.operators.majority import majority_columns, sided_with, sided_with_own

MAJORITY = {"D": "dem_majority_vote", "R": "rep_majority_vote", "I": "ind_majority_vote"}
#: Columns of a roll call that a ballot shows.
SHOWN = [
    "chamber", "congress", "roll_call_number", "bill_name", "policyArea", "title", "question", "url", "vote_date",
    "result",
]
MAJORITY_KEY = ["bill_key", "roll_call_number", "congress"]


def roll_call_context(
    fact: DataFrame | None, votes: DataFrame, bills: DataFrame, strict: bool = False, majority: DataFrame | None = None
) -> DataFrame:
    """Everything a ballot shows about its roll call: result, bill, majority votes.

    All lookups by roll call or bill are joined here, at one row per roll call, before the
    ballots come in. ``strict=True`` keeps sessions and chambers apart in the majority.
    ``majority`` gives the majorities where they are kept (:mod:`hemicycle.plans.running`); the fact
    is not read then.
    """
    key = [*MAJORITY_KEY, "session", "chamber"] if strict else MAJORITY_KEY
    if majority is None:
        majority = majority_columns(fact, key, MAJORITY)
    named = bills.select("bill_name", "congress", "policyArea", "title", "url").distinct()
    rolls = votes.select(
        "congress", "session", "chamber", "roll_call_number", "bill_name", "bill_key",
        F.expr("try_cast(vote_date as date)").alias("vote_date"), "result", "question",
    ).distinct()
    joined = rolls.join(majority, key, "left").join(named, ["bill_name", "congress"], "left").drop("bill_key").distinct()
    # The digest names what a ballot shows of its roll call; the session is not shown.
    return joined.withColumn("shown_id", F.sha2(F.to_json(F.struct(*SHOWN, *MAJORITY.values())), 256))


def member_lookup(members: DataFrame) -> DataFrame:
    """Members by either id: one row per (id_kind, id)."""
    shown = [
        F.col("bioguideID").alias("member"), F.col("invertedOrderName").alias("name"),
        F.col("mostRecentParty").alias("partyName"),
    ]
    by = [
        members.select(F.lit(kind).alias("id_kind"), F.col(col).alias("id"), *shown).filter(F.col("id").isNotNull())
        for kind, col in (("bioguideID", "bioguideID"), ("lisid", "lisid"))
    ]
    return by[0].unionByName(by[1])


def votes_by_member(
    fact: DataFrame, votes: DataFrame, members: DataFrame, bills: DataFrame, strict: bool = False
) -> DataFrame:
    """Every ballot with its member, its roll call, and whether it went with each majority."""
    return ballots_in_context(fact, roll_call_context(fact, votes, bills, strict), members)


def ballots_in_context(fact: DataFrame, context: DataFrame, members: DataFrame) -> DataFrame:
    """:func:`votes_by_member` over a :func:`roll_call_context` made before.

    The context has a row per roll call where the fact has hundreds. Stored as a table of
    its own (:func:`hemicycle.session.stored`), its measured size decides whether the fact
    is joined without being moved at all.

    They meet two tables only: the roll-call context, and the members under
    whichever id the ballot carries (a ballot has exactly one, so one lookup replaces an
    outer join per id and no pile of null ids gathers in one task). A ballot of an unknown
    member stays, without name; one of an unknown roll call does not.

    Equal rows are removed while a ballot is a member, a vote and the digest of what it
    shows of its roll call. The texts are attached after that exchange, not sent through it.
    """
    key = ["congress", "session", "chamber", "roll_call_number", "bill_name"]
    ballots = fact.select(
        *key,
        F.when(F.col("bioguideID").isNotNull(), "bioguideID").otherwise("lisid").alias("id_kind"),
        F.coalesce("bioguideID", "lisid").alias("id"),
        F.col("vote").alias("member_vote"),
    )
    found = (
        ballots.join(context.select(*key, "shown_id"), key)
        .join(member_lookup(members), ["id_kind", "id"], "left")
        .select("congress", "chamber", "name", F.col("member").alias("bioguideID"), "partyName", "member_vote", "shown_id")
        .distinct()
    )
    own = {PARTY_LETTERS[letter]: column for letter, column in MAJORITY.items()}
    shown = context.select("shown_id", *SHOWN, *MAJORITY.values()).distinct()
    # congress and chamber are join keys so that a filter on either reaches the fact's scan
    return found.join(shown, ["congress", "chamber", "shown_id"]).select(
        "name", "chamber", "congress", "roll_call_number", "bioguideID", "partyName",
        "member_vote", "bill_name", "policyArea", "title", "question", "url", "vote_date", "result",
        "dem_majority_vote", "rep_majority_vote",
        sided_with("dem_majority_vote", "member_vote").alias("voted_with_dem_majority"),
        sided_with("rep_majority_vote", "member_vote").alias("voted_with_rep_majority"),
        sided_with_own("partyName", "member_vote", own).alias("voted_with_party_majority"),
    )


def votes_about(fact: DataFrame, context: DataFrame, members: DataFrame, about: Column) -> DataFrame:
    """:func:`ballots_in_context` of the roll calls that ``about`` holds for, a condition on their shown columns.

    The condition goes to the stored context, whose roll calls then tell the scan of the fact which
    congress folders to read: Spark prunes them while the query runs, as the filter names no congress.
    """
    return ballots_in_context(fact, context.filter(about), members)


def sponsored_bills_by_member(sponsors: DataFrame, bills: DataFrame, members: DataFrame) -> DataFrame:
    """Bills a known member sponsored or cosponsored."""
    names = members.select("bioguideID", F.col("invertedOrderName").alias("name"))
    about = bills.select("bill_key", "bill_name", "congress", "title", "url", "policyArea", "introducedDate")
    return (
        sponsors.select("bill_key", "bioguideID", "sponsor_type")
        .join(names, "bioguideID")
        .join(about, "bill_key")
        .select(
            "bioguideID", "name", "sponsor_type", "bill_name", "congress", "title", "url", "policyArea",
            "introducedDate",
        )
    )


def voting_members(members: DataFrame, terms: DataFrame, districts: DataFrame, fact: DataFrame) -> DataFrame:
    """Members with at least one ballot, by congress, chamber, state and district.

    The district number is kept if it occurs in any state, else it is null.
    """
    ids = fact.select("bioguideID", "lisid").distinct()  # one pass over the fact serves both lists
    voters = in_either(members, [("bioguideID", ids.select("bioguideID")), ("lisid", ids.select("lisid"))]).select("bioguideID", "invertedOrderName", "lastName", "imageURL", "mostRecentParty")
    known = districts.select("congressional_district").distinct()
    served = terms.select("bioguideID", "stateCode", "stateName", "chamber", "congress", "district").distinct()
    rows = voters.join(served, "bioguideID").join(
        known, F.col("district") == F.col("congressional_district"), "left"
    )
    return (
        rows.select(
            "invertedOrderName", "lastName", "stateCode", "stateName", "congressional_district", "bioguideID",
            "imageURL", "mostRecentParty", "chamber", "congress",
        )
        .distinct()
        .withColumn("concat_name", member_label("invertedOrderName", "mostRecentParty", "stateCode"))
    )
