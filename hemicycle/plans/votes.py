"""Roll-call dimensions and the ballot fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.dates import house_date, senate_date
from hemicycle.functions.keys import bill_name, vote_bill_key
from hemicycle.functions.votes import HOUSE_PREFIX, PARTY_LETTERS, PRESENT_WORD, is_nay, is_yea
from hemicycle.operators.joins import attach_totals
from hemicycle.operators.nested import unnest

HOUSE_CLASSES = {"yea_or_aye_votes": "yea_total", "nay_or_no_votes": "nay_total", "present_votes": "present_total"}
SENATE_CLASSES = {"yea_or_aye_votes": "yea", "nay_or_no_votes": "nay", "abstain_votes": "abstain"}


def whole(col: str) -> Column:
    """Text to whole number; unreadable text is null."""
    return F.expr(f"try_cast({col} as bigint)")


def party_totals(
    df: DataFrame, keys: list[str], classes: Mapping[str, str], party: str, codes: Mapping[str, str]
) -> DataFrame:
    """Sum each class column for each party: one column per pair, in one aggregate.

    ``codes`` maps the letter of a column name to the party as the rows write it.
    """
    sums = [
        F.sum(F.when(F.col(party) == code, F.col(source)).otherwise(0)).alias(f"{letter}_{name}")
        for name, source in classes.items()
        for letter, code in codes.items()
    ]
    return df.groupBy(*keys).agg(*sums)


def party_totals_house(totals: DataFrame, keys: list[str]) -> DataFrame:
    """House: totals come per party, named in full."""
    return party_totals(totals, keys, HOUSE_CLASSES, "party", PARTY_LETTERS)


def party_totals_senate(ballots: DataFrame, keys: list[str]) -> DataFrame:
    """Senate: totals are counted from ballots, parties are letters."""
    flagged = ballots.withColumns(
        {
            "yea": F.when(is_yea("vote_cast"), 1).otherwise(0),
            "nay": F.when(is_nay("vote_cast"), 1).otherwise(0),
            "abstain": F.when(F.col("vote_cast") == PRESENT_WORD, 1).otherwise(0),
        }
    )
    return party_totals(flagged, keys, SENATE_CLASSES, "party", {p: p for p in PARTY_LETTERS})


ROLL_CALL = ["congress", "bill_key", "session", "roll_call_number"]


def dim_house_votes(votes: DataFrame) -> DataFrame:
    """House roll calls with totals by party (input: staged House votes)."""
    meta = votes.select("vote_metadata.*", "bill_number", "bill_type")
    rows = meta.select(
        whole("rollcall_num").alias("roll_call_number"),
        vote_bill_key().alias("bill_key"),
        house_date("action_date").alias("vote_date"),
        whole("congress").alias("congress"),
        whole("left(session, 1)").alias("session"),
        "bill_type",
        F.replace("chamber", F.lit(HOUSE_PREFIX), F.lit("")).alias("chamber"),
        bill_name("bill_type", "bill_number").alias("bill_name"),
        F.col("vote_question").alias("question"),
        F.col("vote_result").alias("result"),
        whole("vote_totals.totals_by_vote.yea_total").alias("yea_totals"),
        whole("vote_totals.totals_by_vote.nay_total").alias("nay_totals"),
        whole("vote_totals.totals_by_vote.present_total").alias("present_totals"),
        whole("vote_totals.totals_by_vote.not_voting_total").alias("not_voting_totals"),
        F.col("vote_totals.totals_by_party").alias("totals"),
    )
    # Repeated documents of a roll call go before their totals are unnested.
    rows = unnest(rows.distinct(), "totals", "by_party")
    counted = {c: whole(f"by_party.{c}") for c in ("yea_total", "nay_total", "present_total", "not_voting_total")}
    flat = rows.withColumns({"party": F.col("by_party.party"), **counted}).drop("by_party").distinct()
    detail = flat.drop("party", *counted)
    return attach_totals(detail, party_totals_house(flat, ROLL_CALL), ROLL_CALL).select(
        *detail.columns, *[f"{p}_{c}" for c in HOUSE_CLASSES for p in PARTY_LETTERS]
    )


def dim_senate_votes(votes: DataFrame) -> DataFrame:
    """Senate roll calls with totals by party (input: landing Senate votes).

    Repeated ballots of one document count once. The document part of that comparison is a
    digest made before the members are unnested, so the distinct moves narrow rows.
    """
    head = [c for c in votes.schema["roll_call_vote"].dataType.names if c != "members"]
    docs = votes.select(
        *[F.col(f"roll_call_vote.{c}") for c in head],
        F.col("roll_call_vote.members.member").alias("member"),
        "chamber",
        "bill_type",
        bill_name("bill_type", "bill_number").alias("bill_name"),
        vote_bill_key().alias("bill_key"),
        F.sha2(F.to_json(F.struct(*[f"roll_call_vote.{c}" for c in head], "chamber", "bill_number", "bill_type")), 256)
        .alias("document_digest"),
    )
    key = ["congress", "session", "vote_number", "bill_key"]
    classed = (
        unnest(docs.select(*key, "chamber", "document_digest", "member"), "member", "m")
        .select(
            *key, "chamber", "document_digest", "m.party", "m.lis_member_id",
            # one word per class, so that Yea and Aye of one member stay one ballot
            F.when(is_yea("m.vote_cast"), "Yea").when(is_nay("m.vote_cast"), "Nay")
            .when(F.col("m.vote_cast") == PRESENT_WORD, PRESENT_WORD).alias("vote_cast"),
        )
        .distinct()
    )
    totals = party_totals_senate(classed, [*key, "chamber"]).drop("chamber").distinct()
    detail = docs.filter(F.size("member") > 0).select(
        *key,
        senate_date("vote_date").alias("vote_date"),
        "bill_type",
        "chamber",
        "bill_name",
        "question",
        F.col("vote_result").alias("result"),
        F.coalesce(whole("count.yeas"), F.lit(0)).alias("yea_totals"),
        F.coalesce(whole("count.nays"), F.lit(0)).alias("nay_totals"),
        F.coalesce(whole("count.present"), F.lit(0)).alias("present_totals"),
        F.coalesce(whole("count.absent"), F.lit(0)).alias("not_voting_totals"),
    )
    joined = attach_totals(detail, totals, key)
    return joined.select(
        whole("vote_number").alias("roll_call_number"),
        "bill_key",
        "vote_date",
        whole("congress").alias("congress"),
        whole("session").alias("session"),
        "bill_type",
        "chamber",
        "bill_name",
        "question",
        "result",
        "yea_totals",
        "nay_totals",
        "present_totals",
        "not_voting_totals",
        *[f"{p}_{c}" for c in SENATE_CLASSES for p in PARTY_LETTERS],
    ).distinct()


def dim_votes(house: DataFrame, senate: DataFrame) -> DataFrame:
    """Roll calls of both chambers; Senate abstentions fill the present columns."""
    renamed = senate.withColumnsRenamed({f"{p}_abstain_votes": f"{p}_present_votes" for p in PARTY_LETTERS})
    return house.unionByName(renamed).distinct()


def fact_roll_call_vote(house: DataFrame, senate: DataFrame) -> DataFrame:
    """One row per ballot (inputs: staged House votes, landing Senate votes).

    A House ballot names the member by bioguideID, a Senate ballot by lisid.
    """
    head = ["bill_key", "roll_call_number", "congress", "session", "chamber", "bill_name"]
    in_house = house.select(
        vote_bill_key().alias("bill_key"),
        whole("vote_metadata.rollcall_num").alias("roll_call_number"),
        whole("vote_metadata.congress").alias("congress"),
        whole("left(vote_metadata.session, 1)").alias("session"),
        F.replace("vote_metadata.chamber", F.lit(HOUSE_PREFIX), F.lit("")).alias("chamber"),
        bill_name("bill_type", "bill_number").alias("bill_name"),
        F.col("vote_data.recorded_vote").alias("ballots"),
    )
    in_house = unnest(in_house, "ballots", "b").select(
        *head,
        F.col("b.legislator.name_id").alias("bioguideID"),
        F.lit(None).cast("string").alias("lisid"),
        F.col("b.vote").alias("vote"),
        F.col("b.legislator.party").alias("party"),
    )
    in_senate = senate.select(
        vote_bill_key().alias("bill_key"),
        whole("roll_call_vote.vote_number").alias("roll_call_number"),
        whole("roll_call_vote.congress").alias("congress"),
        whole("roll_call_vote.session").alias("session"),
        "chamber",
        bill_name("bill_type", "bill_number").alias("bill_name"),
        F.col("roll_call_vote.members.member").alias("ballots"),
    )
    in_senate = unnest(in_senate, "ballots", "b").select(
        *head,
        F.lit(None).cast("string").alias("bioguideID"),
        F.col("b.lis_member_id").alias("lisid"),
        F.col("b.vote_cast").alias("vote"),
        F.col("b.party").alias("party"),
    )
    return in_house.unionByName(in_senate)
