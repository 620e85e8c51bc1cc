"""Dashboard questions over the exported views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.text import html_link, matches, year_or_dash
from hemicycle.functions.votes import alignment_sentence, ballot_class, label_name
from hemicycle.operators.filters import search_text, where_all
from hemicycle.operators.majority import alignment_ratios
from hemicycle.operators.paging import page

MEMBER = ["bioguideID", "name", "partyName"]
FLAGS = {
    "voted_with_party_majority": "party_majority_share",
    "voted_with_dem_majority": "dem_majority_share",
    "voted_with_rep_majority": "rep_majority_share",
}
VOTE_COLUMNS = [
    "vote_date", "question", "title", "url", "roll_call_number", "policyArea", "member_vote", "dem_majority_vote",
    "rep_majority_vote", "result", "partyName",
]
BILL_COLUMNS = ["title", "url", "sponsor_type", "policyArea", "introducedDate"]


def _scope(votes: DataFrame, chamber: str, policy_area: str | None, member: str | None = None) -> DataFrame:
    return where_all(
        votes,
        [
            F.col("chamber") == chamber,
            F.col("policyArea") == policy_area if policy_area else None,
            F.col("bioguideID") == member if member else None,
        ],
    )


def alignment(votes: DataFrame, chamber: str, policy_area: str | None = None) -> DataFrame:
    """How often each member of a chamber sided with either party's majority and with their own."""
    return alignment_ratios(_scope(votes, chamber, policy_area), MEMBER, FLAGS)


def alignment_summary(
    votes: DataFrame, member: str | None, chamber: str, policy_area: str | None = None
) -> DataFrame:
    """Shares, ballots (cast or not) and a sentence for the chosen member; for all, if none is given."""
    shares = alignment_ratios(_scope(votes, chamber, policy_area, member), MEMBER, FLAGS)
    said = alignment_sentence("name", F.lit(chamber), "dem_majority_share", "rep_majority_share", "n", policy_area)
    return shares.withColumn("sentence", said)


def others(aligned: DataFrame, member: str) -> DataFrame:
    """The alignment rows to set against the chosen member's."""
    return aligned.filter(F.col("bioguideID") != member)


def recent_votes(
    votes: DataFrame,
    member: str | None,
    keyword: str | None = None,
    policy_area: str | None = None,
    number: int = 1,
    size: int = 25,
    regex: bool = False,
    compat: bool = False,
) -> DataFrame:
    """A page of a member's ballots (of everyone's, if none is given), latest first."""
    found = where_all(
        votes,
        [
            F.col("bioguideID") == member if member is not None else None,
            matches("title", keyword, regex) if keyword is not None else None,
            F.col("policyArea") == policy_area if policy_area else None,
        ],
    ).select(*VOTE_COLUMNS)
    order = [F.desc_nulls_last("vote_date"), *[F.asc_nulls_first(c) for c in VOTE_COLUMNS if c != "vote_date"]]
    return page(found, order, number, size, compat)


def with_display(votes: DataFrame) -> DataFrame:
    """Adds the title link and the display class of the three vote columns."""
    classed = {f"{c}_class": ballot_class(c) for c in ("member_vote", "dem_majority_vote", "rep_majority_vote")}
    return votes.withColumns({"title_linked": html_link("url", "title"), **classed})


def recent_sponsored_bills(
    bills: DataFrame,
    member: str | None,
    keyword: str | None = None,
    policy_area: str | None = None,
    number: int = 1,
    size: int = 25,
    regex: bool = False,
    compat: bool = False,
) -> DataFrame:
    """A page of a member's bills (of everyone's, if none is given), latest first.

    A keyword search shows all it finds.
    """
    found = where_all(
        bills,
        [
            F.col("bioguideID") == member if member is not None else None,
            matches("title", keyword, regex) if keyword is not None else None,
            F.col("policyArea") == policy_area if policy_area else None,
        ],
    ).select(
        "title", "url", "sponsor_type", F.coalesce("policyArea", F.lit("-")).alias("policyArea"),
        F.date_format("introducedDate", "yyyy-MM-dd").alias("introducedDate"),
    )
    order = [F.desc_nulls_last("introducedDate"), *[F.asc_nulls_first(c) for c in BILL_COLUMNS[:-1]]]
    return found.orderBy(*order) if keyword is not None else page(found, order, number, size, compat)


def years_served(terms: DataFrame, member: str | None = None) -> DataFrame:
    """Chamber, start and end of each span of a member (of all, if none is given)."""
    rows = where_all(terms, [F.col("bioguideID") == member if member is not None else None])
    shown = [] if member is not None else ["bioguideID"]
    return rows.select(
        *shown, "chamber", F.col("term_start_year").alias("Start Year"), year_or_dash("term_end_year").alias("End Year")
    )


def find_by_zip(members: DataFrame, districts: DataFrame, zip_code: int | str, chamber: str) -> DataFrame:
    """Members of the chamber for a zip code area.

    State and district of the area are matched each on its own; a member without district
    number counts as district 0. The Senate goes by state alone.
    """
    area = districts.filter(F.col("zip_code") == int(zip_code))
    return find_by_area(members.filter(F.col("chamber") == chamber), area, by_district=chamber != "Senate")


def find_by_area(members: DataFrame, area: DataFrame, by_district: bool) -> DataFrame:
    """Members whose state, and district if asked, occur among the rows of ``area``."""
    states = area.select(F.col("state").alias("__state")).distinct()
    found = members.join(states, F.col("stateName") == F.col("__state"), "left_semi")
    if by_district:
        numbers = area.select(F.col("congressional_district").alias("__cd")).distinct()
        mine = F.coalesce("congressional_district", F.lit(0))
        found = found.join(numbers, mine == F.col("__cd"), "left_semi")
    return found


def find_by_name(members: DataFrame, last_name: str, chamber: str, regex: bool = False) -> DataFrame:
    return search_text(members.filter(F.col("chamber") == chamber), "lastName", last_name, regex)


def option_labels(found: DataFrame) -> DataFrame:
    return found.select("concat_name").distinct()


def member_by_label(members: DataFrame, label: str) -> DataFrame:
    """The member row behind an option label (the first by id, if the name is shared)."""
    named = members.filter(F.col("invertedOrderName") == label_name(F.lit(label)))
    return named.orderBy("bioguideID").limit(1)
