"""Ballot, party, chamber and member texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hemicycle.functions.keys import as_column

# Ballot words, chambers and parties as the source documents write them.
YEA_WORDS = ("Yea", "Aye")
NAY_WORDS = ("Nay", "No")
PRESENT_WORD = "Present"
NOT_VOTING_WORD = "Not Voting"
SENATE = "Senate"
HOUSE = "House of Representatives"
HOUSE_PREFIX = "U.S. "
MAIN_PARTIES = ("Democratic", "Republican")
INDEPENDENT = "Independent"
PARTY_LETTERS = {"D": "Democratic", "R": "Republican", "I": "Independent"}


def is_yea(vote: Column | str) -> Column:
    return as_column(vote).isin(*YEA_WORDS)


def is_nay(vote: Column | str) -> Column:
    return as_column(vote).isin(*NAY_WORDS)


def ballot_class(vote: Column | str) -> Column:
    """Display class of a ballot: ``yea``, ``nay`` or ``other``."""
    return F.when(is_yea(vote), "yea").when(is_nay(vote), "nay").otherwise("other")


def ballot_group(vote: Column | str) -> Column:
    """Four-way class used by the loyalty report; any other ballot is null."""
    v = as_column(vote)
    return (
        F.when(is_yea(v), "yea/aye")
        .when(is_nay(v), "nay/no")
        .when(v == PRESENT_WORD, "present")
        .when(v == NOT_VOTING_WORD, "not_voting")
    )


def was_cast(vote: Column | str, not_voting: str = NOT_VOTING_WORD) -> Column:
    """1 unless the ballot is ``not_voting``; a null ballot counts as cast."""
    return F.when(as_column(vote).eqNullSafe(F.lit(not_voting)), 0).otherwise(1)


def party_group(party_name: Column | str) -> Column:
    """The two main parties by name, anything else Independent (null too)."""
    p = as_column(party_name)
    return F.when(p.isin(*MAIN_PARTIES), p).otherwise(INDEPENDENT)


def chamber_name(chamber: Column | str) -> Column:
    """Senate stays; every other value is the House."""
    return F.when(as_column(chamber) == SENATE, SENATE).otherwise(HOUSE)


def member_label(name: Column | str, party: Column | str, state: Column | str) -> Column:
    """``Doe, Jane | D - OR``; null if any part is null."""
    return F.concat(as_column(name), F.lit(" | "), F.left(as_column(party), F.lit(1)), F.lit(" - "), as_column(state))


def label_name(label: Column | str) -> Column:
    """The name part of a :func:`member_label`."""
    return F.split_part(as_column(label), F.lit(" | "), F.lit(1))


def whole_percent(ratio: Column) -> Column:
    """0.125 as ``12%`` (ties to even); ``nan%`` when there is no ratio."""
    return F.concat(
        F.coalesce(F.bround(ratio * 100, 0).cast("bigint").cast("string"), F.lit("nan")), F.lit("%")
    )


def alignment_sentence(
    name: Column | str,
    chamber: Column | str,
    dem_ratio: Column | str,
    rep_ratio: Column | str,
    n: Column | str,
    policy_area: str | None = None,
) -> Column:
    """One-sentence summary of how a member sided with both majorities."""
    title = F.when(as_column(chamber) == HOUSE, "Rep. ").otherwise("Senator ")
    about = F.lit(f" on bills related to {policy_area}" if policy_area else "")
    return F.concat(
        title,
        F.split_part(as_column(name), F.lit(","), F.lit(1)),
        F.lit("'s vote align with the Democratic majority "),
        whole_percent(as_column(dem_ratio)),
        F.lit(" of the time <br>and the Republican majority "),
        whole_percent(as_column(rep_ratio)),
        F.lit(" of the time"),
        about,
        F.lit(" (n = "),
        as_column(n).cast("string"),
        F.lit(" votes)"),
    )
