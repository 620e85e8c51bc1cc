"""Modal vote of each party, and how often members side with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.votes import was_cast
from hemicycle.operators.dedupe import top_per_group


def vote_counts(ballots: DataFrame, keys: Sequence[str], party: str = "party", vote: str = "vote") -> DataFrame:
    """Ballots per roll call, party and vote. Partial sums leave little to exchange."""
    return ballots.groupBy(*keys, party, vote).agg(F.count("*").alias("vote_count"))


def party_majority(ballots: DataFrame, keys: Sequence[str], party: str = "party", vote: str = "vote") -> DataFrame:
    """Most frequent vote per roll call and party; equal counts go to the first vote by name."""
    counts = vote_counts(ballots, keys, party, vote)
    return top_per_group(counts, [*keys, party], [F.desc("vote_count"), F.asc_nulls_first(vote)])


def majority_columns(
    ballots: DataFrame,
    keys: Sequence[str],
    parties: Mapping[str, str],
    party: str = "party",
    vote: str = "vote",
) -> DataFrame:
    """One row per roll call with the modal vote of each party in a column of its own.

    ``parties`` maps a party code to the name of its column. Taking the least of
    (-count, vote) in one aggregate over the counts serves any number of parties, where
    a lookup per party would join the same table again and again.
    """
    counts = vote_counts(ballots.filter(F.col(party).isin(*parties)), keys, party, vote)
    return majority_of_counts(counts, keys, parties, party, vote)


def majority_of_counts(
    counts: DataFrame, keys: Sequence[str], parties: Mapping[str, str], party: str = "party", vote: str = "vote"
) -> DataFrame:
    """:func:`majority_columns` from :func:`vote_counts` made before."""
    ranked = F.struct((-F.col("vote_count")).alias("n"), F.col(vote).alias("v"))
    picks = [F.min(F.when(F.col(party) == code, ranked))["v"].alias(name) for code, name in parties.items()]
    return counts.groupBy(*keys).agg(*picks)


def sided_with(majority: Column | str, vote: Column | str) -> Column:
    m = F.col(majority) if isinstance(majority, str) else majority
    v = F.col(vote) if isinstance(vote, str) else vote
    return F.when(m == v, 1).otherwise(0)


def sided_with_own(party: str, vote: str, majorities: Mapping[str, str]) -> Column:
    """1 when the vote equals the majority vote of the member's own party."""
    hit = F.lit(False)
    for code, column in majorities.items():
        hit = hit | F.coalesce((F.col(party) == code) & (F.col(column) == F.col(vote)), F.lit(False))
    return F.when(hit, 1).otherwise(0)


def alignment_ratios(
    votes: DataFrame,
    group: Sequence[str],
    flags: Mapping[str, str],
    vote: str = "member_vote",
    not_voting: str = "Not Voting",
) -> DataFrame:
    """Share of cast ballots that carry each flag, per group, with ``n`` ballots and ``votes_cast``.

    Rows with a null in the group are left out. A member who cast nothing gets null
    ratios; a ratio above 1 can occur where not voting was itself the majority vote.
    """
    whole = votes
    for column in group:
        whole = whole.filter(F.col(column).isNotNull())
    sums = whole.groupBy(*group).agg(
        F.count("*").alias("n"),
        F.sum(was_cast(vote, not_voting)).alias("votes_cast"),
        *[F.sum(flag).alias(f"__{name}") for flag, name in flags.items()],
    )
    ratios = [F.try_divide(F.col(f"__{name}"), F.col("votes_cast")).alias(name) for name in flags.values()]
    return sums.select(*group, "n", "votes_cast", *ratios)
