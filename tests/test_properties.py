"""Properties that hold on any data, checked on the supplied tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hemicycle.operators.terms import term_islands
from hemicycle.plans import reports, views, votes as v
from parity import shapes
from parity.registry import Tables
from parity.star import Star


@pytest.fixture(scope="module")
def star(spark):
    return Star(Tables(spark, "/root/testdata/sf0.001"))


def test_fact_has_a_row_per_listed_ballot(star):
    house = star.house.agg(F.sum(F.size("vote_data.recorded_vote"))).first()[0]
    senate = star.senate.agg(F.sum(F.size("roll_call_vote.members.member"))).first()[0]
    assert v.fact_roll_call_vote(star.house, star.senate).count() == house + senate


def test_flat_fact_equals_the_one_from_documents(star):
    from_documents = v.fact_roll_call_vote(star.house, star.senate)
    assert star.fact.exceptAll(from_documents.select(star.fact.columns)).isEmpty()
    assert from_documents.select(star.fact.columns).exceptAll(star.fact).isEmpty()


def test_islands_of_a_member_and_chamber_do_not_overlap(star):
    # customers whose third term starts after it ends (see shapes) are no spans of time
    terms = star.terms.filter("term_end_year IS NULL OR term_end_year >= term_start_year")
    by = Window.partitionBy("bioguideID", "chamber").orderBy("term_start_year")
    spans = term_islands(terms).withColumn("next", F.lead("term_start_year").over(by))
    closed = spans.filter("next IS NOT NULL")
    assert closed.filter("term_end_year IS NULL OR next < term_end_year").isEmpty()


def test_shares_stay_in_range_when_not_voting_is_no_majority(star):
    fact = star.fact.filter("vote <> 'Not Voting'")
    seen = views.votes_by_member(fact, shapes.roll_calls(star.t.orders), star.dim_members, star.bills)
    for chamber in ("Senate", "House of Representatives"):
        shares = reports.alignment(seen, chamber)
        assert shares.count() > 0
        assert shares.filter("NOT dem_majority_share BETWEEN 0 AND 1 OR NOT party_majority_share BETWEEN 0 AND 1").isEmpty()
