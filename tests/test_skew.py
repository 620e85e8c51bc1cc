"""One roll call, member or key with a third of all rows: same rows, and no task that gets them all."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hemicycle.operators import joins, merge
from hemicycle.operators.dedupe import top_per_group
from hemicycle.operators.majority import alignment_ratios, party_majority
from hemicycle.plans import views

#: Sizes shrunk so that a test-sized hot key counts as skewed; broadcast off.
SHRUNK = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark):
    """60,000 ballots over 300 roll calls, 20,000 of them in roll call 0."""
    base = spark.range(60_000, numPartitions=8).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 300 END AS roll")
    return base.selectExpr(
        "concat('k', roll) AS bill_key", "roll AS roll_call_number", "118L AS congress", "1L AS session",
        "'House of Representatives' AS chamber", "concat('HR', roll) AS bill_name", "concat('M', id) AS bioguideID",
        "CAST(NULL AS STRING) AS lisid", "CASE WHEN hash(id) % 3 = 0 THEN 'Nay' ELSE 'Yea' END AS vote",
        "CASE WHEN id % 2 = 0 THEN 'D' ELSE 'R' END AS party",
    )


def star(spark, hot):
    rolls = hot.select("bill_key", "roll_call_number", "congress", "session", "chamber", "bill_name").distinct()
    rolls = rolls.selectExpr("*", "'2023-01-01' AS vote_date", "'Passed' AS result", "'On Passage' AS question")
    members = hot.selectExpr("bioguideID", "concat('Name ', bioguideID) AS invertedOrderName", "'Democratic' AS mostRecentParty", "lisid").distinct()
    bills = rolls.selectExpr("bill_name", "congress", "'Area' AS policyArea", "bill_name AS title", "'u' AS url")
    return rolls, members, bills


def test_votes_by_member_splits_the_hot_roll_call(spark, hot):
    rolls, members, bills = star(spark, hot)
    whole = views.votes_by_member(hot, rolls, members, bills)
    expected = rows(whole.groupBy("roll_call_number", "member_vote", "dem_majority_vote").count())
    with settings(spark, SHRUNK):
        split = views.votes_by_member(hot, rolls, members, bills)
        assert len(split.collect()) == 60_000
        assert "skew=true" in split._jdf.queryExecution().executedPlan().toString()
        assert rows(split.groupBy("roll_call_number", "member_vote", "dem_majority_vote").count()) == expected


def test_membership_joins_split_the_hot_key(spark, hot):
    keys = spark.range(300).selectExpr("id AS k")
    with settings(spark, SHRUNK):
        for kept, n in (
            (joins.in_values(hot, "roll_call_number", keys), 60_000),
            (joins.not_in_values(hot, "roll_call_number", keys.filter("k > 0")), hot.filter("roll_call_number = 0").count()),
            (joins.in_either(hot, [("roll_call_number", keys)]), 60_000),
        ):
            assert len(kept.collect()) == n
            assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()


def shuffled_rows(df):
    """Rows written to each exchange of the executed plan."""
    df.collect()
    seen, found = [df._jdf.queryExecution().executedPlan()], []
    while seen:
        node = seen.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if name == "AdaptiveSparkPlanExec":
            seen.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            seen.append(node.plan())
        children = node.children()
        seen.extend(children.apply(i) for i in range(children.size()))
    return found


def test_counts_and_picks_shrink_before_the_exchange(spark, hot):
    counted = party_majority(hot, ["bill_key", "roll_call_number", "congress"])
    assert max(shuffled_rows(counted)) <= 300 * 2 * 2 * 8
    latest = top_per_group(hot.select("roll_call_number", "bioguideID"), ["roll_call_number"], [F.desc("bioguideID")])
    assert max(shuffled_rows(latest)) <= 300 * 8
    shares = alignment_ratios(hot.selectExpr("party", "vote AS member_vote", "1 AS flag"), ["party"], {"flag": "share"})
    assert max(shuffled_rows(shares)) <= 2 * 8
    picked = merge.unique_source(hot.select("roll_call_number", "bioguideID"), ["roll_call_number"], [F.asc("bioguideID")])
    assert max(shuffled_rows(picked)) <= 300 * 8


def test_session_and_chamber_filters_reach_the_fact(spark, hot, tmp_path):
    path = str(tmp_path / "fact")
    hot.withColumn("congress", F.expr("117 + roll_call_number % 3")).write.partitionBy("congress").parquet(path)
    stored = spark.read.parquet(path)
    rolls, _, bills = star(spark, stored)
    _, members, _ = star(spark, hot)
    scoped = views.votes_by_member(stored, rolls, members, bills).filter("congress = 119 AND chamber = 'Senate'")
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    fact_scans = [line for line in plan.splitlines() if "FileScan" in line and "lisid" in line]
    assert fact_scans and all("congress" in s.split("PartitionFilters: [")[1].split("]")[0] and "119" in s for s in fact_scans)
    assert all("EqualTo(chamber,Senate)" in s for s in fact_scans)


def test_scans_read_only_what_is_needed(spark, hot, tmp_path):
    path = str(tmp_path / "fact")
    hot.write.parquet(path)
    plan = party_majority(spark.read.parquet(path), ["bill_key"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<bill_key:string,vote:string,party:string>" in plan
