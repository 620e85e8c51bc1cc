"""State that follows from run to run, against the reports over the whole fact."""

import pathlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hemicycle.operators import majority as mj
from hemicycle.operators.merge import unique_source
from hemicycle.plans import pipeline, reports, running, views

KEYS = pipeline.MODELS["fact_roll_call_vote"].keys
HOUSE = "House of Representatives"
VOTES = "congress long, session long, chamber string, roll_call_number long, bill_name string, bill_key string, vote_date string, result string, question string"
BILLS = "bill_name string, congress long, policyArea string, title string, url string"
FACT = "congress long, session long, chamber string, bill_key string, roll_call_number long, bioguideID string, lisid string, bill_name string, vote string, party string"
MEMBERS = [(f"M{i}", f"S{i}", f"Name {i}", ("Democratic", "Republican", "Independent")[i % 3]) for i in range(7)]


def ballots(spark, congress, roll, votes):
    """Ballots of a roll call: member number to vote."""
    return spark.createDataFrame(
        [(congress, 1, HOUSE, f"k{roll}", roll, f"M{i}", None, f"HR{roll}", v, "DRI"[i % 3]) for i, v in votes.items()], FACT
    )


@pytest.fixture
def members(spark):
    return spark.createDataFrame(MEMBERS, "bioguideID string, lisid string, invertedOrderName string, mostRecentParty string")


@pytest.fixture
def folders(spark, tmp_path):
    rolls = [(c, 1, HOUSE, r, f"HR{r}", f"k{r}", "2023-01-09", "Passed", "On it") for c in (117, 118) for r in (1, 2, 3)]
    spark.createDataFrame(rolls, VOTES).write.parquet(f"{tmp_path}/tables/dim_votes")
    bills = [(f"HR{r}", c, "Health" if r < 3 else None, f"Act {r}", "u") for c in (117, 118) for r in (1, 2, 3)]
    spark.createDataFrame(bills, BILLS).write.parquet(f"{tmp_path}/tables/dim_bills")
    return f"{tmp_path}/tables", f"{tmp_path}/state"


def whole(spark, tables, members, area=None):
    fact, votes, bills = (spark.read.parquet(f"{tables}/{n}") for n in ("fact_roll_call_vote", "dim_votes", "dim_bills"))
    return rows(reports.alignment(views.votes_by_member(fact, votes, members, bills), HOUSE, area))


def same(spark, tables, state, members):
    for area in (None, "Health"):
        assert rows(running.alignment(spark, state, members, HOUSE, area)) == whole(spark, tables, members, area)
    fact = spark.read.parquet(f"{tables}/fact_roll_call_vote")
    assert rows(running.party_majority(spark, state)) == rows(mj.party_majority(fact, views.MAJORITY_KEY))


RUN1 = {0: "Yea", 1: "Nay", 2: "Present", 3: "Yea", 4: "Nay", 5: "Not Voting", 6: None}


def test_runs_with_corrections(spark, folders, members):
    tables, state = folders

    def run(name, frame, **more):
        running.apply_run(spark, tables, state, name, frame, KEYS, **more)

    run("1", ballots(spark, 117, 1, RUN1).union(ballots(spark, 118, 1, RUN1)).union(ballots(spark, 118, 3, {0: "Yea"})))
    # The Democratic majority flips, a ballot changes without flipping anything, and one is as it was. A ballot
    # of a roll call that is not stored counts once it is.
    run("2", ballots(spark, 118, 1, {0: "Nay", 3: "Nay", 1: "Nay", 5: "Present"}).union(ballots(spark, 118, 9, {0: "Yea", 1: "Yea"})))
    same(spark, tables, state, members)
    votes, bills = (spark.read.parquet(f"{tables}/{n}") for n in ("dim_votes", "dim_bills"))
    more = [(118, 1, HOUSE, 9, "HR9", "k9", "2023-02-09", "Passed", "On it")]
    grown, areas = votes.collect() + more, [(b.bill_name, b.congress, "Energy" if b.bill_name == "HR1" else b.policyArea, b.title, b.url) for b in bills.collect()]
    spark.createDataFrame(grown, VOTES).write.mode("overwrite").parquet(f"{tables}/dim_votes")
    spark.createDataFrame(areas, BILLS).write.mode("overwrite").parquet(f"{tables}/dim_bills")
    # A bill changes its area; the congress without ballots in this run is named.
    run("3", ballots(spark, 118, 2, {0: "Yea", 6: "Nay"}).union(ballots(spark, 118, 3, {0: "Nay", 1: "Nay"})), also=[117])
    same(spark, tables, state, members)
    # A member's party changes: no run is needed.
    same(spark, tables, state, members.withColumn("mostRecentParty", F.lit("Republican")))


def test_a_batch_counts_once(spark, folders, members, monkeypatch):
    tables, state = folders
    first = ballots(spark, 118, 1, RUN1)
    running.apply_run(spark, tables, state, "1", first, KEYS)
    second = ballots(spark, 118, 1, {0: "Nay", 3: "Nay"})

    # Dies before its last table: what it left is not read, and the run can be done again.
    write = running._write
    monkeypatch.setattr(running, "_write", lambda df, s, table, batch: write(df, s, table, batch) if table != "alignment" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        running.apply_run(spark, tables, state, "2", second, KEYS)
    assert running.batches(spark, state) == ["000000-1"]
    same(spark, tables, state, members)
    monkeypatch.setattr(running, "_write", write)

    # Dies between the batch and the fact: the fact follows before anything else, and nothing is added twice.
    monkeypatch.setattr(running, "upsert_table", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        running.apply_run(spark, tables, state, "2", second, KEYS)
    monkeypatch.undo()
    running.apply_run(spark, tables, state, "3", ballots(spark, 118, 2, {1: "Yea"}), KEYS)
    same(spark, tables, state, members)
    running.apply_run(spark, tables, state, "2", second, KEYS)
    same(spark, tables, state, members)
    assert spark.read.parquet(f"{tables}/fact_roll_call_vote").filter("vote = 'Nay' AND roll_call_number = 1").count() == 4


def test_other_congresses_are_not_read(spark, folders, members):
    """A run on one congress succeeds where the files of the other cannot be read."""
    tables, state = folders
    running.apply_run(spark, tables, state, "1", ballots(spark, 117, 1, RUN1).union(ballots(spark, 118, 1, RUN1)), KEYS)
    broken: list = []
    for root in (f"{tables}/fact_roll_call_vote/congress=117", f"{state}/counts/batch=000000-1/congress=117", f"{state}/contexts/batch=000000-1/congress=117"):
        for file in pathlib.Path(root).glob("*.parquet"):
            broken.append((file, content := file.read_bytes()))
            file.write_bytes(content[:4] + bytes(60) + content[64:])  # the footer stays, the first pages go
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert len(broken) >= 3
    with pytest.raises(Exception, match="(?i)parquet|read"):
        spark.read.parquet(f"{tables}/fact_roll_call_vote").collect()
    running.apply_run(spark, tables, state, "2", ballots(spark, 118, 1, {0: "Nay", 3: "Nay"}), KEYS)
    for file, content in broken:
        file.write_bytes(content)
    same(spark, tables, state, members)


def test_repeated_ballots_fail_without_an_order(spark, folders):
    tables, state = folders
    twice = ballots(spark, 118, 1, {0: "Yea"}).union(ballots(spark, 118, 1, {0: "Nay"}))
    with pytest.raises(Exception, match="repeats a key"):
        running.apply_run(spark, tables, state, "1", twice, KEYS)
    assert running.batches(spark, state) == [] and unique_source(twice, KEYS, [F.asc("vote")]).count() == 1


def test_roll_calls_prune_the_folders_of_the_fact(spark, folders, members):
    """A condition on roll calls that names no congress: the scan of the fact gets its folders while it runs."""
    tables, state = folders
    frames = [ballots(spark, c, r, RUN1) for c, r in ((117, 1), (118, 2))]
    running.apply_run(spark, tables, state, "1", frames[0].union(frames[1]), KEYS)
    fact, votes, bills = (spark.read.parquet(f"{tables}/{n}") for n in ("fact_roll_call_vote", "dim_votes", "dim_bills"))
    context = running.stored(views.roll_call_context(None, votes, bills, majority=running.majority_table(spark, state)), "context")
    about = (F.col("title") == "Act 2") & (F.col("dem_majority_vote") == "Yea")
    found = views.votes_about(fact, context, members, about)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == rows(views.votes_by_member(fact, votes, members, bills).filter(about)) and found.count() == 7


def test_one_join_tells_what_a_run_changes(spark):
    """Old and new ballots meet once, led by one number; a null id and a row that came back unchanged included."""
    old = spark.createDataFrame([(118, 1, HOUSE, "k", 1, m, s, "HR1", v, "D") for m, s, v in (("M1", None, "Yea"), ("M2", None, "Yea"), (None, None, "Nay"), ("M4", "S4", "Nay"))], FACT)
    old = old.withColumn("congress", F.col("congress").cast("int"))  # as a folder gives it
    new = spark.createDataFrame([(118, 1, HOUSE, "k", 1, m, s, "HR1", v, "D") for m, s, v in (("M1", None, "Nay"), ("M2", None, "Yea"), (None, None, None), ("M5", None, "Yea"), ("M4", "S5", "Nay"))], FACT)
    found = running.changes(old, new, KEYS)
    assert rows(found.select("id", "vote", "sign")) == [
        ("M1", "Nay", 1), ("M1", "Yea", -1), ("M4", "Nay", 1), ("M5", "Yea", 1), (None, "Nay", -1), (None, None, 1)
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Aggregate" not in plan and "xxhash64" in plan
