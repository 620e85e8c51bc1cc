"""Landing folders delivered as streams, against the batch load of the same runs."""

import pytest

import documents as d
from conftest import rows
from hemicycle.plans import pipeline
from hemicycle.sources import readers, sinks
from hemicycle.streaming import delivery

REFS = "congress string, sessionNumber string, rollNumber string, chamber string, bill_number string, bill_type string"


def land_votes(spark, root, landing, day, ballots):
    """A run of one House roll call."""
    folder = root / f"votes{day}"
    folder.mkdir()
    (folder / "r.xml").write_text(d.house_roll(7, ballots))
    refs = spark.createDataFrame([("118", "1", "7", "House", "1", "HR")], REFS)
    sinks.write_run(readers.read_roll_calls_xml(spark, str(folder), "rollcall-vote", refs), f"{landing}/house_votes", f"2023-06-0{day}")


def test_micro_batches_equal_the_batch_load(spark, tmp_path, monkeypatch):
    """Three runs with a corrected ballot; the second dies between its two tables and is taken again."""
    landing, streamed, batch, marks = (f"{tmp_path}/{n}" for n in ("landing", "streamed", "batch", "marks"))
    plain, calls = pipeline.upsert_table, []

    def counted(spark, path, *more, **named):
        calls.append(path)
        if len(calls) == 4:
            raise ZeroDivisionError
        plain(spark, path, *more, **named)

    monkeypatch.setattr(pipeline, "upsert_table", counted)

    def deliver():
        return delivery.deliver(spark, landing, "", streamed, marks, kinds=("house_votes",))["house_votes"]

    none = spark.createDataFrame([], readers.schemas.landing_schema("senate_votes"))
    for day, vote in ((1, "Yea"), (2, "Nay"), (3, "Nay")):
        land_votes(spark, tmp_path, landing, day, [("M1", "D", vote), ("M2", "D", "Yea"), (f"M{2 + day}", "R", "Nay")])
        if day == 2:
            with pytest.raises(Exception, match="(?i)zero"):
                deliver()
        assert deliver() == 1
    done = len(calls)
    assert deliver() == 0 and len(calls) == done == 8
    monkeypatch.undo()
    for day in (1, 2, 3):
        pipeline.store_tables(spark, pipeline.vote_tables(readers.read_ndjson(spark, landing, "house_votes", f"2023-06-0{day}"), none), batch)
    for name in ("dim_votes", pipeline.FACT):
        ours, theirs = (spark.read.parquet(f"{t}/{name}").drop("flowDate") for t in (streamed, batch))
        assert rows(ours) == rows(theirs), name
    assert rows(spark.read.parquet(f"{streamed}/{pipeline.FACT}").select("bioguideID", "vote")) == [
        ("M1", "Nay"), ("M2", "Yea"), ("M3", "Nay"), ("M4", "Nay"), ("M5", "Nay")
    ]


def test_bills_and_members(spark, tmp_path):
    landing, seeds, tables = f"{tmp_path}/landing", tmp_path / "seeds", f"{tmp_path}/tables"
    for folder in ("bills", "senators", "seeds"):
        (tmp_path / folder).mkdir()
    (tmp_path / "bills" / "b.xml").write_text(d.bill(1, "HR", 118, "2023-02-01T00:00:00Z", "First Act", ["M1"], ["M2"]))
    (tmp_path / "senators" / "s.xml").write_text(d.SENATORS)
    (seeds / "senate_id_overrides.csv").write_bytes(d.OVERRIDES.encode())
    sinks.write_run(readers.read_bills_xml(spark, str(tmp_path / "bills")), f"{landing}/bill_status", "2023-06-01")
    (tmp_path / "landing" / "members" / "run_date=2023-06-01").mkdir(parents=True)
    (tmp_path / "landing" / "members" / "run_date=2023-06-01" / "m.json").write_text(d.member("M1", "One", "Democratic", [("House of Representatives", 118, 1, 2023, None)]))
    pipeline.land_senate_ids(spark, str(tmp_path / "senators"), landing)
    got = delivery.deliver(spark, landing, str(seeds), tables, f"{tmp_path}/marks", state=f"{tmp_path}/state", kinds=("bill_status", "members"))
    assert got == {"bill_status": 1, "members": 1}
    assert rows(spark.read.parquet(f"{tables}/dim_sponsors").select("bioguideID", "sponsor_type")) == [("M1", "Sponsor"), ("M2", "Cosponsor")]
    assert spark.read.parquet(f"{tables}/dim_members").select("mostRecentParty").first()[0] == "Democratic"


def test_unreadable_lines_fail(spark, tmp_path):
    (tmp_path / "bill_status" / "run_date=2023-01-01").mkdir(parents=True)
    (tmp_path / "bill_status" / "run_date=2023-01-01" / "a.json").write_text('{"number":"1"}\n{"number":"2",\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        delivery.take_new(delivery.landing_stream(spark, str(tmp_path), "bill_status"), f"{tmp_path}/marks", lambda rows, n: rows.collect())
