"""The regular run on hand-made documents, from files to reports."""

import pytest
from pyspark.sql import functions as F

import documents as d
from conftest import rows
from hemicycle.operators.checks import check_relationship, check_unique
from hemicycle.plans import bills as b, extras, members as m, pipeline, reports, staging, views, votes as v
from hemicycle.sources import readers


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


HOUSE_BALLOTS = [
    ("M1", "D", "Yea"), ("M2", "D", "Yea"), ("M3", "R", "Nay"), ("M6", "R", "Nay"), ("M7", "R", "Yea"), ("M8", "D", "Not Voting"),
    ("M99", "I", "Present"),
]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    xml, votes, people, seeds = (root / n for n in ("bills", "votes", "people", "seeds"))
    late = "2023-03-01T12:00:00Z"
    put(xml / "118" / "hr", "hr1.xml", d.bill(
        1, "HR", 118, "2023-02-01T00:00:00Z", "First Act", ["M1"], ["M2", "M1"], [("hsag00", "Agriculture", "House")],
        [(7, "https://clerk.example/evs/2023/roll007.xml", "House", "2023-01-09T20:00:00Z"),
         (3, "https://senate.example/vote_118_1_00003.xml", "Senate", "2023-02-03T20:00:00Z")], "Agriculture and Food", late))
    put(xml / "118" / "hr", "hr1-old.xml", d.bill(1, "HR", 118, "2023-01-10T00:00:00Z", "First Act (draft)", ["M1"], text_date="2023-01-10T00:00:00Z"))
    put(xml / "118" / "s", "s2.xml", d.bill(2, "S", 118, "2023-02-02T00:00:00Z", "Second Act [a.b]", ["M4"], (), [("ssap00", "Appropriations", "Senate"), ("hsap00", "Appropriations", "House")]))
    put(xml / "113" / "x", "x3.xml", d.bill(3, "XX", 113, "2014-12-31T23:59:59Z", "Too old"))
    put(votes, "roll007.xml", d.house_roll(7, HOUSE_BALLOTS))
    put(votes, "vote_118_1_00003.xml", d.senate_roll(3, [("S44", "D", "Yea"), ("S5", "R", "Nay"), ("S77", "R", "Nay"), ("S78", "R", "Nay")]))
    put(people, "members.json", "\n".join([
        d.member("M1", "One", "Democratic", [("House of Representatives", 118, 1, 2023, None)]),
        d.member("M2", "Two", "Democratic", [("House of Representatives", 118, 3, 2019, 2021), ("House of Representatives", 118, 3, 2023, None)]),
        d.member("M3", "Three", "Republican", [("House of Representatives", 118, None, 2023, None)]),
        d.member("M4", "Sen1", "Democratic", [("House of Representatives", 112, 1, 2011, 2013), ("Senate", 118, None, 2013, None)]),
        d.member("M5", "Sen2", "Republican", [("Senate", 118, None, 2013, None)]),
        d.member("M6", "Six", None, [("House of Representatives", 117, 2, 2021, 2025)], current=False, parties=[("Republican", 2001), ("Libertarian", 2021)]),
        d.member("M7", "Seven", "Republican", [("House of Representatives", 118, 2, 2023, None)]),
        d.member("M8", "Eight", "Democratic", [("House of Representatives", 118, 2, 2023, None)]),
        d.member("M10", "Gone", "Democratic", [("Senate", 100, None, 1987, 1993)], current=False),
        d.member("M11", "Stale", "Democratic", [("Senate", 118, None, 2023, None)], updated="2001-01-01T00:00:00Z"),
    ]))
    put(root / "senators", "senators.xml", d.SENATORS)
    put(seeds, "senate_id_overrides.csv", d.OVERRIDES)
    put(seeds, "state_abbreviations.csv", d.STATES)
    put(seeds, "congressional_zones.csv", d.ZONES)

    landing, tables, out = (str(root / n) for n in ("landing", "tables", "out"))
    day = "2023-06-05"
    pipeline.land_senate_ids(spark, str(root / "senators"), landing)

    def step():
        pipeline.land_bills(spark, str(xml), landing, tables, day)
        pipeline.land_votes(spark, str(votes), landing, tables, day)
        pipeline.land_members(spark, str(people), landing, tables, day)
        pipeline.load_tables(spark, landing, str(seeds), tables)

    step()
    pipeline.export(spark, tables, out)

    class Run:
        pass

    Run.root, Run.landing, Run.tables, Run.out, Run.seeds, Run.step = root, landing, tables, out, str(seeds), staticmethod(step)
    Run.table = staticmethod(lambda name: spark.read.parquet(f"{tables}/{name}"))
    Run.view = staticmethod(lambda name: readers.read_view(spark, out, name))
    Run.land = staticmethod(lambda kind: readers.read_ndjson(spark, landing, kind))
    return Run


def test_landing_keeps_bills_from_the_mark_on(run):
    assert rows(run.land("bill_status").select("type", "number", "title")) == [
        ("HR", "1", "First Act"), ("HR", "1", "First Act (draft)"), ("S", "2", "Second Act [a.b]")
    ]


def test_lone_children_become_lists(run):
    found = run.land("bill_status").filter("title = 'First Act'").select("committees", "sponsors").first()
    assert found["committees"] == '{"item":[{"systemCode":"hsag00","name":"Agriculture","chamber":"House"}]}'
    assert found["sponsors"].startswith('{"item":[{"bioguideId":"M1"')


def test_roll_calls_get_their_bill(run):
    assert rows(run.land("house_votes").select("chamber", "bill_type", "bill_number")) == [("House of Representatives", "HR", 1)]
    assert rows(run.land("senate_votes").select("chamber", "bill_type", "bill_number")) == [("Senate", "HR", 1)]
    first = run.land("house_votes").select(F.expr("rollcall_vote.vote_data.recorded_vote[0]")).first()[0]
    assert (first["legislator"]["name_id"], first["legislator"]["text"], first["vote"]) == ("M1", "Name", "Yea")


def test_members_filter(run):
    ids = [r[0] for r in run.land("members").select("bioguideId").collect()]
    assert "M10" not in ids and "M11" not in ids and len(ids) == 8


def test_fact(run):
    fact = run.table("fact_roll_call_vote")
    assert fact.count() == len(HOUSE_BALLOTS) + 4
    house = fact.filter("bioguideID = 'M6'").select("congress", "session", "chamber", "roll_call_number", "bill_name", "lisid", "vote", "party")
    assert rows(house) == [(118, 1, "House of Representatives", 7, "HR1", None, "Nay", "R")]
    assert rows(fact.filter("lisid = 'S5'").select("bioguideID", "chamber", "vote")) == [(None, "Senate", "Nay")]


def test_roll_call_totals(run):
    cols = ["chamber", "vote_date", "yea_totals", "not_voting_totals", "D_yea_or_aye_votes", "R_nay_or_no_votes", "R_yea_or_aye_votes", "I_present_votes"]
    assert rows(run.table("dim_votes").select(*cols)) == [
        ("House of Representatives", "2023-01-09", 4, 1, 3, 2, 1, 0), ("Senate", "2023-02-03", 2, 1, 1, 3, 0, 0)
    ]


def test_bills_latest_version(run):
    got = rows(run.table("dim_bills").select("bill_name", "title", "policyArea", "url"))
    assert got == [
        ("HR1", "First Act", "Agriculture and Food", "https://www.congress.gov/bill/118th-congress/house-bill/1"),
        ("S2", "Second Act [a.b]", None, "https://www.congress.gov/bill/118th-congress/senate-bill/2"),
    ]


def test_sponsor_role_wins(run):
    got = run.table("dim_sponsors").join(run.table("dim_bills"), "bill_key").select("bill_name", "bioguideID", "sponsor_type")
    assert rows(got) == [("HR1", "M1", "Sponsor"), ("HR1", "M2", "Cosponsor"), ("S2", "M4", "Sponsor")]


def test_committees(run):
    assert rows(run.table("dim_committees").select("name", "chamber", "systemCode")) == [
        ("Agriculture", "House", "hsag00"), ("Appropriations", "House", "hsap00"), ("Appropriations", "Senate", "ssap00")
    ]
    assert run.table("bill_committee_bridge").count() == 3
    assert rows(run.table("dim_bill_subjects").select("subject").distinct()) == [("Budget",)]


def test_members(run):
    got = {r["bioguideID"]: (r["mostRecentChamber"], r["mostRecentParty"], r["lisid"]) for r in run.table("dim_members").collect()}
    assert got["M4"] == ("Senate", "Democratic", "S44")
    assert got["M5"] == ("Senate", "Republican", "S5")
    assert got["M6"] == ("House of Representatives", "Independent", None)


def test_a_lost_run_repeats_without_change(spark, run):
    before = {n: rows(run.table(n).drop("flowDate", "updateDatetime")) for n in pipeline.MODELS}
    stamp = rows(run.table("dim_bills").select("bill_key", "flowDate"))
    pipeline.load_tables(spark, run.landing, run.seeds, run.tables)
    spark.catalog.clearCache()
    assert {n: rows(run.table(n).drop("flowDate", "updateDatetime")) for n in pipeline.MODELS} == before
    assert rows(run.table("dim_bills").select("bill_key", "flowDate")) == stamp


def test_next_run_starts_at_the_mark(spark, run):
    from hemicycle.operators.merge import high_water_mark_of

    mark = high_water_mark_of(spark, f"{run.tables}/dim_bills", "updateDateIncludingText")
    assert spark.range(1).select(mark).first()[0] == "2023-03-01T12:00:00Z"


def test_votes_by_member(run):
    got = {
        (r["name"], r["member_vote"]): (r["partyName"], r["dem_majority_vote"], r["rep_majority_vote"], r["voted_with_dem_majority"], r["voted_with_rep_majority"], r["voted_with_party_majority"], r["title"])
        for r in run.view("vw_votes_by_member").collect()
    }
    assert got[("One, F", "Yea")] == ("Democratic", "Yea", "Nay", 1, 0, 1, "First Act")
    assert got[("Six, F", "Nay")] == ("Independent", "Yea", "Nay", 0, 1, 0, "First Act")
    assert got[("Sen1, F", "Yea")] == ("Democratic", "Yea", "Nay", 1, 0, 1, "First Act")
    # two unknown senators with the same vote show as one nameless row
    assert got[(None, "Nay")] == (None, "Yea", "Nay", 0, 1, 0, "First Act")
    assert run.view("vw_votes_by_member").count() == len(HOUSE_BALLOTS) + 3


def test_voting_members_and_zip(run):
    voting, districts = run.view("vw_voting_members"), run.view("dim_congressional_districts")
    house = reports.find_by_zip(voting, districts, "97201", "House of Representatives")
    # district 1 and 3 of the area; a district found in no area counts as 0, which the area lacks
    assert rows(reports.option_labels(house)) == [("One, F | D - OR",), ("Sen1, F | D - OR",), ("Two, F | D - OR",)]
    senate = reports.find_by_zip(voting, districts, 97201, "Senate")
    assert rows(senate.select("bioguideID")) == [("M4",), ("M5",)]
    assert reports.find_by_zip(voting, districts, 11111, "Senate").count() == 0
    assert rows(reports.find_by_name(voting, "SEV", "House of Representatives").select("lastName")) == [("Seven",)]
    assert rows(reports.member_by_label(run.view("dim_members"), "Two, F | D - OR").select("bioguideID")) == [("M2",)]


def test_alignment_and_summary(run):
    seen = run.view("vw_votes_by_member")
    got = {r["bioguideID"]: (r["n"], r["votes_cast"], r["party_majority_share"], r["dem_majority_share"]) for r in reports.alignment(seen, "House of Representatives").collect()}
    assert got["M1"] == (1, 1, 1.0, 1.0)
    assert got["M7"] == (1, 1, 0.0, 1.0)
    assert got["M8"] == (1, 0, None, None)
    said = reports.alignment_summary(seen, "M7", "House of Representatives", "Agriculture and Food").first()["sentence"]
    assert said == (
        "Rep. Seven's vote align with the Democratic majority 100% of the time <br>and the Republican majority 0% of the time"
        " on bills related to Agriculture and Food (n = 1 votes)"
    )
    rest = reports.others(reports.alignment(seen, "House of Representatives"), "M7")
    assert "M7" not in [r["bioguideID"] for r in rest.collect()]


def test_recent_lists(run):
    votes = reports.recent_votes(run.view("vw_votes_by_member"), "M1", keyword="FIRST", policy_area="Agriculture and Food")
    assert rows(reports.with_display(votes).select("member_vote_class", "rep_majority_vote_class", "title_linked")) == [
        ("yea", "nay", '<a href="https://www.congress.gov/bill/118th-congress/house-bill/1" target="_blank">First Act</a>')
    ]
    bills = run.view("vw_sponsored_bills_by_member")
    found = reports.recent_sponsored_bills(bills, "M4", keyword="[A.B]")
    assert rows(found) == [("Second Act [a.b]", "https://www.congress.gov/bill/118th-congress/senate-bill/2", "Sponsor", "-", "2023-01-09")]


def test_years_served(run):
    got = reports.years_served(run.view("vw_terms_condensed"), "M4")
    assert rows(got) == [("House of Representatives", 2011, "2013"), ("Senate", 2013, "-")]


def test_quality_checks(run):
    assert check_unique(run.table("dim_bills"), ["bill_key"]).count() == 0
    votes, bills = run.table("dim_votes"), run.table("dim_bills")
    assert check_relationship(votes, "bill_key", bills, "bill_key").count() == 2  # keys of unlike parts never meet
    assert check_relationship(votes, ["bill_name", "congress"], bills, ["bill_name", "congress"]).count() == 0


def test_loyalty(run):
    got = {r["bioguideID"]: r["perc_votes_with_party_majority"] for r in extras.party_loyalty(run.table("fact_roll_call_vote"), run.table("dim_votes"), run.table("dim_members")).collect()}
    # Republicans lead with nay in the House; M8 cast no ballot
    assert (got["M1"], got["M3"], got["M7"], got["M8"]) == (1.0, 1.0, 0.0, None)


def test_same_roll_number_in_other_session_and_chamber(spark):
    fact = spark.createDataFrame(
        [("k", 1, 118, s, c, "HR1", f"M{s}{c[0]}", None, vote, "D") for s, c, vote in ((1, "House", "Yea"), (2, "House", "Nay"), (1, "Senate", "Nay"))],
        "bill_key string, roll_call_number long, congress long, session long, chamber string, bill_name string, bioguideID string, lisid string, vote string, party string",
    )
    rolls = fact.selectExpr("bill_key", "roll_call_number", "congress", "session", "chamber", "bill_name", "'2023-01-01' AS vote_date", "'r' AS result", "'q' AS question")
    members = spark.createDataFrame([("M1H", "One", "Democratic", None)], "bioguideID string, invertedOrderName string, mostRecentParty string, lisid string")
    bills = spark.createDataFrame([], "bill_name string, congress long, policyArea string, title string, url string")
    loose = views.votes_by_member(fact, rolls, members, bills).filter("name = 'One'").first()
    strict = views.votes_by_member(fact, rolls, members, bills, strict=True).filter("name = 'One'").first()
    assert (loose["dem_majority_vote"], strict["dem_majority_vote"]) == ("Nay", "Yea")


def test_senate_ballots_of_one_document_count_once(spark):
    schema = readers.schemas.landing_schema("senate_votes")
    head = {"congress": "118", "session": "1", "vote_number": "3", "vote_date": "February 3, 2023,  05:30 PM", "count": {"yeas": "2"}}
    people = [("S1", "Yea"), ("S1", "Aye"), ("S2", "Not Voting"), ("S3", "Yea")]
    doc = {"roll_call_vote": head | {"members": {"member": [{"lis_member_id": i, "vote_cast": x, "party": "D"} for i, x in people]}}, "chamber": "Senate", "bill_number": 1, "bill_type": "S"}
    got = v.dim_senate_votes(spark.createDataFrame([doc, doc], schema))
    assert rows(got.select("D_yea_or_aye_votes", "D_abstain_votes", "yea_totals", "nay_totals")) == [(2, 0, 2, 0)]


def test_conform_fills_missing_lists(spark):
    landed = spark.createDataFrame([("1", "HR", '{"summary":{"actionDate":"2023-01-09","text":"Only"}}', None)], "number string, type string, summaries string, sponsors string")
    for col in readers.schemas.landing_schema("bill_status").names:
        if col not in landed.columns:
            landed = landed.withColumn(col, F.lit(None).cast("string"))
    bill = extras.conform_bill(extras.structured_bills(landed)).first()["bill"]
    assert bill["sponsors"]["item"] == [] and bill["actions"]["item"] == [] and bill["most_recent_text"] == "Only"


def test_latest_summary_is_cut_and_ignores_untexted(spark):
    data = [([("2023-01-01", "x" * 1500), ("2023-02-01", None), ("2022-01-01", "old")],), ([("2023-01-01", None)],), (None,)]
    df = spark.createDataFrame([(s,) for s in data], "summaries struct<summary:array<struct<actionDate:string,text:string>>>")
    assert [r[0] for r in extras.latest_summary(df).select("most_recent_text").collect()] == ["x" * 1000, None, None]


def test_recorded_vote_as_object_or_list(spark):
    one = '{"item":[{"recordedVotes":{"recordedVote":{"rollNumber":"1","chamber":"House"}}},{"text":"none"}]}'
    two = '{"item":[{"recordedVotes":{"recordedVote":[{"rollNumber":"2","chamber":"Senate"},{"rollNumber":"3","chamber":"House"}]}}]}'
    df = spark.createDataFrame([("9", "HR", one), ("9", "HR", two), ("9", "HR", None)], "number string, type string, actions string")
    assert rows(staging.recorded_votes(df).select("rollNumber", "chamber")) == [("1", "House of Representatives"), ("2", "Senate"), ("3", "House of Representatives")]


def test_roll_calls_of_several_years_share_a_file_name(spark, tmp_path):
    put(tmp_path / "2023", "roll007.xml", d.house_roll(7, HOUSE_BALLOTS, session="1st"))
    put(tmp_path / "2024", "roll007.xml", d.house_roll(7, HOUSE_BALLOTS, session="2nd"))
    named = spark.createDataFrame(
        [("118", "1", "7", "House", "1", "HR"), ("118", "2", "7", "House", "2", "HR")],
        "congress string, sessionNumber string, rollNumber string, chamber string, bill_number string, bill_type string",
    )
    found = readers.read_roll_calls_xml(spark, str(tmp_path), "rollcall-vote", named)
    assert rows(found.select("rollcall_vote.vote_metadata.session", "bill_number")) == [("1st", 1), ("2nd", 2)]


def test_unreadable_input_fails_the_run(spark, tmp_path):
    put(tmp_path / "landing" / "bill_status", "a.json", '{"number":"1"}\n{"number":"2",\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_ndjson(spark, str(tmp_path / "landing"), "bill_status").collect()
    whole = d.bill(1, "HR", 118, "2023-02-01T00:00:00Z", "First Act", ["M1"])
    put(tmp_path / "bills", "cut.xml", whole[: len(whole) * 2 // 3])
    with pytest.raises(Exception, match="(?i)malformed|unread"):
        readers.read_bills_xml(spark, str(tmp_path / "bills")).collect()
