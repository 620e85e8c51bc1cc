"""Tables that are one row group are dealt to tasks before they grow."""

import datetime

from pyspark.sql import functions as F

from conftest import rows
from hemicycle.functions.json import parse_parts
from hemicycle.operators import page_index, text_index
from hemicycle.operators.filters import search_text
from hemicycle.plans import members as mem
from hemicycle.plans.bills import dim_sponsors
from hemicycle.plans.staging import stage_house_votes
from hemicycle.plans.votes import dim_house_votes
from hemicycle.session import SQL_SETTINGS
from parity import runs, shapes
from parity.registry import Tables


def test_members_are_dealt_before_their_terms_are_made(spark):
    customer = spark.createDataFrame([(k, k % 3, f"n{k}", "s", 5000.0) for k in range(20)], "c_custkey long, c_nationkey int, c_name string, c_mktsegment string, c_acctbal double")
    for made in (shapes.members(customer), shapes.senate_ids(customer)):
        assert "RepartitionByExpression [c_custkey" in made._jdf.queryExecution().optimizedPlan().toString()
        assert made.count() == 20
    # What is put together again is put together to a size that unpacks to some hundred MB.
    assert int(SQL_SETTINGS["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) <= 1 << 24


def test_a_ranked_term_holds_every_column_once(spark):
    schema = "bioguideID string, chamber string, congress long, district long, term_end_year long, memberType string, term_start_year long, stateCode string, stateName string, note string"
    terms = spark.createDataFrame(
        [("A", "Senate", 108, None, 2006, "M", 2001, "NY", "x", "early"), ("A", "House", 109, 4, 2004, "M", 2003, "NY", "x", "late"), ("B", "House", 109, 4, None, "M", 2003, "NY", "x", "b"), (None, "House", 1, 1, 1, "M", 1, "NY", "x", "none")], schema
    )
    members = spark.createDataFrame([("A", False), ("B", None)], "bioguideId string, currentMember boolean")
    recent = mem.most_recent_chamber(terms, members)
    assert recent.columns == terms.columns
    assert rows(recent.select("bioguideID", "chamber", "note")) == [("A", "Senate", "early"), ("B", "House", "b")]
    serving = spark.createDataFrame([("A", True)], "bioguideId string, currentMember boolean")
    assert rows(mem.most_recent_chamber(terms.filter("bioguideID = 'A'"), serving).select("note")) == [("late",)]
    plan = recent._jdf.queryExecution().optimizedPlan().toString()
    assert "term, struct(" not in plan


def test_tasks_of_an_index_are_bounded_by_letters(spark, tmp_path, monkeypatch):
    # One partition, as of one row group; a long text, texts of one key, a text of letters beyond 16 bits.
    texts = [(n, f"Title number {n} of all") for n in range(40)] + [(7, "title number 7"), (7, "TITLE NUMBER 7"), (50, "ab" * 3000), (51, "\U0001f600a\U0001f600"), (None, "title"), (52, None)]
    titles = spark.createDataFrame(texts, "id long, title string").coalesce(1)
    path = str(tmp_path)
    monkeypatch.setattr(text_index, "LETTERS_PER_TASK", 1000)
    text_index.build_index(titles, "id", "title", path)
    postings = spark.read.parquet(f"{path}/postings")
    assert len(postings.inputFiles()) >= 5
    assert postings.count() == postings.distinct().count() and postings.filter("key = 50").count() == 4
    keyed = titles.filter("id is not null")
    for term in ("title number 7", "7", "bab", "\U0001f600A\U0001f600", "zz"):
        assert rows(text_index.search_index(keyed, "id", "title", term, path)) == rows(search_text(keyed, "title", term))


def test_ranges_of_pages_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(page_index, "MAX_RANGES", 3)
    order = [F.desc_nulls_last("day"), F.asc("id")]
    table = spark.range(200).select("id", F.when(F.col("id") % 9 > 0, F.col("id") % 4).alias("day"))
    page_index.build_pages(table, order, str(tmp_path), 10)
    assert 2 <= len(page_index.ranges_of(spark, str(tmp_path))) <= 3
    whole = table.orderBy(*order).collect()
    for number in range(1, 10):
        found = page_index.read_page(spark, str(tmp_path), order, number, 25)
        assert found.collect() == whole[25 * (number - 1) : 25 * number]
    # The place goes to the scan, which so skips pages of a range's file.
    assert "GreaterThanOrEqual(__place" in page_index.read_page(spark, str(tmp_path), order, 2, 25)._jdf.queryExecution().executedPlan().toString()


def test_sponsors_take_one_pass_over_the_bills(spark):
    item = '{"item":[{"bioguideId":"%s"},{"bioguideId":"%s"}]}'
    bills = spark.createDataFrame(
        [("a", item % ("A", "B"), None), ("b", None, item % ("A", "A")), ("c", None, None), ("d", '{"item":[]}', "no json"), ("e", item % ("A", "B"), item % ("B", "C")), (None, item % ("Z", "Z"), None)],
        "bill_key string, sponsors string, cosponsors string",
    )
    expected = [("a", "A", "Sponsor"), ("a", "B", "Sponsor"), ("b", "A", "Cosponsor"), ("e", "A", "Sponsor"), ("e", "B", "Sponsor"), ("e", "B", "Cosponsor"), ("e", "C", "Cosponsor"), (None, "Z", "Sponsor")]
    for made in (bills, parse_parts(bills, ["sponsors", "cosponsors"])):
        found = dim_sponsors(made)
        assert rows(found) == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])
        assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"


def test_the_ballots_of_a_run_are_dealt_before_they_are_made(spark, tmp_path, monkeypatch):
    found = []
    monkeypatch.setattr(runs.running, "apply_run", lambda spark, tables, state, name, ballots, *more: found.append(ballots))
    orders = [(k, k % 5, "OFP"[k % 3], "1-URGENT", datetime.datetime(1996, 1 + k % 12, 1 + k % 28)) for k in range(40)]
    spark.createDataFrame(orders, ORDERS).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    runs.run_all(Tables(spark, str(tmp_path)))
    assert len(found) == 3
    for ballots, n in zip(found, (20, 20, 15), strict=True):
        plan = ballots._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate explode") < plan.index("RepartitionByExpression [o_orderkey")
        assert ballots.count() == 3 * n


def test_documents_of_a_roll_call_go_before_their_totals_are_unnested(spark):
    orders = [(k, k, "F", "1-URGENT", datetime.datetime(1996, 1, 2)) for k in range(12)]
    votes = stage_house_votes(shapes.house_votes(spark.createDataFrame(orders, ORDERS)))
    found = dim_house_votes(votes)
    assert found.count() == 1
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    unnested = [n for n, line in enumerate(lines) if "Generate explode(totals" in line]
    assert unnested and all(any("Aggregate" in line for line in lines[n + 1 : n + 3]) for n in unnested)
