"""Operators on small hand-made frames, one test per rule that is easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hemicycle.operators import checks, filters, joins, merge, nested, paging
from hemicycle.operators.dedupe import open_end_last, top_per_group
from hemicycle.operators.majority import alignment_ratios, majority_columns, party_majority
from hemicycle.operators.terms import term_islands, terms_condensed
from hemicycle.sources.names import clean_names


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- majority ----------------------------------------------------------------------------


@pytest.fixture
def ballots(spark):
    data = [
        ("b1", 1, "D", "Yea"), ("b1", 1, "D", "Yea"), ("b1", 1, "D", "Nay"),
        ("b1", 1, "R", "Nay"), ("b1", 1, "R", "Yea"),  # a tie goes to the first by name
        ("b2", 1, "D", "Not Voting"), ("b2", 1, "D", "Not Voting"), ("b2", 1, "D", "Yea"),
        ("b3", 1, "R", None), ("b3", 1, "R", None), ("b3", 1, "R", "Aye"),
        ("b3", 1, "L", "Aye"),
    ]
    return spark.createDataFrame(data, "bill_key string, roll int, party string, vote string")


def test_party_majority(ballots):
    got = rows(party_majority(ballots, ["bill_key", "roll"]))
    assert ("b1", 1, "D", "Yea", 2) in got
    assert ("b1", 1, "R", "Nay", 1) in got
    assert ("b2", 1, "D", "Not Voting", 2) in got
    assert ("b3", 1, "R", None, 2) in got
    assert len(got) == 5


def test_majority_columns_agree_with_long_form(ballots):
    wide = majority_columns(ballots, ["bill_key", "roll"], {"D": "d", "R": "r", "I": "i"})
    assert rows(wide) == [("b1", 1, "Yea", "Nay", None), ("b2", 1, "Not Voting", None, None), ("b3", 1, None, None, None)]


def test_alignment_counts_null_as_cast_and_drops_null_members(spark):
    data = [("m1", "Yea", 1), ("m1", None, 0), ("m1", "Not Voting", 1), ("m2", "Not Voting", 0), (None, "Yea", 1), ("m3", "Not Voting", 1), ("m3", "Yea", 1)]
    df = spark.createDataFrame(data, "id string, member_vote string, flag int")
    got = rows(alignment_ratios(df, ["id"], {"flag": "share"}))
    assert got == [("m1", 3, 2, 1.0), ("m2", 1, 0, None), ("m3", 2, 1, 2.0)]


# --- latest per group, terms -------------------------------------------------------------


def test_top_per_group_limits_before_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    top = top_per_group(df, ["k"], [F.desc("v")])
    assert rows(top) == [(0, 99), (1, 97), (2, 98)]
    assert plan(top).count("WindowGroupLimit") >= 2


def test_open_end_wins(spark):
    df = spark.createDataFrame([("m", 2001), ("m", None), ("m", 2020)], "m string, e int")
    assert rows(top_per_group(df, ["m"], [open_end_last("e")])) == [("m", None)]


TERMS = [
    ("a", "House", 2001, 2003), ("a", "House", 2003, 2005), ("a", "House", 2009, 2011), ("a", "Senate", 2011, None),
    ("b", "Senate", 2005, 2011),
]


def test_terms(spark):
    df = spark.createDataFrame(TERMS, "bioguideID string, chamber string, term_start_year int, term_end_year int")
    assert rows(terms_condensed(df)) == [("a", "House", 2001, 2011), ("a", "Senate", 2011, None), ("b", "Senate", 2005, 2011)]
    islands = rows(term_islands(df).drop("term_group"))
    assert islands == [
        ("a", "House", 2001, 2005), ("a", "House", 2009, 2011), ("a", "Senate", 2011, None), ("b", "Senate", 2005, 2011)
    ]


# --- joins -------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("listed", "kept"),
    [([1], [2]), ([1, None], []), ([], [1, 2, None]), ([None], []), ([1, 2, 1], [])],
)
def test_not_in_follows_null_rules(spark, listed, kept):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    values = spark.createDataFrame([(v,) for v in listed], "y int")
    got = joins.not_in_values(df, "x", values)
    assert sorted((r[0] for r in got.collect()), key=lambda v: (v is None, v or 0)) == kept
    df.createOrReplaceTempView("t_left")
    values.createOrReplaceTempView("t_list")
    assert rows(got) == rows(spark.sql("SELECT * FROM t_left WHERE x NOT IN (SELECT y FROM t_list)"))


def test_in_either_never_multiplies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, y string")
    got = joins.in_either(
        df, [("x", spark.createDataFrame([(1,), (1,), (None,)], "v int")), ("y", spark.createDataFrame([("a",), ("b",), ("b",)], "v string"))]
    )
    assert rows(got) == [(1, "a"), (2, "b")]


def test_override(spark):
    ids = spark.createDataFrame([("A", "S1"), ("B", None), ("C", "S3")], "k string, lisid string")
    patch = spark.createDataFrame([("A", "S9"), ("B", "S8"), ("C", None)], "k string, lisid string")
    assert rows(joins.override(ids, patch, "k", "lisid")) == [("A", "S9"), ("B", "S8"), ("C", "S3")]


# --- pages -------------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "exact", "compat"), [(0, 1, 1), (1, 1, 1), (25, 1, 1), (26, 2, 1), (60, 3, 2)])
def test_page_count(spark, n, exact, compat):
    df = spark.range(n)
    assert paging.page_count(df, 25).first()["pages"] == exact
    assert paging.page_count(df, 25, compat=True).first()["pages"] == compat


def test_pages_partition_the_rows(spark):
    df = spark.range(60).selectExpr("id", "id % 7 AS d")
    order = [F.desc("d"), F.asc("id")]
    seen = [r["id"] for p in (1, 2, 3) for r in paging.page(df, order, p, 25).collect()]
    assert sorted(seen) == list(range(60)) and len(seen) == 60
    compat = [r["id"] for r in paging.page(df, order, 1, 25, compat=True).collect()]
    assert len(compat) == 26 and compat[-1] == paging.page(df, order, 2, 25).first()["id"]


def test_page_after_walks_like_offset(spark):
    df = spark.range(60).selectExpr("id", "id % 7 AS d")
    order = [F.desc("d"), F.asc("id")]
    last = paging.page(df, order, 1, 25).collect()[-1]
    walked = paging.page_after(df, [("d", True), ("id", False)], [last["d"], last["id"]], 25)
    assert [tuple(r) for r in walked.collect()] == [tuple(r) for r in paging.page(df, order, 2, 25).collect()]


# --- filters, checks, nested -------------------------------------------------------------


def test_scope_session(spark):
    df = spark.createDataFrame([(117,), (118,), (119,)], "congress int")
    assert rows(filters.scope_session(df)) == [(118,), (119,)]
    assert rows(filters.scope_session(df, "119th Congress (2025-2027)")) == [(119,)]
    assert rows(filters.scope_session(df, 117)) == [(117,)]


def test_where_all(spark):
    df = spark.range(4)
    assert filters.where_all(df, [None, None]).count() == 4
    assert rows(filters.where_all(df, [F.col("id") > 1, None, F.col("id") < 3])) == [(2,)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "z")], "k int, v string")
    assert rows(checks.check_unique(df, ["k", "v"])) == [(1, "a", 2)]
    assert checks.check_not_null(df, "v").count() == 2
    known = spark.createDataFrame([("a",), ("a",), (None,)], "w string")
    assert rows(checks.check_relationship(df, "v", known, "w")) == [(3, "z")]


def test_unnest_and_as_list(spark):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "id int, a array<string>")
    assert rows(nested.unnest(df, "a", "e")) == [(1, "x"), (1, "y")]
    assert spark.range(1).select(nested.as_list(F.lit("S1")), nested.as_list(F.lit(None))).first()[:] == (["S1"], [""])


def test_clean_names_at_every_depth(spark):
    df = spark.createDataFrame([((1, [(2,)]),)], "`a-b` struct<`@c-d`:int,`e:f`:array<struct<`#g`:int>>>")
    clean = clean_names(df)
    assert clean.schema.simpleString() == "struct<a_b:struct<c_d:int,ef:array<struct<g:int>>>>"
    assert clean.select("a_b.c_d", F.col("a_b.ef")[0]["g"]).first()[:] == (1, 2)


# --- upsert ------------------------------------------------------------------------------

SCHEMA = "congress int, k string, v string, flowDate string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_merge_upsert(spark):
    old = frame(spark, [(1, "same", "a", "t0"), (1, "changed", "a", "t0"), (1, None, "a", "t0"), (2, "alone", "a", "t0")])
    new = frame(spark, [(1, "same", "a", "t1"), (1, "changed", None, "t1"), (1, None, "n", "t1"), (3, "fresh", "f", "t1")])
    expected = [
        (1, "changed", None, "t0"), (1, "same", "a", "t0"), (1, None, "n", "t0"), (2, "alone", "a", "t0"), (3, "fresh", "f", "t1"),
    ]
    once = merge.merge_upsert(old, new, ["congress", "k"])
    assert rows(once) == rows(frame(spark, expected))
    assert rows(merge.merge_upsert(once, new, ["congress", "k"])) == rows(once)


def test_merge_rejects_or_picks_among_repeated_keys(spark):
    old = frame(spark, [])
    new = frame(spark, [(1, "x", "a", "t"), (1, "x", "b", "t")])
    with pytest.raises(Exception, match="repeats a key"):
        merge.merge_upsert(old, new, ["congress", "k"]).collect()
    picked = merge.merge_upsert(old, new, ["congress", "k"], order=[F.desc("v")])
    assert rows(picked) == [(1, "x", "b", "t")]


def test_upsert_table_rewrites_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = ["congress", "k"]
    merge.upsert_table(spark, path, frame(spark, [(1, "x", "a", "t0"), (2, "y", "a", "t0")]), keys, partition_by="congress")
    untouched = {p.name for p in (tmp_path / "t" / "congress=2").iterdir()}
    merge.upsert_table(spark, path, frame(spark, [(1, "x", "b", "t1"), (1, "z", "c", "t1")]), keys, partition_by="congress")
    spark.catalog.refreshByPath(path)
    got = spark.read.parquet(path).select("congress", "k", "v", "flowDate")
    assert rows(got) == rows(frame(spark, [(1, "x", "b", "t0"), (1, "z", "c", "t1"), (2, "y", "a", "t0")]))
    assert {p.name for p in (tmp_path / "t" / "congress=2").iterdir()} == untouched


def test_older_version_does_not_replace_a_newer_one(spark):
    old = frame(spark, [(1, "x", "2024", "t0"), (1, "y", "2023", "t0"), (1, "z", None, "t0"), (1, "w", "2024", "t0")])
    new = frame(spark, [(1, "x", "2023", "t1"), (1, "y", "2024", "t1"), (1, "z", "2020", "t1"), (1, "w", None, "t1"), (1, "n", "1999", "t1")])
    got = merge.merge_upsert(old, new, ["congress", "k"], version=["v"]).select("k", "v")
    assert rows(got) == [("n", "1999"), ("w", "2024"), ("x", "2024"), ("y", "2024"), ("z", "2020")]


@pytest.mark.parametrize("folders", [None, "congress"])
def test_upsert_that_dies_loses_nothing(spark, tmp_path, monkeypatch, folders):
    path, keys = str(tmp_path / "t"), ["congress", "k"]
    first, second = frame(spark, [(1, "x", "a", "t0"), (2, "y", "a", "t0")]), frame(spark, [(1, "x", "b", "t1"), (3, "z", "b", "t1")])
    merge.upsert_table(spark, path, first, keys, partition_by=folders)
    whole = merge.rename
    for dies_at, expected in ((1, "a"), (2, "b"), (3, "b")):
        calls = []

        def dying(spark, old, new):
            calls.append(new)
            if len(calls) == dies_at:
                raise RuntimeError("the driver died")
            whole(spark, old, new)

        monkeypatch.setattr(merge, "rename", dying)
        with pytest.raises(RuntimeError, match="died"):
            merge.upsert_table(spark, path, second, keys, partition_by=folders)
        monkeypatch.setattr(merge, "rename", whole)
        assert merge.table_exists(spark, path)
        got = spark.read.parquet(path).select("k", "v")
        assert rows(got) == ([("x", "a"), ("y", "a")] if expected == "a" else [("x", "b"), ("y", "a"), ("z", "b")])


def test_folder_without_a_table_is_an_error(spark, tmp_path):
    (tmp_path / "t" / "_temporary").mkdir(parents=True)
    with pytest.raises(Exception, match="(?i)infer"):
        merge.upsert_table(spark, str(tmp_path / "t"), frame(spark, [(1, "x", "a", "t0")]), ["congress", "k"])


def test_unreadable_dates_fail(spark):
    df = spark.createDataFrame([(1, "2020-01-01", None)], "id int, updateDateIncludingText string, updateDate string")
    with pytest.raises(Exception, match="unreadable date: 2020-01-01"):
        merge.filter_new_bills(df, "2020-01-01T00:00:00Z").collect()


def test_marks(spark, tmp_path):
    df = spark.createDataFrame([("2020-01-01T00:00:00Z",), (None,)], "d string")
    assert merge.high_water_mark(df, "d").first()[0] == "2020-01-01T00:00:00Z"
    assert merge.high_water_mark(df.filter("false"), "d").first()[0] == merge.DEFAULT_MARK
    missing = merge.high_water_mark_of(spark, str(tmp_path / "none"), "d")
    assert spark.range(1).select(missing).first()[0] == merge.DEFAULT_MARK


def test_filter_new_bills_is_inclusive_and_falls_back(spark):
    data = [(1, "2020-01-01T00:00:00Z", None), (2, None, "2020-01-01T00:00:00Z"), (3, "2019-12-31T23:59:59Z", "2021-01-01T00:00:00Z"), (4, None, None)]
    df = spark.createDataFrame(data, "id int, updateDateIncludingText string, updateDate string")
    assert [r["id"] for r in merge.filter_new_bills(df, "2020-01-01T00:00:00Z").collect()] == [1, 2]


def test_filter_new_votes_dates_missing_as_1900(spark):
    df = spark.createDataFrame([(1, None), (2, "2020-01-01T00:00:00Z")], "id int, date string")
    assert [r["id"] for r in merge.filter_new_votes(df, "2015-01-01T00:00:00Z").collect()] == [2]
    assert merge.filter_new_votes(df, "1900-01-01T00:00:00Z").count() == 2


def test_filter_members(spark):
    schema = "id string, updateDate string, terms_all struct<item:array<struct<endYear:int>>>"
    day = "2020-01-01T00:00:00Z"
    data = [("open", day, ([(2001,), (None,)],)), ("late", day, ([(2016,)],)), ("early", day, ([(2015,)],)), ("old", "2010-01-01T00:00:00Z", ([(None,)],))]
    kept = merge.filter_members(spark.createDataFrame(data, schema), day)
    assert [r["id"] for r in kept.collect()] == ["open", "late"]
