"""Readers and writers: each query writes what Spark derives from a table and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.operators import merge
from hemicycle.plans import bills as b, staging, votes as v
from hemicycle.session import scratch_path
from hemicycle.sources import readers, sinks
from parity import shapes
from parity.registry import Tables, query
from parity.star_sql import star


def _text(df: DataFrame, expr: str, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.selectExpr(f"{expr} AS value").write.text(path)
    return path


@query(
    "xml_roundtrip",
    """SELECT p_partkey::VARCHAR AS number, 'HR' AS type, p_name AS title, 'Area ' || p_brand AS area,
         'Committee ' || p_size || CASE WHEN p_size > 25 THEN ',Second' ELSE '' END AS committees, p_type AS subject
       FROM part""",
)
def _(t: Tables) -> DataFrame:
    xml = """concat('<bill><number>', p_partkey, '</number><type>HR</type><title>', p_name,
        '</title><policyArea><name>Area ', p_brand, '</name></policyArea><committees><item><name>Committee ', p_size,
        '</name></item>', CASE WHEN p_size > 25 THEN '<item><name>Second</name></item>' ELSE '' END, '</committees>',
        '<subjects><legislativeSubjects><item><name>', p_type, '</name></item></legislativeSubjects></subjects></bill>')"""
    bills = readers.read_bills_xml(t.spark, _text(t.part, xml, "bills-xml"), glob="part-*", bundled=True)
    return bills.select(
        "number", "type", "title", F.col("policyArea.name").alias("area"),
        F.array_join("committees.item.name", ",").alias("committees"),
        F.array_join("subjects.legislativeSubjects.item.name", ",").alias("subject"),
    )


@query(
    "house_xml",
    """SELECT o_orderkey::VARCHAR AS rollcall_num, strftime(o_orderdate, '%Y-%m-%d') AS vote_date, 'C' || (o_custkey + i) AS name_id,
         'Legislator ' || o_custkey AS text, o_orderpriority AS vote, 'House of Representatives' AS chamber
       FROM orders, (SELECT unnest([0, 1]) AS i)""",
)
def _(t: Tables) -> DataFrame:
    from hemicycle.functions.dates import house_date

    ballot = (
        "'<recorded-vote><legislator name-id=\"C', o_custkey + {i}, '\" party=\"D\">Legislator ', o_custkey, "
        "'</legislator><vote>', o_orderpriority, '</vote></recorded-vote>'"
    )
    xml = (
        "concat('<rollcall-vote><vote-metadata><rollcall-num>', o_orderkey, '</rollcall-num><action-date>', "
        "date_format(o_orderdate, 'd-MMM-yyyy'), '</action-date></vote-metadata><vote-data>', "
        + ballot.format(i=0) + ", " + ballot.format(i=1) + ", '</vote-data></rollcall-vote>')"
    )
    rolls = readers.read_roll_calls_xml(t.spark, _text(t.orders, xml, "house-xml"), "rollcall-vote", glob="part-*", bundled=True)
    ballots = rolls.select(
        F.col("rollcall_vote.vote_metadata.rollcall_num").alias("rollcall_num"),
        house_date("rollcall_vote.vote_metadata.action_date").alias("vote_date"),
        "chamber",
        F.explode("rollcall_vote.vote_data.recorded_vote").alias("b"),
    )
    return ballots.select("rollcall_num", "vote_date", "b.legislator.name_id", "b.legislator.text", "b.vote", "chamber")


@query(
    "senate_xml",
    """SELECT o_orderkey::VARCHAR AS vote_number, 'S' || o_custkey AS lis_member_id, o_orderpriority AS vote_cast, 'Senate' AS chamber,
         o_orderstatus AS yeas FROM orders""",
)
def _(t: Tables) -> DataFrame:
    xml = (
        "concat('<roll_call_vote><vote_number>', o_orderkey, '</vote_number><count><yeas>', o_orderstatus, '</yeas></count>"
        "<members><member><vote_cast>', o_orderpriority, '</vote_cast><lis_member_id>S', o_custkey, "
        "'</lis_member_id></member></members></roll_call_vote>')"
    )
    rolls = readers.read_roll_calls_xml(t.spark, _text(t.orders, xml, "senate-xml"), "roll_call_vote", glob="part-*", bundled=True)
    return rolls.select(
        "roll_call_vote.vote_number", "roll_call_vote.count.yeas", "chamber", F.explode("roll_call_vote.members.member").alias("m")
    ).select("vote_number", "yeas", "chamber", "m.lis_member_id", "m.vote_cast")


@query(
    "senate_ids_xml",
    """SELECT s_name AS last_name, 'C' || s_suppkey AS "bioguideID", unnest(CASE WHEN s_nationkey < 5 THEN ['']
         WHEN s_nationkey < 15 THEN ['S' || s_suppkey] ELSE ['S' || s_suppkey, 'T' || s_suppkey] END) AS lisid FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    xml = (
        "concat('<senator><full_name><first_name>F</first_name><last_name>', s_name, '</last_name></full_name><bioguide>C', "
        "s_suppkey, '</bioguide>', CASE WHEN s_nationkey < 5 THEN '' WHEN s_nationkey < 15 THEN concat('<lisid>S', s_suppkey, '</lisid>') "
        "ELSE concat('<lisid>S', s_suppkey, '</lisid><lisid>T', s_suppkey, '</lisid>') END, '</senator>')"
    )
    ids = readers.read_senate_ids_xml(t.spark, _text(t.supplier, xml, "senators-xml"), glob="part-*", bundled=True)
    return staging.stage_senate_ids(ids).select("last_name", "bioguideID", "lisid")


@query("ndjson_roundtrip", star("SELECT * FROM fact", "fact"))
def _(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "landing")
    sinks.write_run(shapes.house_votes(t.orders), f"{root}/{readers.HOUSE_VOTES}", "2024-05-06", 100_000)
    sinks.write_run(shapes.senate_votes(t.orders), f"{root}/{readers.SENATE_VOTES}", "2024-05-06", 100_000)
    house, senate = (readers.read_ndjson(t.spark, root, kind) for kind in (readers.HOUSE_VOTES, readers.SENATE_VOTES))
    return v.fact_roll_call_vote(staging.stage_house_votes(house), staging.stage_senate_votes(senate))


@query("landing_bills", star("SELECT * FROM sponsors", "sponsors"))
def _(t: Tables) -> DataFrame:
    """JSON parts written as nested values come back as JSON text."""
    from hemicycle.plans.extras import structured_bills

    root = scratch_path(t.spark, "landing")
    sinks.write_run(structured_bills(shapes.bills(t.orders)), f"{root}/{readers.BILLS}", "2024-05-06")
    return b.dim_sponsors(staging.stage_bills(readers.read_ndjson(t.spark, root, readers.BILLS)))


@query("landing_members", star('SELECT "bioguideID", chamber, term_start_year, term_end_year FROM all_terms', "members"))
def _(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "landing")
    sinks.write_run(shapes.members(t.customer), f"{root}/{readers.MEMBERS}", "2024-05-06")
    terms = staging.stage_terms(readers.read_members(t.spark, root))
    return terms.select("bioguideID", "chamber", "term_start_year", "term_end_year")


@query("csv_roundtrip", """SELECT n_name AS "Name", 'N' || n_nationkey AS "Abbreviation" FROM nation""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "seed")
    states = t.nation.selectExpr("n_name AS Name", "concat('N', n_nationkey) AS Abbreviation")
    states.write.option("header", "true").csv(path)
    return readers.read_seed(t.spark, path, "state_abbreviations")


@query("parquet_export", star("SELECT DISTINCT bill_key, roll_call_number, congress, chamber, result FROM head", "doc"))
def _(t: Tables) -> DataFrame:
    out = scratch_path(t.spark, "export")
    rolls = shapes.roll_calls(t.orders).select("bill_key", "roll_call_number", "congress", "chamber", "result").distinct()
    sinks.export_views({"dim_votes": rolls}, out, partition_by="congress")
    back = readers.read_view(t.spark, out, "dim_votes")
    return back.withColumn("congress", F.col("congress").cast("bigint"))


@query(
    "run_partition",
    """SELECT o_orderkey, '2024-01-01' AS run_date FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, '2024-01-02' FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "runs")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    first, second = rows.filter("o_orderstatus = 'F'"), rows.filter("o_orderstatus <> 'F'")
    for df, day in ((rows, "2024-01-01"), (second, "2024-01-02"), (first, "2024-01-01")):
        sinks.write_run(df.select("o_orderkey"), path, day, 100_000)
    back = t.spark.read.schema("o_orderkey bigint, run_date string").json(path)
    return back


@query(
    "split_by_chamber",
    star("SELECT chamber, lisid, \"bioguideID\", vote FROM fact", "fact"),
)
def _(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "split")
    house, senate = sinks.split_by_chamber(shapes.fact(t.orders))
    sinks.write_ndjson(house, f"{root}/house", 10_000)
    sinks.write_ndjson(senate, f"{root}/senate", 10_000)
    schema = "chamber string, lisid string, bioguideID string, vote string"
    return t.spark.read.schema(schema).json([f"{root}/house", f"{root}/senate"])


@query(
    "upsert_table",
    """SELECT o_orderkey AS k, o_orderstatus AS st, CASE WHEN o_orderstatus = 'O' THEN 'first' ELSE 'second' END AS v FROM orders""",
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "upsert")
    rows = t.orders.selectExpr("o_orderkey AS k", "o_orderstatus AS st", "'first' AS v")
    keys = ["k", "st"]
    merge.upsert_table(t.spark, path, rows.filter("st <> 'P'"), keys, partition_by="st")
    merge.upsert_table(t.spark, path, rows.filter("st <> 'O'").withColumn("v", F.lit("second")), keys, partition_by="st")
    return t.spark.read.parquet(path)


@query(
    "merge_replay",
    """SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN '2023' ELSE '2024' END AS ver,
         CASE WHEN o_orderstatus = 'P' THEN 'old' ELSE o_orderstatus END AS v FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """An older run that is loaded after a newer one adds rows and changes none."""
    path = scratch_path(t.spark, "replay")
    newer = t.orders.filter("o_orderstatus <> 'P'").selectExpr("o_orderkey AS k", "'2024' AS ver", "o_orderstatus AS v")
    older = t.orders.selectExpr("o_orderkey AS k", "'2023' AS ver", "'old' AS v")
    for run in (newer, older):
        merge.upsert_table(t.spark, path, run, ["k"], version=["ver"])
    return t.spark.read.parquet(path)


@query("overwrite_table", star("SELECT * FROM districts", "districts"))
def _(t: Tables) -> DataFrame:
    from hemicycle.plans.members import dim_congressional_districts

    path = scratch_path(t.spark, "districts")
    for _run in range(2):
        sinks.overwrite_table(dim_congressional_districts(shapes.zones(t.customer), shapes.states(t.nation)), path)
    return t.spark.read.parquet(path)
