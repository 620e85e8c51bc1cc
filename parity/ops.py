"""Generic operators over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.functions import dates, json as js, keys, text, votes as vt
from hemicycle.operators import checks, filters, joins, merge, nested, paging
from hemicycle.operators.dedupe import top_per_group
from hemicycle.operators.joins import attach_totals
from hemicycle.plans import reports
from hemicycle.plans.extras import strict_greatest
from hemicycle.plans.votes import party_totals
from hemicycle.sources.names import clean_names
from hemicycle.sources.readers import query_with_dates
from parity import shapes
from parity.registry import Tables, query
from parity.star import Star, text_dates
from parity.star_sql import star

# --- latest per group, joins -------------------------------------------------------------


@query(
    "latest_order",
    """SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    picked = top_per_group(
        t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"), ["o_custkey"],
        [F.desc("o_orderdate"), F.desc("o_orderkey")],
    )
    return text_dates(picked, "o_orderdate")


@query(
    "in_values",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def _(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return joins.in_values(t.customer, "c_custkey", urgent).select("c_custkey", "c_name")


@query(
    "not_in_values",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def _(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return joins.not_in_values(t.customer, "c_custkey", urgent).select("c_custkey", "c_name")


@query(
    "in_either",
    """SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)
       OR c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)""",
)
def _(t: Tables) -> DataFrame:
    dear = t.orders.filter("o_totalprice > 490000").select("o_custkey")
    poor = t.supplier.filter("s_acctbal < 0").select("s_nationkey")
    return joins.in_either(t.customer, [("c_custkey", dear), ("c_nationkey", poor)]).select("c_custkey", "c_nationkey")


@query(
    "party_totals",
    """SELECT s.s_nationkey, l_returnflag, l_linestatus,
              count(CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 1 END)::BIGINT AS early,
              d."A_qty", d."N_qty", d."R_qty"
       FROM lineitem JOIN supplier s ON l_suppkey = s_suppkey JOIN (
         SELECT s_nationkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS "A_qty",
           sum(CASE WHEN l_returnflag = 'N' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS "N_qty",
           sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS "R_qty"
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey) d ON s.s_nationkey = d.s_nationkey
       GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "s_nationkey", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("qty"), "l_shipdate"
    )
    early = F.count(F.when(F.col("l_shipdate") < "1998-01-01", 1))
    detail = lines.groupBy("s_nationkey", "l_returnflag", "l_linestatus").agg(early.alias("early"))
    totals = party_totals(lines, ["s_nationkey"], {"qty": "qty"}, "l_returnflag", {c: c for c in "ANR"})
    return attach_totals(detail, totals, ["s_nationkey"])


# --- filters, search, pages --------------------------------------------------------------


@query("search_title", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%red w%'")
def _(t: Tables) -> DataFrame:
    return filters.search_text(t.part, "p_name", "RED w").select("p_partkey", "p_name")


@query("search_documents", "SELECT doc_id, lang, md5(text) AS digest FROM documents WHERE lower(text) LIKE '%tion the%'")
def _(t: Tables) -> DataFrame:
    found = filters.search_text(t.documents, "text", "Tion The")
    return found.select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    "optional_filters",
    """SELECT p_partkey, p_name, coalesce(nullif(p_brand, 'Brand#1'), '-') AS brand FROM part
       WHERE p_size IN (1, 5, 9) AND p_type = 'SMALL'""",
)
def _(t: Tables) -> DataFrame:
    chosen = filters.where_all(t.part, [F.col("p_size").isin(1, 5, 9), None, F.col("p_type") == "SMALL"])
    brand = F.nullif("p_brand", F.lit("Brand#1"))
    return chosen.select("p_partkey", "p_name", brand.alias("brand")).fillna({"brand": "-"})


@query(
    "recent_page",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
       ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 100 OFFSET 200""",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return text_dates(paging.page(rows, [F.desc("o_orderdate"), F.asc("o_orderkey")], 3, 100), "o_orderdate")


@query(
    "page_after",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
       WHERE orders.o_orderdate < TIMESTAMP '1998-06-01' OR (orders.o_orderdate = TIMESTAMP '1998-06-01' AND o_orderkey > 500)
       ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 50""",
)
def _(t: Tables) -> DataFrame:
    import datetime

    rows = t.orders.select("o_orderkey", "o_orderdate")
    last = [datetime.datetime(1998, 6, 1), 500]
    rows = rows.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return text_dates(paging.page_after(rows, [("o_orderdate", True), ("o_orderkey", False)], last, 50), "o_orderdate")


@query("page_count", 'SELECT count(*) AS "rows", greatest(1, ceil(count(*) / 25))::BIGINT AS pages FROM events')
def _(t: Tables) -> DataFrame:
    return paging.page_count(t.events, 25)


@query("page_count_compat", 'SELECT count(*) AS "rows", greatest(1, floor(count(*) / 100))::BIGINT AS pages FROM lineitem')
def _(t: Tables) -> DataFrame:
    return paging.page_count(t.lineitem, 100, compat=True)


@query(
    "brand_counts",
    """SELECT l_suppkey, p_brand, count(*) AS n, p_brand || ' | (n=' || count(*) || ')' AS label
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_brand""",
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return filters.policy_area_counts(lines, None, "l_suppkey", "p_brand")


@query(
    "member_by_label",
    star("""SELECT "bioguideID", "invertedOrderName" FROM members WHERE "invertedOrderName" = (SELECT c_name || ', ' || c_mktsegment FROM customer ORDER BY c_custkey DESC LIMIT 1)
            ORDER BY "bioguideID" LIMIT 1""", "members"),
)
def _(t: Tables) -> DataFrame:
    # the label of the last customer, as the option list would show it
    label = t.customer.select(
        vt.member_label(F.concat("c_name", F.lit(", "), "c_mktsegment"), F.lit("Democratic"), F.lit("N1")).alias("label"),
        "c_custkey",
    ).orderBy(F.desc("c_custkey")).first()["label"]
    return reports.member_by_label(Star(t).members, label).select("bioguideID", "invertedOrderName")


# --- JSON, arrays, structs ---------------------------------------------------------------


@query("json_scalar", "SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS nested FROM events")
def _(t: Tables) -> DataFrame:
    wrapped = F.concat(F.lit('{"outer":'), "props", F.lit("}"))
    return t.events.select("event_id", js.json_scalar("props", "$.k").alias("k"), js.json_scalar(wrapped, "$.outer").alias("nested"))


@query(
    "json_explode",
    "SELECT event_id, unnest([event_type, json_extract_string(props, '$.k')]) AS name FROM events WHERE event_type <> 'error'",
)
def _(t: Tables) -> DataFrame:
    items = F.when(
        F.col("event_type") != "error",
        F.concat(
            F.lit('{"item":[{"name":"'), "event_type", F.lit('"},{"name":"'), F.get_json_object("props", "$.k"), F.lit('"}]}')
        ),
    )
    rows = js.json_explode(t.events.select("event_id", items.alias("items")), "items", "$.item", "item")
    return rows.select("event_id", js.json_scalar("item", "$.name").alias("name"))


@query("unnest_array", "SELECT vec_id, label, floor(e * 1000)::BIGINT AS e FROM (SELECT vec_id, label, unnest(embedding)::DOUBLE AS e FROM embeddings)")
def _(t: Tables) -> DataFrame:
    rows = nested.unnest(t.embeddings, "embedding", "e")
    return rows.select("vec_id", "label", F.floor(F.col("e").cast("double") * 1000).alias("e"))


@query(
    "flatten_struct",
    "SELECT n_nationkey, n_name, r_name, r_regionkey, n_regionkey FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def _(t: Tables) -> DataFrame:
    packed = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.struct("n_nationkey", "n_name").alias("n"), F.struct("r_name", "r_regionkey").alias("r"), "n_regionkey"
    )
    return nested.flatten(packed, "n", "r")


@query("clean_names", 'SELECT s_suppkey AS supp_key, s_name AS text, s_nationkey AS nation_key FROM supplier')
def _(t: Tables) -> DataFrame:
    odd = t.supplier.select(
        F.col("s_suppkey").alias("@supp-key"),
        F.struct(F.col("s_name").alias("#text"), F.array(F.struct(F.col("s_nationkey").alias("nation-:key"))).alias("in-side")).alias("a-b"),
    )
    clean = clean_names(odd)
    return clean.select("supp_key", "a_b.text", F.col("a_b.in_side")[0]["nation_key"].alias("nation_key"))


# --- keys, texts, dates ------------------------------------------------------------------


@query(
    "surrogate_key",
    """SELECT p_partkey, md5(p_brand || '-' || coalesce(nullif(p_size, 7)::VARCHAR, '_dbt_utils_surrogate_key_null_') || '-' || p_type) AS part_key
       FROM part""",
)
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", keys.surrogate_key("p_brand", F.nullif("p_size", F.lit(7)), "p_type").alias("part_key"))


@query(
    "ballot_class",
    star(
        """SELECT vote, party, CASE WHEN vote IN ('Yea', 'Aye') THEN 'yea' WHEN vote IN ('Nay', 'No') THEN 'nay' ELSE 'other' END AS class,
             CASE WHEN vote IN ('Yea', 'Aye') THEN 'yea/aye' WHEN vote IN ('Nay', 'No') THEN 'nay/no' WHEN vote = 'Present' THEN 'present'
               WHEN vote = 'Not Voting' THEN 'not_voting' END AS ballot_group, count(*) AS n FROM fact GROUP BY ALL""",
        "fact",
    ),
)
def _(t: Tables) -> DataFrame:
    counted = Star(t).fact.groupBy("vote", "party").agg(F.count("*").alias("n"))
    return counted.withColumns({"class": vt.ballot_class("vote"), "ballot_group": vt.ballot_group("vote")})


@query("truncate_text", "SELECT doc_id, lang, source, n_chars, CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS text FROM documents")
def _(t: Tables) -> DataFrame:
    return text.truncate_text(t.documents)


@query(
    "html_link",
    """SELECT page_id, '<a href="' || coalesce(CASE WHEN url NOT LIKE 'https%' THEN url END, 'None') || '" target="_blank">Page ' || page_id || '</a>' AS link
       FROM pages""",
)
def _(t: Tables) -> DataFrame:
    plain = F.when(~F.col("url").like("https%"), F.col("url"))
    return t.pages.select("page_id", text.html_link(plain, F.concat(F.lit("Page "), "page_id")).alias("link"))


@query(
    "date_formats",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS house, strftime(o_orderdate, '%Y-%m-%d') AS senate,
         strftime(o_orderdate, '%Y-%m-%d') AS colon, NULL::VARCHAR AS unreadable FROM orders""",
)
def _(t: Tables) -> DataFrame:
    long = F.date_format("o_orderdate", "MMMM d, yyyy")
    return t.orders.select(
        "o_orderkey",
        dates.house_date(F.date_format("o_orderdate", "d-MMM-yyyy")).alias("house"),
        dates.senate_date(F.concat(long, F.lit(",  05:30 PM"))).alias("senate"),
        dates.senate_date(F.concat(long, F.lit(", 11: 05 AM"))).alias("colon"),
        dates.house_date("o_orderpriority").alias("unreadable"),
    )


@query(
    "names_and_labels",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE 'Independent' END AS grouped,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'Senate' ELSE 'House of Representatives' END AS chamber,
         c_name || ' | ' || left(c_mktsegment, 1) || ' - ' || c_nationkey AS label, c_name AS back,
         CASE WHEN c_nationkey = 3 THEN '-' ELSE c_nationkey::VARCHAR END AS year FROM customer""",
)
def _(t: Tables) -> DataFrame:
    swapped = F.replace(F.replace("c_mktsegment", F.lit("BUILDING"), F.lit("Democratic")), F.lit("MACHINERY"), F.lit("Republican"))
    back = F.replace(F.replace(vt.party_group(swapped), F.lit("Democratic"), F.lit("BUILDING")), F.lit("Republican"), F.lit("MACHINERY"))
    label = vt.member_label("c_name", "c_mktsegment", F.col("c_nationkey").cast("string"))
    return t.customer.select(
        "c_custkey", back.alias("grouped"),
        vt.chamber_name(F.when(F.col("c_mktsegment") == "BUILDING", "Senate").otherwise("House")).alias("chamber"),
        label.alias("label"), vt.label_name(label).alias("back"),
        text.year_or_dash(F.nullif("c_nationkey", F.lit(3))).alias("year"),
    )


@query(
    "greatest_round",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey = 5 THEN NULL ELSE greatest(l_partkey, l_suppkey, l_orderkey) END AS top,
         round(l_suppkey / nullif(l_linenumber - 1, 0), 2) AS share FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    some_null = F.nullif("l_partkey", F.lit(5).cast("bigint"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", strict_greatest(some_null, F.col("l_suppkey"), F.col("l_orderkey")).alias("top"),
        F.round(F.try_divide("l_suppkey", F.col("l_linenumber") - 1), 2).alias("share"),
    )


@query(
    "query_with_dates",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed FROM orders",
)
def _(t: Tables) -> DataFrame:
    t.orders.selectExpr("*", "CAST(o_orderdate AS STRING) AS placed").createOrReplaceTempView("parity_orders")
    found = query_with_dates(t.spark, "SELECT o_orderkey, placed FROM parity_orders", ["placed"])
    return found.withColumn("placed", F.date_format("placed", "yyyy-MM-dd HH:mm:ss"))


# --- incremental load --------------------------------------------------------------------


@query(
    "merge_upsert",
    """WITH t AS (SELECT o_orderkey AS k, nullif(o_orderpriority, '5-LOW') AS p, o_totalprice AS v, 'first' AS "flowDate" FROM orders WHERE o_orderstatus <> 'O'),
            s AS (SELECT o_orderkey AS k, nullif(o_orderpriority, '5-LOW') AS p, o_totalprice + 1 AS v, 'second' AS "flowDate" FROM orders WHERE o_orderstatus <> 'F')
       SELECT coalesce(t.k, s.k) AS k, coalesce(t.p, s.p) AS p, coalesce(s.v, t.v) AS v, coalesce(t."flowDate", s."flowDate") AS "flowDate"
       FROM t FULL JOIN s ON t.k = s.k AND t.p IS NOT DISTINCT FROM s.p""",
)
def _(t: Tables) -> DataFrame:
    old = t.orders.filter("o_orderstatus <> 'O'").selectExpr(
        "o_orderkey AS k", "nullif(o_orderpriority, '5-LOW') AS p", "o_totalprice AS v", "'first' AS flowDate")
    new = t.orders.filter("o_orderstatus <> 'F'").selectExpr(
        "o_orderkey AS k", "nullif(o_orderpriority, '5-LOW') AS p", "o_totalprice + 1 AS v", "'second' AS flowDate")
    return merge.merge_upsert(old, new, ["k", "p"])


@query(
    "merge_latest",
    """WITH s AS (SELECT o_custkey AS k, o_orderstatus AS st, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
       SELECT coalesce(c_custkey, k) AS k, coalesce(st, c_mktsegment) AS st, coalesce(d, 'never') AS d
       FROM customer FULL JOIN s ON c_custkey = k""",
)
def _(t: Tables) -> DataFrame:
    old = t.customer.selectExpr("c_custkey AS k", "c_mktsegment AS st", "'never' AS d")
    new = t.orders.selectExpr("o_custkey AS k", "o_orderstatus AS st", "date_format(o_orderdate, 'yyyy-MM-dd') AS d", "o_orderkey")
    return merge.merge_upsert(old, new, ["k"], order=[F.desc("d"), F.asc("o_orderkey")])


@query(
    "high_water_mark",
    """SELECT coalesce(max(coalesce(CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END, '2015-01-01T00:00:00Z')),
              '2015-01-01T00:00:00Z') AS mark FROM events""",
)
def _(t: Tables) -> DataFrame:
    stamp = F.when(F.col("event_type") != "error", F.date_format("ts", dates.ISO_INSTANT))
    return merge.high_water_mark(t.events.select(stamp.alias("stamp")), "stamp")


@query(
    "filter_new_bills",
    """WITH b AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%dT12:00:00Z') AS d, CASE WHEN o_orderstatus <> 'P' THEN
              strftime(o_orderdate + INTERVAL 1 YEAR, '%Y-%m-%dT12:00:00Z') END AS dt FROM orders)
       SELECT k, d, dt FROM b WHERE coalesce(dt, d) >= (SELECT max(d) FROM b JOIN orders ON k = o_orderkey WHERE o_totalprice < 60000)""",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_orderkey").alias("k"), "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd'T12:00:00Z'").alias("d"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 YEAR"), "yyyy-MM-dd'T12:00:00Z'"),
        ).alias("dt"),
    )
    mark = merge.high_water_mark(rows.filter("o_totalprice < 60000"), "d")
    return merge.filter_new_bills(rows.drop("o_totalprice"), mark, "dt", "d")


@query("filter_new_votes", "SELECT event_id FROM events WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-15 00:00:00'")
def _(t: Tables) -> DataFrame:
    stamp = F.when(F.col("event_type") != "error", F.date_format("ts", dates.ISO_INSTANT))
    return merge.filter_new_votes(t.events.select("event_id", stamp.alias("date")), "2024-01-15T00:00:00Z").select("event_id")


@query(
    "filter_members",
    star(
        """SELECT DISTINCT 'C' || k AS "bioguideID" FROM person WHERE 10 + k % 14 >= 15
           AND (cur OR greatest(2006 + k % 5, 2004 + k % 5 + CASE WHEN k % 4 = 0 THEN 3 ELSE 0 END) > 2009)""",
        "members",
    ),
)
def _(t: Tables) -> DataFrame:
    kept = merge.filter_members(shapes.members(t.customer), "2015-01-09T12:00:00Z", end_year=2009)
    return kept.select(F.col("bioguideId").alias("bioguideID"))


# --- checks ------------------------------------------------------------------------------


@query("check_unique", "SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS mon, count(*) AS n_records FROM orders GROUP BY ALL HAVING count(*) > 1")
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("mon"))
    return checks.check_unique(rows, ["o_custkey", "mon"])


@query("check_not_null", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'")
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("R")).alias("flag"))
    return checks.check_not_null(rows, "flag").drop("flag")


@query("check_relationship", "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t: Tables) -> DataFrame:
    return checks.check_relationship(t.documents.select("doc_id", "n_chars"), "doc_id", t.labels, "doc_id")


@query(
    "check_vote_bills",
    star(
        """SELECT DISTINCT v.bill_name, v.congress, v.roll_call_number, v.chamber, v.vote_date FROM votes v
           WHERE NOT EXISTS (SELECT 1 FROM bills b WHERE b.bill_name = v.bill_name AND b.congress = v.congress AND b."policyArea" IS NOT NULL)""",
        "bills",
    ),
)
def _(t: Tables) -> DataFrame:
    rolls = shapes.roll_calls(t.orders).select("bill_name", "congress", "roll_call_number", "chamber", "vote_date")
    known = Star(t).bills.filter("policyArea IS NOT NULL")
    return checks.check_relationship(rolls, ["bill_name", "congress"], known, ["bill_name", "congress"]).distinct()
