"""Landing-shaped frames derived from the supplied tables.

Every order is one document of a roll call and one version of a bill, every customer a
member, every nation a state. Documents of a roll call agree in all but their ballots.
Arrays are made within a row, so the derived data grows with the tables and no group is
ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bill type, congress, session and roll-call number of an order, in both SQL dialects.
BILL_TYPE = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'HR' WHEN '2-HIGH' THEN 'S' WHEN '3-MEDIUM' THEN 'HJRES' "
    "WHEN '4-NOT SPECIFIED' THEN 'SCONRES' ELSE 'AMDT' END"
)
VOTE = (
    "CASE WHEN ({n}) % 11 < 4 THEN 'Yea' WHEN ({n}) % 11 = 4 THEN 'Aye' WHEN ({n}) % 11 < 8 THEN 'Nay' "
    "WHEN ({n}) % 11 = 8 THEN 'No' WHEN ({n}) % 11 = 9 THEN 'Present' ELSE 'Not Voting' END"
)
PARTY = "CASE WHEN ({x}) % 10 < 5 THEN 'D' WHEN ({x}) % 10 < 9 THEN 'R' ELSE 'I' END"


def dealt(orders: DataFrame) -> DataFrame:
    """The columns that documents are made of, dealt by key.

    A supplied table may be one row group, which one task would turn into all documents. The number is
    given, so that the narrow rows are not put together again; a real landing folder has files enough.
    """
    narrow = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return narrow.repartition(int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")


def dealt_customers(customer: DataFrame) -> DataFrame:
    """The columns that members and their ids are made of, dealt by key for the same reason.

    Few enough to be put together in tasks of the advisory size.
    """
    return customer.select("c_custkey", "c_nationkey", "c_name", "c_mktsegment", "c_acctbal").repartition("c_custkey")


def documents(orders: DataFrame) -> DataFrame:
    """Common columns of the documents."""
    return orders.selectExpr(
        "o_orderkey AS k",
        "o_custkey AS c",
        "o_orderstatus AS st",
        f"{BILL_TYPE} AS bt",
        "CAST(month(o_orderdate) AS BIGINT) AS m",
        "CAST(year(o_orderdate) AS BIGINT) AS y",
        "(day(o_orderdate) - 1) div 10 AS dec",
        "109 + 2 * (CAST(year(o_orderdate) AS BIGINT) - 1995) AS cong",
        "o_orderdate AS d",
    ).withColumn("vd", F.expr("make_date(CAST(y AS INT), CAST(m AS INT), CAST(1 + 10 * dec AS INT))"))


def _ballots(element: str) -> str:
    return "array(" + ", ".join(element.format(i=i) for i in range(3)) + ")"


def _vote(i: str = "{i}") -> str:
    return VOTE.format(n=f"k + 7 * {i}")


def house_votes(orders: DataFrame) -> DataFrame:
    """House landing rows: orders that are not open."""
    total = (
        "named_struct('party', '{p}', 'yea_total', CAST(m + {w} AS STRING), 'nay_total', CAST(dec * {w} AS STRING), "
        "'present_total', CAST(y % 10 AS STRING), 'not_voting_total', CAST({w} AS STRING))"
    )
    totals = ", ".join(total.format(p=p, w=w) for w, p in enumerate(("Republican", "Democratic", "Independent"), 1))
    ballot = (
        "named_struct('legislator', named_struct('name_id', concat('C', c + {i}), 'unaccented_name', "
        "concat('Customer', c + {i}), 'party', " + PARTY.format(x="c + {i}") + ", 'state', 'ZZ'), 'vote', " + _vote() + ")"
    )
    return documents(dealt(orders)).filter("st <> 'O'").selectExpr(
        f"""named_struct(
            'vote_metadata', named_struct(
                'congress', CAST(cong AS STRING),
                'session', CASE WHEN m <= 6 THEN '1st' ELSE '2nd' END,
                'chamber', 'U.S. House of Representatives',
                'rollcall_num', CAST(dec + 1 AS STRING),
                'vote_question', concat('On ', bt),
                'vote_result', CASE WHEN m % 2 = 0 THEN 'Passed' ELSE 'Failed' END,
                'action_date', date_format(vd, 'd-MMM-yyyy'),
                'vote_totals', named_struct(
                    'totals_by_party', array({totals}),
                    'totals_by_vote', named_struct('yea_total', CAST(m * 3 AS STRING), 'nay_total',
                        CAST(dec AS STRING), 'present_total', '0', 'not_voting_total', CAST(y % 7 AS STRING)))),
            'vote_data', named_struct('recorded_vote', {_ballots(ballot)})) AS rollcall_vote""",
        "'House of Representatives' AS chamber",
        "m AS bill_number",
        "bt AS bill_type",
    )


def senate_votes(orders: DataFrame) -> DataFrame:
    """Senate landing rows: open orders."""
    ballot = (
        "named_struct('member_full', concat('Senator ', c + {i}), 'last_name', concat('Customer', c + {i}), "
        "'first_name', 'Sen', 'party', " + PARTY.format(x="c + {i}") + ", 'state', 'ZZ', 'vote_cast', " + _vote()
        + ", 'lis_member_id', concat('S', c + {i}))"
    )
    return documents(dealt(orders)).filter("st = 'O'").selectExpr(
        f"""named_struct(
            'congress', CAST(cong AS STRING),
            'session', CASE WHEN m <= 6 THEN '1' ELSE '2' END,
            'vote_number', CAST(dec + 1 AS STRING),
            'vote_date', concat(date_format(vd, 'MMMM d, yyyy'), ',  05:30 PM'),
            'question', concat('On ', bt),
            'vote_result', CASE WHEN m % 2 = 0 THEN 'Passed' ELSE 'Failed' END,
            'count', named_struct('yeas', CAST(m * 2 AS STRING), 'nays', CAST(dec AS STRING), 'present',
                CASE WHEN m = 1 THEN '1' END, 'absent', CASE WHEN m % 2 = 0 THEN '3' END),
            'members', named_struct('member', {_ballots(ballot)})) AS roll_call_vote""",
        "'Senate' AS chamber",
        "m AS bill_number",
        "bt AS bill_type",
    )


def bills(orders: DataFrame) -> DataFrame:
    """Bill landing rows with JSON text parts, one version per order."""
    def vote(chamber: str) -> str:
        return (
            "'{\"rollNumber\":\"', k, '\",\"url\":\"https://votes.example/', k, '.xml\",\"chamber\":\"', " + chamber
            + ", '\",\"congress\":\"', cong, '\",\"date\":\"', stamp, '\",\"sessionNumber\":\"1\"}'"
        )

    def action(votes: str) -> str:
        return (
            "',{\"actionDate\":\"', day, '\",\"text\":\"Roll call\",\"type\":\"Floor\",\"recordedVotes\":{\"recordedVote\":', "
            + votes + ", '}}'"
        )

    one = vote("CASE WHEN st = 'O' THEN 'Senate' ELSE 'House' END")
    two = "'[', " + vote("'House'") + ", ',', " + vote("'Senate'") + ", ']'"
    stamped = documents(dealt(orders)).withColumn("day", F.date_format("d", "yyyy-MM-dd")).withColumn(
        "stamp", F.concat("day", F.lit("T12:00:00Z"))
    )
    return stamped.selectExpr(
        "CAST(m AS STRING) AS number",
        "bt AS type",
        "CAST(cong AS STRING) AS congress",
        "concat('Act ', k, ' on ', bt) AS title",
        "stamp AS updateDate",
        "CASE WHEN st <> 'P' THEN stamp END AS updateDateIncludingText",
        "day AS introducedDate",
        "CASE WHEN bt <> 'AMDT' THEN concat('{\"name\":\"Area ', bt, '\"}') END AS policyArea",
        "concat('{\"item\":[{\"bioguideId\":\"C', c, '\"}]}') AS sponsors",
        "CASE WHEN st <> 'P' THEN concat('{\"count\":\"2\",\"item\":[{\"bioguideId\":\"C', c + 1, '\"},{\"bioguideId\":\"C', c + 2, "
        "'\"}]}') END AS cosponsors",
        "concat('{\"item\":[{\"systemCode\":\"h', y % 3, '\",\"name\":\"Committee ', m, '\",\"chamber\":\"House\"},"
        "{\"systemCode\":\"s0\",\"name\":\"Committee ', bt, '\",\"chamber\":\"Senate\"}]}') AS committees",
        "CASE WHEN st <> 'F' THEN concat('{\"legislativeSubjects\":{\"item\":[{\"name\":\"Subject ', y, '\"},{\"name\":"
        "\"Subject ', c, '\"}]}}') END AS subjects",
        "concat('{\"item\":[{\"actionDate\":\"', day, '\",\"text\":\"Introduced\",\"type\":\"Intro\"}', "
        f"{action(one)}, {action(two)}, ']}}') AS actions",
        """concat('{"summary":[{"actionDate":"', day, '"},{"actionDate":"', day, '","text":"Text of ', k,
            '"},{"actionDate":"1990-01-01","text":"Old"}]}') AS summaries""",
        """concat('{"actionDate":"', day, '","text":"Latest"}') AS latestAction""",
    )


#: Years of the three terms of customer k, in both SQL dialects.
T1_START, T1_END = "2000 + k % 5", "2002 + k % 5"
T2_START = "2002 + k % 5 + (CASE WHEN k % 4 = 0 THEN 3 ELSE 0 END)"
T2_END = "2004 + k % 5 + (CASE WHEN k % 4 = 0 THEN 3 ELSE 0 END)"
T3_START = T2_END
T3_END = "CASE WHEN cur THEN NULL ELSE 2006 + k % 5 END"
CHAMBER = "CASE WHEN {t} THEN 'Senate' ELSE 'House of Representatives' END"
T1_CHAMBER = CHAMBER.format(t="k % 3 = 0")
T3_CHAMBER = CHAMBER.format(t="(k % 3 = 0) <> (k % 5 = 0)")


def members(customer: DataFrame) -> DataFrame:
    """Member landing rows."""
    term = (
        "named_struct('chamber', {ch}, 'congress', ({s} - 1789) div 2 + 1, 'district', CASE WHEN k % 7 = 0 THEN "
        "CAST(NULL AS BIGINT) ELSE k % 53 END, 'endYear', CAST({e} AS BIGINT), 'memberType', 'Member', 'startYear', {s}, "
        "'stateCode', concat('N', n), 'stateName', concat('NATION_', n))"
    )
    terms = ", ".join(
        term.format(ch=ch, s=s, e=e)
        for ch, s, e in (
            (T1_CHAMBER, T1_START, T1_END), (T1_CHAMBER, T2_START, T2_END), (T3_CHAMBER, T3_START, T3_END),
        )
    )
    party = "CASE WHEN {x} % 10 < 5 THEN 'Democratic' WHEN {x} % 10 < 9 THEN 'Republican' ELSE 'Libertarian' END"
    base = dealt_customers(customer).selectExpr(
        "c_custkey AS k", "CAST(c_nationkey AS BIGINT) AS n", "c_name", "c_mktsegment AS seg", "c_acctbal > 4000 AS cur"
    )
    return base.selectExpr(
        "concat('C', k) AS bioguideId",
        "seg AS firstName",
        "c_name AS lastName",
        "concat(c_name, ', ', seg) AS invertedOrderName",
        "named_struct('attribution', 'none', 'imageUrl', concat('https://img.example/', k)) AS depiction",
        "CAST(1930 + k % 60 AS STRING) AS birthYear",
        "CAST(NULL AS STRING) AS deathYear",
        "cur AS currentMember",
        "concat('20', 10 + k % 14, '-01-09T12:00:00Z') AS updateDate",
        f"""array(
            named_struct('partyName', {party.format(x='k')}, 'startYear', 1990 + k % 10, 'endYear', 1994 + k % 10),
            named_struct('partyName', {party.format(x='(k + CASE WHEN k % 17 = 0 THEN 5 ELSE 0 END)')},
                'startYear', 1994 + k % 10, 'endYear', CAST(NULL AS BIGINT))) AS partyHistory""",
        f"array({terms}) AS terms",
    ).withColumn("terms_all", F.struct(F.col("terms").alias("item")))


def senate_ids(customer: DataFrame) -> DataFrame:
    """Senator id landing rows: every customer, some with two ids."""
    return dealt_customers(customer).selectExpr(
        "concat('{\"first_name\":\"', c_mktsegment, '\",\"last_name\":\"', c_name, '\"}') AS full_name",
        "concat('N', c_nationkey) AS state",
        "concat('C', c_custkey) AS bioguide",
        "CASE WHEN c_custkey % 9 = 0 THEN array(concat('S', c_custkey), concat('SZ', c_custkey)) "
        "ELSE array(concat('S', c_custkey)) END AS lisid",
    )


def overrides(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr("concat('C', s_suppkey) AS bioguideID", "concat('X', s_suppkey) AS lisid")


def states(nation: DataFrame) -> DataFrame:
    return nation.selectExpr("n_name AS Name", "concat('N', n_nationkey, ' ') AS Abbreviation")


def zones(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "CAST(10000 + c_custkey % 500 AS INT) AS zcta",
        "concat('N', c_nationkey) AS state_abbr",
        "CAST(c_custkey % 40 AS INT) AS cd",
    )


# --- star tables without the detour over documents ---------------------------------------


def fact(orders: DataFrame, shift: int = 0) -> DataFrame:
    """The ballots of :func:`house_votes` and :func:`senate_votes`, flat; ``shift`` corrects the votes."""
    heads = documents(orders).selectExpr(
        "md5(concat_ws('-', bt, m)) AS bill_key", "dec + 1 AS roll_call_number", "cong AS congress",
        "CASE WHEN m <= 6 THEN 1L ELSE 2L END AS session",
        "CASE WHEN st = 'O' THEN 'Senate' ELSE 'House of Representatives' END AS chamber",
        "concat(bt, m) AS bill_name", "k", "c", "array(0, 1, 2) AS seats",
    )
    return heads.selectExpr("*", "explode(seats) AS i").selectExpr(
        "bill_key", "roll_call_number", "congress", "session", "chamber", "bill_name",
        "CASE WHEN chamber <> 'Senate' THEN concat('C', c + i) END AS bioguideID",
        "CASE WHEN chamber = 'Senate' THEN concat('S', c + i) END AS lisid",
        f"{VOTE.format(n=f'k + 7 * i + {shift}')} AS vote",
        f"{PARTY.format(x='c + i')} AS party",
    )


def roll_calls(orders: DataFrame) -> DataFrame:
    """Roll calls as :func:`hemicycle.plans.votes.dim_votes` gives them, without totals."""
    distinct = documents(orders).select("bt", "m", "cong", "dec", "vd", (F.col("st") == "O").alias("senate")).distinct()
    return distinct.selectExpr(
        "dec + 1 AS roll_call_number", "md5(concat_ws('-', bt, m)) AS bill_key", "date_format(vd, 'yyyy-MM-dd') AS vote_date",
        "cong AS congress", "CASE WHEN m <= 6 THEN 1L ELSE 2L END AS session", "bt AS bill_type",
        "CASE WHEN senate THEN 'Senate' ELSE 'House of Representatives' END AS chamber", "concat(bt, m) AS bill_name",
        "concat('On ', bt) AS question", "CASE WHEN m % 2 = 0 THEN 'Passed' ELSE 'Failed' END AS result",
    )
