"""Queries over tables that several runs with corrections have filled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.plans import running, views
from hemicycle.plans.pipeline import FACT as FACT_TABLE, MODELS
from hemicycle.session import scratch_path, stored
from hemicycle.sources import readers, sinks
from hemicycle.streaming import delivery
from parity import shapes
from parity.registry import Tables, query
from parity.star import _ALIGNED, Star, text_dates
from parity.star_sql import FACT, star

#: Orders of each run, and how far their votes are shifted: later runs deliver some ballots again, corrected.
RUNS = (("o_orderkey % 4 < 2", 0), ("o_orderkey % 4 IN (1, 2)", 4), ("o_orderkey % 4 = 3 OR o_orderkey % 8 = 1", 9))

_KEY = 'congress, session, chamber, bill_key, roll_call_number, "bioguideID", lisid'
_RUN = FACT.removeprefix("fact AS (").removesuffix(")").replace("(k + 7 * i)", "(k + 7 * i + {shift})").replace("FROM doc,", "FROM (SELECT * FROM doc WHERE {where}),")
def fact_of_runs(shifted: bool = True) -> str:
    """The ballots after all runs: the last run's, and of those the first by vote."""
    delivered = " UNION ALL ".join(
        f"SELECT {n} AS run, * FROM ("
        + _RUN.replace("{shift}", str(shift if shifted else 0)).replace("{where}", where.replace("o_orderkey", "k"))
        + ")"
        for n, (where, shift) in enumerate(RUNS)
    )
    return f"""delivered AS ({delivered}),
fact AS (SELECT * EXCLUDE (run) FROM delivered
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY run DESC, vote NULLS LAST, party NULLS LAST) = 1)"""


def runs_sql(select: str, upto: str, shifted: bool = True) -> str:
    return star(select, upto).replace(FACT, fact_of_runs(shifted))


def run_all(t: Tables) -> tuple[str, str]:
    """Folders of the tables and of the state after all runs."""
    tables, state = scratch_path(t.spark, "runs_tables"), scratch_path(t.spark, "runs_state")
    s = Star(t)
    shapes.roll_calls(t.orders).write.parquet(f"{tables}/dim_votes")
    s.bills.write.parquet(f"{tables}/dim_bills")
    model = MODELS["fact_roll_call_vote"]
    for n, (where, shift) in enumerate(RUNS):
        ballots = shapes.fact(shapes.dealt(t.orders.filter(where)), shift)
        running.apply_run(t.spark, tables, state, f"run{n}", ballots, model.keys, model.order())
    return tables, state


@query("running_alignment", runs_sql(_ALIGNED.format(more=""), "vbm"))
def _(t: Tables) -> DataFrame:
    _, state = run_all(t)
    return running.alignment(t.spark, state, Star(t).dim_members, "House of Representatives")


@query("running_majority", runs_sql("SELECT * FROM majority", "majority"))
def _(t: Tables) -> DataFrame:
    _, state = run_all(t)
    return running.party_majority(t.spark, state).withColumn("vote_count", F.col("vote_count").cast("long"))


@query("streamed_fact", runs_sql("SELECT * FROM fact", "fact", shifted=False))
def _(t: Tables) -> DataFrame:
    """Three runs of roll calls landed and delivered as streams; some documents come twice."""
    landing, tables, marks = (scratch_path(t.spark, f"streamed_{n}") for n in ("landing", "tables", "marks"))
    for n, (where, _) in enumerate(RUNS, 1):
        orders = t.orders.filter(where)
        for kind, rows in ((readers.HOUSE_VOTES, shapes.house_votes(orders)), (readers.SENATE_VOTES, shapes.senate_votes(orders))):
            sinks.write_run(rows, f"{landing}/{kind}", f"2023-01-0{n}", 1_000_000)
        delivery.deliver(t.spark, landing, "", tables, marks, kinds=(readers.HOUSE_VOTES, readers.SENATE_VOTES))
    return t.spark.read.parquet(f"{tables}/{FACT_TABLE}").drop("flowDate")


@query("votes_about", star("SELECT * FROM vbm WHERE result = 'Passed' AND vote_date BETWEEN '1996-03-01' AND '1996-09-30'", "vbm"))
def _(t: Tables) -> DataFrame:
    """Ballots of some roll calls, from a stored fact in congress folders."""
    s, path = Star(t), scratch_path(t.spark, "votes_about")
    s.fact.hint("rebalance", "congress").write.partitionBy("congress").parquet(path)
    context = stored(views.roll_call_context(s.fact, shapes.roll_calls(t.orders), s.bills), "roll_call_context")
    about = (F.col("result") == "Passed") & F.col("vote_date").between("1996-03-01", "1996-09-30")
    fact = t.spark.read.schema(f"{s.fact.drop('congress').schema.simpleString()[7:-1].replace(':', ' ')}, congress bigint").parquet(path)
    return text_dates(views.votes_about(fact, context, s.dim_members, about), "vote_date")
