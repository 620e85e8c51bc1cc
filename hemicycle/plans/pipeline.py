"""The regular run: documents to landing folders, landing folders to tables, tables to exports.

Every step reads what the step before wrote, so a run can be repeated from any of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.operators.merge import (
    AUDIT_COLUMNS, MEMBER_YEAR_LIMIT, filter_members, filter_new_bills, high_water_mark_of, table_exists, upsert_table,
)
from hemicycle.plans import bills as b, members as m, running, staging, views, votes as v
from hemicycle.session import stored
from hemicycle.sources import readers, sinks


@dataclass(frozen=True)
class Model:
    """How a table is kept: its key, the pick among source rows of one key, its folders."""

    keys: Sequence[str]
    order: Callable[[], list[Column]] | None = None
    partition_by: str | None = None
    stamp: str = "flowDate"
    #: What tells an older version of a row from a newer one, whichever run comes last.
    version: Sequence[str] = ()


#: Stored tables. Where the source may repeat a key, ``order`` says which row is kept.
MODELS = {
    "fact_roll_call_vote": Model(
        ["congress", "session", "chamber", "bill_key", "roll_call_number", "bioguideID", "lisid"],
        lambda: [F.asc_nulls_last(c) for c in ("vote", "party")],
        "congress",
    ),
    "dim_votes": Model(
        ["congress", "session", "bill_key", "roll_call_number", "chamber"],
        lambda: [F.desc_nulls_last(c) for c in ("vote_date", "result", "yea_totals", "nay_totals")],
    ),
    "dim_bills": Model(["bill_key"], version=("updateDateIncludingText",)),
    "dim_sponsors": Model(["bill_key", "bioguideID"], lambda: [F.desc("sponsor_type")]),
    "dim_bill_subjects": Model(["bill_key", "subject"], stamp="updateDatetime"),
    "dim_committees": Model(
        ["committee_key", "chamber"], lambda: [F.asc_nulls_last("systemCode"), F.asc_nulls_last("name")],
        stamp="updateDatetime",
    ),
    "bill_committee_bridge": Model(["bill_key", "committee_key", "chamber"], stamp="updateDatetime"),
    "dim_terms": Model(["bioguideID", "term_start_year", "chamber"]),
    "dim_party_history": Model(
        ["bioguideID", "startYear"], lambda: [F.desc_nulls_first("endYear"), F.asc_nulls_last("partyName")]
    ),
    "dim_members": Model(["bioguideID"], version=("updateDate",)),
}


FACT = "fact_roll_call_vote"


def stamped(df: DataFrame, col: str = "flowDate") -> DataFrame:
    """Adds the time of the load."""
    return df.withColumn(col, F.current_timestamp())


def land_bills(spark: SparkSession, xml: str, landing: str, tables: str, run_date: str, max_records: int = sinks.ROWS_PER_FILE) -> None:
    """Bill files updated since the stored bills to a landing run."""
    mark = high_water_mark_of(spark, f"{tables}/dim_bills", "updateDateIncludingText")
    new = filter_new_bills(readers.read_bills_xml(spark, xml), mark)
    sinks.write_run(new, f"{landing}/{readers.BILLS}", run_date, max_records)


def land_votes(spark: SparkSession, xml: str, landing: str, tables: str, run_date: str, max_records: int = sinks.ROWS_PER_FILE) -> None:
    """Roll calls named in the bills of this run, on or after the latest stored vote day."""
    day = high_water_mark_of(spark, f"{tables}/dim_votes", "vote_date", "2015-01-01")
    mark = F.concat(day, F.lit("T00:00:00Z"))
    named = staging.recorded_votes(readers.read_ndjson(spark, landing, readers.BILLS, run_date), mark)
    refs = stored(named.select(
        "congress", "sessionNumber", "rollNumber", "chamber", "bill_number", "bill_type"
    ).distinct(), "vote_references")
    for tag, kind in (("rollcall-vote", readers.HOUSE_VOTES), ("roll_call_vote", readers.SENATE_VOTES)):
        sinks.write_run(readers.read_roll_calls_xml(spark, xml, tag, refs), f"{landing}/{kind}", run_date, max_records)


def land_members(
    spark: SparkSession, json_dir: str, landing: str, tables: str, run_date: str, end_year: int = MEMBER_YEAR_LIMIT,
    max_records: int = sinks.ROWS_PER_FILE,
) -> None:
    """Members updated since the stored ones who serve or served after ``end_year``."""
    mark = high_water_mark_of(spark, f"{tables}/dim_members", "updateDate")
    raw = spark.read.schema(readers.schemas.landing_schema(readers.MEMBERS)).option("mode", "FAILFAST").json(json_dir)
    sinks.write_run(filter_members(raw, mark, end_year), f"{landing}/{readers.MEMBERS}", run_date, max_records)


def land_senate_ids(spark: SparkSession, xml: str, landing: str, max_records: int = sinks.ROWS_PER_FILE) -> None:
    """The list of senators' ids. It is a whole, so each run replaces it."""
    sinks.write_ndjson(readers.read_senate_ids_xml(spark, xml), f"{landing}/{readers.SENATE_IDS}", max_records)


def bill_tables(bills: DataFrame) -> dict[str, DataFrame]:
    """Stored tables that landed bills give."""
    staged = staging.stage_parsed_bills(bills)
    return {
        "dim_bills": b.dim_bills(staged),
        "dim_sponsors": b.dim_sponsors(staged),
        "dim_bill_subjects": b.dim_bill_subjects(staged),
        "dim_committees": b.dim_committees(staged),
        "bill_committee_bridge": b.bill_committee_bridge(staged),
    }


def vote_tables(house: DataFrame, senate: DataFrame) -> dict[str, DataFrame]:
    """Stored tables that landed roll calls give."""
    house, senate = staging.stage_house_votes(house), staging.stage_senate_votes(senate)
    return {
        "dim_votes": v.dim_votes(v.dim_house_votes(house), v.dim_senate_votes(senate)),
        FACT: v.fact_roll_call_vote(house, senate),
    }


def member_tables(members: DataFrame, ids: DataFrame, overrides: DataFrame) -> dict[str, DataFrame]:
    """Stored tables that landed members give, with the senators' ids."""
    staged = staging.stage_members(members)
    terms, history = staging.stage_terms(staged), m.dim_party_history(staged)
    return {
        "dim_terms": m.dim_terms(terms),
        "dim_party_history": history,
        "dim_members": m.dim_members(staged, terms, staging.stage_senate_ids(ids), overrides, history),
    }


def sources(spark: SparkSession, landing: str, seeds: str, run_date: str | None = None) -> dict[str, DataFrame]:
    """Every stored table as computed from the landing folders (all runs, or one)."""

    def landed(kind: str) -> DataFrame:
        return readers.read_ndjson(spark, landing, kind, run_date)

    overrides = readers.read_seed(spark, f"{seeds}/senate_id_overrides.csv", "senate_id_overrides")
    return {
        **bill_tables(landed(readers.BILLS)),
        **vote_tables(landed(readers.HOUSE_VOTES), landed(readers.SENATE_VOTES)),
        **member_tables(landed(readers.MEMBERS), readers.read_senate_ids(spark, landing), overrides),
    }


def store_tables(spark: SparkSession, found: dict[str, DataFrame], tables: str, state: str | None = None, run: str = "run") -> None:
    """Upsert some tables. Storing the same rows again changes nothing.

    With ``state`` the majorities and alignment kept there follow along (:mod:`hemicycle.plans.running`).
    """
    for name in sorted(found, key=lambda n: n == FACT):  # the ballots come last
        df, model = found[name], MODELS[name]
        order = model.order() if model.order else None
        if not (state and name == FACT):
            upsert_table(
                spark, f"{tables}/{name}", stamped(df, model.stamp), model.keys, AUDIT_COLUMNS, order, model.partition_by,
                model.version,
            )
    if state and {FACT, "dim_bills", "dim_votes"} & set(found):
        also = {r[0] for part in ("dim_votes", "dim_bills") if part in found for r in found[part].select("congress").distinct().collect()}
        if FACT in found:
            ballots = stamped(found[FACT], MODELS[FACT].stamp)
        elif table_exists(spark, f"{tables}/{FACT}"):
            ballots = spark.read.parquet(f"{tables}/{FACT}").limit(0)
        else:
            return
        running.apply_run(spark, tables, state, run, ballots, MODELS[FACT].keys, MODELS[FACT].order(), also - {None})


def load_tables(
    spark: SparkSession, landing: str, seeds: str, tables: str, run_date: str | None = None, state: str | None = None
) -> None:
    """Upsert every table (:func:`store_tables`) from the landing folders."""
    store_tables(spark, sources(spark, landing, seeds, run_date), tables, state, run_date or "all")
    zones = readers.read_seed(spark, f"{seeds}/congressional_zones.csv", "congressional_zones")
    states = readers.read_seed(spark, f"{seeds}/state_abbreviations.csv", "state_abbreviations")
    sinks.overwrite_table(m.dim_congressional_districts(zones, states), f"{tables}/dim_congressional_districts")


def reporting_views(spark: SparkSession, tables: str, strict: bool = False, state: str | None = None) -> dict[str, DataFrame]:
    """The exported tables: four views over the stored tables, and two dimensions as they are.

    With ``state`` the majorities come from there, and not from a pass over the fact.
    """
    from hemicycle.operators.terms import terms_condensed

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{tables}/{name}")

    fact, votes, bills, members = (table(n) for n in ("fact_roll_call_vote", "dim_votes", "dim_bills", "dim_members"))
    terms, districts = table("dim_terms"), table("dim_congressional_districts")
    if state and strict:
        raise ValueError("the kept majorities do not tell sessions and chambers apart")
    majority = running.majority_table(spark, state) if state else None
    context = stored(views.roll_call_context(fact, votes, bills, strict, majority), "roll_call_context")
    return {
        "vw_votes_by_member": views.ballots_in_context(fact, context, members),
        "vw_sponsored_bills_by_member": views.sponsored_bills_by_member(table("dim_sponsors"), bills, members),
        "vw_voting_members": views.voting_members(members, terms, districts, fact),
        "vw_terms_condensed": terms_condensed(terms).orderBy("bioguideID", "term_start_year"),
        "dim_members": members,
        "dim_congressional_districts": districts,
    }


def export(spark: SparkSession, tables: str, out: str) -> None:
    sinks.export_views(reporting_views(spark, tables), out, partition_by="congress")
