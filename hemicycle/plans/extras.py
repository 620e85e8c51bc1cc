"""Reports and record shapes that the regular run does not use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.dates import house_date, senate_date
from hemicycle.functions.json import json_list, json_scalar
from hemicycle.functions.votes import PARTY_LETTERS, ballot_group, was_cast
from hemicycle.operators.majority import sided_with_own
from hemicycle.operators.nested import or_empty
from hemicycle.plans.views import member_lookup
from hemicycle.sources.schemas import BILL_PARTS, RECORDED_VOTE

#: Characters of a summary that are kept.
SUMMARY_LENGTH = 1000


def strict_greatest(*cols: Column) -> Column:
    """Largest value; null if any is null (Spark's own skips nulls)."""
    some_null = F.lit(False)
    for c in cols:
        some_null = some_null | c.isNull()
    return F.when(~some_null, F.greatest(*cols))


def leading_class(letter: str) -> Column:
    """Ballot class with most votes of a party; yea wins ties, then nay."""
    yea, nay, present = (F.col(f"{letter}_{c}_votes") for c in ("yea_or_aye", "nay_or_no", "present"))
    top = strict_greatest(yea, nay, present)
    return F.when(top == yea, "yea/aye").when(top == nay, "nay/no").when(top == present, "present")


def party_loyalty(fact: DataFrame, votes: DataFrame, members: DataFrame) -> DataFrame:
    """Share of a member's ballots that match their party's leading class, to two digits.

    Roll calls are matched by number and bill name alone.
    """
    leading = {PARTY_LETTERS[p]: f"lead_{p}" for p in PARTY_LETTERS}
    rolls = votes.select("roll_call_number", "bill_name", *[leading_class(p).alias(f"lead_{p}") for p in PARTY_LETTERS])
    # A roll call listed n times counts n times: group equal rows, weigh by their number.
    rolls = rolls.groupBy(*rolls.columns).agg(F.count("*").alias("__w"))
    ballots = fact.select(
        "chamber", "roll_call_number", "bill_name",
        F.when(F.col("bioguideID").isNotNull(), "bioguideID").otherwise("lisid").alias("id_kind"),
        F.coalesce("bioguideID", "lisid").alias("id"),
        ballot_group("vote").alias("member_vote"),
    )
    joined = ballots.join(rolls, ["roll_call_number", "bill_name"]).join(member_lookup(members), ["id_kind", "id"])
    flagged = joined.select(
        "name", F.col("member").alias("bioguideID"), "partyName", "chamber",
        (sided_with_own("partyName", "member_vote", leading) * F.col("__w")).alias("sided"),
        (was_cast("member_vote", "not_voting") * F.col("__w")).alias("cast"),
    )
    share = F.round(F.try_divide(F.sum("sided"), F.sum("cast")), 2)
    return flagged.groupBy("name", "bioguideID", "partyName", "chamber").agg(
        share.alias("perc_votes_with_party_majority")
    )


def latest_text(summaries: Column) -> Column:
    """Text of the latest summary that has one, shortened; of equal dates the first listed."""
    dated = F.filter(summaries, lambda s: s["text"].isNotNull())
    latest = F.array_max(F.transform(dated, lambda s: F.try_to_date(s["actionDate"])))
    at_latest = F.filter(dated, lambda s: F.try_to_date(s["actionDate"]) == latest)
    return F.left(F.try_element_at(at_latest, F.lit(1))["text"], F.lit(SUMMARY_LENGTH))


def latest_summary(bills: DataFrame) -> DataFrame:
    """Adds ``most_recent_text`` to bills in structured form."""
    return bills.withColumn("most_recent_text", latest_text(F.col("summaries.summary")))


def structured_bills(bills: DataFrame) -> DataFrame:
    """Landing bills with the known JSON parts parsed.

    Lists that may come as one object (recorded votes, summaries) are read as text first.
    """
    loose = {
        "actions": BILL_PARTS["actions"].replace(f"array<struct<{RECORDED_VOTE}>>", "string"),
        "summaries": "struct<summary:string>",
    }
    present = [c for c in BILL_PARTS if c in bills.columns]
    out = bills.withColumns({c: F.from_json(c, loose.get(c, BILL_PARTS[c])) for c in present})
    if "summaries" in present:
        summary = json_list("summaries.summary", "$", "struct<versionCode:string,actionDate:string,actionDesc:string,"
                            "updateDate:string,text:string>")
        out = out.withColumn("summaries", F.struct(summary.alias("summary")))
    if "actions" in present:

        def with_votes(a: Column) -> Column:
            votes = json_list(a["recordedVotes"]["recordedVote"], "$", f"struct<{RECORDED_VOTE}>")
            return a.withField("recordedVotes", F.struct(votes.alias("recordedVote")))

        out = out.withColumn("actions", F.struct(F.transform("actions.item", with_votes).alias("item")))
    return out


def conform_bill(bills: DataFrame) -> DataFrame:
    """Narrow nested record of a bill; missing lists become empty ones (input: structured bills)."""

    def listed(path: str, element: str, build) -> Column:
        return or_empty(F.transform(F.col(path), build), f"struct<{element}>")

    def fields(*names: str):
        return lambda x: F.struct(*[x[n].alias(n) for n in names])

    committee = "name:string,chamber:string,type:string"
    action = f"actionDate:string,text:string,type:string,actionCode:string,recordedVotes:array<struct<{RECORDED_VOTE}>>"
    person = "bioguideID:string,fullName:string,firstName:string,lastName:string"

    def narrow_action(a: Column) -> Column:
        votes = or_empty(a["recordedVotes"]["recordedVote"], f"struct<{RECORDED_VOTE}>")
        return F.struct(
            *[a[n].alias(n) for n in ("actionDate", "text", "type", "actionCode")], votes.alias("recordedVotes")
        )

    def narrow_person(p: Column) -> Column:
        return F.struct(p["bioguideId"].alias("bioguideID"), *[p[n].alias(n) for n in ("fullName", "firstName", "lastName")])

    bill = F.struct(
        "number", "updateDate", "type", "introducedDate", "congress",
        F.struct(listed("committees.item", committee, fields("name", "chamber", "type")).alias("item")).alias("committees"),
        F.struct(listed("actions.item", action, narrow_action).alias("item")).alias("actions"),
        F.struct(listed("sponsors.item", person, narrow_person).alias("item")).alias("sponsors"),
        F.struct(
            F.col("cosponsors.count").alias("count"),
            listed("cosponsors.item", "bioguideID:string", lambda p: F.struct(p["bioguideId"].alias("bioguideID")))
            .alias("item"),
        ).alias("cosponsors"),
        F.struct(F.col("policyArea.name").alias("name")).alias("policyArea"),
        F.struct(
            F.struct(listed("subjects.legislativeSubjects.item", "name:string", fields("name")).alias("item"))
            .alias("legislativeSubjects")
        ).alias("subjects"),
        "title",
        F.struct(F.col("latestAction.actionDate").alias("actionDate"), F.col("latestAction.text").alias("text"))
        .alias("latestAction"),
        latest_text(F.col("summaries.summary")).alias("most_recent_text"),
    )
    return bills.select(bill.alias("bill"))


def unify_votes(house: DataFrame, senate: DataFrame) -> DataFrame:
    """One record shape for both chambers: ``vote`` metadata and a list of ``legislator``.

    Inputs are the landing frames.
    """

    def totals(yea: str, nay: str, present: str, absent: str) -> Column:
        named = {"yea": yea, "nay": nay, "present": present, "not_voting": absent}
        return F.struct(*[F.expr(f"try_cast({c} as bigint)").alias(n) for n, c in named.items()]).alias("totals")

    def vote(root: str, date: Column, number: str, result: str, chamber: str, counted: Column) -> Column:
        return F.struct(
            date.alias("date"),
            F.expr(f"try_cast({root}.congress as bigint)").alias("congress"),
            F.col(f"{root}.session").alias("session"),
            F.col("bill_type"),
            F.col("bill_number").cast("string").alias("bill_number"),
            F.lit(chamber).alias("chamber"),
            F.col(f"{root}.{number}").alias("roll_call_number"),
            F.col(f"{root}.{result}").alias("result"),
            counted,
        ).alias("vote")

    h, s = "rollcall_vote.vote_metadata", "roll_call_vote"
    by_vote = f"{h}.vote_totals.totals_by_vote"
    house_vote = vote(
        h, house_date(f"{h}.action_date"), "rollcall_num", "vote_result", "House",
        totals(*[f"{by_vote}.{c}_total" for c in ("yea", "nay", "present", "not_voting")]),
    )
    senate_vote = vote(
        s, senate_date(f"{s}.vote_date"), "vote_number", "vote_result", "Senate",
        totals(*[f"{s}.count.{c}" for c in ("yeas", "nays", "present", "absent")]),
    )
    house_people = F.transform(
        "rollcall_vote.vote_data.recorded_vote",
        lambda b: F.struct(
            b["legislator"]["name_id"].alias("id"), F.lit(None).cast("string").alias("first_name"),
            b["legislator"]["unaccented_name"].alias("last_name"), b["legislator"]["party"].alias("party"),
            b["legislator"]["state"].alias("state"), b["vote"].alias("vote"),
        ),
    )
    senate_people = F.transform(
        "roll_call_vote.members.member",
        lambda m: F.struct(
            m["lis_member_id"].alias("id"), m["first_name"].alias("first_name"), m["last_name"].alias("last_name"),
            m["party"].alias("party"), m["state"].alias("state"), m["vote_cast"].alias("vote"),
        ),
    )
    return house.select(house_vote, house_people.alias("legislator")).unionByName(
        senate.select(senate_vote, senate_people.alias("legislator"))
    )


def unified_ballots(unified: DataFrame) -> DataFrame:
    """Distinct ballots of :func:`unify_votes`, flat."""
    return unified.select("vote.*", F.explode("legislator").alias("l")).select(
        "date", "congress", F.left("session", F.lit(1)).alias("session"), "bill_type", "bill_number", "chamber",
        "roll_call_number", "result", F.col("totals.yea").alias("yea_totals"), F.col("totals.nay").alias("nay_totals"),
        F.col("totals.present").alias("present_totals"), F.col("totals.not_voting").alias("not_voting_totals"),
        F.col("l.id").alias("id"), F.col("l.vote").alias("vote"), F.col("l.party").alias("party"),
        F.concat("l.last_name", F.lit(", "), "l.first_name").alias("legislator_name"),
    ).distinct()


def first_lisid(ids: DataFrame) -> DataFrame:
    """Flat senator ids with the first Senate id of each (input: landing senator ids)."""
    return ids.select(
        json_scalar("full_name", "$.first_name").alias("first_name"),
        json_scalar("full_name", "$.last_name").alias("last_name"),
        "state",
        F.col("bioguide").alias("bioguideID"),
        F.try_element_at("lisid", F.lit(1)).alias("lisid"),
    )
