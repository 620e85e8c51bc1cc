"""Star schema and reporting views over the derived landing rows."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.operators.filters import scope_session
from hemicycle.operators.majority import party_majority
from hemicycle.operators.terms import term_islands, terms_condensed
from hemicycle.plans import bills as b
from hemicycle.plans import extras, members as mem, reports, staging, views, votes as v
from hemicycle.session import stored
from parity import shapes
from parity.registry import Tables, query
from parity.star_sql import BALLOT_ID, ORDINAL, senate, star


class Star:
    """The models, built lazily on the derived landing rows."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def house(self) -> DataFrame:
        return staging.stage_house_votes(shapes.house_votes(self.t.orders))

    @cached_property
    def senate(self) -> DataFrame:
        return staging.stage_senate_votes(shapes.senate_votes(self.t.orders))

    @cached_property
    def votes(self) -> DataFrame:
        return v.dim_votes(v.dim_house_votes(self.house), v.dim_senate_votes(self.senate))

    @cached_property
    def staged_bills(self) -> DataFrame:
        return staging.stage_bills(shapes.bills(self.t.orders))

    @cached_property
    def bills(self) -> DataFrame:
        return b.dim_bills(self.staged_bills)

    @cached_property
    def sponsors(self) -> DataFrame:
        return b.dim_sponsors(self.staged_bills)

    @cached_property
    def landed_members(self) -> DataFrame:
        return shapes.members(self.t.customer)

    @cached_property
    def staged_terms(self) -> DataFrame:
        return staging.stage_terms(self.landed_members)

    @cached_property
    def terms(self) -> DataFrame:
        return mem.dim_terms(self.staged_terms)

    @cached_property
    def party_history(self) -> DataFrame:
        return mem.dim_party_history(self.landed_members)

    @cached_property
    def senate_ids(self) -> DataFrame:
        return staging.stage_senate_ids(shapes.senate_ids(self.t.customer))

    @cached_property
    def members(self) -> DataFrame:
        return mem.dim_members(
            self.landed_members, self.staged_terms, self.senate_ids, shapes.overrides(self.t.supplier), self.party_history
        )

    @cached_property
    def districts(self) -> DataFrame:
        return mem.dim_congressional_districts(shapes.zones(self.t.customer), shapes.states(self.t.nation))

    # The views read stored tables, as they do in a regular run: the fact and the roll calls
    # straight from the supplied tables, the small dimensions written once.

    @cached_property
    def fact(self) -> DataFrame:
        return shapes.fact(self.t.orders)

    @cached_property
    def dim_members(self) -> DataFrame:
        return stored(self.members, "dim_members")

    @cached_property
    def votes_by_member(self) -> DataFrame:
        rolls = shapes.roll_calls(self.t.orders)
        context = stored(views.roll_call_context(self.fact, rolls, self.bills), "roll_call_context")
        return views.ballots_in_context(self.fact, context, self.dim_members)

    @cached_property
    def sponsored(self) -> DataFrame:
        return views.sponsored_bills_by_member(self.sponsors, stored(self.bills, "dim_bills"), self.dim_members)

    @cached_property
    def voting(self) -> DataFrame:
        return views.voting_members(self.dim_members, self.terms, self.districts, self.fact)


def text_dates(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols})


# --- fact and dimensions ---------------------------------------------------------------


@query("fact_roll_call_vote", star("SELECT * FROM fact", "fact"))
def _(t: Tables) -> DataFrame:
    s = Star(t)
    return v.fact_roll_call_vote(s.house, s.senate)


@query("dim_house_votes", star("SELECT * FROM house", "house"))
def _(t: Tables) -> DataFrame:
    return v.dim_house_votes(Star(t).house)


@query("dim_senate_votes", star(senate("abstain_votes"), "fact"))
def _(t: Tables) -> DataFrame:
    return v.dim_senate_votes(Star(t).senate)


@query("roll_calls_union", star("SELECT * FROM votes", "votes"))
def _(t: Tables) -> DataFrame:
    return Star(t).votes


@query("dim_bills", star("SELECT * FROM bills", "bills"))
def _(t: Tables) -> DataFrame:
    return text_dates(Star(t).bills, "introducedDate")


@query("sponsors", star("SELECT * FROM sponsors", "sponsors"))
def _(t: Tables) -> DataFrame:
    return Star(t).sponsors


@query(
    "dim_bill_subjects",
    star(
        """SELECT DISTINCT md5(bt || '-' || m || '-' || cong) AS bill_key, 'Subject ' || unnest([y, c]) AS subject
           FROM doc WHERE st <> 'F'""",
        "doc",
    ),
)
def _(t: Tables) -> DataFrame:
    return b.dim_bill_subjects(Star(t).staged_bills)


_COMMITTEE = """SELECT md5(bt || '-' || m || '-' || cong) AS bill_key, 'House' AS chamber, 'Committee ' || m AS name, 'h' || (y % 3) AS "systemCode" FROM doc
    UNION ALL SELECT md5(bt || '-' || m || '-' || cong), 'Senate', 'Committee ' || bt, 's0' FROM doc"""


@query("dim_committees", star(f'SELECT DISTINCT chamber, name, "systemCode", md5(name) AS committee_key FROM ({_COMMITTEE})', "doc"))
def _(t: Tables) -> DataFrame:
    return b.dim_committees(Star(t).staged_bills)


@query("bill_committee_bridge", star(f"SELECT DISTINCT bill_key, chamber, name, md5(name) AS committee_key FROM ({_COMMITTEE})", "doc"))
def _(t: Tables) -> DataFrame:
    return b.bill_committee_bridge(Star(t).staged_bills)


@query("stage_terms", star("SELECT * EXCLUDE (cur) FROM all_terms", "members"))
def _(t: Tables) -> DataFrame:
    return Star(t).staged_terms


@query("latest_with_open_end", star("SELECT * FROM terms", "members"))
def _(t: Tables) -> DataFrame:
    return Star(t).terms


@query("dim_party_history", star("SELECT DISTINCT * FROM party_history", "members"))
def _(t: Tables) -> DataFrame:
    return Star(t).party_history


@query("most_recent_state", star("SELECT * EXCLUDE (cur) FROM recent", "members"))
def _(t: Tables) -> DataFrame:
    s = Star(t)
    return mem.most_recent_chamber(s.staged_terms, s.landed_members)


@query("dim_members", star('SELECT * REPLACE ("currentMember"::VARCHAR AS "currentMember") FROM members', "members"))
def _(t: Tables) -> DataFrame:
    return Star(t).members.withColumn("currentMember", F.col("currentMember").cast("string"))


@query("districts", star("SELECT * FROM districts", "districts"))
def _(t: Tables) -> DataFrame:
    return Star(t).districts


@query(
    "stage_senate_ids",
    """SELECT c_mktsegment AS first_name, c_name AS last_name, 'N' || c_nationkey AS state, 'C' || c_custkey AS "bioguideID",
              unnest(CASE WHEN c_custkey % 9 = 0 THEN ['S' || c_custkey, 'SZ' || c_custkey] ELSE ['S' || c_custkey] END) AS lisid
       FROM customer""",
)
def _(t: Tables) -> DataFrame:
    return Star(t).senate_ids


@query(
    "override_join",
    """SELECT DISTINCT first_name, last_name, state, "bioguideID", coalesce('X' || s_suppkey, lisid) AS lisid
       FROM (SELECT c_custkey, c_mktsegment AS first_name, c_name AS last_name, 'N' || c_nationkey AS state, 'C' || c_custkey AS "bioguideID",
                unnest(CASE WHEN c_custkey % 9 = 0 THEN ['S' || c_custkey, 'SZ' || c_custkey] ELSE ['S' || c_custkey] END) AS lisid
             FROM customer) LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def _(t: Tables) -> DataFrame:
    return mem.senate_ids(Star(t).senate_ids, shapes.overrides(t.supplier))


@query(
    "first_lisid",
    """SELECT c_mktsegment AS first_name, c_name AS last_name, 'N' || c_nationkey AS state, 'C' || c_custkey AS "bioguideID",
              'S' || c_custkey AS lisid FROM customer""",
)
def _(t: Tables) -> DataFrame:
    return extras.first_lisid(shapes.senate_ids(t.customer))


# --- views -----------------------------------------------------------------------------


@query("party_majority", star("SELECT * FROM majority", "majority"))
def _(t: Tables) -> DataFrame:
    return party_majority(Star(t).fact, views.MAJORITY_KEY)


@query("votes_by_member", star("SELECT * FROM vbm", "vbm"))
def _(t: Tables) -> DataFrame:
    return text_dates(Star(t).votes_by_member, "vote_date")


@query("sponsored_bills_by_member", star("SELECT * FROM sponsored", "sponsored"))
def _(t: Tables) -> DataFrame:
    return text_dates(Star(t).sponsored, "introducedDate")


@query("voting_members", star("SELECT * FROM voting", "voting"))
def _(t: Tables) -> DataFrame:
    return Star(t).voting


@query(
    "terms_condensed",
    star(
        """SELECT "bioguideID", chamber, min(term_start_year) AS term_start_year,
             CASE WHEN bool_or(term_end_year IS NULL) THEN NULL ELSE max(term_end_year) END AS term_end_year
           FROM terms GROUP BY ALL""",
        "members",
    ),
)
def _(t: Tables) -> DataFrame:
    return terms_condensed(Star(t).terms)


@query(
    "term_islands",
    star(
        """, placed AS (SELECT *, row_number() OVER (PARTITION BY "bioguideID"
             ORDER BY term_end_year NULLS FIRST, chamber, term_start_year) AS place FROM terms),
           heads AS (SELECT * FROM placed t WHERE NOT EXISTS (FROM placed b WHERE b."bioguideID" = t."bioguideID"
             AND b.place = t.place - 1 AND b.chamber = t.chamber AND b.term_end_year = t.term_start_year)),
           counted AS (SELECT t."bioguideID", t.chamber, t.term_start_year, t.term_end_year, count(h.place) AS term_group
             FROM terms t LEFT JOIN heads h ON h."bioguideID" = t."bioguideID" AND h.chamber = t.chamber
               AND coalesce(h.term_end_year, 0) <= coalesce(t.term_end_year, 0) GROUP BY ALL)
           SELECT "bioguideID", chamber, term_group, min(term_start_year) AS term_start_year,
             CASE WHEN bool_or(term_end_year IS NULL) THEN NULL ELSE max(term_end_year) END AS term_end_year
           FROM counted GROUP BY "bioguideID", chamber, term_group""",
        "members",
    ),
)
def _(t: Tables) -> DataFrame:
    return term_islands(Star(t).terms)


# --- reports ---------------------------------------------------------------------------

_SHARES = """count(*) AS n, sum(CASE WHEN member_vote = 'Not Voting' THEN 0 ELSE 1 END)::BIGINT AS votes_cast,
    sum(voted_with_party_majority) / nullif(sum(CASE WHEN member_vote = 'Not Voting' THEN 0 ELSE 1 END), 0) AS party_majority_share,
    sum(voted_with_dem_majority) / nullif(sum(CASE WHEN member_vote = 'Not Voting' THEN 0 ELSE 1 END), 0) AS dem_majority_share,
    sum(voted_with_rep_majority) / nullif(sum(CASE WHEN member_vote = 'Not Voting' THEN 0 ELSE 1 END), 0) AS rep_majority_share"""
_ALIGNED = f"""SELECT "bioguideID", name, "partyName", {_SHARES} FROM vbm
    WHERE chamber = 'House of Representatives' AND "bioguideID" IS NOT NULL AND name IS NOT NULL AND "partyName" IS NOT NULL {{more}}
    GROUP BY "bioguideID", name, "partyName" """


@query("alignment", star(_ALIGNED.format(more=""), "vbm"))
def alignment(t: Tables) -> DataFrame:
    return reports.alignment(Star(t).votes_by_member, "House of Representatives")


@query("alignment_policy_area", star(_ALIGNED.format(more="""AND "policyArea" = 'Area HJRES'"""), "vbm"))
def _(t: Tables) -> DataFrame:
    return reports.alignment(Star(t).votes_by_member, "House of Representatives", "Area HJRES")


@query(
    "alignment_summary",
    star(
        f"""SELECT *, 'Rep. ' || split_part(name, ',', 1) || '''s vote align with the Democratic majority ' ||
              coalesce(round_even(dem_majority_share * 100, 0)::BIGINT::VARCHAR, 'nan') || '% of the time <br>and the Republican majority ' ||
              coalesce(round_even(rep_majority_share * 100, 0)::BIGINT::VARCHAR, 'nan') || '% of the time on bills related to Area HR (n = ' || n || ' votes)' AS sentence
            FROM ({_ALIGNED.format(more="""AND "policyArea" = 'Area HR'""")})""",
        "vbm",
    ),
)
def _(t: Tables) -> DataFrame:
    return reports.alignment_summary(Star(t).votes_by_member, None, "House of Representatives", "Area HR")


#: Every class of votes of every party on a roll call as a row; of equal counts the class with the greater ``weight`` leads.
_CLASSES = " UNION ALL ".join(
    f"""SELECT line, '{name}' AS party, '{shown}' AS class, "{letter}_{column}_votes" * 4 + {weight} AS weight FROM listed"""
    for letter, name in (("D", "Democratic"), ("R", "Republican"), ("I", "Independent"))
    for weight, column, shown in ((3, "yea_or_aye", "yea/aye"), (2, "nay_or_no", "nay/no"), (1, "present", "present"))
)


@query(
    "party_loyalty",
    star(
        f""", listed AS (SELECT row_number() OVER () AS line, * FROM votes),
        leads AS (SELECT line, party, arg_max(class, weight) AS class FROM ({_CLASSES}) GROUP BY line, party),
        cast_as AS (SELECT unnest(['Yea', 'Aye', 'No', 'Nay', 'Present', 'Not Voting']) AS vote,
                           unnest(['yea/aye', 'yea/aye', 'nay/no', 'nay/no', 'present', 'not_voting']) AS class)
        SELECT p.name, p."bioguideID", p."partyName", f.chamber,
          round(count(*) FILTER (k.class = c.class) / nullif(count(*) FILTER (c.class IS DISTINCT FROM 'not_voting'), 0), 2)
            AS perc_votes_with_party_majority
        FROM fact f JOIN people p ON p.ident = {BALLOT_ID} LEFT JOIN cast_as c ON c.vote = f.vote
          JOIN listed v ON v.roll_call_number = f.roll_call_number AND v.bill_name = f.bill_name
          LEFT JOIN leads k ON k.line = v.line AND k.party = p."partyName"
        GROUP BY ALL""",
        "vbm",
    ),
)
def _(t: Tables) -> DataFrame:
    s = Star(t)
    return extras.party_loyalty(s.fact, stored(s.votes, "dim_votes"), s.dim_members)


@query(
    "recent_votes",
    star(
        """SELECT vote_date, question, title, url, roll_call_number, "policyArea", member_vote, dem_majority_vote, rep_majority_vote, result, "partyName"
           FROM vbm WHERE title ILIKE '%on hj%' AND "policyArea" = 'Area HJRES'
           ORDER BY vote_date DESC, question NULLS FIRST, title NULLS FIRST, url NULLS FIRST, roll_call_number NULLS FIRST, "policyArea" NULLS FIRST,
             member_vote NULLS FIRST, dem_majority_vote NULLS FIRST, rep_majority_vote NULLS FIRST, result NULLS FIRST, "partyName" NULLS FIRST
           LIMIT 50 OFFSET 50""",
        "vbm",
    ),
)
def _(t: Tables) -> DataFrame:
    page = reports.recent_votes(Star(t).votes_by_member, None, "ON hj", "Area HJRES", number=2, size=50)
    return text_dates(page, "vote_date")


@query(
    "recent_sponsored_bills",
    star(
        """SELECT title, url, sponsor_type, coalesce("policyArea", '-') AS "policyArea", "introducedDate" FROM sponsored
           ORDER BY "introducedDate" DESC, title NULLS FIRST, url NULLS FIRST, sponsor_type NULLS FIRST, 4 NULLS FIRST LIMIT 101 OFFSET 100""",
        "sponsored",
    ),
)
def _(t: Tables) -> DataFrame:
    return reports.recent_sponsored_bills(Star(t).sponsored, None, number=2, size=100, compat=True)


@query(
    "years_served",
    star(
        """SELECT "bioguideID", chamber, min(term_start_year) AS "Start Year",
             CASE WHEN bool_or(term_end_year IS NULL) THEN '-' ELSE max(term_end_year)::VARCHAR END AS "End Year"
           FROM terms GROUP BY "bioguideID", chamber""",
        "members",
    ),
)
def _(t: Tables) -> DataFrame:
    return reports.years_served(terms_condensed(Star(t).terms))


@query(
    "policy_area_counts",
    star(
        """SELECT "bioguideID", "policyArea", count(*) AS n, "policyArea" || ' | (n=' || count(*) || ')' AS label FROM vbm
           WHERE "policyArea" IS NOT NULL GROUP BY "bioguideID", "policyArea" """,
        "vbm",
    ),
)
def _(t: Tables) -> DataFrame:
    from hemicycle.operators.filters import policy_area_counts

    return policy_area_counts(Star(t).votes_by_member, None)


@query(
    "find_by_area",
    star(
        """SELECT "bioguideID", chamber, congress, congressional_district, concat_name FROM voting
           WHERE chamber = 'House of Representatives' AND "stateName" IN (SELECT state FROM districts)
             AND coalesce(congressional_district, 0) IN (SELECT congressional_district FROM districts)""",
    ),
)
def _(t: Tables) -> DataFrame:
    s = Star(t)
    house = s.voting.filter("chamber = 'House of Representatives'")
    return reports.find_by_area(house, s.districts, by_district=True).select(
        "bioguideID", "chamber", "congress", "congressional_district", "concat_name"
    )


@query(
    "find_by_zip",
    star(
        """SELECT "bioguideID", chamber, congress, concat_name FROM voting
           WHERE chamber = 'Senate' AND "stateName" IN (SELECT state FROM districts WHERE zip_code = 10007)""",
    ),
)
def _(t: Tables) -> DataFrame:
    s = Star(t)
    return reports.find_by_zip(s.voting, s.districts, "10007", "Senate").select(
        "bioguideID", "chamber", "congress", "concat_name"
    )


@query(
    "find_by_name",
    star("""SELECT DISTINCT concat_name FROM voting WHERE chamber = 'Senate' AND "lastName" ILIKE '%customer#%1%'"""),
)
def _(t: Tables) -> DataFrame:
    return reports.option_labels(reports.find_by_name(Star(t).voting, "CUSTOMER#.*1", "Senate", regex=True))


@query("scope_session", star("SELECT * FROM voting WHERE congress IN (108, 110)"))
def _(t: Tables) -> DataFrame:
    return scope_session(Star(t).voting, None, (108, 110))


@query(
    "unify_votes",
    star(
        f"""SELECT DISTINCT strftime(vd, '%Y-%m-%d') AS date, cong AS congress, session::VARCHAR AS session, bt AS bill_type,
             m::VARCHAR AS bill_number, CASE WHEN st = 'O' THEN 'Senate' ELSE 'House' END AS chamber, (dec + 1)::VARCHAR AS roll_call_number,
             CASE WHEN m % 2 = 0 THEN 'Passed' ELSE 'Failed' END AS result,
             CASE WHEN st = 'O' THEN m * 2 ELSE m * 3 END AS yea_totals, dec AS nay_totals,
             CASE WHEN st <> 'O' THEN 0 WHEN m = 1 THEN 1 END::BIGINT AS present_totals,
             CASE WHEN st <> 'O' THEN y % 7 WHEN m % 2 = 0 THEN 3 END::BIGINT AS not_voting_totals,
             CASE WHEN st = 'O' THEN 'S' ELSE 'C' END || (c + i) AS id, {shapes.VOTE.format(n='k + 7 * i')} AS vote,
             {shapes.PARTY.format(x='c + i')} AS party, CASE WHEN st = 'O' THEN 'Customer' || (c + i) || ', Sen' END AS legislator_name
           FROM doc, (SELECT unnest([0, 1, 2]) AS i)""",
        "doc",
    ),
)
def _(t: Tables) -> DataFrame:
    return extras.unified_ballots(extras.unify_votes(shapes.house_votes(t.orders), shapes.senate_votes(t.orders)))


@query(
    "recorded_votes",
    star(
        """SELECT m::VARCHAR AS bill_number, bt AS bill_type, k::VARCHAR AS "rollNumber", 'https://votes.example/' || k || '.xml' AS url,
             ch AS chamber, cong::VARCHAR AS congress, day || 'T12:00:00Z' AS date, '1' AS "sessionNumber"
           FROM doc, LATERAL (SELECT unnest([chamber, 'House of Representatives', 'Senate']) AS ch) WHERE day >= '1998-03-01'""",
        "doc",
    ),
)
def _(t: Tables) -> DataFrame:
    return staging.recorded_votes(shapes.bills(t.orders), "1998-03-01T12:00:00Z")


@query("latest_summary", star("SELECT bt || m AS bill, 'Text of ' || k AS most_recent_text FROM doc", "doc"))
def _(t: Tables) -> DataFrame:
    found = extras.latest_summary(extras.structured_bills(shapes.bills(t.orders)))
    return found.select(F.concat("type", "number").alias("bill"), "most_recent_text")


@query(
    "conform_record",
    star(
        """SELECT bt AS type, m::VARCHAR AS number, title, 'Area ' || area AS area, 2::INTEGER AS n_committees, 'Committee ' || m AS first_committee,
             3::INTEGER AS n_actions, 3::INTEGER AS n_votes, 'C' || c AS sponsor, CASE WHEN st = 'P' THEN 0 ELSE 2 END::INTEGER AS n_cosponsors,
             CASE WHEN st = 'F' THEN 0 ELSE 2 END::INTEGER AS n_subjects, 'Latest' AS latest, 'Text of ' || k AS most_recent_text
           FROM (SELECT *, 'Act ' || k || ' on ' || bt AS title, nullif(bt, 'AMDT') AS area FROM doc)""",
        "doc",
    ),
)
def _(t: Tables) -> DataFrame:
    record = extras.conform_bill(extras.structured_bills(shapes.bills(t.orders))).select("bill.*")
    votes = F.aggregate("actions.item", F.lit(0), lambda n, a: n + F.size(a["recordedVotes"]))
    return record.select(
        "type", "number", "title", F.col("policyArea.name").alias("area"), F.size("committees.item").alias("n_committees"),
        F.expr("committees.item[0].name").alias("first_committee"), F.size("actions.item").alias("n_actions"),
        votes.alias("n_votes"), F.expr("sponsors.item[0].bioguideID").alias("sponsor"),
        F.size("cosponsors.item").alias("n_cosponsors"), F.size("subjects.legislativeSubjects.item").alias("n_subjects"),
        F.col("latestAction.text").alias("latest"), "most_recent_text",
    )


@query(
    "bill_url",
    star(
        """SELECT k, bt || c AS bill_name, 'https://www.congress.gov/bill/' || """
        + ORDINAL.format(n="c")
        + """ || '-congress/' || CASE bt WHEN 'S' THEN 'senate-bill' WHEN 'HR' THEN 'house-bill' WHEN 'HJRES' THEN 'house-joint-resolution'
             WHEN 'SCONRES' THEN 'senate-concurrent-resolution' END || '/' || k AS url FROM doc""",
        "doc",
    ),
)
def _(t: Tables) -> DataFrame:
    from hemicycle.functions.keys import bill_name, bill_url

    return shapes.documents(t.orders).select("k", bill_name("bt", "c").alias("bill_name"), bill_url("c", "bt", "k").alias("url"))
