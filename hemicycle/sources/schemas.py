"""Declared schemas of the landing data.

Fixed values: field names and types are those of the source documents after name
cleaning. Declaring them keeps reads to one pass (no inference) and makes a single XML
child of a repeated element a one-element array.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- roll calls ------------------------------------------------------------------------

_PARTY_TOTAL = "party:string,yea_total:string,nay_total:string,present_total:string,not_voting_total:string"
_VOTE_TOTAL = "total_stub:string,yea_total:string,nay_total:string,present_total:string,not_voting_total:string"
_HEADER = "party_header:string,yea_header:string,nay_header:string,present_header:string,not_voting_header:string"

_HOUSE_METADATA = (
    "majority:string,congress:string,session:string,chamber:string,rollcall_num:string,legis_num:string,"
    "vote_question:string,vote_type:string,vote_result:string,action_date:string,"
    "action_time:struct<time_etz:string,text:string>,vote_desc:string,"
    f"vote_totals:struct<totals_by_party_header:struct<{_HEADER}>,"
    f"totals_by_party:array<struct<{_PARTY_TOTAL}>>,totals_by_vote:struct<{_VOTE_TOTAL}>>"
)
_LEGISLATOR = (
    "name_id:string,sort_field:string,unaccented_name:string,party:string,state:string,role:string,text:string"
)
_HOUSE_ROLL = (
    f"vote_metadata:struct<{_HOUSE_METADATA}>,"
    f"vote_data:struct<recorded_vote:array<struct<legislator:struct<{_LEGISLATOR}>,vote:string>>>"
)

_SENATOR_BALLOT = (
    "member_full:string,last_name:string,first_name:string,party:string,state:string,vote_cast:string,"
    "lis_member_id:string"
)
_SENATE_ROLL = (
    "congress:string,session:string,congress_year:string,vote_number:string,vote_date:string,modify_date:string,"
    "vote_question_text:string,vote_document_text:string,vote_result_text:string,question:string,"
    "vote_title:string,majority_requirement:string,vote_result:string,"
    "document:struct<document_congress:string,document_type:string,document_number:string,document_name:string,"
    "document_title:string,document_short_title:string>,"
    "amendment:struct<amendment_number:string,amendment_to_amendment_number:string,"
    "amendment_to_amendment_to_amendment_number:string,amendment_to_document_number:string,"
    "amendment_to_document_short_title:string,amendment_purpose:string>,"
    "count:struct<yeas:string,nays:string,present:string,absent:string>,"
    "tie_breaker:struct<by_whom:string,tie_breaker_vote:string>,"
    f"members:struct<member:array<struct<{_SENATOR_BALLOT}>>>"
)
_BILL_REFERENCE = "chamber string, bill_number bigint, bill_type string"

# --- bills -----------------------------------------------------------------------------

BILL_SCALARS = (
    "number", "updateDate", "updateDateIncludingText", "originChamber", "originChamberCode", "type",
    "introducedDate", "congress", "constitutionalAuthorityStatementText",
)
BILL_JSON = (
    "committees", "relatedBills", "actions", "sponsors", "cosponsors", "policyArea", "subjects", "summaries",
    "titles", "textVersions", "latestAction", "committeeReports", "cboCostEstimates", "laws", "amendments",
    "cdata", "notes",
)

_PERSON = (
    "bioguideId:string,fullName:string,firstName:string,middleName:string,lastName:string,party:string,"
    "state:string,district:string,isByRequest:string,sponsorshipDate:string,isOriginalCosponsor:string"
)
RECORDED_VOTE = "rollNumber:string,url:string,chamber:string,congress:string,date:string,sessionNumber:string"
#: Shape of the parts of a bill the models look into.
BILL_PARTS = {
    "committees": "struct<item:array<struct<systemCode:string,name:string,chamber:string,type:string>>>",
    "actions": "struct<item:array<struct<actionDate:string,text:string,type:string,actionCode:string,"
    f"recordedVotes:struct<recordedVote:array<struct<{RECORDED_VOTE}>>>>>>",
    "sponsors": f"struct<item:array<struct<{_PERSON}>>>",
    "cosponsors": f"struct<count:string,item:array<struct<{_PERSON}>>>",
    "policyArea": "struct<name:string>",
    "subjects": "struct<legislativeSubjects:struct<item:array<struct<name:string>>>>",
    "summaries": "struct<summary:array<struct<versionCode:string,actionDate:string,actionDesc:string,"
    "updateDate:string,text:string>>>",
    "latestAction": "struct<actionDate:string,text:string>",
}

# --- members ---------------------------------------------------------------------------

_TERM = (
    "chamber:string,congress:bigint,district:bigint,endYear:bigint,memberType:string,startYear:bigint,"
    "stateCode:string,stateName:string"
)

#: Schema of the newline JSON of each landing folder.
LANDING = {
    "house_votes": f"rollcall_vote struct<{_HOUSE_ROLL}>, {_BILL_REFERENCE}",
    "senate_votes": f"roll_call_vote struct<{_SENATE_ROLL}>, {_BILL_REFERENCE}",
    "bill_status": ", ".join(f"{c} string" for c in (*BILL_SCALARS, "title", *BILL_JSON)),
    "members": (
        "addressInformation struct<city:string,district:string,officeAddress:string,phoneNumber:string,"
        "zipCode:bigint>, bioguideId string, birthYear string, deathYear string, "
        "cosponsoredLegislation struct<count:bigint,url:string>, currentMember boolean, "
        "depiction struct<attribution:string,imageUrl:string>, directOrderName string, district bigint, "
        "firstName string, honorificName string, invertedOrderName string, lastName string, "
        "leadership array<struct<congress:bigint,current:boolean,type:string>>, officialWebsiteUrl string, "
        "partyHistory array<struct<partyAbbreviation:string,partyName:string,startYear:bigint,endYear:bigint>>, "
        "previousNames array<struct<directOrderName:string,endDate:string,firstName:string,"
        "honorificName:string,invertedOrderName:string,lastName:string,middleName:string,startDate:string>>, "
        "sponsoredLegislation struct<count:bigint,url:string>, state string, "
        f"terms array<struct<{_TERM}>>, updateDate string, "
        "terms_all struct<item:array<struct<chamber:string,startYear:bigint,endYear:bigint>>>, "
        "middleName string, suffixName string, nickName string"
    ),
    "senate_ids": (
        "full_name string, publication_name string, party string, state string, bioguide string, "
        "service_dates string, death_date string, lisid array<string>, featured_bio string, current string"
    ),
}

#: Seed files with a header line.
SEEDS = {
    "state_abbreviations": "Name string, Abbreviation string",
    "senate_id_overrides": "first_name string, last_name string, state string, bioguideID string, lisid string",
    "congressional_zones": "zcta int, state_abbr string, cd int",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def landing_schema(kind: str) -> T.StructType:
    return struct(LANDING[kind])


def bill_xml_schema() -> T.StructType:
    """Bill element as XML: known parts as structs, the rest as their inner XML text."""
    parts = [f"{c} {BILL_PARTS.get(c, 'string')}" for c in BILL_JSON]
    return struct(", ".join([*(f"{c} string" for c in BILL_SCALARS), "title string", *parts]))


def _hyphenated(kind: T.DataType, keep: frozenset[str] = frozenset()) -> T.DataType:
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_hyphenated(kind.elementType, keep))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name.replace("_", "-"), _hyphenated(f.dataType)) for f in kind.fields])
    return kind


def roll_call_xml_schema(chamber: str) -> T.StructType:
    """Root element of a roll call; House documents write names with hyphens."""
    if chamber == "house":
        return _hyphenated(struct(_HOUSE_ROLL))
    return struct(_SENATE_ROLL)


def senator_xml_schema() -> T.StructType:
    names = "struct<first_name:string,middle_name:string,last_name:string,suffix:string,nickname:string>"
    return struct(
        f"full_name {names}, publication_name {names}, party string, state string, bioguide string, "
        "service_dates string, death_date string, lisid array<string>, featured_bio string, current string"
    )
