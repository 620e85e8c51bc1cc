"""JSON parts parsed once into variants, against the same models over text."""

from conftest import rows
from hemicycle.functions import json as js
from hemicycle.plans import bills as b, staging

PARTS = "bill_key string, number string, type string, congress string, title string, updateDate string, updateDateIncludingText string, introducedDate string, policyArea string, sponsors string, cosponsors string, subjects string, committees string, actions string"
ONE = '{"item":[{"bioguideId":"M1"},{"bioguideId":"M1"},{"bioguideId":null},{"other":1}]}'
TEXTS = [
    (ONE, '{"item":[{"bioguideId":"M2"}]}', '{"legislativeSubjects":{"item":[{"name":"Taxes [a]"},{"name":{"x":1}}]}}', '{"item":[{"name":"{odd","chamber":"House"}]}', '{"name":"Health"}'),
    ('{"item":{"bioguideId":"M1"}}', "not json", None, '{"item":[]}', '{"name":["a"]}'),
    (None, "", '{"legislativeSubjects":null}', '[{"name":"x"}]', '{"name":"[x]"}'),
]
ACTIONS = ['{"item":[{"recordedVotes":{"recordedVote":{"rollNumber":"1","chamber":"House"}}},{"text":"none"},{"recordedVotes":{"recordedVote":[{"rollNumber":"2"},{"rollNumber":"3","chamber":"Senate"}]}}]}', None, "{"]


def landed(spark):
    found = [(str(n), "HR", "118", f"T{n}", None, None, None, area, s, c, subjects, committees, actions) for n, ((s, c, subjects, committees, area), actions) in enumerate(zip(TEXTS, ACTIONS, strict=True))]
    return spark.createDataFrame(found, PARTS.removeprefix("bill_key string, "))


def test_models_over_variants(spark):
    text, parsed = staging.stage_bills(landed(spark)), staging.stage_parsed_bills(landed(spark))
    assert js.is_variant(parsed, "sponsors") and not js.is_variant(text, "sponsors")
    for model in (b.dim_bills, b.dim_sponsors, b.dim_bill_subjects, b.dim_committees, b.bill_committee_bridge, staging.recorded_votes):
        ours = model(parsed)
        assert rows(ours) == rows(model(text)) and ours.columns == model(text).columns
    assert rows(staging.recorded_votes(parsed).select("rollNumber", "chamber")) == [("1", "House of Representatives"), ("2", "House of Representatives"), ("3", "Senate")]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_is_parsed_once(spark):
    """One parse of each part on landing, and none in any model; over text every model parses."""
    parsed = js.parse_parts(staging.stage_bills(landed(spark)), staging.JSON_PARTS)
    assert plan(parsed.selectExpr("*")).count("parse_json(") + plan(parsed).count("parseJson(") in (len(staging.JSON_PARTS), 2 * len(staging.JSON_PARTS))
    stored = staging.stage_parsed_bills(landed(spark))
    for model in (b.dim_sponsors, b.dim_bill_subjects, b.dim_committees, b.bill_committee_bridge, staging.recorded_votes):
        assert not any(x in plan(model(stored)) for x in ("parse_json", "parseJson", "get_json_object", "from_json"))
        assert any(x in plan(model(staging.stage_bills(landed(spark)))) for x in ("get_json_object", "from_json"))
