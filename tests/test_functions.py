"""Column helpers on hand-made values."""

import hashlib

import pytest
from pyspark.sql import functions as F

from hemicycle.functions import dates, json as js, keys, text, votes as vt


def value(spark, col):
    return spark.range(1).select(col).first()[0]


@pytest.mark.parametrize(
    ("number", "said"),
    [(1, "1st"), (2, "2nd"), (3, "3rd"), (4, "4th"), (11, "11th"), (12, "12th"), (13, "13th"), (101, "101st"), (111, "111th"),
     (112, "112th"), (113, "113th"), (118, "118th"), (121, "121st"), (122, "122nd"), (123, "123rd")],
)
def test_ordinal(spark, number, said):
    assert value(spark, keys.ordinal(F.lit(number))) == said


def test_bill_url(spark):
    df = spark.createDataFrame([("118", "HR", "21"), ("121", "SJRES", "4"), ("118", "XX", "1"), ("118", None, "1")], "congress string, type string, number string")
    assert [r[0] for r in df.select(keys.bill_url("congress", "type", "number")).collect()] == [
        "https://www.congress.gov/bill/118th-congress/house-bill/21",
        "https://www.congress.gov/bill/121st-congress/senate-joint-resolution/4", None, None,
    ]


def test_keys_differ_by_table(spark):
    df = spark.createDataFrame([("HR", "21", "118")], "type string, number string, congress string")
    three, two = df.select(keys.congress_bill_key(), keys.vote_bill_key("type", "number")).first()
    assert three == hashlib.md5(b"HR-21-118").hexdigest()
    assert two == hashlib.md5(b"HR-21").hexdigest()


def test_null_key_part_is_marked(spark):
    got = value(spark, keys.surrogate_key(F.lit("a"), F.lit(None)))
    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


@pytest.mark.parametrize(
    ("vote", "shown", "group", "cast"),
    [("Yea", "yea", "yea/aye", 1), ("Aye", "yea", "yea/aye", 1), ("Nay", "nay", "nay/no", 1), ("No", "nay", "nay/no", 1),
     ("Present", "other", "present", 1), ("Not Voting", "other", "not_voting", 0), ("Jeffries", "other", None, 1), (None, "other", None, 1)],
)
def test_ballots(spark, vote, shown, group, cast):
    v = F.lit(vote).cast("string")
    got = spark.range(1).select(vt.ballot_class(v), vt.ballot_group(v), vt.was_cast(v)).first()
    assert tuple(got) == (shown, group, cast)


def test_party_and_chamber(spark):
    df = spark.createDataFrame([("Democratic",), ("Republican",), ("Libertarian",), (None,)], "p string")
    assert [r[0] for r in df.select(vt.party_group("p")).collect()] == ["Democratic", "Republican", "Independent", "Independent"]
    assert value(spark, vt.chamber_name(F.lit("Senate"))) == "Senate"
    assert value(spark, vt.chamber_name(F.lit("House"))) == "House of Representatives"


def test_labels(spark):
    label = vt.member_label(F.lit("Doe, Jane"), F.lit("Democratic"), F.lit("OR"))
    assert value(spark, label) == "Doe, Jane | D - OR"
    assert value(spark, vt.label_name(label)) == "Doe, Jane"
    assert value(spark, vt.member_label(F.lit("Doe"), F.lit(None).cast("string"), F.lit("OR"))) is None


def test_sentence(spark):
    said = vt.alignment_sentence(F.lit("Doe, Jane"), F.lit("Senate"), F.lit(0.125), F.lit(0.375), F.lit(8), "Health")
    assert value(spark, said) == (
        "Senator Doe's vote align with the Democratic majority 12% of the time <br>and the Republican majority 38% of the time"
        " on bills related to Health (n = 8 votes)"
    )
    house = vt.alignment_sentence(F.lit("Doe"), F.lit("House of Representatives"), F.lit(None).cast("double"), F.lit(1.0), F.lit(1))
    assert value(spark, house).startswith("Rep. Doe's vote align with the Democratic majority nan% of the time")


def test_dates(spark):
    assert value(spark, dates.house_date(F.lit("9-Jan-2023"))) == "2023-01-09"
    assert value(spark, dates.house_date(F.lit("soon"))) is None
    for written in ("January 9, 2023,  05:30 PM", "January 9, 2023, 05: 30 PM", "January 19, 2023,  11:30 AM"):
        assert value(spark, dates.senate_date(F.lit(written))) in ("2023-01-09", "2023-01-19")


@pytest.mark.parametrize(
    ("doc", "path", "found"),
    [('{"name":"Health"}', "$.name", "Health"), ('{"name":{"a":1}}', "$.name", None), ('{"name":[1]}', "$.name", None),
     ('{"name":"{not json}"}', "$.name", "{not json}"), ('{"name":1.0}', "$.name", "1.0"), ('{"x":1}', "$.name", None),
     ("broken", "$.name", None), (None, "$.name", None), ('{"name":null}', "$.name", None)],
)
def test_json_scalar(spark, doc, path, found):
    df = spark.createDataFrame([(doc,)], "c string")
    assert df.select(js.json_scalar("c", path)).first()[0] == found


def test_json_explode_drops_empty(spark):
    df = spark.createDataFrame([(1, '{"item":[{"n":1},{"n":2}]}'), (2, '{"item":[]}'), (3, None), (4, '{"item":{"n":9}}')], "id int, c string")
    got = js.json_explode(df, "c", "$.item", "x").select("id", js.json_scalar("x", "$.n")).collect()
    assert [tuple(r) for r in got] == [(1, "1"), (1, "2")]


@pytest.mark.parametrize(
    ("term", "regex", "found"),
    [("ACT (a", False, [1]), ("act", False, [1, 2]), ("", False, [1, 2]), ("a.t", False, []), ("a.t", True, [1, 2]), ("%", False, [])],
)
def test_search(spark, term, regex, found):
    df = spark.createDataFrame([(1, "An Act (amended)"), (2, "act two"), (3, None)], "id int, t string")
    assert [r[0] for r in df.filter(text.matches("t", term, regex)).collect()] == found


def test_display_texts(spark):
    assert value(spark, text.html_link(F.lit("u"), F.lit("t"))) == '<a href="u" target="_blank">t</a>'
    assert value(spark, text.year_or_dash(F.lit(None).cast("bigint"))) == "-"
    assert value(spark, text.year_or_dash(F.lit(2021))) == "2021"
    df = text.truncate_text(spark.createDataFrame([("é" * 101, 7), ("x" * 100, 8), (None, 9)], "t string, n int"))
    assert [tuple(r) for r in df.collect()] == [("é" * 100 + "...", 7), ("x" * 100, 8), (None, 9)]
