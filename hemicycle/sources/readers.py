"""Landing documents, landing folders, seeds and exported tables as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.functions.votes import HOUSE, SENATE, chamber_name
from hemicycle.sources import schemas
from hemicycle.sources.names import clean_names

#: Landing folder names.
BILLS, HOUSE_VOTES, SENATE_VOTES = "bill_status", "house_votes", "senate_votes"
MEMBERS, SENATE_IDS = "members", "senate_ids"
#: Names of landing files, plain or compressed.
LANDING_FILES = "*.json{,.gz}"

_ROLL_TAGS = {"rollcall-vote": ("house", "rollcall_vote", HOUSE), "roll_call_vote": ("senate", "roll_call_vote", SENATE)}


def _xml(spark: SparkSession, path: str | Sequence[str], row_tag: str, schema, glob: str, bundled: bool) -> DataFrame:
    """XML rows; attributes keep their own names and element text is called ``text``.

    A file holds one document, or any number of them one after another if ``bundled``;
    bundled files may be split between tasks. A document that cannot be read fails the job.
    """
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("attributePrefix", "")
        .option("valueTag", "text")
        .option("mode", "FAILFAST")
        .option("multiLine", str(not bundled).lower())
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .schema(schema)
        .load(path)
    )


def read_bills_xml(
    spark: SparkSession, path: str | Sequence[str], glob: str = "*.xml", bundled: bool = False
) -> DataFrame:
    """Every bill of a tree of bill files, parts as structs; an only child is a list of one.

    Bundled files must hold bare ``bill`` elements: when Spark splits such files it takes
    the ``billStatus`` tag around them for the row tag.
    """
    return _xml(spark, path, "bill", schemas.bill_xml_schema(), glob, bundled)


def bills_as_json_text(bills: DataFrame) -> DataFrame:
    """The landing form of :func:`read_bills_xml`: the variable parts as JSON text."""
    typed = dict(bills.dtypes)
    return bills.select(
        *[
            F.to_json(c).alias(c) if c in schemas.BILL_PARTS and typed[c].startswith("struct") else F.col(c)
            for c in bills.columns
        ]
    )


#: Where a document states its congress, session and number.
_ROLL_FIELDS = {
    "rollcall-vote": ("vote_metadata.congress", "vote_metadata.session", "vote_metadata.rollcall_num"),
    "roll_call_vote": ("congress", "session", "vote_number"),
}


def read_roll_calls_xml(
    spark: SparkSession, path: str | Sequence[str], row_tag: str, references: DataFrame | None = None,
    glob: str = "*.xml",
    bundled: bool = False,
) -> DataFrame:
    """Roll calls of one chamber with the bill they belong to.

    ``references`` has the columns congress, sessionNumber, rollNumber, chamber, bill_number and
    bill_type (see :func:`hemicycle.plans.staging.recorded_votes`); a roll call belongs to the bill
    that names its congress, session and number, as the document states them: file names repeat in
    every year. Without it the bill columns are null.
    """
    kind, column, chamber = _ROLL_TAGS[row_tag]
    raw = _xml(spark, path, row_tag, schemas.roll_call_xml_schema(kind), glob, bundled)
    named = clean_names(raw.select(F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias(column)))
    named = named.select(column, F.lit(chamber).alias("chamber"))
    if references is None:
        return named.withColumns(
            {"bill_number": F.lit(None).cast("bigint"), "bill_type": F.lit(None).cast("string")}
        )
    stated = [F.col(f"{column}.{field}") for field in _ROLL_FIELDS[row_tag]]
    given = [F.col(c) for c in ("congress", "sessionNumber", "rollNumber")]
    keys = ["__congress", "__session", "__number"]
    known = (
        references.filter(chamber_name("chamber") == chamber)
        .select(
            *[_leading_number(c).alias(k) for c, k in zip(given, keys, strict=True)],
            F.expr("try_cast(bill_number as bigint)").alias("bill_number"),
            "bill_type",
        )
        .dropna(subset=keys)
        .distinct()
    )
    numbered = named.withColumns({k: _leading_number(c) for c, k in zip(stated, keys, strict=True)})
    return numbered.join(known, keys).select(column, "chamber", "bill_number", "bill_type")


def _leading_number(c: Column) -> Column:
    """The digits a text starts with, as a number: 1st, 00007 and 118 alike."""
    return F.nullif(F.regexp_extract(c.cast("string"), r"^\s*(\d+)", 1), F.lit("")).cast("bigint")


def read_senate_ids_xml(
    spark: SparkSession, path: str | Sequence[str], glob: str = "*.xml", bundled: bool = False
) -> DataFrame:
    """Senator id list; a missing id is a list with one empty text, names are JSON text."""
    raw = clean_names(_xml(spark, path, "senator", schemas.senator_xml_schema(), glob, bundled))
    ids = F.when(F.size(F.coalesce("lisid", F.array())) > 0, F.col("lisid")).otherwise(F.array(F.lit("")))
    return raw.withColumns(
        {"full_name": F.to_json("full_name"), "publication_name": F.to_json("publication_name"), "lisid": ids}
    )


def read_ndjson(spark: SparkSession, root: str, kind: str, run_date: str | None = None) -> DataFrame:
    """One landing folder with the declared schema: all runs, or the one given.

    A line that is no JSON, or has a value of another type, fails the job.
    """
    folder = f"{root.rstrip('/')}/{kind}" + (f"/run_date={run_date}" if run_date else "")
    return (
        spark.read.schema(schemas.landing_schema(kind))
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", LANDING_FILES)
        .json(folder)
    )


def read_members(spark: SparkSession, root: str) -> DataFrame:
    return read_ndjson(spark, root, MEMBERS)


def read_senate_ids(spark: SparkSession, root: str) -> DataFrame:
    return read_ndjson(spark, root, SENATE_IDS)


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A seed CSV by name of its schema. Any of LF, CRLF and CR ends a line."""
    return spark.read.option("header", "true").schema(schemas.SEEDS[name]).csv(path)


def read_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One exported table."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def query_with_dates(spark: SparkSession, sql: str, date_cols: Sequence[str] = ()) -> DataFrame:
    """Result of a SQL text with the named columns as timestamps."""
    return spark.sql(sql).withColumns({c: F.to_timestamp(F.col(c)) for c in date_cols})
