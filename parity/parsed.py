"""The bill models over parts that were parsed once into variants; the SQL is that of the models over text."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from hemicycle.plans import bills as b, staging
from parity import shapes
from parity.registry import SQL, Tables, query
from parity.star import Star, text_dates


class Parsed(Star):
    """The models over stored variants."""

    @cached_property
    def staged_bills(self) -> DataFrame:
        return staging.stage_parsed_bills(shapes.bills(self.t.orders))


@query("variant_sponsors", SQL["sponsors"])
def _(t: Tables) -> DataFrame:
    return Parsed(t).sponsors


@query("variant_committees", SQL["dim_committees"])
def _(t: Tables) -> DataFrame:
    return b.dim_committees(Parsed(t).staged_bills)


@query("variant_subjects", SQL["dim_bill_subjects"])
def _(t: Tables) -> DataFrame:
    return b.dim_bill_subjects(Parsed(t).staged_bills)


@query("variant_bills", SQL["dim_bills"])
def _(t: Tables) -> DataFrame:
    return text_dates(Parsed(t).bills, "introducedDate")


@query("variant_recorded_votes", SQL["recorded_votes"])
def _(t: Tables) -> DataFrame:
    parsed = staging.stored(staging.parse_parts(shapes.bills(t.orders), ["actions"]), "parsed_actions")
    return staging.recorded_votes(parsed, "1998-03-01T12:00:00Z")
