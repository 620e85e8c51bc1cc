"""Surrogate keys, bill names and links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker the key macro puts in place of a null part.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Host and the slug of each bill type. Other types have no link.
BILL_SITE = "https://www.congress.gov/bill/"
BILL_SLUGS = {
    "S": "senate-bill",
    "HR": "house-bill",
    "SRES": "senate-resolution",
    "HRES": "house-resolution",
    "SJRES": "senate-joint-resolution",
    "SCONRES": "senate-concurrent-resolution",
    "HJRES": "house-joint-resolution",
    "HCONRES": "house-concurrent-resolution",
}


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the parts joined by ``-``; a null part counts as a marker text."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def bill_name(bill_type: Column | str, number: Column | str) -> Column:
    """``HR`` and ``21`` make ``HR21``; null if either part is null."""
    return F.concat(as_column(bill_type), as_column(number).cast("string"))


def ordinal(number: Column | str) -> Column:
    """English ordinal text of a whole number: 1st, 2nd, 3rd, 11th, 112th, 121st."""
    n = as_column(number).cast("bigint")
    tail = F.pmod(n, F.lit(10))
    teen = F.pmod(n, F.lit(100)).between(11, 13)
    suffix = (
        F.when(teen, "th")
        .when(tail == 1, "st")
        .when(tail == 2, "nd")
        .when(tail == 3, "rd")
        .otherwise("th")
    )
    return F.concat(n.cast("string"), suffix)


def bill_slug(bill_type: Column | str) -> Column:
    kind = as_column(bill_type)
    known = iter(BILL_SLUGS.items())
    first, slug = next(known)
    return reduce(lambda acc, kv: acc.when(kind == kv[0], kv[1]), known, F.when(kind == first, slug))


def bill_url(congress: Column | str, bill_type: Column | str, number: Column | str) -> Column:
    """Public page of a bill; null for an unknown type or any null part."""
    return F.concat(
        F.lit(BILL_SITE),
        ordinal(F.expr(f"try_cast({congress} as bigint)") if isinstance(congress, str) else congress),
        F.lit("-congress/"),
        bill_slug(bill_type),
        F.lit("/"),
        as_column(number).cast("string"),
    )


def congress_bill_key(bill_type: Column | str = "type", number: Column | str = "number", congress: Column | str = "congress") -> Column:
    """Key of a bill version: type, number and congress."""
    return surrogate_key(bill_type, number, congress)


def vote_bill_key(bill_type: Column | str = "bill_type", number: Column | str = "bill_number") -> Column:
    """Key the vote tables carry: type and number only.

    It never equals :func:`congress_bill_key`; votes and bills meet on name and congress.
    """
    return surrogate_key(bill_type, number)
