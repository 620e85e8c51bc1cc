"""Date texts of the source documents. Unreadable text becomes null, except in :func:`stated_instant`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hemicycle.functions.keys import as_column

# Formats of the source documents.
HOUSE_DATE = "d-MMM-yyyy"
SENATE_DATE = "MMMM d, yyyy, h:mm a"
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_DAY = "yyyy-MM-dd"


def house_date(col: Column | str) -> Column:
    """``9-Jan-2023`` to ``2023-01-09``."""
    return F.date_format(F.try_to_timestamp(as_column(col), F.lit(HOUSE_DATE)), ISO_DAY)


def senate_date(col: Column | str) -> Column:
    """``January 9, 2023,  05:30 PM`` to ``2023-01-09``; runs of blanks count as one."""
    tidy = F.regexp_replace(F.regexp_replace(as_column(col), r"\s+", " "), ": ", ":")
    return F.date_format(F.try_to_timestamp(tidy, F.lit(SENATE_DATE)), ISO_DAY)


def iso_instant(col: Column | str) -> Column:
    """``2023-01-09T12:00:00Z`` as a timestamp."""
    return F.try_to_timestamp(as_column(col), F.lit(ISO_INSTANT))


def stated_instant(col: Column | str) -> Column:
    """:func:`iso_instant`, but a text that is there and cannot be read fails the job; empty is null."""
    text = F.nullif(as_column(col), F.lit(""))
    broken = F.raise_error(F.concat(F.lit("unreadable date: "), text))
    return F.when(text.isNotNull(), F.coalesce(iso_instant(text), broken.cast("timestamp")))
