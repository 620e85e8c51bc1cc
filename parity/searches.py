"""Searches by the inverted index and pages by the page index; the SQL scans and sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.operators import page_index, text_index
from hemicycle.session import scratch_path
from parity.registry import SQL, Tables, query
from parity.star import text_dates


def indexed(df: DataFrame, key: str, text: str, term: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "text_index")
    text_index.build_index(df, key, text, path)
    return text_index.search_index(df, key, text, term, path)


@query("indexed_title", SQL["search_title"])
def _(t: Tables) -> DataFrame:
    return indexed(t.part, "p_partkey", "p_name", "RED w").select("p_partkey", "p_name")


@query("indexed_title_short", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%b%'")
def _(t: Tables) -> DataFrame:
    return indexed(t.part, "p_partkey", "p_name", "B").select("p_partkey", "p_name")


@query("indexed_name", "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%r#%77%' AND c_name LIKE '%77%'")
def _(t: Tables) -> DataFrame:
    return indexed(t.customer, "c_custkey", "c_name", "77").select("c_custkey", "c_name")


@query("indexed_documents", SQL["search_documents"])
def _(t: Tables) -> DataFrame:
    found = indexed(t.documents, "doc_id", "text", "Tion The")
    return found.select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("indexed_page", SQL["recent_page"])
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "page_index")
    order = [F.desc("o_orderdate"), F.asc("o_orderkey")]
    page_index.build_pages(t.orders.select("o_orderkey", "o_orderdate"), order, path, 1000)
    return text_dates(page_index.read_page(t.spark, path, order, 3, 100), "o_orderdate")
