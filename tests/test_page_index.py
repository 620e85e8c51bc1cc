"""Pages by stored ranges against sorted pages."""

import pytest
from pyspark.sql import functions as F

from hemicycle.operators import page_index
from hemicycle.operators.paging import page

def order():
    return [F.desc_nulls_last("day"), F.asc_nulls_first("id")]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    # A third of all rows share a day, others have none.
    rows = spark.range(500).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "2023-01-01").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("2022-"), F.lpad(F.col("id"), 4, "0"))).alias("day")
    )
    rows = rows.repartition(5, "id")
    page_index.build_pages(rows, order(), path, 60)
    return rows, path


def test_every_page(spark, pages):
    rows, path = pages
    whole = [tuple(r) for r in rows.orderBy(*order()).collect()]
    assert len(page_index.ranges_of(spark, path)) >= 5 and page_index.page_count(spark, path, 45) == 12
    for number in range(1, 14):
        got = [tuple(r) for r in page_index.read_page(spark, path, order(), number, 45).collect()]
        assert got == whole[45 * (number - 1) : 45 * number]
    for number in (1, 4):
        ours, theirs = page_index.read_page(spark, path, order(), number, 100, compat=True), page(rows, order(), number, 100, compat=True)
        assert ours.collect() == theirs.collect()


def test_a_page_reads_its_ranges_only(spark, pages):
    _, path = pages
    plan = page_index.read_page(spark, path, order(), 9, 20)
    assert 1 <= len({f.split("__range=")[1].split("/")[0] for f in plan.inputFiles()}) and "PartitionFilters: [__range" in plan._jdf.queryExecution().executedPlan().toString()
    scanned = spark.read.parquet(f"{path}/rows").filter(F.col("__range").isin([r for r, a, b in page_index.ranges_of(spark, path) if a < 180 and b > 160])).count()
    assert scanned < 200


def test_empty_table(spark, tmp_path):
    page_index.build_pages(spark.createDataFrame([], "id long, day string"), order(), str(tmp_path))
    got = page_index.read_page(spark, str(tmp_path), order(), 1, 10)
    assert got.collect() == [] and got.columns == ["id", "day"]
    assert page_index.ranges_of(spark, str(tmp_path)) == [] and page_index.page_count(spark, str(tmp_path), 10) == 1
