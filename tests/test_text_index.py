"""The inverted index against a scan."""

import pytest

from conftest import rows
from hemicycle.operators import text_index
from hemicycle.operators.filters import search_text

TITLES = [
    (1, "A bill to amend the Tax Code"), (2, "the TAX act"), (3, "To"), (4, "t"), (5, ""), (6, None), (7, "Étude İstanbul 한국어"), (8, "100% [a.b] _x_\0y"),
    (9, "aaaaaa"), (10, "line\nbreak \U0001f600\U0001f601!"), (9, "another title of nine"), (None, "a title without a key"), *[(100 + i, f"resolution number {i} of the House") for i in range(60)],
]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    titles = spark.createDataFrame([(*t, "x") for t in TITLES], "id long, title string, key string")
    text_index.build_index(titles, "id", "title", path)
    return titles, path


@pytest.mark.parametrize("term", ["tax", "TAX C", "the", "to", "T", "", "zzz", "tax zzz", "étude i", "국어", "% [A.B]", "_X", "aaaa", "aaaaaaa", "title", "number 5", "x_\0", "q", "59", "E\nB", "\U0001f600\U0001f601!", "\U0001f601"])
def test_same_rows_as_a_scan(index, term):
    titles, path = index
    # A row without a key is in no index.
    keyed = titles.filter("id is not null")
    assert rows(text_index.search_index(keyed, "id", "title", term, path)) == rows(search_text(keyed, "title", term))


def test_lookups_are_pushed_to_the_postings(spark, index, monkeypatch):
    titles, path = index

    def plan(term):
        return text_index.search_index(titles, "id", "title", term, path)._jdf.queryExecution().executedPlan().toString()

    assert "In(gram" in plan("number 59") and "StringStartsWith(gram" in plan("q")
    assert "postings" not in plan("zzz") and "gram" not in plan("resolution")
    monkeypatch.setattr(text_index, "COMMON", 1.0)
    assert "In(gram" in plan("resolution")
    assert rows(text_index.search_index(titles, "id", "title", "resolution", path)) == rows(search_text(titles, "title", "resolution"))


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "id long, title string")
    text_index.build_index(none, "id", "title", str(tmp_path))
    assert [text_index.search_index(none, "id", "title", t, str(tmp_path)).collect() for t in ("", "a", "abc")] == [[], [], []]
