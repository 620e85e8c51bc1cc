"""Every operator against a plain version, and on nulls, empty texts, repeated rows and empty tables."""

import collections
import hashlib
import html
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from hemicycle.llm import bpe, fingerprints, html_text, minhash, mixing, nearest, quality, queries, sharding, substrings, token_counts
from hemicycle.llm.common import WordHashes, components, word_hashes
from parity.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, rank int, bands string"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def found(spark, name):
    return {r[0]: r for r in driver.queries()[name](spark, FOLDER).collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with the operators' names."""
    long = " ".join(f"w{i % 977}" for i in range(20_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 3), (4, "One two", "en", "a", 7),
        (5, "one TWO", "en", "b", 7), (6, long, "de", None, len(long)), (7, long, None, "b", len(long)),
        (8, "x " * 200, "en", "b", 400), (8, "x " * 200, "en", "b", 400), (None, "one two", "fr", "a", 7), (None, None, None, None, None),
    ]
    return spark.createDataFrame([(*r, "k", 1, "b") for r in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_long_words_are_not_kept():
    cache = WordHashes()
    hashes, counts = word_hashes([b"x" * 5_000_000 + b" y", b"y"], cache)
    assert list(cache) == [b"y"] and counts.tolist() == [2, 1] and hashes[1] == hashes[2] != hashes[0]


def test_near_duplicates(spark, texts):
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    got = found(spark, "op1_minhash_near_dedup")
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def test_blocks_find_every_link_that_stars_leave(spark, monkeypatch):
    """A chain: each text is alike to the next only; blocks of two sets."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[12 * i : 12 * i + 150])) for i in range(20)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_substrings(spark, texts):
    seen = collections.Counter()
    words = {i: t.encode().split() for i, t in texts.items()}
    for w in words.values():
        seen.update(tuple(w[j : j + 35]) for j in range(len(w) - 34))
    got = found(spark, "op2_substring_dedup")
    for i, w in words.items():
        cut = {p for j in range(len(w) - 34) if seen[tuple(w[j : j + 35])] > 1 for p in range(j, j + 35)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in cut)
        assert tuple(got[i])[1:] == (len(w), len(cut), hashlib.sha256(kept).hexdigest())


def plain_removed(rows, k=35):
    """Words, removed words and digest of the rest of each ``(id, text)``."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = collections.Counter(tuple(w[j : j + k]) for _, w in split for j in range(len(w) - k + 1))
    out = []
    for i, w in split:
        edges = np.zeros(len(w) + 1, int)
        for j in range(len(w) - k + 1):
            if seen[tuple(w[j : j + k])] > 1:
                edges[j] += 1
                edges[j + k] -= 1
        cut = np.cumsum(edges)[: len(w)] > 0
        kept = b" ".join(x for x, c in zip(w, cut, strict=True) if not c)
        out.append((i, len(w), int(cut.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(docs, **more):
    return sorted(map(tuple, substrings.remove_repeats(docs, **more).select("doc.doc_id", "n_words", "n_removed", "sha256").collect()), key=str)


@pytest.mark.parametrize("limit", [0, 256])
def test_substrings_of_crowded_minimisers(spark, odd, limit):
    """A passage between words that differ everywhere: its windows share a minimiser in many distinct super-k-mers."""
    assert removed(odd, limit=limit) == plain_removed([(r.doc_id, r.text) for r in odd.collect()])
    draw = np.random.default_rng(4)

    def words(n):
        return " ".join(f"u{x}" for x in draw.integers(0, 10**9, n))

    passage, line = words(60), words(30)
    rows = [(i, f"{words(40)} {passage} {words(20)} {line} {words(40)}") for i in range(30)]
    rows += [(100 + i, f"{words(1)} {line} {words(5)} {line} {words(3)}") for i in range(20)] + [(200 + i, rows[3][1]) for i in range(10)]
    # Near copies: one word of each differs.
    base = words(150).split()
    rows += [(300 + i, " ".join([*base[: 4 * i], f"x{i}", *base[4 * i + 1 :]])) for i in range(30)]
    rows += [(400 + i, "again " * (30 + i)) for i in range(20)] + [(500, f"{line} {line} {line}")]
    got = removed(spark.createDataFrame(rows, "doc_id long, text string"), limit=limit)
    assert got == plain_removed(rows) and sum(r[2] for r in got) > 4000


def test_fingerprints(spark, texts):
    got = found(spark, "op3_fingerprints")
    ids = sorted(texts)
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[j][:half]
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert row.fingerprint == fingerprints.shown(fingerprints.signature(texts[i].encode()))
        assert row.edited_fingerprint == fingerprints.shown(fingerprints.signature(edited.encode()))
    close = [abs(r.near_edited - 1 / 3) for i, r in got.items() if len(texts[i]) > 1000]
    assert np.mean(close) < 0.1


def test_fingerprint_likeness_is_that_of_the_sets(spark, texts):
    """Both likeness columns against the exact likeness of sets of nine bytes: 64 draws err by 0.0625 at most on average."""
    ids = sorted(texts)
    sets = {}

    def parts(text):
        raw = text.encode()
        if raw not in sets:
            sets[raw] = {raw[i : i + 9] for i in range(len(raw) - 8)} or {raw}
        return sets[raw]

    def likeness(a, b):
        return len(parts(a) & parts(b)) / len(parts(a) | parts(b))

    got, errors = found(spark, "op3_fingerprints"), {"edited": [], "next": []}
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[j][:half]
        errors["edited"].append(got[i].near_edited - likeness(texts[i], edited))
        errors["next"].append(got[i].near_next - likeness(texts[i], texts[j]))
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].fingerprint == got[j].fingerprint) or texts[i] != texts[j]
    for found_errors in errors.values():
        assert np.abs(found_errors).max() < 0.3 and np.abs(found_errors).mean() < 0.07 and abs(np.mean(found_errors)) < 0.02


def test_alike_texts(spark):
    rows = [(1, "a b c d e f g h " * 9), (2, "a b c d e f g h " * 9 + "x"), (3, "something else altogether"), (4, None), (5, "")]
    got = dict(fingerprints.alike(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


@pytest.mark.parametrize("one_bucket", [False, True])
def test_alike_texts_by_brute_force(spark, monkeypatch, one_bucket):
    """Texts that all share half of their words, in groups; with one bucket its first text links to one group only."""

    def banded(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[1]] * batch.num_rows, pa.list_(pa.int64()))], [batch.schema.names[0], "bands"])

    if one_bucket:
        monkeypatch.setattr(fingerprints, "_banded", banded)
    draw = np.random.default_rng(5)

    def words(n):
        return " ".join(map(str, draw.integers(1000, 9999, n)))

    common = words(120)
    rows = []
    for group in range(40):
        own = words(45)
        rows += [(1000 * k + group, f"{common} {own} {words(4)}") for k in range(3)]
    rows += [rows[7], (9000, rows[7][1]), (rows[3][0], "another text of the id"), (9001, "another text of the id"), (None, common)]
    sets = [(i, set(fingerprints.shingles(t.encode()).tolist())) for i, t in rows if i is not None]
    label = {i: i for i, _ in sets}
    for i, x in sets:
        for j, y in sets:
            if i < j and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert len(set(label.values())) == 40
    got = fingerprints.alike(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {r.doc_id: r.class_id for r in got} == {**label, None: None}


def test_queries_with_sql(spark):
    duck = connect(FOLDER)
    for name in ("op4_top_scores", "op9_mixing"):
        assert differences(driver.queries()[name](spark, FOLDER), duck, driver.oracle_sql()[name]) == []


def test_top_scores_odd(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD", 3)
    monkeypatch.setattr(nearest, "LEAF", 1)
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [-1.0, 0.5]), (None, [9.0, 9.0])]
    got = nearest.top_scores(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), top=2).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2, 65536), (0, 2, 3, 65536), (50, 1, 0, 65536), (50, 2, 2, 65536)]
    assert nearest.top_scores(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_top_scores_of_large_components(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD", 3)
    monkeypatch.setattr(nearest, "LEAF", 1)
    draw = np.random.default_rng(8)
    rows = [(i, [float(x) for x in draw.normal(size=5)]) for i in range(60)]
    rows += [(60, [40000.0, 1.0, 0.5, 0.0, 3.0]), (61, [0.0, 1e6 + 0.25, 7e5, 0.0, -2e6]), (62, [0.0, 1e6, 7e5, 1.0, -2e6]), (100, [3e5, 1e6, 1e6, 1.0, 1e5 + 1 / 3]), (150, [0.0] * 5)]
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    expected = []
    for q in (i for i in whole if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        expected += [(q, rank, i, -score) for rank, (score, i) in enumerate(scores[:5], 1)]
    got = nearest.top_scores(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    big = np.array([[2.0**70, 3.0], [2.0**40 + 1, 2.0**21 + 1]])
    assert nearest.products(big, np.array([[0.0, 5.0], [0.0, 2.0**33 + 1]])).tolist() == [[15, 3 * (2**33 + 1)], [5 * (2**21 + 1), (2**21 + 1) * (2**33 + 1)]]
    with pytest.raises(ValueError):
        nearest.products(big, np.array([[1.0, 0.0]]))


def test_token_counts(spark, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    got = found(spark, "op5_token_counts")
    for i, t in texts.items():
        n = len(library.encode(t))
        assert tuple(got[i])[1:] == (len(t.encode()), n, n > 4096)
    lengths = token_counts.Lengths(queries.vocabulary("piece_bpe_32k.model"), {})
    for t in ("", " ", "a ", "a  b\n\n c \n", "▁▁x ▁", "\x00é한😀\t"):
        assert sum(map(lengths.__getitem__, token_counts.pre_tokens(t))) == len(library.encode(t))


def test_quality(spark):
    got = found(spark, "op6_quality")
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    right = [r.predicted == known[i] for i, r in got.items() if i in known and r.held_out]
    assert np.mean(right) > 0.9


def plain_bpe(library, i, text):
    """Row of op7 by the library."""
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    mine = bpe.encoder(queries.vocabulary("word_bpe_49k.json"))
    more = ["", "  ", "</w>", "aaaa" * 99, "It's <|endoftext|>İΣ ΣΑΣ\x1cß é\x00 한😀", "<|ENDOFTEXT|> 12 3!?.", "thththe"]
    for t in [*texts.values(), *more]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert mine.encode(t).tolist() == ids
        assert mine.decode(np.array(ids, np.uint32)).decode() == library.decode(ids, skip_special_tokens=False)
    expected = sorted(plain_bpe(library, i, t) for i, t in texts.items())
    assert sorted(tuple(r)[:4] for r in found(spark, "op7_bpe_roundtrip").values()) == expected


def test_shards(spark, texts):
    got = driver.queries()["op8_hilbert_shards"](spark, FOLDER).collect()
    counts = collections.Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode())) for r in got)
    cells = np.arange(4**6)
    coords = np.array([(cells >> (4 * i)) & 15 for i in range(3)])
    order = np.argsort(sharding.hilbert_places(coords, 4))
    assert (np.abs(np.diff(coords[:, order], axis=1)).sum(axis=0) == 1).all()


def test_mixing_keeps_words_near_targets(spark):
    rows = [(i, "w " * (i % 9 + 1), f"s{i % 4}" if i % 5 else None) for i in range(2000)]
    got = mixing.mixed_rows(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, targets, source = collections.Counter(), {}, {r[0]: r[2] for r in rows}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
        assert r.taken <= 3 * r["size"]
    assert len(targets) == 5 and all(abs(taken[s] - target) <= 20 for s, target in targets.items())


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><header class="site-header">Site</header>
<div id="cookie-notice">We use cookies</div><div class="layout"><div class="post"><h2>Big &amp; small</h2><p>First <b>bold</b>
 text&nbsp;here, which is long enough to count as content of a page.<p>Second one, also long enough to be the content &lt;here&gt;.
<script>var a = "</p>";</script><form><input name=q>Search</form><ul><li>One item of the text<li>Two items of the text</ul></div>
<div class="comments"><p>I do not agree at all with this article, said a reader.</p></div></div>
<aside class="sidebar"><p>Popular now</p></aside><footer>&copy; us</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "Big & small First bold text here, which is long enough to count as content of a page. "
        "Second one, also long enough to be the content <here>. One item of the text Two items of the text"
    )
    assert [html_text.main_text(x) for x in (None, "", "<", "<p", "</div>", "<!-- x", "<script>a")] == ["", "", "<", "", "", "", ""]
    assert html_text.main_text("<div>" * 5000 + "deep words" + "</div>" * 5000) == "deep words"


LONG = "<p>A paragraph that is long enough to count as the content of this page.</p>"


@pytest.mark.parametrize("name", ["wrapper no-sidebar", "container with-sidebar", "page has-side-nav", "sidebar-layout", "nav form"])
def test_main_text_in_named_wrappers(name):
    plain = "T " + " ".join([re.sub("<.*?>", "", LONG)] * 3)
    around = '<nav><a href="/">Home</a></nav><div class="{}">{}<div class="sidebar">Side <a href="/x">x</a></div></div><div class="ad">Buy</div>'
    for inner in (f"<article><h1>T</h1>{LONG * 3}</article>", f"<main><h1>T</h1>{LONG * 3}</main>", f"<div><h1>T</h1>{LONG * 3}</div>"):
        assert html_text.main_text(f"<body>{around.format(name, inner)}</body>") == plain
    comments = f'<section id="comments"><article class="comment">{LONG * 9}</article></section>'
    assert html_text.main_text(f"<body><article><h1>T</h1>{LONG * 3}</article>{comments}</body>") == plain


def test_main_text_keeps_slugs():
    page = f"""<body><article><h1>T</h1>{LONG}<section id="discussion"><h2 id="related-work">Related work</h2>{LONG}</section>
    <p id="search-results">Found</p><div class="share">Share it</div></article></body>"""
    plain = re.sub("<.*?>", "", LONG)
    assert html_text.main_text(page) == f"T {plain} Related work {plain} Found"


@pytest.mark.parametrize("page", [
    "<div>" * 200_000 + "deep words" + "</div>" * 200_000, "<b>" * 50_000 + "<div>x</div>" * 50_000,
    "<p><li>" + "<b>" * 50_000 + "<div>y</div><li>" * 50_000, "</i>" * 200_000 + "z", "<article>" * 50_000 + "q",
], ids=["deep", "inline", "items", "ends", "articles"])
def test_main_text_takes_linear_time(page):
    start = time.process_time()
    assert html_text.main_text(page)
    assert time.process_time() - start < 20


def test_main_text_keeps_what_a_word_may_be_about():
    """Within an article a weak name drops forms, links and what is no prose; clear names still drop."""
    text = "<p>Some long text of the article that is here for good.</p>"
    parts = {
        '<p class="social">A paragraph on social policy</p>': "A paragraph on social policy",
        '<div class="search">Search theory is a field of study.</div>': "Search theory is a field of study.",
        '<div class="share">Share it</div>': "", '<div class="related"><a href="/x">Another article that you may like to read</a></div>': "",
        '<div class="search"><form><input></form>Search this whole site for anything you like</div>': "",
        '<div class="notice">This site keeps small files to give you the best of it.</div>': "",
        '<div class="ad">Buy our new product while it is on offer in your town.</div>': "",
        '<div class="comments"><p>I do not agree at all with this article, said a reader.</p></div>': "",
    }
    for part, kept in parts.items():
        got = html_text.main_text(f"<body><article>{text}{part}</article></body>")
        assert got == f"Some long text of the article that is here for good. {kept}".strip()


def test_main_text_of_broken_and_unknown_tags():
    assert html_text.main_text('<body><p>hello world text</p><a "…') == "hello world text"
    assert html_text.main_text('<body><p>one <b class="x>two</b> three</p><p>four</p>') == "one two three four"
    assert html_text.main_text("<body><p>foo<my-tag>bar</my-tag>baz</p><x-app><div>one</div><div>two</div></x-app>").startswith("foobarbaz")
    assert html_text.main_text("<table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul>") == "a b c d e"


def test_main_text_of_parts():
    def part(name, n=5, size=400):
        return "".join(f"<p>{(name + str(i) + ' word' * size)[:size]}</p>" for i in range(n))

    def plain(*parts):
        return " ".join(re.sub("<.*?>", " ", "".join(parts)).split())

    menu = "<div>" + "".join(f'<a href="/{i}">Entry {i}</a> ' for i in range(9)) + "</div>"
    parts = [part("a"), part("b"), part("c", 9, 80)]
    for tag in ("section", 'div class="part"', "article", 'article class="post"'):
        cut = [f"<{tag}><h2>H</h2>{x}</{tag.split()[0]}>" for x in parts]
        for around in ("<body>{}{}</body>", '<body>{}<div class="wrap">{}</div></body>', "<body>{}<main>{}</main></body>"):
            assert html_text.main_text(around.format(menu, "".join(cut))) == plain(*cut)
    cut = [f"<section>{x}</section>" for x in parts]
    assert html_text.main_text(f'<body>{menu}<div class="wrap"><h1>T</h1>{"<p>Short.</p>".join(cut)}</div></body>') == plain("<h1>T</h1>", "<p>Short.</p>".join(cut))
    far = f'<div><div><section>{parts[0]}</section></div>{menu}<div><div>{parts[1]}</div></div></div>'
    assert html_text.main_text(f"<body>{menu}{far}</body>") == plain(parts[0], parts[1])
    inline = html_text.main_text(f"<body><span>{'bold text here ' * 40}</span><div>{parts[0]}</div><a href=x>x</a></body>")
    assert inline == plain("bold text here " * 40, parts[0])


def test_main_text_of_pages(spark):
    for page in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        text = html_text.main_text(page.html)
        plain = re.search(r"<article>(.*?)</article>", page.html, re.S)
        assert bool(text) == bool(plain and re.sub(r"<[^>]*>", "", plain[1]).strip())
        assert "track(" not in text and "©" not in text and "<b>" not in text


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7)], "a long, b long")
    got = dict(components(edges, "test").collect())
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}


@pytest.mark.parametrize("name", ["near", "cut", "prints", "tokens", "quality", "bpe", "shards", "mix", "mixed"])
def test_odd_and_empty_tables(spark, odd, none, name):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    run = {
        "near": minhash.near_duplicates, "cut": substrings.remove_repeats, "prints": fingerprints.edited_fingerprints,
        "tokens": lambda d: token_counts.count_tokens(d, queries.vocabulary("piece_bpe_32k.model")),
        "quality": lambda d: quality.scored(d, labels), "bpe": lambda d: bpe.encoded(d, queries.vocabulary("word_bpe_49k.json")),
        "shards": sharding.shard_documents, "mix": mixing.mixed_rows, "mixed": mixing.mixed_documents,
    }[name]
    assert run(none).collect() == []
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = run(odd)
    if name == "mixed":
        assert got.columns == odd.columns and {(r.doc_id, r.text) for r in got.collect()} <= set(rows)
        return
    found = got.collect()
    assert len(found) == len(rows)
    if name == "near":
        expected = {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (977, 6), 7: (977, 6), 8: (1, 8)}
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
        assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    elif name == "cut":
        assert sorted(((r.doc.doc_id, r.n_words, r.n_removed, r.sha256) for r in found), key=str) == plain_removed(rows)
    elif name == "prints":
        assert sorted(((r.doc_id, r.n_chars) for r in found), key=str) == sorted(((i, len(t or "")) for i, t in rows), key=str)
        by_id = {r.doc_id: r.fingerprint for r in found}
        assert by_id[6] == by_id[7] != by_id[8] and by_id[1] == by_id[2]
    elif name == "tokens":
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
        expected = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in rows]
        assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    elif name == "quality":
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
        assert len({r.score for r in found if r.doc_id in (6, 7)}) == 1
    elif name == "bpe":
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
        assert sorted((tuple(r)[:4] for r in found), key=str) == sorted((plain_bpe(library, i, t) for i, t in rows), key=str)
    elif name == "shards":
        assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in found), key=str) == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    else:
        assert sorted((r.doc_id or 0, r["size"]) for r in found) == sorted((i or 0, len((t or "").split())) for i, t in rows)
        assert all(0 <= r.taken <= 3 * r["size"] for r in found)


def test_stages_keep_columns(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == odd.columns and [t for _, t in docs.dtypes] == [t for _, t in odd.dtypes]
            docs.collect()


def test_pipeline(spark):
    assert driver.queries()["pipeline"](spark, FOLDER).count() > 0


def plain_scores(texts, labels):
    """Scores of the discriminant by covariances, determinants and solved systems."""
    x = {i: np.array(quality.statistics(t.encode())) for i, t in texts.items()}
    rows = {k: np.array([x[i] for i, q in labels.items() if q == k and i in x and zlib.crc32(str(i).encode()) % 4 != 2]) for k in (0, 1)}
    cov = {k: np.cov(v.T, bias=True) for k, v in rows.items()}
    n = {k: len(v) for k, v in rows.items()}
    both = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    odds = {i: np.log((n[1] + 1) / (n[0] + 1)) for i in x}
    for k, sign in ((0, -1), (1, 1)):
        c = 0.8 * cov[k] + 0.2 * both
        c = 0.9 * c + np.diag(0.1 * np.diag(c) + 1e-4 + 1e-3 * np.diag(both))
        for i, v in x.items():
            d = v - rows[k].mean(axis=0)
            odds[i] += sign * -0.5 * (np.linalg.slogdet(c)[1] + d @ np.linalg.solve(c, d))
    return {i: 1 / (1 + np.exp(-np.clip(o, -50, 50))) for i, o in odds.items()}


def test_quality_scores(spark, texts):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    scores = plain_scores(texts, labels)
    got = found(spark, "op6_quality")
    assert set(got) == set(scores) and all(abs(got[i].score - v) < 1e-9 and got[i].predicted == (v >= 0.7) for i, v in scores.items())


def test_pipeline_by_brute_force(spark):
    """All five stages in plain Python; every row of run() with its count of copies."""
    from tokenizers import Tokenizer

    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    scores = plain_scores({i: r.text for i, r in docs.items()}, labels)
    good = sorted(i for i in docs if scores[i] >= 0.7)
    sets = {}
    for i in good:
        w = docs[i].text.encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in good}
    for n, i in enumerate(good):
        for j in good[n + 1 :]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    words = {i: docs[i].text.encode().split() for i in good if label[i] == i}
    seen = collections.Counter(tuple(w[j : j + 35]) for w in words.values() for j in range(len(w) - 34))
    left = {}
    for i, w in words.items():
        cut = {p for j in range(len(w) - 34) if seen[tuple(w[j : j + 35])] > 1 for p in range(j, j + 35)}
        left[i] = b" ".join(x for p, x in enumerate(w) if p not in cut).decode() if cut else docs[i].text
    size = {i: len(t.encode().split()) for i, t in left.items()}
    names = sorted({docs[i].source for i in left})
    own = {s: sum(size[i] for i in left if docs[i].source == s) for s in names}
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    order = sorted(names, key=lambda s: (3 * own[s] / weight[s], names.index(s)))
    levels = [(sum(own.values()) - sum(3 * own[o] for o in order[:n])) / sum(weight[o] for o in order[n:]) for n in range(len(order))]
    level = max(v for s, v in zip(order, levels, strict=True) if v * weight[s] <= 3 * own[s])
    library = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    expected = collections.Counter()
    for s in names:
        rate = min(float(3 * own[s]), level * weight[s]) / own[s]
        shift = int(hashlib.md5(b"s" + s.encode()).hexdigest()[:6], 16) / (1 << 24)
        for at, i in enumerate(sorted((i for i in left if docs[i].source == s), key=lambda i: (size[i], i))):
            copies = min(3, int((at + 1) * rate + shift) - int(at * rate + shift))
            if copies:
                ids = library.encode(left[i], add_special_tokens=False).ids
                expected[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()] = copies
    assert 0 < len(left) < len(good) < len(docs)
    assert collections.Counter(tuple(r)[:3] for r in corpus_pipeline.run(spark, FOLDER).collect()) == expected


def test_main_text_is_that_of_the_article(spark):
    for page in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)
        plain = html.unescape(re.sub(r"<(script|style|form)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ", article[1], flags=re.S)) if article else ""
        assert "".join(html_text.main_text(page.html).split()) == "".join(plain.split())
        spaced = re.sub(r"</?(a|b|i|em|strong|span|code|sup|sub|u|small)\b[^>]*>", "", re.sub(r"<(script|style|form)\b.*?</\1>|<!--.*?-->", "", article[1] if article else "", flags=re.S))
        assert html_text.main_text(page.html) == " ".join(html.unescape(re.sub("<[^>]*>", " ", spaced)).split())


def test_main_text_of_odd_tables(spark):
    """Nulls, empty pages, repeated rows, and columns with the operator's names."""
    page = f"<body><article><h1>T</h1>{LONG}</article></body>"
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (2, None, ""), (3, "v", "plain"), (4, "w", "<p>" * 3 + "x" * 300_000)]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extracted(docs).collect()), key=str)
    plain = {page: "T " + re.sub("<.*?>", "", LONG), "plain": "plain", rows[5][2]: "x" * 300_000}
    assert got == sorted(((i, u, plain.get(h, ""), len(plain.get(h, ""))) for i, u, h in rows), key=str)
    assert html_text.extracted(docs.limit(0)).collect() == []
