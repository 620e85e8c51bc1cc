"""Aligned tokens of two vocabularies against whole texts given to both libraries."""

import bisect
import collections
import hashlib

import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as driver
from hemicycle.llm import alignment
from hemicycle.llm.queries import vocabulary

FOLDER = "/root/testdata/sf0.001"
A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def plain(texts):
    """Rows by document, from tokens of whole texts and all pairs of tokens that end together."""
    a_library = Tokenizer.from_file(A)
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(shown)))
    code = {c: b for b, c in letters.items()}
    rows, counts = [], collections.Counter()
    for i, text in texts:
        raw = (" " + (text or "")).encode()
        a = a_library.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_library.encode(text or "")
        bytes_a = [bytes(code[c] for c in a_library.id_to_token(t)) for t in a]
        pieces = [b_library.id_to_piece(t) for t in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b_library.is_byte(t) else p.replace("▁", " ").encode() for t, p in zip(b, pieces, strict=True)]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            rows.append((i, [], [], [], ""))
            continue
        ends_a, ends_b = list(_sums(bytes_a)), list(_sums(bytes_b))
        both = sorted(set(ends_a) & set(ends_b))
        groups = collections.defaultdict(lambda: ([], []))
        for side, tokens, ends in ((0, a, ends_a), (1, b, ends_b)):
            for token, end in zip(tokens, ends, strict=True):
                groups[bisect.bisect_left(both, end)][side].append(str(token))
        at_a, at_b = dict(zip(ends_a, a, strict=True)), dict(zip(ends_b, b, strict=True))
        links = [(at_a[e], at_b[e]) for e in both]
        counts.update(links)
        shown_groups = ";".join(f"{','.join(groups[g][0])}|{','.join(groups[g][1])}" for g in range(len(both)))
        rows.append((i, a, b, links, hashlib.sha256(shown_groups.encode()).hexdigest()))
    highest = collections.defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (i, len(a), len(b), len(links), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for i, a, b, links, digest in rows
    ]


def _sums(parts):
    total = 0
    for p in parts:
        total += len(p)
        yield total


def same(got, expected):
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_query(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = driver.queries()["op12_token_alignment"](spark, FOLDER)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    same([tuple(r) for r in got.collect()], plain(texts))


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a  b", "a▁b", "▁", "<|endoftext|> x <s> </s> <unk> <0x41>", "ﬁ ① \x00 \x1c \x85 z", "café 한국 \U0001f600 \U0001f468‍\U0001f469",
    "it's we'll I'd 'tis  x\t\ty \r\n\r\n z ", "aaaa" * 50, " x 　y  z", "12345 3.14 !!! ??", "näive İ ΣΑΣ", "x " * 300,
]


@pytest.mark.parametrize("frequent", [0, 3, 1 << 16])
def test_odd_texts(spark, frequent):
    rows = [(n if n % 5 else None, t, "k") for n, t in enumerate(ODD)] + [(1, "a", "k"), (1, "it's", "k")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, key string").withColumn("links", alignment.F.lit(1)).withColumn("n_a", alignment.F.lit(1))
    same([tuple(r) for r in alignment.aligned(docs, A, B, frequent).collect()], plain([r[:2] for r in rows]))
    assert alignment.aligned(docs.limit(0), A, B).collect() == []


def test_long_text():
    text = "".join(chr(0x4E00 + i * 7 % 5000) for i in range(300_000)) + " end" * 100_000
    (n_a, n_b, digest, links), none = alignment.aligner(A, B).documents([text, None])
    library = sentencepiece.SentencePieceProcessor(model_file=B)
    assert (n_b, len(digest)) == (len(library.encode(text)), 64) and none == (0, 0, "", []) and 100_000 <= len(links) <= n_a


def test_identity_map():
    of = alignment.aligner(A, B).of
    for a, b in enumerate(of.same.tolist()):
        assert b < 0 or of.bytes_a[a] == of.bytes_b[b] != b""
    assert of.bytes_b[of.same[of.bytes_a.index(b" the")]] == b" the" and (of.same >= 0).sum() > 10_000


def test_quick_encoder_and_cache(monkeypatch, spark):
    """Units by the quick encoder as by the library; a cache that is full all the time changes nothing."""
    align = alignment.Aligner(alignment.Vocabularies(A, B))
    assert align.of.quick is not None
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    units = sorted({u for t in texts for u in alignment.CUT.split(" " + t)} | {" don't", " !!", " é1½ª", " x²", " ſtʼn'S"})
    assert align.encode(units) == [e.ids for e in align.of.a.encode_batch(units, add_special_tokens=False)]
    expected = list(align.documents(texts))
    monkeypatch.setattr(alignment, "KEPT_UNITS", 500)
    monkeypatch.setattr(alignment, "BATCH", 300)
    assert list(alignment.Aligner(align.of).documents(texts)) == expected
