"""BPE encoding by longest matches with backtracking, and decoding from an offset table.

A sequence of tokens is what the merges give exactly if every two neighbours are compatible: applied
to the two texts side by side, no merge reaches across the boundary before both are complete. So the
encoder takes the longest token that is compatible with the one before, shorter ones if need be, and
steps back where none is; places that failed are not tried again, which keeps it linear. An
Aho-Corasick automaton gives the longest token at every place of a word in one pass.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.common import CACHE_ENTRIES, small_batches

#: Letters of a piece or word that a cache may hold.
LONGEST = 64

#: Characters that str.split cuts at but the tokenizer does not.
_ODD_SPACES = regex.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"\p{White_Space}+")
_NEVER = 1 << 40


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    letters |= {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Encoder:
    """Encoder and decoder of a tokenizer file: byte-level BPE whose words end in a marked letter."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab = model["vocab"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not self.end or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError("not a tokenizer of the kind this encoder is for")
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        # A word is a string of symbols: one for each byte, another one for each byte at its end.
        letters = byte_letters()
        self.inner = [chr(b) for b in range(256)]
        self.last = [chr(256 + b) for b in range(256)]
        text: dict[int, str] = {}
        for b, letter in enumerate(letters):
            text[vocab[letter]], text[vocab[letter + self.end]] = self.inner[b], self.last[b]
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.parts.setdefault(c, (a, b))
            self.joined[a, b] = c
            text[c] = text[a] + text[b]
        if any(c <= max(p) for c, p in self.parts.items()) or len(self.joined) != len(self.parts):
            raise ValueError("token numbers must be in the order of the merges")
        self.size = {i: len(t) for i, t in text.items()}
        self.number = {t: i for i, t in text.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        # A token that the merges do not give from its own text never appears; it is left out.
        lost = [i for i, (a, b) in self.parts.items() if not self._whole(a, b, i)]
        for i in lost:
            del self.number[text[i]]
        self.text = text
        self.automaton = ahocorasick.Automaton()
        for t, i in self.number.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.cache: dict[str, bytes] = {}
        self.chunks = Chunks(self)
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        shown = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.offsets = np.cumsum([0, *map(len, shown)])
        self.blob = np.frombuffer(b"".join(shown), np.uint8)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at an edge of ``token`` while it is built, each with the merge that ends it."""
        found, until = [(token, _NEVER)], token
        while token in self.parts:
            until, token = token, self.parts[token][side]
            found.append((token, until))
        return found

    def _meets(self, one: int, two: int, before: int = _NEVER) -> bool:
        """Whether a merge reaches across the boundary of two tokens earlier than ``before``.

        Of two equal merges side by side the left one comes first.
        """
        for a, a_ends in self._edge(one, 1):
            for b, b_ends in self._edge(two, 0):
                rank = self.joined.get((a, b))
                if rank is not None and rank < a_ends and rank <= b_ends and rank < before:
                    return True
        return False

    def _whole(self, a: int, b: int, token: int) -> bool:
        return not self._meets(a, b, token)

    def compatible(self, one: int, two: int) -> bool:
        known = self.fits.get((one, two))
        if known is None:
            if len(self.fits) >= 4 * CACHE_ENTRIES:
                self.fits.clear()
            known = self.fits[one, two] = not self._meets(one, two)
        return known

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper prefix; -1 if there is none."""
        found = self.shorter.get(token)
        if found is None:
            text = self.text[token]
            found = next((self.number[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.number), -1)
            self.shorter[token] = found
        return found

    def encode_symbols(self, symbols: str) -> list[int]:
        whole = self.number.get(symbols)
        if whole is not None:
            return [whole]
        longest = [-1] * len(symbols)
        size = self.size
        for end, token in self.automaton.iter(symbols):
            longest[end + 1 - size[token]] = token  # ends come in order, so the longest is last
        tokens: list[int] = []
        dead = bytearray(len(symbols) + 1)
        at, token = 0, longest[0]
        while True:
            while token >= 0:
                after = at + size[token]
                if not dead[after] and (not tokens or self.compatible(tokens[-1], token)):
                    break
                token = self._shorter(token)
            if token >= 0:
                tokens.append(token)
                at = after
                if at == len(symbols):
                    return tokens
                token = longest[at]
            else:
                if not tokens:
                    raise ValueError("the vocabulary cannot spell a word")
                dead[at] = 1
                token = tokens.pop()
                at -= size[token]

    def encode_word(self, word: str) -> bytes:
        """Token numbers of a normalised word as little-endian 32-bit integers."""
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            raw = word.encode()
            inner = self.inner
            symbols = "".join([inner[b] for b in raw[:-1]]) + self.last[raw[-1]]
            found = np.array(self.encode_symbols(symbols), "<u4").tobytes()
            if len(word) <= LONGEST:
                self.cache[word] = found
        return found

    def encode_plain(self, text: str) -> bytes:
        chunks = _SPACES.split(text) if _ODD_SPACES.search(text) else text.split()
        return b"".join(map(self.chunks.__getitem__, chunks))

    def encode(self, text: str) -> np.ndarray:
        """Token numbers of a whole text; special strings in it are special tokens."""
        if self.cut_special and any(s in text for s in self.special):
            special = self.special
            pieces = self.cut_special(text)
            raw = b"".join(np.array([special[p]], "<u4").tobytes() if p in special else self.encode_plain(p) for p in pieces)
        else:
            raw = self.encode_plain(text)
        return np.frombuffer(raw, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts joined by one blank, each found by its offset."""
        out = []
        for i in range(0, len(ids), 1 << 18):
            begin = self.offsets[ids[i : i + (1 << 18)]]
            size = self.offsets[ids[i : i + (1 << 18)].astype(np.int64) + 1] - begin
            heads = np.cumsum(size) - size
            out.append(self.blob[np.arange(int(size.sum())) + np.repeat(begin - heads, size)].tobytes())
        return b"".join(out)[:-1]


class Chunks(dict):
    """Tokens of the pieces between white space, kept until the cache is full."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        # Letter by letter: a capital sigma at a word's end is no special case for the tokenizer.
        plain = (chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)).replace("Σ", "σ").lower()
        value = b"".join(map(self.encoder.encode_word, self.encoder.words(plain)))
        if len(chunk) <= LONGEST:
            self[chunk] = value
        return value


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def digests(path: str):
    """A column function of a text: number of tokens, SHA-256 of the ids and of the decoded text."""
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf("struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>")
    def run(texts: pa.Array) -> pa.Array:
        bpe, rows = encoder(path), []
        for text in texts.to_pylist():
            ids = bpe.encode(text or "")
            rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
        return pa.array([dict(zip(("n_tokens", "ids_sha256", "decoded_sha256"), r, strict=True)) for r in rows], kind)

    return run


def encode_column(path: str):
    """A column function of a text: its token ids."""

    @F.arrow_udf("array<long>")
    def run(texts: pa.Array) -> pa.Array:
        bpe = encoder(path)
        return pa.array([bpe.encode(t or "").astype(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))

    return run


def decode_column(path: str):
    """A column function of token ids: the decoded text."""

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        bpe = encoder(path)
        return pa.array([bpe.decode(np.array(i or [], np.uint32)).decode() for i in ids.to_pylist()], pa.string())

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for each row of ``docs`` (``doc_id``, ``text``).

    Null and empty texts have no tokens. An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    return docs.select("doc_id", digests(path)("text").alias("found")).select("doc_id", "found.*")
