"""Operator 9: BPE encoding and decoding with a contiguous rank array per word.

A word is held as an array of part boundaries and an array with the rank of
each adjacent pair.  The smallest rank is found by a scan, its boundary is
deleted, and the two neighbouring ranks are refreshed, until no pair has a
rank.  Words are short, so scanning beats a heap.  Ids and decoded pieces of
recent words are kept in a bounded table.

The vocabulary file of a public tokenizer is a parameter: a byte-level BPE
with word ends, normalised by NFC, white space and lower case.

Cases: null or empty text: no tokens, empty decoding; repeated rows are
encoded alike; other columns are ignored; no rows: no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from harmonia.llm.common import LATIN_L, LATIN_N, LATIN_S, is_latin, sql_type

NO_RANK = 1 << 60
#: Words kept with their ids; the tables are emptied when they are full.
MAX_WORDS = 800_000
#: The file's word pattern for texts below U+0100.
LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_L}]+|[{LATIN_N}]|[^{LATIN_S}{LATIN_L}{LATIN_N}]+")


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes, as byte-level vocabularies write them."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + i)
    return [names[b] for b in range(256)]


class RankBPE:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        # a pair of part ids gives its rank and the id of the joined part, in one number
        self.pairs: dict[int, int] = {}
        for rank, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            self.pairs[self.ids[left] << 20 | self.ids[right]] = rank << 20 | self.ids[left + right]
        self.names = {i: t for t, i in self.ids.items()}
        self.decimal = {i: str(i) for i in self.names}
        letters = byte_alphabet()
        self.inner = [self.ids[x] for x in letters]
        self.last = [self.ids[x + self.end] for x in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        # the file's pattern, its white space class as Unicode defines it
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.said: dict[str, str] = {}   # word -> its pieces
        self.coded: dict[str, str] = {}  # word -> its decimal ids

    def merge(self, word: str) -> list[int]:
        """Ids of the parts of one word.

        Each boundary is held as the id of the part that it opens, next to
        the array of adjacent ranks.  The boundary inside the pair of the
        smallest rank is deleted until no pair has a rank.
        """
        data = word.encode()
        part = [self.inner[b] for b in data[:-1]]
        part.append(self.last[data[-1]])
        get = self.pairs.get
        ranks = [get(a << 20 | b, NO_RANK) for a, b in zip(part, part[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            part[i] = new = low & 0xFFFFF
            del part[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(new << 20 | part[i + 1], NO_RANK)
            if i:
                ranks[i - 1] = get(part[i - 1] << 20 | new, NO_RANK)
        return part

    def normal(self, text: str) -> str:
        """NFC and lower case, letter by letter (no context rules); the pattern skips white space."""
        text = unicodedata.normalize("NFC", text)
        if text.isascii():
            return text.lower()
        low = text.lower()
        # Python lowers a closing capital sigma by context, the vocabulary's normaliser does not
        return "".join(c.lower() for c in text) if "Σ" in text else low

    def learn(self, words: set[str]) -> None:
        """Put words into the tables."""
        if len(self.coded) >= MAX_WORDS:
            self.coded.clear()
            self.said.clear()
        for w in words.difference(self.coded):
            part = self.merge(w)
            self.coded[w] = " ".join(map(self.decimal.__getitem__, part))
            self.said[w] = " ".join(map(self.names.__getitem__, part))

    def encode(self, text: str) -> tuple[str, str, int]:
        """Ids joined by a space, decoded text, and number of tokens."""
        ids, said = [], []
        for piece in self.split_special.split(text) if "<|" in text else (text,):
            if piece in self.special:
                ids.append(str(self.special[piece]))
                said.append(piece)
                continue
            # up to U+00FF, NFC changes nothing and lower case stays in the range
            words = LATIN.findall(piece.lower()) if is_latin(piece) else self.pattern.findall(self.normal(piece))
            if words:
                self.learn(set(words))
                ids.append(" ".join(map(self.coded.__getitem__, words)))
                said.append(" ".join(map(self.said.__getitem__, words)))
        coded = " ".join(ids)
        return coded, " ".join(said), coded.count(" ") + 1 if coded else 0


@lru_cache(maxsize=2)
def load(path: str) -> RankBPE:
    """One encoder per worker process and file."""
    return RankBPE(path)


def encode_texts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (decimal, joined by a space) and ``decoded``."""
    return _run(docs, vocabulary, doc_id, text, "ids string, decoded string", lambda s: s)


def encode_digests(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode_texts`` with SHA-256 digests in place of the long strings."""
    return _run(docs, vocabulary, doc_id, text, "ids_sha256 string, decoded_sha256 string",
                lambda s: hashlib.sha256(s.encode()).hexdigest())


def _run(docs: DataFrame, vocabulary: str, doc_id: str, text: str, fields: str, shape) -> DataFrame:
    names = ["doc_id", "n_tokens", *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            n, ids, said = [], [], []
            for t in batch.column(1).to_pylist():
                a, b, k = bpe.encode(t or "")
                n.append(k)
                ids.append(shape(a))
                said.append(shape(b))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(said, pa.string())],
                names=names)

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {sql_type(docs, doc_id)}, n_tokens bigint, {fields}")
