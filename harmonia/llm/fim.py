"""Operator 12: fill-in-the-middle documents, cut with a wavelet matrix over character classes.

A text is a sequence of code points, each in one of eight classes (letter,
digit, space, line feed, sentence end, other punctuation, control, other).
Its units end with a code point of given classes (lines: line feeds), the
last unit with the text.  The classes of a batch of texts are kept in one
wavelet matrix of three bit levels; a rank query counts a class before a
position, the ranks of the end classes add up to the number of boundaries,
and bisection on that number finds the position after any number of units,
for all texts of the batch at once.  Where the cuts fall is drawn from a
digest of the document's id, so a retried task draws the same.

``fill_in_middle`` puts the three parts into prefix-suffix-middle or
suffix-prefix-middle order behind sentinels, ``restore`` is its inverse.
Only the cuts are found in Python; parts, output and restored text are
DataFrame functions.

Cases: a null text counts as empty; an empty text, and one that contains a
sentinel, stays as it is (form ``plain``, lengths null); a null id draws like
an empty one; rows that repeat are each formed alike; other columns are passed
through and helper columns take free names; no rows: no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmonia.llm.common import fresh

OTHER, LETTER, DIGIT, SPACE, LINE_FEED, STOP, PUNCTUATION, CONTROL = range(8)
LEVELS = 3
#: Classes whose code points end a unit.
UNIT_ENDS = {"line": (LINE_FEED,), "sentence": (LINE_FEED, STOP), "word": (LINE_FEED, SPACE)}
SENTINELS = ("<P>", "<S>", "<M>")
#: Code points that share one wavelet matrix (a longer text has one of its own).
CHUNK = 1 << 22
#: Code points from here on are letters, but for the few classed below it.
CLASSED = 0x3100


def _class_of(c: str) -> int:
    kind = unicodedata.category(c)
    if c == "\n":
        return LINE_FEED
    if c in ".!?…。":
        return STOP
    if kind == "Zs" or c in "\t\v\f\r":
        return SPACE
    return {"L": LETTER, "N": DIGIT, "P": PUNCTUATION, "C": CONTROL}.get(kind[0], OTHER)


_CLASSES = np.array([_class_of(chr(i)) for i in range(CLASSED)] + [LETTER], np.uint8)


def class_codes(text: str) -> np.ndarray:
    """The class of every code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASSES[np.minimum(points, CLASSED)]


class WaveletMatrix:
    """Rank over a sequence of small codes: one bit vector a level, zeros moved before ones."""

    def __init__(self, codes: np.ndarray, levels: int = LEVELS):
        self.levels = []
        for shift in range(levels - 1, -1, -1):
            bit = (codes >> shift) & 1
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(codes) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            ones = bit.astype(bool)
            self.levels.append((shift, words, before, len(codes) - int(ones.sum())))
            codes = np.concatenate((codes[~ones], codes[ones]))

    def _follow(self, code: int, at: np.ndarray) -> np.ndarray:
        """Where the positions before which ``code`` is counted end up at the last level."""
        for shift, words, before, zeros in self.levels:
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(words[word] & low)
            at = zeros + ones if (code >> shift) & 1 else at - ones
        return at

    def rank(self, code: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Occurrences of ``code`` in ``start:stop``, for arrays of both."""
        return self._follow(code, stop) - self._follow(code, start)


class Units:
    """Boundaries of the units of several texts that share one wavelet matrix."""

    def __init__(self, texts: list[str], ends: tuple[int, ...]):
        codes = class_codes("".join(texts))
        stop = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.start, self.stop, self.ends = np.concatenate(([0], stop[:-1])), stop, ends
        self.matrix = WaveletMatrix(codes)
        full = self.stop > self.start
        last = codes[self.stop - 1] if len(codes) else np.zeros(len(texts), np.uint8)
        self.count = self.boundaries(self.stop) + (full & ~np.isin(last, ends))

    def boundaries(self, at: np.ndarray) -> np.ndarray:
        """Unit ends between each text's start and ``at``: the ranks of the end classes."""
        return sum(self.matrix.rank(c, self.start, at) for c in self.ends)

    def cut_after(self, k: np.ndarray) -> np.ndarray:
        """Length of each text's first ``k`` units, by bisection on the boundary count."""
        low, high = self.start.copy(), self.stop.copy()
        while (low < high).any():
            mid = (low + high) >> 1
            enough = self.boundaries(mid) >= k
            high = np.where(enough, mid, high)
            low = np.where(enough, low, np.minimum(mid + 1, high))
        return low - self.start


def _chunks(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def two_cuts(texts: list[str], h1: np.ndarray, h2: np.ndarray, ends: tuple[int, ...],
             limit: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text its number of units and the lengths before the first and the second cut."""
    found = []
    for i, j in _chunks(texts, limit):
        units = Units(texts[i:j], ends)
        a, b = h1[i:j] % (units.count + 1), h2[i:j] % (units.count + 1)
        found.append((units.count, units.cut_after(np.minimum(a, b)), units.cut_after(np.maximum(a, b))))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _cuts_udf(unit: str):
    ends = UNIT_ENDS[unit]

    @F.arrow_udf("struct<n: long, first: long, second: long>")
    def cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        n, a, b = two_cuts(text.to_pylist(), h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False), ends)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (n, a, b)], ["n", "first", "second"])

    return cuts


def _draw(doc_id: str, seed: int, k: int) -> Column:
    """The ``k``-th number (from 1) drawn for a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("bigint")


def _check(sentinels: tuple[str, str, str]) -> None:
    """Sentinels whose first character stands nowhere else in them cannot arise where parts meet."""
    first = {s[:1] for s in sentinels}
    if len(set(sentinels)) < 3 or "" in first or any(c in first for s in sentinels for c in s[1:]):
        raise ValueError("sentinels must differ and begin with a character that they hold nowhere else")


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "line", seed: int = 7,
                   fim_rate: int = 100, spm_rate: int = 50, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """All columns of ``docs`` plus ``n`` (units), ``form``, ``prefix_chars``,
    ``middle_chars`` and ``output``; columns of these names are replaced."""
    _check(sentinels)
    given, at = fresh(docs, "_text"), fresh(docs, "_cuts")
    whole = F.col(given)
    got = docs.withColumn(given, F.coalesce(F.col(text), F.lit("")))
    got = got.withColumn(at, _cuts_udf(unit)(whole, _draw(doc_id, seed, 1), _draw(doc_id, seed, 2)))
    n, first, second = (F.col(f"{at}.{x}") for x in ("n", "first", "second"))
    plain = (whole == "") | (F.pmod(_draw(doc_id, seed, 3), F.lit(100)) >= fim_rate)
    for s in sentinels:
        plain = plain | whole.contains(s)
    form = (F.when(plain, "plain").when(F.pmod(_draw(doc_id, seed, 4), F.lit(100)) < spm_rate, "spm").otherwise("psm"))
    p, s, m = (F.lit(x) for x in sentinels)
    prefix = F.substr(whole, F.lit(1), first.cast("int"))
    middle = F.substr(whole, first.cast("int") + 1, (second - first).cast("int"))
    suffix = F.substr(whole, second.cast("int") + 1)
    kind = fresh(docs, "_form")
    got = got.withColumn(kind, form)
    cut = F.col(kind) != "plain"
    output = (F.when(~cut, whole).when(F.col(kind) == "psm", F.concat(p, prefix, s, suffix, m, middle))
              .otherwise(F.concat(s, suffix, p, prefix, m, middle)))
    return (got.withColumns({"output": output, "n": n, "prefix_chars": F.when(cut, first),
                             "middle_chars": F.when(cut, second - first)})
            .withColumn("form", F.col(kind)).drop(given, at, kind))


def restore(formed: DataFrame, to: str = "restored", output: str = "output", form: str = "form",
            sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Adds ``to``: the text rebuilt from ``output`` and ``form`` alone."""
    _check(sentinels)
    p, s, m = (re.escape(x) for x in sentinels)
    out = F.col(output)
    text = (F.when(F.col(form) == "psm", F.regexp_replace(out, f"(?s)^{p}(.*?){s}(.*?){m}(.*)$", "$1$3$2"))
            .when(F.col(form) == "spm", F.regexp_replace(out, f"(?s)^{s}(.*?){p}(.*?){m}(.*)$", "$2$3$1"))
            .otherwise(out))
    return formed.withColumn(to, text)
