"""Operator 6: line-first quality rules.

Every line of a text is judged first: closing punctuation, navigation and
boilerplate.  Failing lines are removed and the document is rejected if
too large a share of its visible characters went with them.  Base counts
over the whole text (words, symbols, repeated lines and word windows) are
returned beside the verdict.

Cases: null or empty text has no words, so it fails the base rule; blank
lines are kept and count nothing; repeated rows are judged alike; other
columns are ignored; no rows: no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from harmonia.llm.common import sql_type

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIX = np.uint64(0x9E3779B97F4A7C15)
ODD = np.random.default_rng(8).integers(0, 2**63, WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)
#: Characters that may close a sentence, and closers that may follow them.
ENDS = ".!?…:;。！？"
CLOSERS = "\"'”’»)]"
BOILERPLATE = re.compile(
    r"cookie|privacy policy|terms of (?:use|service)|all rights reserved|©|\(c\) ?(?:19|20)\d\d|copyright"
    r"|subscribe (?:now|to)|sign (?:in|up)|log ?in\b|click here|read more|share (?:on|this)|javascript|lorem ipsum"
    r"|skip to (?:content|main)|back to top|licensed under|permission is hereby granted")
DOUBLED = re.compile(r"[!?]{2,}(?:\s|$)")
LETTERS = re.compile(r"[^\W\d_]+")
BARS = "|»>•·"
NAVIGATION = re.compile(r"(?:\S[^|»>•·]{0,30}\s[|»>•·]\s){2,}")
MENU = frozenset(("home", "menu", "search", "contact", "about", "about us", "next", "previous", "login"))


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the document's rejection."""

    max_unclosed_words: int = 6      # a line without closing punctuation needs more words than this
    max_boilerplate_words: int = 40  # longer lines are prose that mentions such a phrase
    min_letter_share: float = 0.3    # of the visible characters of a line
    max_symbol_share: float = 0.1    # symbols among the visible characters of a line
    max_doubled_share: float = 0.5   # words that close with doubled punctuation
    max_removed_share: float = 0.5   # of the document's visible characters


def line_fault(line: str, rules: LineRules) -> str | None:
    """Name of the first rule that the line breaks, or None."""
    s = line.strip(SPACES)
    if not s:
        return None
    n = len(s.split())
    if n <= rules.max_boilerplate_words and BOILERPLATE.search(s.lower()):
        return "boilerplate"
    if n <= 3 and s.lower() in MENU or any(map(s.__contains__, BARS)) and NAVIGATION.search(s):
        return "navigation"
    if n <= rules.max_unclosed_words and s.rstrip(CLOSERS)[-1:] not in ENDS:
        return "punctuation"
    if sum(map(s.count, SYMBOLS)) > rules.max_symbol_share * len(s) or \
            sum(map(len, LETTERS.findall(s))) < rules.min_letter_share * len(s):
        return "punctuation"
    if ("!!" in s or "??" in s) and len(DOUBLED.findall(s)) > max(2, rules.max_doubled_share * n):
        return "punctuation"
    return None


def clean_lines(text: str, rules: LineRules) -> tuple[str, int, int]:
    """The text without failing lines, visible characters removed and in all."""
    kept, gone, total = [], 0, 0
    for line in text.split("\n"):
        size = len(line.strip(SPACES))
        total += size
        if size and line_fault(line, rules):
            gone += size
        else:
            kept.append(line)
    return "\n".join(kept), gone, total


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur at least twice.

    Windows get exact ranks by doubling: ranks of adjacent halves are paired
    and ranked again, so equal ranks mean equal windows.
    """
    if len(words) <= size:
        return 0
    names: dict[bytes, int] = {}
    rank = np.fromiter(map(names.setdefault, words, range(len(words))), np.int64, len(words))
    if len(names) == len(words):
        return 0
    # equal windows have equal sums, so distinct sums rule repeats out
    mixed = (rank.astype(np.uint64) + np.uint64(1)) * MIX
    mixed ^= mixed >> np.uint64(29)
    count = len(words) - size + 1
    sums = np.sort(sum(mixed[i:i + count] * ODD[i] for i in range(size)))
    if (sums[1:] != sums[:-1]).all():
        return 0
    step = 1
    while step < size:
        pair = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1]
        step *= 2
    often = np.bincount(rank)[rank] > 1
    if not often.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = text.encode().split()  # bytes split on exactly space and 9 to 13
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


FIELDS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, n_removed_chars bigint, cleaned string")


def line_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 rules: LineRules = LineRules()) -> DataFrame:
    """``doc_id``, the base counts, both verdicts, and the cleaned text."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for t in batch.column(1).to_pylist():
                n, *rest = measures(t or "")
                cleaned, gone, total = clean_lines(t or "", rules)
                failed = n < 20 or 100 * rest[-1] > 30 * n
                row = (n, *rest, failed, not failed and gone <= rules.max_removed_share * total, gone, cleaned)
                for col, v in zip(out, row):
                    col.append(v)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["doc_id", *(f.split()[0] for f in FIELDS.split(", "))])

    return docs.select(doc_id, text).mapInArrow(judge, f"doc_id {sql_type(docs, doc_id)}, {FIELDS}")
