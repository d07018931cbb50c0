"""Operator 5: language identification with error-correcting output codes.

Every language gets a codeword; one binary logistic classifier per bit
predicts it from hashed byte n-grams of the lower-cased letters.  Decoding
sums the classifiers' losses over the bits of each codeword, each bit
weighted by its accuracy in training, and takes the nearest codeword; a
small lead over the second nearest marks the text as ambiguous.

Fit: on the at most ``max_train`` labelled rows with the smallest hashes of
their ids; a language that is not among them cannot be predicted.  The model
(``DIMS`` by bits) does not grow with the data.  Prediction reads whole
texts and only the text.

Cases: null text or text without a letter: ``und``, score 0, not ambiguous;
null labels are not learnt from; no labelled rows: everything is ``und``;
repeated rows are predicted alike; other columns are ignored; no rows: no
rows.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmonia.llm.common import sql_type, tidy

#: Hashed n-gram counts per text.
DIMS = 4096
GRAMS = (2, 3, 4)
MAX_TRAIN = 3000
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Texts are turned into counts in runs of about this many bytes.
RUN_BYTES = 1 << 21


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: the id's CRC-32 modulo 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def letters_only(text: str) -> str:
    """Lower-cased words of letters, with a space around each; empty if there is none."""
    words = LETTERS.findall(text.lower())
    words = words if text.isascii() else [w for w in words if any(map(str.isalpha, w))]
    return f" {' '.join(words)} " if words else ""


def counts(texts: list[str]) -> np.ndarray:
    """Rows of normalised square roots of hashed n-gram counts."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode(), np.uint8).astype(np.uint32)
        if len(b) < max(GRAMS):
            b = np.pad(b, (0, max(GRAMS) - len(b)), constant_values=32)
        code, total = b, None
        for n in range(2, max(GRAMS) + 1):
            code = code[:-1] * np.uint32(0x01000193) + b[n - 1:]
            if n in GRAMS:
                h = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - (DIMS.bit_length() - 1))
                got = np.bincount(h, minlength=DIMS)
                total = got if total is None else total + got
        row = np.sqrt(total, dtype=np.float32)
        out[i] = row / np.linalg.norm(row)
    return out


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n rows of +1/-1: all splits of up to 5 languages, else the best of many random codes."""
    if n <= 1:
        return np.ones((n, 1), np.float32)
    if n <= 5:
        bits = (np.arange(1, 2 ** (n - 1))[None, :] >> np.arange(n - 1)[:, None]) & 1
        return np.vstack([bits, np.zeros((1, bits.shape[1]), int)]).astype(np.float32) * 2 - 1
    rng, size = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, far = None, -1
    for _ in range(300):
        m = rng.choice(np.array([-1, 1], np.float32), (n, size))
        d = ((size - m @ m.T) / 2 + size * np.eye(n)).min()
        if d > far and (np.abs(m.sum(0)) < n).all():
            best, far = m, d
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray      # languages x bits
    weights: np.ndarray   # DIMS x bits
    bias: np.ndarray
    trust: np.ndarray     # weight of each bit's loss

    def losses(self, x: np.ndarray) -> np.ndarray:
        f = x @ self.weights + self.bias
        return (np.logaddexp(0, -f[:, None, :] * self.code[None]) * self.trust).sum(2)

    def decide(self, x: np.ndarray, lead: float) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (share of the language among exp(-loss)), ambiguous."""
        p = np.exp(-self.losses(x))
        p /= p.sum(1, keepdims=True)
        top = np.sort(p, 1)[:, ::-1]
        second = top[:, 1] if p.shape[1] > 1 else 0.0
        return [self.langs[i] for i in p.argmax(1)], top[:, 0], top[:, 0] - second < lead


def train(x: np.ndarray, labels: list[str], rounds: int = 120, rate: float = 0.3, decay: float = 1e-5) -> Model | None:
    """Logistic classifiers of all bits at once, by Adam on the whole sample."""
    langs = sorted(set(labels))
    if not langs:
        return None
    code = codewords(len(langs))
    want = code[[langs.index(v) for v in labels]]
    w, b = np.zeros((DIMS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, b)]
    for t in range(1, rounds + 1):
        pull = -want / (1 + np.exp(want * (x @ w + b))) / len(x)
        for v, g, s in zip((w, b), (x.T @ pull + decay * w, pull.sum(0)), state):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.999 * s[1] + 0.001 * g * g
            v -= rate * (s[0] / (1 - 0.9 ** t)) / (np.sqrt(s[1] / (1 - 0.999 ** t)) + 1e-8)
    right = ((x @ w + b) * want > 0).mean(0)
    trust = np.clip(2 * right - 1, 0.05, 1)
    return Model(langs, code, w, b, (trust / trust.mean()).astype(np.float32))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        max_train: int = MAX_TRAIN) -> Model | None:
    """Train on a bounded sample: the rows with the smallest id hashes that are not held out."""
    usable = docs.filter(~held_out(F.col(doc_id)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rank = F.xxhash64(F.col(doc_id).cast("string"), F.lit("fit"))
    ids = usable.select(rank.alias("h")).orderBy("h").limit(max_train).agg(F.max("h")).first()[0]
    if ids is None:
        return None

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [letters_only(t) for t in batch.column(0).to_pylist()]
            rows = [r.astype(np.float16).tobytes() if t else None for t, r in zip(texts, counts(texts))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1), batch.column(2)],
                                             names=["x", "lang", "h"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        got = pa.Table.from_batches(got).sort_by([("h", "ascending"), ("lang", "ascending")])
        x = np.empty((got.num_rows, DIMS), np.float32)
        for i, v in enumerate(got.column("x")):
            x[i] = np.frombuffer(v.as_buffer(), np.float16)
        labels = got.column("lang").to_pylist()
        del got
        m = train(x, labels)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((m.langs, m.code, m.weights, m.bias, m.trust))])], names=["model"])

    # the bounded sample meets in one task, which trains; the driver gets the model alone
    got = (usable.filter(rank <= ids).select(F.col(text).alias("t"), F.col(lang).cast("string").alias("lang"), rank.alias("h"))
           .mapInArrow(tidy(features), "x binary, lang string, h bigint").filter("x is not null").limit(max_train).coalesce(1)
           .mapInArrow(tidy(learn), "model binary").first())
    return None if got is None else Model(*pickle.loads(got["model"]))


def _predict(model: Model | None, texts: list[str | None], lead: float) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and ambiguity of texts, in runs of bounded size."""
    plain = [letters_only(t) if t and model else "" for t in texts]
    said, score, vague = [UNDETERMINED] * len(plain), [0.0] * len(plain), [False] * len(plain)
    known = [i for i, t in enumerate(plain) if t]
    at = 0
    while at < len(known):
        end, size = at, 0
        while end < len(known) and size < RUN_BYTES and end - at < 256:
            size += len(plain[known[end]])
            end += 1
        got = model.decide(counts([plain[i] for i in known[at:end]]), lead)
        for i, a, b, c in zip(known[at:end], *got):
            said[i], score[i], vague[i] = a, float(b), bool(c)
        at = end
    return said, score, vague


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text",
             lead: float = 0.2) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row, from whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, score, vague = _predict(model, batch.column(1).to_pylist(), lead)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(said, pa.string()), pa.array(score, pa.float64()), pa.array(vague, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(doc_id, text).mapInArrow(
        tidy(run), f"doc_id {sql_type(docs, doc_id)}, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame, model: Model | None, text: str = "text", min_score: float = 0.3,
                    lead: float = 0.2) -> DataFrame:
    """The rows of ``docs`` with a language: not ``und``, and not both ambiguous and below ``min_score``."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, score, vague = _predict(model, batch.column(at).to_pylist(), lead)
            yield batch.filter(pa.array([a != UNDETERMINED and not (c and b < min_score)
                                         for a, b, c in zip(said, score, vague)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
