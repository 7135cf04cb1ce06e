"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text's terms are its words (ASCII and Unicode letters lower-cased, hashed to
``WORD_TERMS`` rows) and its surface: the shape of each token (case, digits, runs of
punctuation), tokens that repeat the one before, and how often its tokens and lines occur
again. Counts are damped by a logarithm, weighted by inverse document frequency and
projected on the first ``dims`` singular vectors of the training sample's term matrix;
the vectors have length 1.

The model is fitted on the driver on a bounded sample: ``train_rows`` labelled documents of
each class in hash order of their ids, texts of up to ``train_chars`` characters. It is
the projection and the labelled vectors: at most 2 * ``train_rows`` * ``dims`` numbers,
which every task gets (a fixed bound, whatever the input).

Every whole text is scored: exact cosines with all labelled vectors, by blocked matrix
products in Arrow batches; the ``k`` nearest vote with their similarity to the power
``sharpness``, each class's votes weighted by its share of all labelled documents over its
share of the sample.

Rows: null and empty texts have no terms, so no neighbours; their score is 0. Repeated rows and null ids are scored like any other; extra columns are
ignored. An empty table gives an empty result; without labelled rows of both classes,
every text gets the share of good labels (1 if there are none).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import arrow_batch, text_slices, texts_of

WORD_TERMS, SHAPE_TERMS = 1024, 256
SURFACE = 40  # the last terms: repeats and shares
TERMS = WORD_TERMS + SHAPE_TERMS + SURFACE
DIMS, NEIGHBOURS, SHARPNESS = 48, 25, 4.0
TRAIN_ROWS, TRAIN_CHARS = 1000, 20_000
PREDICT_AT = 0.7
SURFACE_WEIGHT = 3.0
PUNCTUATION = ".,;:!?*#%&$\"'()[]{}<>|-_/\\"
SHAPE_CHARS = 12
CACHE_TOKENS = 300_000
BLOCK_DOCS = 1024
SLICE_CHARS = 1_500_000


def _case(letters: str) -> str:
    # a capital at the start of a word says little
    return "a" if letters.islower() or letters[1:].islower() else "A" if letters.isupper() else "Aa"


def _shape(token: str) -> str:
    """Case and kind of each run of characters: 'Word,' is 'a,', 'ABC!!' is 'A!!', 'ab12' is 'a0'."""
    body = token.rstrip(PUNCTUATION)
    if body.isalpha():
        return _case(body) + token[len(body):][:SHAPE_CHARS]
    out = ""
    for c in token:
        s = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if s not in "Aa0" or not out.endswith(s):
            out += s
        if len(out) == SHAPE_CHARS:
            break
    return out


def _hash(text: str, terms: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % terms


class Tokens(dict):
    """token -> number; each number has a word term, a shape term, and marks (ends in no
    letter, is upper case)."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, bool, bool]] = []

    def __missing__(self, token: str) -> int:
        self[token] = number = len(self)
        self.rows.append((_hash(token.strip(PUNCTUATION).lower(), WORD_TERMS), WORD_TERMS + _hash(_shape(token), SHAPE_TERMS),
                          not token[-1].isalpha(), token.isupper()))
        return number


class TermCounts:
    """Texts to damped term counts."""

    def __init__(self) -> None:
        self.tokens = Tokens()
        self.known = np.empty((4, 0), np.int64)

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        if len(self.tokens) > CACHE_TOKENS:
            self.__init__()  # type: ignore[misc]
        flat: list[str] = []
        lengths = np.empty(len(texts), np.int64)
        lines = np.zeros(len(texts))
        for i, t in enumerate(texts):
            found = t.split()
            lengths[i] = len(found)
            flat += found
            own = t.split("\n")
            lines[i] = 1 - len(set(own)) / len(own)
        at = np.fromiter(map(self.tokens.__getitem__, flat), np.int64, len(flat))
        if self.tokens.rows:
            self.known = np.concatenate([self.known, np.array(self.tokens.rows, np.int64).T], 1)
            self.tokens.rows = []
        word, shape, marked, upper = self.known[:, at]
        doc = np.repeat(np.arange(len(texts)), lengths)
        counts = np.bincount(np.concatenate([doc * TERMS + word, doc * TERMS + shape]), minlength=len(texts) * TERMS)
        counts = np.log1p(counts.reshape(len(texts), TERMS), dtype=np.float32)
        # Shares of tokens by what they are, each as one of a few grades, so that they are terms like others.
        n = np.maximum(lengths, 1)
        again = np.zeros(len(texts))
        if len(flat) > 1:
            same = (at[1:] == at[:-1]) & (doc[1:] == doc[:-1])
            again = np.bincount(doc[1:][same], minlength=len(texts)) / n
        pairs = np.unique(doc * (len(self.tokens) + 1) + at) if len(flat) else np.empty(0, np.int64)
        types = np.bincount(pairs // (len(self.tokens) + 1), minlength=len(texts)) / np.sqrt(n)  # steadier than types / tokens
        grades = [np.minimum(again * 8, 7), np.minimum(types / 2, 7), *(np.minimum(np.bincount(doc, x, len(texts)) / n * 8, 7) for x in (marked, upper)),
                  np.minimum(lines * 8, 7)]
        rows = np.flatnonzero(lengths)
        for g, values in enumerate(grades):
            counts[rows, WORD_TERMS + SHAPE_TERMS + 8 * g + values[rows].astype(int)] = SURFACE_WEIGHT
        return counts


@dataclass
class Model:
    project: np.ndarray  # TERMS x dims, with the inverse document frequencies
    vectors: np.ndarray  # labelled vectors
    good: np.ndarray  # their labels
    prior: float

    def embed(self, counts: np.ndarray) -> np.ndarray:
        v = counts @ self.project
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray, k: int = NEIGHBOURS, sharpness: float = SHARPNESS) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        out = np.empty(len(counts))
        share = self.good.mean()
        weight = np.where(self.good, self.prior / share, (1 - self.prior) / (1 - share)).astype(np.float32)
        for a in range(0, len(counts), BLOCK_DOCS):
            block = counts[a:a + BLOCK_DOCS]
            near = self.embed(block) @ self.vectors.T
            best = np.argpartition(-near, min(k, near.shape[1]) - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(near, best, 1), 0) ** sharpness * weight[best]
            total = votes.sum(1)
            good = (votes * self.good[best]).sum(1)
            out[a:a + BLOCK_DOCS] = np.where(block.any(1) & (total > 0), good / np.maximum(total, 1e-12), 0.0)
        return np.clip(out, 0.0, 1.0)


def fit(rows: Sequence[tuple[str, int]], prior: float | None = None, dims: int = DIMS) -> Model:
    """A model of (text, label) rows; ``prior`` is the share of good labels (default: in the rows)."""
    labels = np.array([bool(q) for _, q in rows], bool)
    if prior is None:
        prior = float(labels.mean()) if len(labels) else 1.0
    if not len(labels) or labels.all() or not labels.any():
        return Model(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels[:0], prior)
    count = TermCounts()
    x = np.concatenate([count(texts) for _, texts in text_slices([t for t, _ in rows], SLICE_CHARS)])
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    x = x * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    _, axes = np.linalg.eigh(x.T @ x)  # the term matrix's right singular vectors
    project = (idf[:, None] * axes[:, ::-1][:, :dims]).astype(np.float32)
    model = Model(project, np.zeros((0, dims), np.float32), labels, prior)
    model.vectors = np.concatenate([model.embed(count(texts)) for _, texts in text_slices([t for t, _ in rows], SLICE_CHARS)])
    return model


def training_sample(docs: DataFrame, labels: DataFrame, trained_on: Column, train_rows: int = TRAIN_ROWS, train_chars: int = TRAIN_CHARS) -> tuple[list[tuple[str, int]], float]:
    """At most about ``train_rows`` (text, label) rows of each class, in hash order, and the
    share of good labels among all."""
    known = labels.where(trained_on & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    if not counts:
        return [], 1.0
    order = F.pmod(F.xxhash64("doc_id"), F.lit(2**30))
    share = F.coalesce(*[F.when(F.col("quality") == q, F.lit(min(2**30, 2**30 * train_rows // n + 1))) for q, n in sorted(counts.items())])
    few = (known.withColumn("_order", order).where(F.col("_order") <= share)
           .orderBy("_order", "doc_id", "quality").limit(2 * train_rows * len(counts)))
    sample = (docs.select("doc_id", "text").where(F.char_length("text") <= train_chars).join(F.broadcast(few), "doc_id")
              .orderBy("_order", "doc_id", "quality", "text").limit(2 * train_rows * len(counts)))
    return [(r.text, r.quality) for r in sample.collect()], counts.get(1, 0) / sum(counts.values())


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and score."""
    schema = pa.schema([("score", pa.float64())])
    fields = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TermCounts()
        for batch in batches:
            for at, texts in text_slices(texts_of(batch.column(len(keep))), SLICE_CHARS):
                new = [model.score(count(texts[a:a + BLOCK_DOCS])) for a in range(0, len(texts), BLOCK_DOCS)]
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *arrow_batch({"score": np.concatenate(new)}, schema).columns], names=[*keep, "score"])

    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "score double"])
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, types)
