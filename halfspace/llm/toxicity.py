"""Toxicity by a small convolutional network over hashed word embeddings, in numpy.

A word is the sum of the embeddings of its hashed features: the word itself and its
first characters, so that inflected forms of one stem share some. Filters of several
widths slide over the words, the largest response of each filter is kept, and a linear
layer turns these into a logit. Only buckets whose words differ in frequency between the
two labels have an embedding; all others are zero, so most windows give the same response
and only those that touch a known word are computed.

Thresholds are calibrated by language on labelled rows that were not fitted. The
language is told from the text's function words. A score is the logit, shifted so that
the language's threshold lands on ``DECISION``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfspace.llm.common import documents, labelled_sample, remainder, slices, steady_hash

DECISION = 0.7

# Rows fitted or calibrated on, of each label, at most.
MOST_LABELLED = 2000
# One labelled row in so many calibrates the thresholds instead of being fitted.
CALIBRATE_EVERY = 4

BUCKETS = 1 << 24
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 30
PREFIXES = (4, 5, 6)  # in bytes
# Standard errors by which a bucket's frequency must differ, and rows it must occur in.
LEAST_Z = 4.5
LEAST_ROWS = 3
# Rows of a label that a language needs for a threshold of its own.
LEAST_BY_LANGUAGE = 20
# Different words that a task remembers at a time.
MEMO = 200_000

WORD = re.compile(r"[^\W\d_]+")

# Common function words of some languages.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it was with as on are this by be from",
    "de": "der die das und ist nicht ein eine zu den mit dem auf für von sich des",
    "fr": "le les des et est une du dans qui pour sur pas avec au par plus ce",
    "es": "el los las una por con para del se no su al lo como más pero",
}
LANGUAGES = ["other", *FUNCTION_WORDS]
LANGUAGE_OF = {
    word: number
    for number, name in enumerate(LANGUAGES)
    if name in FUNCTION_WORDS
    for word in FUNCTION_WORDS[name].split()
}


def features(word: str) -> list[int]:
    """Hash buckets of a lower-case word: the whole word, and its first bytes."""
    data = word.encode()
    prefixes = [zlib.crc32(data[:n]) % BUCKETS for n in PREFIXES if len(data) >= n]
    return [zlib.crc32(data, 1) % BUCKETS, *prefixes]


@dataclass
class Network:
    """Weights, and thresholds on the logit by language number."""

    rows: dict[int, int]  # bucket -> row of the table; row 0 is the zero vector
    table: np.ndarray
    filters: list[np.ndarray]  # by width: (width, DIM, FILTERS)
    biases: list[np.ndarray]
    dense: np.ndarray
    bias: float
    thresholds: dict[int, float] = field(default_factory=dict)

    def token_rows(self, token: str) -> tuple[int, ...]:
        """Rows of the words in a token, which is text without white space."""
        found = {
            row
            for word in WORD.findall(token.lower())
            for bucket in features(word)
            if (row := self.rows.get(bucket, 0))
        }
        return tuple(sorted(found))


class Reader:
    """Turns texts into the windows that touch a known word; remembers tokens it has seen.

    Texts are cut at white space. What a token stands for, its kind, is the set of the
    table rows of its words; nearly all tokens are of kind 0, which has none.
    """

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.kinds: dict[tuple[int, ...], int] = {(): 0}
        self.known = np.zeros((0, self.network.table.shape[1]))

    def kind(self, token: str) -> int:
        return self.kinds.setdefault(self.network.token_rows(token), len(self.kinds))

    def read(self, text: str) -> tuple[list[np.ndarray], int]:
        """For each width the windows as kinds, the empty window first; the language."""
        tokens = text.split()
        memo = self.memo
        different = set(tokens)
        for token in different.difference(memo):
            memo[token] = self.kind(token)
        windows = [np.zeros((1, width), np.int32) for width in WIDTHS]
        if any(map(memo.__getitem__, different)):
            most = max(WIDTHS)
            kinds = np.zeros(len(tokens) + 2 * most, np.int32)
            kinds[most : most + len(tokens)] = [memo[t] for t in tokens]
            known = np.flatnonzero(kinds)
            for i, width in enumerate(WIDTHS):
                starts = np.unique((known[:, None] - np.arange(width)).ravel())
                found = kinds[starts[:, None] + np.arange(width)]
                windows[i] = np.concatenate([windows[i], found])
        votes = Counter(LANGUAGE_OF[t] for t in different & LANGUAGE_OF.keys())
        language = min(votes, key=lambda n: (-votes[n], n)) if votes else 0
        return windows, language

    def padded_rows(self, start: int = 0) -> np.ndarray:
        """The table rows of the kinds, padded with row 0."""
        kinds = list(self.kinds)[start:]
        width = max(1, *map(len, kinds), 1)
        return np.array([k + (0,) * (width - len(k)) for k in kinds], np.int32)

    def vectors(self) -> np.ndarray:
        """The kinds' vectors; those made since the last call are added."""
        if len(self.known) < len(self.kinds):
            new = self.network.table[self.padded_rows(len(self.known))].sum(axis=1)
            self.known = np.concatenate([self.known, new])
        return self.known


def _pooled(network, vectors, windows, starts):
    """Largest response of each filter in each text, and the window that gave it."""
    pooled, where = [], []
    for width, filters, bias, spans, at in zip(
        WIDTHS, network.filters, network.biases, windows, starts, strict=True
    ):
        out = bias + sum(vectors[spans[:, j]] @ filters[j] for j in range(width))
        best = np.maximum.reduceat(out, at, axis=0)
        owner = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(out))))
        hit_row, hit_filter = np.nonzero(out == best[owner])
        first = np.zeros(best.shape, np.int64)
        first[owner[hit_row[::-1]], hit_filter[::-1]] = hit_row[::-1]
        pooled.append(best)
        where.append(first)
    return pooled, where


def _joined(texts: list[list[np.ndarray]]):
    windows = [np.concatenate([t[i] for t in texts]) for i in range(len(WIDTHS))]
    starts = [
        np.cumsum([0, *[len(t[i]) for t in texts[:-1]]]) for i in range(len(WIDTHS))
    ]
    return windows, starts


def logits(network: Network, reader: Reader, texts: list[list[np.ndarray]]) -> np.ndarray:
    windows, starts = _joined(texts)
    pooled, _ = _pooled(network, reader.vectors(), windows, starts)
    return np.maximum(np.concatenate(pooled, axis=1), 0) @ network.dense + network.bias


def _fresh(sample: list[tuple[int, str, int]], seed: int) -> Network:
    """An untrained network: embeddings start from how buckets differ between the labels."""
    random = np.random.default_rng(seed)
    seen = [Counter(), Counter()]
    for _, text, label in sample:
        words = set(WORD.findall(text.lower()))
        seen[label].update({f for w in words for f in features(w)})
    n = [max(1, sum(label == v for _, _, label in sample)) for v in (0, 1)]
    rows, start = {}, [0.0]
    for bucket in sorted(seen[1]):
        in_bad, in_good = seen[1][bucket], seen[0][bucket]
        share = (in_bad + in_good + 1) / (n[0] + n[1] + 2)
        error = np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
        z = (in_bad / n[1] - in_good / n[0]) / max(error, 1e-9)
        if z >= LEAST_Z and in_bad >= LEAST_ROWS:
            rows[bucket] = len(start)
            start.append(min(z / 10, 3.0))
    table = random.normal(0, 0.05, (len(start), DIM))
    table[:, 0] = start
    table[0] = 0
    filters = [random.normal(0, 0.3, (w, DIM, FILTERS)) for w in WIDTHS]
    for bank in filters:
        bank[:, 0, : FILTERS // 2] = np.abs(bank[:, 0, : FILTERS // 2]) + 0.3
    biases = [np.zeros(FILTERS) for _ in WIDTHS]
    dense = random.normal(0, 0.1, FILTERS * len(WIDTHS))
    return Network(rows, table, filters, biases, dense, -1.0)


def _fit(network: Network, sample: list[tuple[int, str, int]], seed: int) -> None:
    """Adam on the weighted logistic loss; gradients flow to each filter's best window."""
    random = np.random.default_rng(seed)
    reader = Reader(network)
    texts = [reader.read(text)[0] for _, text, _ in sample]
    labels = np.array([label for *_, label in sample], float)
    weight = np.where(labels == 1, (1 - labels).sum() / max(1, labels.sum()), 1.0)
    rows = reader.padded_rows()
    values = [network.table, *network.filters, *network.biases, network.dense]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    step = 0
    for _ in range(EPOCHS):
        for chosen in np.array_split(random.permutation(len(texts)), max(1, len(texts) // 64)):
            vectors = network.table[rows].sum(axis=1)
            windows, starts = _joined([texts[i] for i in chosen])
            pooled, where = _pooled(network, vectors, windows, starts)
            hidden = np.concatenate(pooled, axis=1)
            logit = np.maximum(hidden, 0) @ network.dense + network.bias
            off = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[chosen]) * weight[chosen]
            off /= weight[chosen].sum()
            back = off[:, None] * network.dense * (hidden > 0)
            vector_grad = np.zeros_like(vectors)
            filter_grads, bias_grads = [], []
            for i, width in enumerate(WIDTHS):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                grad = np.zeros_like(network.filters[i])
                for j in range(width):
                    kinds = windows[i][where[i], j]  # (texts, filters)
                    grad[j] = np.einsum("tf,tfd->df", part, vectors[kinds])
                    pull = part[:, :, None] * network.filters[i][j].T[None]
                    np.add.at(vector_grad, kinds, pull)
                filter_grads.append(grad)
                bias_grads.append(part.sum(axis=0))
            table_grad = np.zeros_like(network.table)
            np.add.at(table_grad, rows, vector_grad[:, None, :])
            table_grad[0] = 0
            grads = [table_grad, *filter_grads, *bias_grads, off @ np.maximum(hidden, 0)]
            step += 1
            for value, grad, (first, second) in zip(values, grads, moments, strict=True):
                first += 0.1 * (grad - first)
                second += 0.001 * (grad * grad - second)
                scale = np.sqrt(second / (1 - 0.999**step)) + 1e-8
                value -= 0.01 * (first / (1 - 0.9**step)) / scale + 1e-5 * value
            network.bias -= 0.05 * float(off.sum())


def best_threshold(logit: np.ndarray, label: np.ndarray) -> float:
    """The threshold with the best F1. It lies in the middle of the gap between the
    rows on both sides."""
    order = np.argsort(-logit, kind="stable")
    logit, label = logit[order], label[order]
    hits = np.cumsum(label)
    f1 = 2 * hits / (np.arange(1, len(label) + 1) + label.sum())
    f1[:-1][logit[:-1] == logit[1:]] = -1  # a threshold can't part equal logits
    at = int(np.argmax(f1))
    if at + 1 < len(logit):
        return float(logit[at] + logit[at + 1]) / 2
    return float(logit[at]) - 1.0


def train(sample: list[tuple[int, str, int]], seed: int = 7) -> Network:
    """A network fitted to one part of (doc_id, text, label) rows, calibrated on the other.

    Without rows of both labels there is nothing to learn, and no text reaches the
    threshold.
    """
    fitted = [row for row in sample if steady_hash(row[0]) % CALIBRATE_EVERY]
    held = [row for row in sample if not steady_hash(row[0]) % CALIBRATE_EVERY]
    if len({label for *_, label in fitted}) < 2:
        network = _fresh([], seed)
        network.dense[:] = 0
        network.thresholds = {0: np.inf}
        return network
    network = _fresh(fitted, seed)
    _fit(network, fitted, seed)
    if len({label for *_, label in held}) < 2:
        held = fitted
    reader = Reader(network)
    texts, languages = zip(*(reader.read(text) for _, text, _ in held), strict=True)
    logit = logits(network, reader, list(texts))
    label = np.array([label for *_, label in held])
    languages = np.array(languages)
    network.thresholds = {0: best_threshold(logit, label)}
    for number in range(1, len(LANGUAGES)):
        mine = languages == number
        if min((label[mine] == 1).sum(), (label[mine] == 0).sum()) >= LEAST_BY_LANGUAGE:
            network.thresholds[number] = best_threshold(logit[mine], label[mine])
    return network


class Scorer:
    """Scores from 0 to 1 of texts; the decision for each language is at ``DECISION``."""

    def __init__(self, network: Network):
        self.network = network
        self.reader = Reader(network)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        if len(self.reader.memo) > MEMO:
            self.reader.forget()
        read, languages = zip(*(self.reader.read(t or "") for t in texts), strict=True)
        logit = logits(self.network, self.reader, list(read))
        thresholds = self.network.thresholds
        cut = np.array([thresholds.get(n, thresholds[0]) for n in languages])
        shifted = np.clip(logit - cut, -500, 500) + np.log(DECISION / (1 - DECISION))
        return 1 / (1 + np.exp(-shifted))


def learn(docs: DataFrame, labels: DataFrame, fit: Column, most: int = MOST_LABELLED) -> Network:
    """A network learned from at most ``most`` rows of each label, of those that meet ``fit``."""
    return train(labelled_sample(docs, labels, "toxic", fit, most))


def score(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id and score (0 to 1, higher for toxic) of each row's whole text.

    A NULL, empty or blank text has the score of a text without known words. Equal texts
    have equal scores. Other columns are ignored; an empty table gives an empty result.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network)
        for part in slices(batches, "text"):
            scores = scorer(part.column("text").to_pylist())
            yield pa.record_batch([part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, score double")


def keep_clean(docs: DataFrame, network: Network) -> DataFrame:
    """The rows of ``docs`` whose score is below the decision, with all their columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network)
        for part in slices(batches, "text"):
            yield part.filter(pa.array(scorer(part.column("text").to_pylist()) < DECISION))

    return docs.mapInArrow(rows, docs.schema)


def learnable() -> Column:
    """Rows that labels may be learned from; the others are held out."""
    return remainder("doc_id", 3) != 1


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    network = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learnable())
    return score(docs, network).select(
        "doc_id",
        (~learnable()).alias("held_out"),
        "score",
        (F.col("score") >= DECISION).cast("int").alias("predicted"),
    )
