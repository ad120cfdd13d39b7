"""Document quality by a linear-chain conditional random field over lines.

Each line with a word is labelled good or bad, from its own features, those of the lines
before and after it, and the label of its neighbours. Labels are known for documents
only, so lines start with their document's label; then lines of bad documents that the
model takes for good are relabelled, and it is fitted again. A document's quality is the
forward-backward probability of good, averaged over its lines by their length. The cut on
it is chosen on labelled rows that were not fitted, and lands on ``DECISION``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfspace.llm.common import documents, labelled_sample, remainder, slices, steady_hash

DECISION = 0.7

# Rows fitted or calibrated on, of each label, at most.
MOST_LABELLED = 1500
CALIBRATE_EVERY = 4
# Lines of a chain that is fitted; longer documents give several. Scoring has no limit.
FIT_LINES = 64
ROUNDS = 3
STEPS = 120
# How fast a score falls off around the cut.
STEEPNESS = 12.0

# Kinds of byte: other (letters of any script), upper case, digit, white space, symbol,
# bar, sentence mark, exclamation.
KINDS = 8
KIND = np.zeros(256, np.uint8)
KIND[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
KIND[list(b"0123456789")] = 2
KIND[list(b" \t\n\x0b\x0c\r")] = 3
KIND[list(b"#*$%&<>{}[]=\\^~_@+/")] = 4
KIND[list(b"|")] = 5
KIND[list(b".,;:?()'\"-")] = 6
KIND[list(b"!")] = 7

# Own features of a line; with those of both neighbours and whether they exist.
OWN = 13
WIDTH = 3 * OWN + 3


def lines_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Own features of each line with a word, and the lines' lengths in bytes."""
    rows, lengths = [], []
    seen: set[bytes] = set()
    for line in (text or "").encode().split(b"\n"):
        words = line.split()
        if not words:
            continue
        n, size = len(words), len(line)
        kinds = np.bincount(KIND[np.frombuffer(line, np.uint8)], minlength=KINDS)
        inked = size - kinds[3]
        repeats = sum(map(bytes.__eq__, words, words[1:]))
        rows.append(
            (
                kinds[1] / inked,
                kinds[2] / inked,
                kinds[4] / inked,
                kinds[5] / inked,
                kinds[6] / inked,
                kinds[7] / inked,
                np.log1p(n),
                inked / n / 10,
                len(set(words)) / n,
                repeats / n,
                line in seen,
                line.rstrip()[-1:] in b".!?",
                n <= 2,
            )
        )
        lengths.append(size)
        seen.add(line)
    return np.array(rows, float).reshape(-1, OWN), np.array(lengths, float)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """A line's features, those of the line before and after it, and a constant."""
    none = np.zeros((1, OWN))
    there = np.ones(len(own))
    before = np.concatenate([none, own[:-1]])
    after = np.concatenate([own[1:], none])
    first, last = there.copy(), there.copy()
    first[:1] = 0
    last[-1:] = 0
    return np.column_stack([own, before, after, first, last, there])


@dataclass
class Field:
    """A trained field: standardisation, weights of good against bad, transitions, cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray  # from (bad, good) to (bad, good)
    cut: float = 0.5

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -6, 6) @ self.weights

    def good(self, emissions: np.ndarray) -> np.ndarray:
        """Probability of good for each line of one chain, by forward-backward."""
        ratio = np.exp(np.clip(emissions, -30, 30)).tolist()
        (bb, bg), (gb, gg) = np.exp(self.transitions).tolist()
        n = len(ratio)
        ahead, p = [0.0] * n, ratio[0] / (1 + ratio[0]) if n else 0.0
        for i in range(n):
            if i:
                good, bad = (p * gg + (1 - p) * bg) * ratio[i], p * gb + (1 - p) * bb
                p = good / (good + bad)
            ahead[i] = p
        out, back_good, back_bad = [0.0] * n, 1.0, 1.0
        for i in range(n - 1, -1, -1):
            p = ahead[i]
            good, bad = p * back_good, (1 - p) * back_bad
            out[i] = good / (good + bad)
            r = ratio[i] * back_good
            back_good, back_bad = gg * r + gb * back_bad, bg * r + bb * back_bad
            total = back_good + back_bad
            back_good, back_bad = back_good / total, back_bad / total
        return np.array(out)

    def share(self, text: str | None) -> float:
        """The probability of good, averaged over lines by length; 0 without lines."""
        own, lengths = lines_of(text)
        if not len(own):
            return 0.0
        return float(self.good(self.emissions(with_neighbours(own))) @ lengths / lengths.sum())

    def score(self, text: str | None) -> float:
        shifted = STEEPNESS * (self.share(text) - self.cut) + np.log(DECISION / (1 - DECISION))
        return float(1 / (1 + np.exp(-shifted)))


def _posteriors(emissions: np.ndarray, there: np.ndarray, transitions: np.ndarray):
    """Of padded chains at once: probability of good, and expected transitions."""
    n, most = emissions.shape
    ratio = np.exp(np.clip(emissions, -30, 30))
    move = np.exp(transitions)
    ahead = np.zeros((most, n, 2))
    for i in range(most):
        prior = ahead[i - 1] @ move if i else np.full((n, 2), 0.5)
        now = prior * np.stack([np.ones(n), ratio[:, i]], axis=1)
        ahead[i] = now / now.sum(axis=1, keepdims=True)
    good = np.zeros((n, most))
    pairs = np.zeros((2, 2))
    back = np.ones((n, 2))
    for i in range(most - 1, -1, -1):
        on = there[:, i]
        both = ahead[i] * back
        good[:, i] = np.where(on, both[:, 1] / both.sum(axis=1), 0)
        local = np.stack([np.ones(n), ratio[:, i]], axis=1) * back
        if i:
            pair = ahead[i - 1][:, :, None] * move[None] * local[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            pairs += pair[on].sum(axis=0)
        earlier = local @ move.T
        back = np.where(on[:, None], earlier / earlier.sum(axis=1, keepdims=True), back)
    return good, pairs


def _fit(field: Field, features: np.ndarray, there: np.ndarray, labels: np.ndarray) -> None:
    """Adam on the log-likelihood of the line labels; chains are padded rows."""
    x = np.clip((features - field.mean) / field.scale, -6, 6) * there[:, :, None]
    linked = there[:, 1:]
    counts = np.zeros((2, 2))
    np.add.at(counts, (labels[:, :-1][linked], labels[:, 1:][linked]), 1)
    total = there.sum()
    values = [field.weights, field.transitions]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    # Both labels weigh the same, whatever their shares.
    share = np.clip((labels * there).sum() / total, 0.02, 0.98)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) * there
    for step in range(1, STEPS + 1):
        good, pairs = _posteriors(x @ field.weights, there, field.transitions)
        off = (labels - good) * weight
        grads = [
            np.einsum("nt,ntd->d", off, x) / total - 0.002 * field.weights,
            (counts - pairs) / total - 0.01 * field.transitions,
        ]
        for value, grad, (first, second) in zip(values, grads, moments, strict=True):
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            scale = np.sqrt(second / (1 - 0.99**step)) + 1e-8
            value += 0.05 * (first / (1 - 0.9**step)) / scale


def _chains(rows: list[np.ndarray], docs: list[int]):
    """Padded chains of at most ``FIT_LINES`` lines, and each chain's document."""
    cut = [
        (doc, r[i : i + FIT_LINES])
        for doc, r in zip(docs, rows, strict=True)
        for i in range(0, len(r), FIT_LINES)
    ]
    most = max(len(r) for _, r in cut)
    features = np.zeros((len(cut), most, rows[0].shape[1]))
    there = np.zeros((len(cut), most), bool)
    for i, (_, r) in enumerate(cut):
        features[i, : len(r)] = r
        there[i, : len(r)] = True
    return features, there, np.array([doc for doc, _ in cut])


def best_cut(shares: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the best balanced accuracy, in the middle of its gap."""
    values = np.unique(shares)
    cuts = np.concatenate([[values[0] - 0.01], (values[1:] + values[:-1]) / 2])
    good, bad = np.sort(shares[labels == 1]), np.sort(shares[labels == 0])
    kept = 1 - np.searchsorted(good, cuts) / len(good)
    caught = np.searchsorted(bad, cuts) / len(bad)
    return float(cuts[np.argmax(kept + caught)])


def train(sample: list[tuple[int, str, int]]) -> Field:
    """A field fitted to one part of (doc_id, text, label) rows, its cut chosen on the other.

    Without rows of both labels there is nothing to learn, and every text is good.
    """
    rows = [(key, lines_of(text)[0], label) for key, text, label in sample]
    rows = [(key, with_neighbours(own), label) for key, own, label in rows if len(own)]
    fitted = [row for row in rows if steady_hash(row[0]) % CALIBRATE_EVERY]
    field = Field(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), np.zeros((2, 2)), -1.0)
    if len({label for *_, label in fitted}) < 2:
        return field
    every = np.concatenate([features for _, features, _ in fitted])
    field.mean, field.scale = every.mean(axis=0), np.maximum(every.std(axis=0), 0.02)
    field.mean[-1] = 0  # the constant
    field.scale[-1] = 1
    docs = list(range(len(fitted)))
    features, there, owner = _chains([features for _, features, _ in fitted], docs)
    of_doc = np.array([label for *_, label in fitted])
    labels = np.where(there, of_doc[owner][:, None], 0)
    for round_ in range(ROUNDS):
        _fit(field, features, there, labels)
        if round_ + 1 < ROUNDS:
            x = field.emissions(features.reshape(-1, WIDTH)).reshape(there.shape)
            good, _ = _posteriors(x, there, field.transitions)
            good = np.where(there, good, 2)
            least = np.full(len(fitted), 2.0)
            np.minimum.at(least, owner, good.min(axis=1))
            fine = (good > 0.5) & (good > least[owner][:, None])
            labels = np.where(there, (of_doc[owner] == 1)[:, None] | fine, 0).astype(int)
    held = [row for row in sample if not steady_hash(row[0]) % CALIBRATE_EVERY]
    if len({label for *_, label in held}) < 2:
        held = sample
    shares = np.array([field.share(text) for _, text, _ in held])
    field.cut = best_cut(shares, np.array([label for *_, label in held]))
    return field


def learn(docs: DataFrame, labels: DataFrame, fit: Column, most: int = MOST_LABELLED) -> Field:
    """A field learned from at most ``most`` rows of each label, of those that meet ``fit``."""
    return train(labelled_sample(docs, labels, "quality", fit, most))


def score(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id and score (0 to 1, higher for good) of each row's whole text.

    A NULL, empty or blank text has no line, counts as wholly bad and has the lowest
    score. Equal texts have equal scores. Other columns are ignored; an empty table gives
    an empty result.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            scores = [field.score(text) for text in part.column("text").to_pylist()]
            columns = [part.column("doc_id"), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns, names=["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` whose score reaches the decision, with all their columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            scores = np.array([field.score(t) for t in part.column("text").to_pylist()])
            yield part.filter(pa.array(scores >= DECISION))

    return docs.mapInArrow(rows, docs.schema)


def learnable() -> Column:
    """Rows that labels may be learned from; the others are held out."""
    return remainder("doc_id", 4) != 2


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    field = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learnable())
    return score(docs, field).select(
        "doc_id",
        (~learnable()).alias("held_out"),
        "score",
        (F.col("score") >= DECISION).cast("int").alias("predicted"),
    )
