"""Quality rules whose cutoffs are risk-controlled on labelled holdouts.

Each rule rejects a text when one measure is above a cutoff. For each stratum (language) the
rules are tightened together along a path: a step's cutoffs are those that a given share of
the stratum's texts exceed, of texts that are not labelled good, so the path is fixed before
the good labels are looked at. A step is certified when the exact binomial (Clopper-Pearson)
upper bound on the share of labelled good texts that its rules reject together is at most
``RISK``. Steps are nested, and tested in order up to the first that fails, so a path needs
one certificate for all its steps and rules; strata share ``ERROR`` by Bonferroni. So with
probability ``1 - ERROR`` no stratum loses more than ``RISK`` of its good texts to the rules.
Of the certified steps the most lenient one stays that rejects nearly as many bad texts as
any. A stratum with too few labels (some 220 good ones with four strata) has no cutoffs.

Measures and the counts behind the cutoffs cover all rows; the driver sees one row for
each stratum, rule and cutoff, or step.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfspace.llm.common import documents, shared_table, slices

RISK = 0.02
ERROR = 0.05
# A rule stays as lenient as it can while it rejects this share of what it could.
NEARLY = 0.99

# Base rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Cutoffs of every measure, from lenient to strict. All measures are shares.
CUTOFFS = [round(0.98 - 0.02 * i, 2) for i in range(49)]

# Steps of a path: the share of texts that each rule's cutoff may exceed.
STEPS = [0.0, *(min(1.0, round(0.0025 * 1.25**i, 5)) for i in range(28))]

# The measures, as SQL over the counts; a text without words has none.
RULES = {
    "symbols": "n_symbols / word_chars",
    "upper_case": "n_upper / word_chars",
    "repeated_words": "n_repeat_words / n_words",
    "repeated_neighbours": "n_twice / n_words",
    "copied_lines": "n_dup_lines / n_lines",
}

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_twice", "n_lines",
]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def _repeated(numbers: np.ndarray, different: int) -> int:
    """Words that lie in a three-word window found at least twice."""
    if len(numbers) < 4:
        return 0
    pairs = numbers[:-1] * different + numbers[1:]
    if different > 1 << 20:  # keeps three words within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * different + numbers[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def counts(text: bytes) -> tuple[int, ...]:
    """The counts of one UTF-8 text, in the order of ``COUNTS``."""
    data = np.frombuffer(text, np.uint8)
    words = text.split()  # of bytes: at the six ASCII white spaces
    code_points = int(((data & 0xC0) != 0x80).sum())
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in text.split(b"\n"):
        if line.strip():
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    return (
        len(words),
        code_points - int(_SPACE[data].sum()),
        int(_SYMBOL[data].sum()),
        n_dup,
        _repeated(numbers, len(known)),
        int(((data >= 65) & (data <= 90)).sum()),
        int((numbers[1:] == numbers[:-1]).sum()),
        n_lines,
    )


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of each row's whole text; NULL counts as empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [counts(t or b"") for t in part.column("text").to_pylist()]
            columns = np.array(found, np.int64).reshape(-1, len(COUNTS)).T
            yield pa.record_batch(
                [part.column("doc_id"), part.column("stratum"), *map(pa.array, columns)],
                names=["doc_id", "stratum", *COUNTS],
            )

    kind = dict(docs.dtypes)["doc_id"]
    raw = docs.select(
        "doc_id",
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.col("text").cast("binary"),
    )
    schema = ", ".join([f"doc_id {kind}", "stratum string", *(f"{c} bigint" for c in COUNTS)])
    return raw.mapInArrow(rows, schema)


def base_failed() -> Column:
    repeated = F.lit(100) * F.col("n_repeat_words")
    return (F.col("n_words") < LEAST_WORDS) | (
        repeated > F.lit(MOST_REPEATED_PERCENT) * F.col("n_words")
    )


def _measure(rule: str) -> Column:
    above, below = RULES[rule].split(" / ")
    return F.coalesce(F.try_divide(F.col(above).cast("double"), F.col(below)), F.lit(0.0))


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson upper bound on a share of which k of n were seen."""
    if k >= n:
        return 1.0

    def at_most_k(p: float) -> float:
        terms = [
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)
        ]
        largest = max(terms)
        return math.exp(largest) * sum(math.exp(t - largest) for t in terms)

    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if at_most_k(middle) > error else (low, middle)
    return high


def certified(
    good: int, rejected: list[tuple[float, int, int]], risk: float, error: float
) -> float | None:
    """The cutoff or step to use, given (it, good rejected, bad rejected) from lenient to strict."""
    fine = []
    for cutoff, k, bad in rejected:
        # No bound is below k / n, so large k need not be worked out.
        if good == 0 or k > risk * good or upper_bound(k, good, error) > risk:
            break
        fine.append((cutoff, bad))
    most = max((bad for _, bad in fine), default=0)
    return next((cutoff for cutoff, bad in fine if most and bad >= NEARLY * most), None)


def paths(above: dict[str, dict[str, list[int]]], texts: dict[str, int]) -> dict[str, list[dict[str, float]]]:
    """Each stratum's steps, a cutoff for each rule, from lenient to strict.

    ``above`` has, for each stratum and rule, how many of the stratum's ``texts`` lie above
    each of ``CUTOFFS``.
    """
    found: dict[str, list[dict[str, float]]] = {}
    for stratum, rules in above.items():
        steps: list[dict[str, float]] = []
        for share in STEPS:
            step = {
                rule: min((c for c, n in zip(CUTOFFS, counts, strict=True) if n <= share * texts[stratum]), default=1.0)
                for rule, counts in rules.items()
            }
            if not steps or step != steps[-1]:
                steps.append(step)
        found[stratum] = steps
    return found


def learn_cutoffs(
    rows: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR
) -> list[tuple[str, str, float]]:
    """(stratum, rule, cutoff) for all that have one, from measured rows and their labels.

    Rows that fail the base rules take no part, as no cutoff decides about them. An id
    that is labelled twice counts once, with the lower label.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
    )
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    measures = [_measure(rule).alias(rule) for rule in RULES]
    judged = rows.where(~base_failed()).join(known, "doc_id", "left").select("stratum", "label", *measures)
    judged = shared_table(judged, "judged")
    # One counter for each rule and cutoff: how many measures lie above it.
    counters = [
        F.sum((F.col(rule) > c).cast("int")).alias(f"{rule}_{i}") for rule in RULES for i, c in enumerate(CUTOFFS)
    ]
    others = judged.where(F.coalesce(F.col("label") != 1, F.lit(True)))
    counted = others.groupBy("stratum").agg(F.count("*").alias("texts"), *counters).collect()
    above = {
        row.stratum: {rule: [row[f"{rule}_{i}"] for i in range(len(CUTOFFS))] for rule in RULES}
        for row in counted
    }
    steps = paths(above, {row.stratum: row.texts for row in counted})
    listed = [
        (stratum, at, *(step[rule] for rule in RULES))
        for stratum, path in steps.items()
        for at, step in enumerate(path)
    ]
    if not listed:
        return []
    cuts = [f"cut_{rule}" for rule in RULES]
    path = rows.sparkSession.createDataFrame(listed, ", ".join(["stratum string", "at int", *(f"{c} double" for c in cuts)]))
    hit = F.lit(False)
    for rule, cut in zip(RULES, cuts, strict=True):
        hit = hit | (F.col(rule) > F.col(cut))
    good, bad = F.col("label") == 1, F.col("label") == 0
    # The path has as many rows as strata and steps, and was made here.
    held = judged.where("label IS NOT NULL").join(F.broadcast(path), "stratum")
    table = held.groupBy("stratum", "at").agg(
        F.count_if(good).alias("n"), F.count_if(good & hit).alias("k"), F.count_if(bad & hit).alias("bad")
    )
    rejected = defaultdict(list)
    for row in sorted(table.collect(), key=lambda row: (row.stratum, row.at)):
        rejected[row.stratum].append((row.at, row.k, row.bad, row.n))
    one = error / max(1, len(rejected))
    found = []
    for stratum, counts in sorted(rejected.items()):
        at = certified(counts[0][3], [c[:3] for c in counts], risk, one)
        if at is not None:
            found += [(stratum, rule, cutoff) for rule, cutoff in steps[stratum][int(at)].items()]
    return found


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, the counts, ``base_failed`` and ``kept`` of each row, and ``failed_rules``.

    A NULL, empty or blank text has no words and fails the base rules. NULL is a stratum
    of its own. Rows without an id, or that repeat one, are judged like others. Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = shared_table(measured(docs, stratum), "measures")
    cutoffs = learn_cutoffs(rows, labels)
    # Each cutoff is a comparison in the plan; their number is that of strata times rules.
    failed = [
        F.when((F.col("stratum") == s) & (_measure(rule) > cutoff), F.lit(rule))
        for s, rule, cutoff in cutoffs
    ]
    failed_rules = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    judged = rows.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed_rules)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return apply_rules(documents(spark, sf_dir), labels).select(
        "doc_id",
        *COUNTS[:5],
        "base_failed",
        "kept",
    )
