"""Repeated passages against brute force over all strings of the given length."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from halfspace.llm import repeats
from halfspace.workspace import setting

SCHEMA = "doc_id BIGINT, text STRING, lang STRING"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Many small joins over a few rows: with two partitions each, half the time."""
    with setting(spark, "spark.sql.shuffle.partitions", "2"):
        yield


def brute(texts: list[bytes], length: int) -> list[tuple[list, bytes]]:
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        edges = np.flatnonzero(np.diff([0, *gone, 0])).tolist()
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((list(zip(edges[::2], edges[1::2], strict=True)), kept))
    return out


def compared(spark, rows: list[tuple], length: int, **options) -> None:
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA)
    texts = [(t or "").encode() for _, t in rows]
    want = sorted(
        (str(i), len(t), spans, kept)
        for (i, _), t, (spans, kept) in zip(rows, texts, brute(texts, length), strict=True)
    )
    found = repeats.remove_repeats(docs, length, **options).collect()
    got = sorted((str(r.doc_id), r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found)
    assert got == want


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages and runs of one character."""
    dice = random.Random(5)
    words = ["".join(dice.choices("abcdeé", k=dice.randint(1, 8))) for _ in range(300)]
    prose = lambda n: " ".join(dice.choices(words, k=n))
    shared = [prose(80) for _ in range(3)]
    rows = [(i, prose(dice.randint(1, 200))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(8)]
    rows += [(200 + i, rows[20 + i][1].replace(" ", "  ", 3)) for i in range(8)]
    for i in range(40):
        a = dice.randrange(200)
        rows.append((300 + i, prose(20) + shared[i % 3][a : a + dice.randrange(150, 300)] + prose(20)))
    rows += [(400, "x" * 900), (401, "ab" * 350 + prose(9)), (402, prose(9) + "abc" * 200)]
    rows += [(403, "y" * 200), (404, "z" * 199), (405, "w" * 201), (406, "0123456789" * 30)]
    rows += [(None, None), (1, ""), (1, rows[3][1]), (None, rows[3][1])]
    return rows


def test_as_brute_force(spark, corpus):
    compared(spark, corpus, 200)


@pytest.mark.parametrize("length", [1, 7, 60])
def test_other_lengths(spark, corpus, length):
    compared(spark, corpus[:40] + corpus[-12:], length)


def test_large_groups_are_halved(spark, corpus):
    """With groups of two segments at most, each shared passage is dealt anew, to the end."""
    compared(spark, corpus, 200, most=2)


def test_blocks_and_batches_meet(spark, corpus, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 256)
    monkeypatch.setattr(repeats, "BATCH_BYTES", 500)
    compared(spark, corpus, 200)


def test_rounds_give_common_prefixes():
    """Random short documents of several groups, all windows, by brute force."""
    dice = random.Random(3)
    for _ in range(60):
        groups, first, texts, length = [], [], [], dice.randint(1, 5)
        for group in range(dice.randint(1, 4)):
            for _ in range(dice.randint(1, 9)):
                groups.append(group)
                first.append(dice.randint(-4, 0))
                texts.append(bytes(dice.choices(b"ab", k=length + dice.randint(0, 6))))
        windows = [
            [(g, f + i, t[i : i + length]) for i in range(len(t) - length + 1)]
            for g, f, t in zip(groups, first, texts, strict=True)
        ]
        counts = Counter(w for ws in windows for w in ws)
        got = repeats.repeated_windows(np.array(groups), np.array(first), texts, length)
        assert [m.tolist() for m in got] == [[counts[w] > 1 for w in ws] for ws in windows]


def test_odd_tables(spark):
    names = "doc_id BIGINT, text STRING, row BIGINT, key STRING, found INT, bytes BINARY"
    text = "Nothing but the same sentence. " * 9
    rows = [(1, text, 5, "k", 1, b"b"), (None, text, None, None, None, None), (2, None, 5, "k", 1, b"b")]
    docs = spark.createDataFrame(rows, names)
    out = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    assert out[1].kept == out[None].kept == out[2].kept == b""
    assert out[2].spans == [] and out[1].spans[0].stop == len(text)
    assert repeats.remove_repeats(docs.limit(0)).collect() == []
    long = "".join(random.Random(1).choices("abcdefgh ", k=2_500_000))
    docs = spark.createDataFrame([(1, long), (2, "q" + long[1_048_000:1_049_000])], "doc_id BIGINT, text STRING")
    out = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    assert [tuple(s) for s in out[1].spans] == [(1_048_000, 1_049_000)]
    assert out[2].kept == b"q"


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    texts = [(r.text or "").encode() for r in rows]
    want = {
        r.doc_id: (len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
        for r, t, (spans, kept) in zip(rows, texts, brute(texts, repeats.LENGTH), strict=True)
    }
    got = repeats.op13_repeated_passages(spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
