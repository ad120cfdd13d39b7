"""The prefix trie against a trie built turn by turn in Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from halfspace.llm import turn_trie
from halfspace.workspace import setting

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Many small joins over a few rows: with two partitions each, half the time."""
    with setting(spark, "spark.sql.shuffle.partitions", "2"):
        yield


def brute(rows: list[tuple]) -> list[tuple]:
    turns: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [t[2:] for t in sorted(found)] for conv, found in turns.items()}
    nodes: dict = {}
    for conv in turns:
        h = zlib.crc32(str(conv).encode()) % 6
        whole = turns.get(conv - conv % 100, [])[:h] + turns[conv][h:]
        for d in range(len(whole) + 1):
            nodes.setdefault(tuple(whole[:d]), []).append((conv, d == len(whole)))
    below = {path: [p for p in nodes if p[: len(path)] == path] for path in nodes}
    out = []
    for path, members in nodes.items():
        children = [p for p in below[path] if len(p) == len(path) + 1]
        leaves = [p for p in below[path] if not any(len(q) > len(p) for q in below[p])]
        ends = ",".join(str(c) for c, last in sorted(members) if last)
        out.append(
            (
                min(members)[0],
                len(path),
                min(nodes[path[:-1]])[0] if path else None,
                len(members),
                len(children),
                len(leaves),
                sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below[path] if p),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def built(df, **options) -> list[tuple]:
    nodes = turn_trie.prefix_trie(df, **options).nodes.select(*COLUMNS).collect()
    return sorted((tuple(r) for r in nodes), key=str)


@pytest.fixture(scope="module")
def rows():
    """Bases and what is built on them, copies, a long conversation, ties and NULLs."""
    dice = random.Random(4)
    texts = ["", "ä", "yes", "no", "go on", "yes"]
    rows = []
    for conv in [*range(0, 12), *range(100, 112), 205, 207, 300, 399]:
        for turn in range(dice.randint(1, 9)):
            rows.append((conv, turn, dice.choice(["user", "assistant", None]), dice.choice(texts)))
    rows += [(conv, turn, "user", "same") for conv in (401, 402, 403, 404) for turn in range(7)]
    rows += [(500, turn, "user", f"turn {turn % 3}") for turn in range(120)]
    rows += [(501, turn, "user", f"turn {turn % 3}") for turn in range(60)]
    rows += [(12, None, None, None), (12, None, "user", "b"), (12, None, "user", "a"), (12, 3, None, None)]
    rows += [(13, 1, "user", "x"), (13, 1, "user", "x"), (13, 1, "assistant", "x"), (None, 1, "user", "lost")]
    rows += [(14, 1, "us", "ery"), (15, 1, "user", "y"), (16, 1, "user", "y" * 200), (-7, 0, "user", "y")]
    dice.shuffle(rows)
    return rows


def sql_base(rows):
    """Ids below zero count towards zero, as in SQL."""
    return [r for r in rows if r[0] is None or r[0] >= 0]


def test_as_brute_force(spark, rows):
    assert built(spark.createDataFrame(sql_base(rows), SCHEMA)) == brute(sql_base(rows))


def test_a_conversation_is_spread_over_parts(spark, rows, monkeypatch):
    """Few distinct ids over many parts, windows of three depths, texts of two ids."""
    monkeypatch.setattr(turn_trie, "BUCKET", 3)
    monkeypatch.setattr(turn_trie, "CHUNK", 2)
    some = [r for r in sql_base(rows) if r[0] in (401, 402, 403, 404, 500, 501)]
    df = spark.createDataFrame(some, SCHEMA)
    whole = setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false")
    with whole, setting(spark, "spark.sql.shuffle.partitions", "8"):
        turns = turn_trie._sorted_turns(df, 0, turn_trie.MODULUS)
        assert turns.where("conv_id = 500").select("part").distinct().count() > 2
        assert built(df) == brute(some)


def test_references_lead_to_the_last_turn(spark, rows):
    trie = turn_trie.prefix_trie(spark.createDataFrame(sql_base(rows), SCHEMA))
    found = trie.nodes.join(trie.turns, trie.nodes.ref == trie.turns.seq)
    assert found.count() == trie.nodes.where("depth > 0").count()
    root = trie.nodes.where("ref IS NULL").collect()
    assert len(root) == 1 and root[0].depth == 0


def test_collisions_are_noticed(spark, rows):
    df = spark.createDataFrame(sql_base(rows), SCHEMA)
    with pytest.raises(turn_trie.FingerprintCollisionError):
        turn_trie.prefix_trie(df, modulus=5)


def test_another_set_of_hashes_is_tried(spark, rows, monkeypatch):
    calls = []
    monkeypatch.setattr(turn_trie, "_same_texts", lambda turns: bool(calls.append(1)) or len(calls) == 2)
    some = sql_base(rows)[:60]
    assert built(spark.createDataFrame(some, SCHEMA)) == brute(some)
    assert len(calls) == 2


def test_equal_elements_are_compared_by_text(spark):
    schema = "conv_id BIGINT, seq BIGINT, a BIGINT, b BIGINT, role STRING, text STRING"
    same = [(1, 1, 5, 6, "user", "x"), (2, 2, 5, 6, "user", "x"), (3, 3, 5, 7, "user", "y")]
    assert turn_trie._same_texts(spark.createDataFrame(same, schema))
    assert not turn_trie._same_texts(spark.createDataFrame([*same, (4, 4, 5, 6, "user", "z")], schema))


def test_odd_tables(spark):
    names = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, seq INT, part STRING, a INT, depth INT"
    odd = [(0, 0, "user", "q" * 300_000, 9, "p", 1, 2), (1, None, None, None, 9, "p", 1, 2)]
    df = spark.createDataFrame(odd, names)
    assert built(df) == brute([r[:4] for r in odd])
    assert built(df.limit(0)) == []
    assert built(df.where("turn IS NULL")) == brute([odd[1][:4]])


def test_products_compose(spark):
    a, b = turn_trie._product("2305843009213693950", "7", "2305843009213693949", "11", turn_trie.MODULUS)
    row = spark.sql(f"SELECT {a} AS a, {b} AS b").first()
    m = turn_trie.MODULUS
    assert (row.a, row.b) == ((m - 1) * (m - 2) % m, (7 * (m - 2) + 11) % m)


def test_query_agrees_with_its_sql(spark, sf_dir):
    duck = duckdb.connect()
    path = f"{sf_dir}/conversations.parquet"
    duck.execute(f"create view conversations as select * from '{path}'")
    expected = duck.sql(turn_trie.OP11_SQL)
    got = turn_trie.op11_prefix_trie(spark, sf_dir)
    assert got.columns == expected.columns
    assert {str(t) for t in expected.types} == {"BIGINT", "VARCHAR"}
    ours, theirs = ([tuple(r) for r in rows] for rows in (got.collect(), expected.fetchall()))
    assert sorted(ours, key=str) == sorted(theirs, key=str)
