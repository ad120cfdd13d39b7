"""Exact and near duplicates, components and hot joins against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from halfspace.llm import exact_dedup, simhash
from halfspace.llm.common import hot_join, shared_table
from halfspace.llm.components import connected_components

SCHEMA = "doc_id BIGINT, text STRING"


def find(parents: dict, x):
    while parents.setdefault(x, x) != x:
        x = parents[x]
    return x


def brute_groups(rows):
    """doc_id -> (keep_id, group size) by text without white space; ids are unique."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = {}
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0]))[0]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out |= {doc_id: (keep, len(members), doc_id == keep, digest) for doc_id, _ in members}
    return out


def marked(spark, rows, **options):
    df = exact_dedup.mark_duplicates(spark.createDataFrame(rows, SCHEMA), **options)
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_exact_dedup_agrees_with_brute_force(spark):
    dice = random.Random(3)
    words = ["a", "b ", " c", "\t", "é\n", "", "𐍈", "\x0b", "\x1f", "\xa0"]
    rows = [(i, "".join(dice.choices(words, k=dice.randint(0, 4)))) for i in range(400)]
    rows += [(1000 + i, "hot copy " + " " * (i % 3)) for i in range(300)]
    rows += [(2000, None), (-5, ""), (2001, "x" * 300_000), (2002, "x" * 299_999 + " x")]
    assert marked(spark, rows) == brute_groups(rows)
    # A tiny capacity doubles the directory to its limit; the answer stays the same.
    assert marked(spark, rows, capacity=2, max_depth=5) == brute_groups(rows)


def test_exact_dedup_agrees_with_its_sql(spark, sf_dir):
    ours = exact_dedup.op3_exact_dedup(spark, sf_dir)
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    theirs = connection.sql(exact_dedup.OP3_SQL)
    columns = theirs.columns
    assert set(ours.columns) == set(columns)
    assert sorted(map(tuple, ours.select(*columns).collect())) == sorted(theirs.fetchall())


def test_directory_splits_only_overfull_buckets(spark):
    # Four entries begin with bit 1, one with bit 0.
    keys = [1, -1, -2, -3, -(2**62) - 1]
    entries = spark.createDataFrame([(k,) for k in keys], "key BIGINT")
    slots = {r.slot: (r.depth, r.bucket) for r in exact_dedup.directory(entries, 2, 3).collect()}
    assert slots[0] == slots[3] == (1, 0)
    assert slots[4] == slots[5] == (2, 4)
    assert slots[6] == (3, 6)
    assert slots[7] == (3, 7)  # three entries, at the last depth


def test_keys_that_collide_are_chained(spark, monkeypatch):
    def colliding(docs):
        keyed = exact_dedup.normalised(F.col("text"))
        chars = F.length(F.coalesce("text", F.lit("")))
        return docs.select("doc_id", chars.alias("chars"), keyed.alias("norm")).withColumn(
            "key", F.lit(7).cast("bigint")
        )

    monkeypatch.setattr(exact_dedup, "_keyed", colliding)
    rows = [(1, "a"), (2, "b"), (3, "a "), (4, "c")]
    assert marked(spark, rows) == brute_groups(rows)
    index = exact_dedup.build_index(colliding(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(r.chain for r in index.collect()) == [1, 2, 3]


def test_portions_of_a_group_meet_in_the_chain(spark):
    """Copies arrive in several rows at their bucket's owner, who adds them up."""
    rows = [(i, "same text" + " " * (i % 5)) for i in range(60)] + [(None, "same text"), (99, "other")]
    docs = spark.createDataFrame(rows, SCHEMA)
    portions = exact_dedup._portions(exact_dedup._keyed(docs))
    assert 2 < portions.count() <= exact_dedup.PORTIONS + 1
    assert sorted((r.group_size, r.keep_id) for r in exact_dedup.build_index(exact_dedup._keyed(docs)).collect()) == [(1, 99), (61, 4)]
    assert marked(spark, rows) == brute_groups(rows)


def test_a_chain_that_does_not_compare_bytes_is_wrong(spark, monkeypatch):
    """Texts with one key are told apart by the chain alone."""
    monkeypatch.setattr(exact_dedup, "hash_key", lambda norm: F.lit(7).cast("bigint"))
    rows = [(i, f"text {i % 5}") for i in range(40)]
    assert marked(spark, rows) == brute_groups(rows)


def test_columns_of_any_name_come_back_as_they_were(spark):
    names = "doc_id BIGINT, text STRING, __key_doc_id STRING, __doc_id STRING, key_of_sha STRING, _key_no_keep_id STRING"
    docs = spark.createDataFrame([(1, "a", "mine", "yours", "x", "y"), (2, "a", "m", "z", "x", "y")], names)
    for operator in (exact_dedup.deduplicate, simhash.keep_representatives):
        kept = operator(docs)
        assert kept.columns == docs.columns
        assert [tuple(r) for r in kept.collect()] == [(1, "a", "mine", "yours", "x", "y")]


def test_deduplicate_keeps_all_columns_of_one_row_each(spark):
    rows = [(2, "a b", 1, b"x"), (1, "ab", 2, None), (None, "c", 3, None), (None, "c", 4, None)]
    rows += [(5, "d", 5, None), (5, "d", 6, None), (5, "e", 7, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, key INT, sha BINARY")
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [
        (0, "c"), (2, "a b"), (5, "d"), (5, "e"),
    ]


def brute_fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]
    n = max(1, len(words) - 3)
    shingles = [b" ".join(words[i : i + 4]) for i in range(n)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = {doc_id: brute_fingerprint(text) for doc_id, text in rows}
    parents = {}
    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((find(parents, a), find(parents, b)))
                parents[high] = low
    return {i: (f"{prints[i]:016x}", find(parents, i)) for i in ids}


def near_rows(dice, n):
    base = [f"w{dice.randint(0, 50)}" for _ in range(400)]
    rows = []
    for i in range(n):
        words = list(base)
        words[dice.randrange(400)] = f"Z{i}"
        rows.append((i, " ".join(words)))
    return rows


def test_simhash_agrees_with_brute_force(spark):
    dice = random.Random(5)
    rows = near_rows(dice, 60)
    rows += [(100 + i, " ".join(dice.choices("abcdefgh", k=dice.randint(0, 6)))) for i in range(80)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "É é A\xa0b"), (304, "x " * 30_000)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    expected = brute_components(rows)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found.collect()} == expected
    assert len({c for _, c in expected.values()}) < len(rows) - 20


@pytest.mark.parametrize("tile", [2, 5, 4096])
def test_tiles_lose_no_link(spark, tile):
    dice = random.Random(8)
    prints = {dice.getrandbits(64) for _ in range(100)}
    center = dice.getrandbits(64)
    for _ in range(200):  # a crowd around one centre, and chains that leave it
        center ^= 1 << dice.randrange(64) if dice.random() < 0.2 else 0
        prints.add(center ^ 1 << dice.randrange(64) ^ 1 << dice.randrange(64))
    signed = [(p - (p >> 63 << 64),) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "print BIGINT"), tile=tile).collect()
    array = np.array(sorted(prints), np.uint64)
    nodes = simhash.mixed(array).view(np.int64).tolist()
    ours, theirs = {}, {}
    for edge in edges:
        ours[find(ours, edge.a)] = find(ours, edge.b)
    for i, p in enumerate(array):
        for j in np.flatnonzero(np.bitwise_count(array ^ p) <= 4):
            theirs[find(theirs, nodes[i])] = find(theirs, nodes[j])

    def classes(parents):
        groups = {}
        for node in nodes:
            groups.setdefault(find(parents, node), set()).add(node)
        return {frozenset(g) for g in groups.values()}

    assert classes(ours) == classes(theirs)


def test_block_layout_covers_all_bits():
    for count in (0, 1, 1000, 10**6, 10**9, 10**11):
        blocks = simhash.block_layout(count)
        assert sum(1 << s for s, w in blocks for s in range(s, s + w)) == 2**64 - 1
        assert len(blocks) > simhash.DISTANCE


def test_keep_representatives_keeps_one_row_each(spark):
    rows = [*near_rows(random.Random(1), 5), (9, None), (8, ""), (8, ""), (None, "lonely words")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], f"{SCHEMA}, component_id STRING")
    kept = simhash.keep_representatives(docs)
    expected = {c for _, c in brute_components([r for r in rows if r[0] is not None]).values()}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(expected)
    assert kept.where("doc_id IS NULL").count() == 1


def test_representatives_are_chosen_by_component_not_by_id(spark):
    dice = random.Random(4)
    text = lambda: " ".join("".join(dice.choices("abcdefgh", k=6)) for _ in range(200))
    named, *lonely = [text() for _ in range(6)]
    repeated = [text() for _ in range(5)]
    copied = text()
    rows = [(1, named), (None, named + "\n")]  # a copy without an id goes
    rows += [(None, t) for t in lonely] + [(None, lonely[0] + " ")]
    rows += [(7, t) for t in repeated] + [(7, repeated[0])]
    rows += [(3, copied), (7, copied + "\t")]  # 7 goes where 3 is, and stays elsewhere
    rows += [(9, None), (9, ""), (None, " ")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    kept = [(r.doc_id, (r.text or "").strip()) for r in simhash.keep_representatives(docs).collect()]
    expected = [(1, named), (3, copied), (9, "")]
    expected += [(None, t) for t in lonely] + [(7, t) for t in repeated]
    assert sorted(kept, key=str) == sorted(expected, key=str)


def test_components_of_paths_stars_and_cycles(spark):
    dice = random.Random(2)
    ids = [dice.getrandbits(63) for _ in range(300)]
    pairs = list(zip(ids[:100], ids[1:100], strict=False))  # a long path
    pairs += [(ids[120], x) for x in ids[121:200]]  # a star
    pairs += [(ids[200], ids[201]), (ids[201], ids[202]), (ids[202], ids[200])]
    pairs += [(ids[250], ids[250])]
    labels = connected_components(spark.createDataFrame(pairs, "a BIGINT, b BIGINT")).collect()
    parents = {}
    for a, b in pairs:
        parents[find(parents, a)] = find(parents, b)
    ours = {}
    for row in labels:
        ours.setdefault(row.label, set()).add(row.node)
    theirs = {}
    for node in parents:
        theirs.setdefault(find(parents, node), set()).add(node)
    assert {frozenset(g) for g in ours.values()} == {
        frozenset(g) for g in theirs.values() if len(g) > 1
    }


def test_no_edges_no_components(spark):
    assert connected_components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_hot_join_agrees_with_a_join(spark):
    left = [(i % 7 if i % 3 else 99, i) for i in range(3000)] + [(1000 + i, i) for i in range(900)]
    rows = shared_table(spark.createDataFrame(left, "k BIGINT, v BIGINT"), "test")
    right = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    right = shared_table(right.where("k <> 5"), "test")
    ours = sorted(map(tuple, hot_join(rows, right, ["k"], "n").select("k", "v", "m").collect()))
    assert ours == sorted(map(tuple, rows.join(right, "k").select("k", "v", "m").collect()))


@pytest.mark.parametrize("function", [exact_dedup.mark_duplicates, simhash.near_duplicates,
                                      exact_dedup.deduplicate, simhash.keep_representatives])
def test_empty_table_and_clashing_columns(spark, function):
    schema = f"{SCHEMA}, key STRING, norm INT, node BINARY, print STRING, n INT, sha INT, kept INT"
    assert function(spark.createDataFrame([], schema)).count() == 0
    row = (1, "a b", "k", 1, b"", "p", 2, 3, 4)
    assert function(spark.createDataFrame([row, row], schema)).count() in (1, 2)
