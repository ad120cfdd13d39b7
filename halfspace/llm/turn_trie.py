"""The prefix trie of rebuilt conversations, from composable fingerprints of turns.

A turn's element is a map x -> a x + b modulo a prime, with a and b from a hash of its
role and text. A sequence's fingerprint is the product of its turns' maps, so the
fingerprint of two sequences one after the other is the product of theirs. A rebuilt
conversation is a head of its base and a suffix of its own: its prefixes' fingerprints
are products of the base's head, worked out once for each base, and of its own turns
from the first one kept. No rebuilt text, and no rebuilt list of turns, is ever made.

Turns are sorted once by conversation and place, over all tasks, so a conversation of any
length is spread over parts of the sorted table. Products run within each part; a second,
short pass over one product for each part carries them on.

A node is a depth and a fingerprint, and keeps a reference to its last turn. That equal
fingerprints are equal sequences is verified: all members of a node must have one parent
and one last element, and turns with one element must have the same role and text as the
turn that the element refers to, compared byte by byte. Otherwise all is done anew with
other hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halfspace.llm.common import hot_join, shared_table

MODULUS = 2**61 - 1
TRIES = 3

# A conversation's base is the one its id is counted from in steps of SPREAD, and its head
# has fewer than HEADS turns.
SPREAD = 100
HEADS = 6

# Depths of a chain that one window sums, and ids that are joined to one text.
BUCKET = 65_536
CHUNK = 65_536

NODE = ["depth", "fa", "fb"]
STEPS = "conv_id bigint, part bigint, pos bigint, seq bigint, a bigint, b bigint, chars bigint, xa bigint, xb bigint"
CARRIES = "conv_id bigint, part bigint, ca bigint, cb bigint"
CHUNKS = "depth bigint, fa bigint, fb bigint, first bigint, ids string"
DIGESTS = "depth bigint, fa bigint, fb bigint, ends_sha256 string"
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


class FingerprintCollisionError(Exception):
    """Raised when several sets of hashes all gave different turns one fingerprint."""


@dataclass(frozen=True)
class Trie:
    """``nodes``, and the ``turns`` that their ``ref`` column refers to by ``seq``."""

    nodes: DataFrame
    turns: DataFrame


def _product(a1: str, b1: str, a2: str, b2: str, modulus: int) -> tuple[str, str]:
    """SQL for the map that applies (a1, b1) and then (a2, b2)."""
    wide = [f"cast({value} AS decimal(19,0))" for value in (a1, b1, a2, b2)]
    m = f"cast({modulus} AS decimal(19,0))"
    return (
        f"cast(({wide[0]} * {wide[2]}) % {m} AS bigint)",
        f"cast(({wide[1]} * {wide[2]} + {wide[3]}) % {m} AS bigint)",
    )


def head_turns(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % HEADS


def _head() -> Column:
    return F.crc32(F.col("conv_id").cast("string")) % HEADS


def _sorted_turns(conversations: DataFrame, seed: int, modulus: int) -> DataFrame:
    """All turns with their element, numbered in order of conversation and place.

    The number's upper bits are the part of the table that the turn lies in. The sort
    sees bounded keys only: turns that tie go by the beginnings of role and text, then by
    the digest of both; identical rows can be in any order.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        text("role").alias("role"),
        text("text").alias("text"),
    )
    # The role's length comes first, so no two turns make the same bytes.
    whole = F.concat(F.lit(f"{seed}:"), F.length("role").cast("string"), F.lit(":"), "role", "text")
    number = lambda start: F.conv(F.substring("digest", start, 15), 16, 10).cast("bigint")
    rows = rows.withColumn("digest", F.sha2(whole, 256)).select(
        "*",
        (number(1) % F.lit(modulus - 1) + 1).alias("a"),
        (number(16) % F.lit(modulus)).alias("b"),
        F.length("text").cast("bigint").alias("chars"),
        F.monotonically_increasing_id().alias("given"),
    )
    order = [
        F.asc("conv_id"),
        F.asc_nulls_first("turn"),
        F.substring("role", 1, 64),
        F.substring("text", 1, 64),
        F.asc("digest"),
        F.asc("given"),
    ]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.select(
        "conv_id", F.monotonically_increasing_id().alias("seq"), "a", "b", "chars", "role", "text"
    )
    return shared_table(numbered, "turns").withColumn("part", F.shiftright("seq", 33))


def _steps(turns: DataFrame, modulus: int) -> DataFrame:
    """Each turn's place in its conversation, and the product of its own turns before it.

    The product (xa, xb) has the turns of this part from the conversation's first kept
    one on.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in STEPS.split(", ")]
        group, pos, head, xa, xb = None, 0, 0, 1, 0
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in ("conv_id", "part", "start", "a", "b")}
            out = []
            for conv_id, part, start, a, b in zip(*columns.values(), strict=True):
                if (conv_id, part) != group:
                    group, pos, head, xa, xb = (conv_id, part), start, head_turns(conv_id), 1, 0
                out.append((pos, xa, xb))
                if pos >= head:
                    xa, xb = xa * a % modulus, (xb * a + b) % modulus
                pos += 1
            places = dict(zip(("pos", "xa", "xb"), map(list, zip(*out, strict=True)), strict=True)) if out else {}
            if places:
                arrays = [
                    pa.array(places[n], pa.int64()) if n in places else batch.column(n) for n in names
                ]
                yield pa.record_batch(arrays, names)

    keys = ["conv_id", "part"]
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = turns.groupBy(*keys).agg(F.count("*").alias("n"))
    groups = groups.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rows = turns.select(*keys, "seq", "a", "b", "chars").join(groups, keys)
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "seq")
    return shared_table(rows.mapInArrow(scan, STEPS), "turn-steps")


def _carries(steps: DataFrame, modulus: int) -> DataFrame:
    """For each part of a conversation, the product of its own turns in earlier parts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in CARRIES.split(", ")]
        conv, ca, cb = None, 1, 0
        for batch in batches:
            out = []
            for conv_id, part, a, b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if conv_id != conv:
                    conv, ca, cb = conv_id, 1, 0
                out.append((conv_id, part, ca, cb))
                ca, cb = ca * a % modulus, (cb * a + b) % modulus
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    a, b = _product("last.xa", "last.xb", "last.a", "last.b", modulus)
    last = F.max_by(F.struct("xa", "xb", "a", "b", "pos"), "pos").alias("last")
    # A part that ends before the first kept turn has an empty product.
    kept = F.col("last.pos") >= _head()
    totals = steps.groupBy("conv_id", "part").agg(last).select(
        "conv_id",
        "part",
        F.when(kept, F.expr(a)).otherwise(1).alias("a"),
        F.when(kept, F.expr(b)).otherwise(0).alias("b"),
    )
    return totals.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(scan, CARRIES)


def _memberships(steps: DataFrame, modulus: int) -> tuple[DataFrame, DataFrame]:
    """A row for each conversation and depth, root included; and each conversation's length.

    A row has the prefix's fingerprint, its parent's, the last turn's element, code points
    and number, and whether the conversation ends there.
    """
    head = F.sort_array(F.collect_list(F.struct("pos", "a", "b", "chars", "seq"))).alias("turns")
    heads = steps.where(f"conv_id % {SPREAD} = 0 AND pos < {HEADS - 1}").groupBy("conv_id").agg(head)
    a, b = _product("element_at(done, -1).a", "element_at(done, -1).b", "t.a", "t.b", modulus)
    products = F.expr(
        f"""aggregate(turns, array(named_struct('a', 1L, 'b', 0L)),
                      (done, t) -> concat(done, array(named_struct('a', {a}, 'b', {b}))))"""
    )
    heads = heads.select(F.col("conv_id").alias("base"), "turns", products.alias("products"))
    convs = steps.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = convs.withColumns({"h": _head(), "base": F.expr(f"conv_id - conv_id % {SPREAD}")})
    whole = F.coalesce(F.size("turns"), F.lit(0))
    convs = convs.join(heads, "base", "left").withColumn("n_head", F.least("h", whole))
    convs = convs.withColumn("length", F.expr("n_head + greatest(own - h, 0)"))
    convs = shared_table(convs, "conversations")
    identity = F.expr("named_struct('a', 1L, 'b', 0L)")
    lead = F.when(F.col("n_head") > 0, F.expr("element_at(products, cast(n_head + 1 AS int))")).otherwise(identity)
    leads = _carries(steps, modulus).join(
        convs.select("conv_id", "h", "n_head", "length", lead.alias("lead")), "conv_id"
    )
    la, lb = _product("lead.a", "lead.b", "ca", "cb", modulus)
    leads = leads.select("conv_id", "part", "h", "n_head", "length", F.expr(la).alias("la"), F.expr(lb).alias("lb"))
    xa, xb = _product("la", "lb", "xa", "xb", modulus)
    own = steps.join(leads, ["conv_id", "part"]).where("pos >= h").select(
        "conv_id",
        F.expr("pos - h + n_head + 1").alias("depth"),
        F.expr(xa).alias("xa"),
        F.expr(xb).alias("xb"),
        "a",
        "b",
        "chars",
        "seq",
        "length",
    )
    at = F.explode(F.expr("sequence(1, cast(n_head AS int))")).alias("at")
    inherited = convs.where("n_head > 0").select("conv_id", "length", "turns", "products", at).select(
        "conv_id",
        F.col("at").cast("bigint").alias("depth"),
        F.expr("products[at - 1].a").alias("xa"),
        F.expr("products[at - 1].b").alias("xb"),
        *[F.expr(f"turns[at - 1].{name}").alias(name) for name in ("a", "b", "chars", "seq")],
        "length",
    )
    fa, fb = _product("xa", "xb", "a", "b", modulus)
    below = own.unionByName(inherited).withColumns({"fa": F.expr(fa), "fb": F.expr(fb)})
    nothing = {name: F.lit(0).cast("bigint") for name in ("depth", "xa", "xb", "a", "b", "chars", "seq", "fb")}
    roots = convs.select("conv_id", "length").withColumns({**nothing, "fa": F.lit(1).cast("bigint")})
    rows = below.unionByName(roots).withColumn("ends", F.expr("depth = length")).drop("length")
    return shared_table(rows, "memberships"), convs.select("conv_id", "length")


def _same_texts(turns: DataFrame) -> bool:
    """Whether all turns with one element have the role and text of the first of them."""
    first = turns.groupBy("a", "b").agg(F.min("seq").alias("ref"), F.count("*").alias("n"))
    first = first.where("n > 1").select("ref")
    texts = turns.join(first, turns.seq == first.ref).select(
        "a", "b", "ref", F.col("role").alias("role_there"), F.col("text").alias("text_there")
    )
    differ = "seq <> ref AND (role <> role_there OR text <> text_there)"
    return turns.join(texts, ["a", "b"]).where(differ).isEmpty()


def _digests(members: DataFrame) -> DataFrame:
    """The digest of each node's ends. Ids are joined to texts by tasks that share a large
    node's ids, and its texts are hashed one after another."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in CHUNKS.split(", ")]
        types = [*[pa.int64()] * 4, pa.string()]
        node, ids = None, []

        def chunk() -> tuple:
            return (*node, ids[0], ",".join(map(str, ids)))

        for batch in batches:
            out = []
            for *here, conv_id in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if here != node or len(ids) == CHUNK:
                    if ids:
                        out.append(chunk())
                    node, ids = here, []
                ids.append(conv_id)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
        if ids:
            yield pa.record_batch([pa.array([c], t) for c, t in zip(chunk(), types, strict=True)], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in DIGESTS.split(", ")]
        types = [*[pa.int64()] * 3, pa.string()]
        node, state = None, None
        for batch in batches:
            out = []
            rows = zip(*(batch.column(name).to_pylist() for name in [*NODE, "ids"]), strict=True)
            for *here, ids in rows:
                if here != node:
                    if state:
                        out.append((*node, state.hexdigest()))
                    node, state = here, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
        if state:
            last = (*node, state.hexdigest())
            yield pa.record_batch([pa.array([c], t) for c, t in zip(last, types, strict=True)], names)

    ends = members.where("ends").select(*NODE, "conv_id")
    ordered = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    chunks = shared_table(ordered.mapInArrow(join, CHUNKS), "node-ends")
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, DIGESTS)


def _nodes(members: DataFrame) -> DataFrame:
    """One row for each depth and fingerprint; ``sound`` if its members agree on all."""
    same = ["xa", "xb", "a", "b", "chars"]
    nodes = members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("seq").alias("ref"),
        *[F.min(name).alias(name) for name in same],
        *[F.max(name).alias(f"{name}_too") for name in same],
    )
    sound = F.lit(True)
    for name in same:
        sound = sound & (F.col(name) == F.col(f"{name}_too"))
    return shared_table(nodes.select(*NODE, "conv_id", "n_convs", "ref", "xa", "xb", "chars", sound.alias("sound")), "nodes")


def _with_subtrees(nodes: DataFrame, members: DataFrame, lengths: DataFrame) -> DataFrame:
    """Children, parents, and sums over subtrees.

    Nodes with the same smallest member c follow each other down c's path: its chain. A
    subtree's sum is the rest of the node's own chain, and the whole chains of its other
    members, as these begin further down. So it is a sum over memberships, without
    going up the trie level by level.
    """
    up = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("xa").alias("fa"), F.col("xb").alias("fb"))
    nodes = nodes.join(up.agg(F.count("*").alias("n_children")), NODE, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))
    )
    nodes = nodes.withColumns(
        {
            "saved": (F.col("n_convs") - 1) * F.col("chars"),
            "leaf": (F.col("n_children") == 0).cast("bigint"),
            "bucket": F.floor(F.col("depth") / BUCKET),
        }
    )
    nodes = shared_table(nodes, "nodes-children")
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("fa").alias("xa"),
        F.col("fb").alias("xb"),
        F.col("conv_id").alias("parent_conv_id"),
        "n_children",
    )
    children = nodes.where("depth > 0").select(*NODE, "xa", "xb")
    parent = hot_join(children, parents, ["depth", "xa", "xb"], "n_children").select(*NODE, "parent_conv_id")

    rest = Window.partitionBy("conv_id", "bucket").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("conv_id").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    sums = ["saved", "leaf"]
    buckets = nodes.groupBy("conv_id", "bucket").agg(*[F.sum(n).alias(n) for n in sums])
    chains = shared_table(
        buckets.groupBy("conv_id").agg(*[F.sum(n).alias(f"{n}_chain") for n in sums])
        .join(lengths, "conv_id").withColumn("weight", F.col("length") + 1).drop("length"),
        "chains",
    )
    buckets = buckets.select(
        "conv_id", "bucket", *[F.coalesce(F.sum(n).over(later), F.lit(0)).alias(f"{n}_later") for n in sums]
    )
    along = nodes.select(
        *NODE, "conv_id", "bucket", *[F.sum(n).over(rest).alias(f"{n}_rest") for n in sums]
    ).join(buckets, ["conv_id", "bucket"]).join(chains, "conv_id")
    own = along.select(
        *NODE, *[(F.col(f"{n}_rest") + F.col(f"{n}_later") - F.col(f"{n}_chain")).alias(f"{n}_own") for n in sums]
    )
    theirs = hot_join(members.select(*NODE, "conv_id"), chains, ["conv_id"], "weight")
    theirs = theirs.groupBy(*NODE).agg(*[F.sum(f"{n}_chain").alias(f"{n}_all") for n in sums])
    return nodes.join(own, NODE).join(theirs, NODE).join(parent, NODE, "left").select(
        *NODE,
        "conv_id",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("leaf_own") + F.col("leaf_all")).alias("n_leaves"),
        (F.col("saved_own") + F.col("saved_all")).alias("saved_tokens"),
        "ref",
    )


def prefix_trie(conversations: DataFrame, modulus: int = MODULUS) -> Trie:
    """The trie of all rebuilt conversations.

    A node has ``depth``, its fingerprint ``fa`` and ``fb``, its smallest member
    ``conv_id``, its parent's, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, and ``ref``, the ``seq`` of its last turn in
    ``turns``. The root refers to no turn, so its ``ref`` is NULL.

    Rows without a ``conv_id`` belong to no conversation and are left out. NULL turns come
    first; turns that tie, repeated rows included, each count, in order of role, text (by
    their first 64 characters, then by digest). NULL roles and texts are empty. Only a
    base that is a conversation itself gives a head. Other columns are ignored, and an
    empty table gives no nodes, not even a root. ``modulus`` is a prime.
    """
    for seed in range(TRIES):
        turns = _sorted_turns(conversations, seed, modulus)
        members, lengths = _memberships(_steps(turns, modulus), modulus)
        nodes = _nodes(members)
        if nodes.where("NOT sound").isEmpty() and _same_texts(turns):
            break
    else:
        raise FingerprintCollisionError(f"{TRIES} sets of hashes modulo {modulus} had collisions")
    found = _with_subtrees(nodes, members, lengths).join(_digests(members), NODE, "left")
    return Trie(
        found.withColumns(
            {
                "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)),
                "ref": F.when(F.col("depth") > 0, F.col("ref")),
            }
        ),
        turns,
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).nodes
    numbers = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return nodes.select(*[F.col(name).cast("bigint").alias(name) for name in numbers], "ends_sha256")


# The checksum is worked out from its definition: a round for each bit of each character.
OP11_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, xor(4294967295, list_reduce(
           list_concat([4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
             lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda sum, step: CASE WHEN step >= 0 THEN xor(sum, step)
                                  WHEN sum % 2 = 1 THEN xor(sum // 2, 3988292384) ELSE sum // 2 END)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos < c.h
  UNION ALL
  SELECT conv_id, 1, pos, role, text FROM convs JOIN turns USING (conv_id) WHERE pos >= h
), hashed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth,
         md5(to_json([role, text])) AS turn, length(text) AS chars
  FROM rebuilt
), paths AS (
  SELECT conv_id, depth, chars,
         md5(list(turn) OVER (PARTITION BY conv_id ORDER BY depth)::VARCHAR) AS node
  FROM hashed
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs
), members AS (
  SELECT *, lag(node) OVER path AS above, lead(node) OVER path IS NULL AS ends
  FROM paths WINDOW path AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
  SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(chars) AS saved, bool_and(ends)::INT AS leaf,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM members GROUP BY depth, node
), subtrees AS (
  SELECT depth, node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT DISTINCT a.depth, a.node, b.depth AS d, b.node AS below
        FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND a.depth <= b.depth) p
  JOIN (SELECT depth AS d, node AS below, leaf, saved FROM nodes) n USING (d, below)
  GROUP BY depth, node
), children AS (
  SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, sha256(n.ids) AS ends_sha256
FROM nodes n
JOIN subtrees s USING (depth, node)
LEFT JOIN children c USING (depth, node)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.above
"""
