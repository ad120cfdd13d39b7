"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``SLOTS`` equal slots by the hash of the document's id and its text's
checksum, so that an id that many rows share does not fill one slot. Rows equal in both are
cut into chunks of bounded size, which the hash tells apart as well. Each shard stands on it at ``VNODES`` pseudo-random slots. A slot's rows belong to the first
shard clockwise that is not full. A shard is full when its load has reached the bound,
``(1 + EPSILON)`` times the mean; slots it then has no room for continue clockwise. So
no shard exceeds the bound by more than one slot, and adding a shard moves little more
than the new shard's share.

Loads are decided on the table of slots, whose size does not depend on the input, in at
most one round per shard: a shard that turns slots away is full and takes no more. Only
DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halfspace.llm.common import documents, shared_table

SLOTS = 1 << 16
VNODES = 128
EPSILON = 0.002
# Equal rows of more than this share of a shard's mean load are cut into chunks of it.
CHUNK_SHARE = 1 / 512


def ring(spark: SparkSession, shards: int, vnodes: int = VNODES) -> DataFrame:
    """For each slot, ``walk``: all shards in the order met clockwise from it.

    A virtual node's place depends on its shard and number alone. The table has
    ``SLOTS`` rows.
    """
    nodes = spark.range(shards).select(
        F.col("id").cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(vnodes - 1))).alias("vnode"),
    )
    place = F.pmod(F.xxhash64(F.lit("vnode"), "shard", "vnode"), F.lit(SLOTS)).cast("int")
    # One entry per place; the ring is walked once round, so places are repeated above it.
    nodes = nodes.select(place.alias("place"), "shard").groupBy("place").agg(
        F.min("shard").alias("shard")
    )
    around = F.collect_list(F.struct("place", "shard"))
    sorted_nodes = nodes.agg(F.sort_array(around).alias("nodes"))
    slots = spark.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    # The arcs between virtual nodes: all slots of an arc share a walk.
    ends = sorted_nodes.select(
        F.posexplode("nodes").alias("arc", "node"), "nodes"
    ).select(
        "arc",
        F.col("node.place").alias("place"),
        F.array_distinct(
            F.transform(
                F.concat(
                    F.slice("nodes", F.col("arc") + 1, F.size("nodes")),
                    F.slice("nodes", F.lit(1), F.col("arc")),
                ),
                lambda node: node.getField("shard"),
            )
        ).alias("walk"),
    )
    before = Window.orderBy("place")  # at most shards * vnodes rows
    arcs = ends.withColumn("after", F.coalesce(F.lag("place").over(before), F.lit(-1)))
    last = ends.agg(F.max("place").alias("last"), F.min(F.struct("place", "walk")).alias("first"))
    inside = arcs.select(
        F.explode(F.sequence(F.col("after") + 1, F.col("place"))).alias("slot"), "walk"
    )
    wrapped = last.where(F.col("last") < SLOTS - 1).select(
        F.explode(F.sequence(F.col("last") + 1, F.lit(SLOTS - 1))).alias("slot"),
        F.col("first.walk").alias("walk"),
    )
    return slots.join(inside.unionByName(wrapped), "slot")


def _slot() -> Column:
    return F.shiftrightunsigned("key", 48).cast("int").alias("slot")


def place_slots(sizes: DataFrame, walks: DataFrame, shards: int, epsilon: float) -> DataFrame:
    """The shard of each slot, given each slot's ``size``; the rounds of the bounded loads.

    The state is one table of at most ``SLOTS`` rows, written anew in every round; the
    driver sees one row per shard.
    """
    # Written first, so that one task below reads a row for each slot, not for each task.
    sizes = shared_table(sizes, "slot-sizes")
    slots = shared_table(
        sizes.join(walks, "slot").withColumn("shard", F.lit(None).cast("int")).coalesce(1),
        "ring",
    )
    total = slots.agg(F.sum("size")).first()[0] or 0
    bound = total * (1 + epsilon) / shards
    loads = dict.fromkeys(range(shards), 0)
    full: set[int] = set()
    for _ in range(shards + 1):
        taken = F.array(*[F.lit(s) for s in sorted(full)]).cast("array<int>")
        free = F.filter("walk", lambda s: ~F.array_contains(taken, s))
        wish = F.when(F.col("shard").isNull(), F.get(free, 0))
        load = F.element_at(
            F.create_map(*[F.lit(x) for s, n in loads.items() for x in (s, float(n))]),
            F.col("wish"),
        )
        # The order in which a shard takes slots is a hash of the slot, not its place.
        order = Window.partitionBy("wish").orderBy(F.xxhash64(F.lit("turn"), "slot"), "slot")
        ahead = F.coalesce(
            F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
        tried = slots.withColumn("wish", wish).withColumn(
            "fits", F.col("wish").isNotNull() & (ahead + load < F.lit(bound))
        )
        state = tried.select(
            "slot",
            "size",
            "n_rows",
            "walk",
            F.coalesce("shard", F.when(F.col("fits"), F.col("wish"))).alias("shard"),
            F.when(~F.col("fits"), F.col("wish")).alias("turned_from"),
        )
        written = shared_table(state.coalesce(1), "ring")
        for row in written.groupBy("shard").agg(F.sum("size").alias("n")).collect():
            if row.shard is not None:
                loads[row.shard] = row.n
        turned = written.where("turned_from IS NOT NULL").select("turned_from").distinct()
        turned_from = {row.turned_from for row in turned.collect()}
        slots = written.drop("turned_from")
        if not turned_from:
            break
        full |= turned_from
    return slots


def _chunked(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with their ``key`` on the ring: equal rows beyond a chunk's size get others.

    There are at most ``shards / CHUNK_SHARE`` groups of equal rows that are larger, so they
    are broadcast. Their rows are numbered inside the parts of the written table, and the
    parts by what lies before them; which of equal rows has which number does not matter.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    chunk = max(1, int(total * CHUNK_SHARE / shards))
    groups = rows.groupBy("key", "size").agg(F.count("*").alias("n"))
    large = groups.where(F.col("n") * F.col("size") > chunk).select("key", "size")
    large = shared_table(large, "shard-large")
    if large.isEmpty():
        return rows
    on = ["key", "size"]
    here = rows.join(F.broadcast(large), on)
    before = Window.partitionBy(*on).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = here.groupBy(*on, "part").agg(F.count("*").alias("n"))
    parts = parts.select(*on, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy(*on, "part").orderBy("seq")
    numbered = here.withColumn("place", F.row_number().over(inside) - 1).join(parts, [*on, "part"])
    each = F.greatest(F.floor(F.lit(chunk) / F.col("size")), F.lit(1))
    number = F.floor((F.col("place") + F.col("earlier")) / each)
    moved = F.when(number > 0, F.xxhash64("key", number)).otherwise(F.col("key"))
    spread = numbered.withColumn("key", moved).select(*rows.columns)
    rest = rows.join(F.broadcast(large), on, "left_anti")
    return shared_table(rest.unionByName(spread), "shard-chunks")


def assign_shards(
    docs: DataFrame, shards: int = 8, epsilon: float = EPSILON, vnodes: int = VNODES
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in its shard) of each row.

    The size is the text's UTF-8 bytes plus one; a NULL text has none, an empty one
    neither. The ring's key is the id with the text's checksum: rows without an id, or that
    repeat one, are spread by their texts, and rows that are equal in both by chunks. Other columns are ignored, and an empty table gives
    an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumns(
        {
            "key": F.xxhash64("doc_id", "text_crc32"),
            "part": F.spark_partition_id(),
            "seq": F.monotonically_increasing_id(),
        }
    )
    rows = _chunked(shared_table(rows, "shard-rows"), shards).drop("part", "seq")
    sizes = rows.groupBy(_slot()).agg(
        F.sum("size").alias("size"), F.count("*").alias("n_rows")
    )
    placed = place_slots(sizes, ring(docs.sparkSession, shards, vnodes), shards, epsilon)
    # Where each slot's rows begin in their shard: a running count over the bounded table.
    earlier = (
        Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    base = F.coalesce(F.sum("n_rows").over(earlier), F.lit(0))
    bases = shared_table(
        placed.select("slot", "shard", base.alias("base")).coalesce(1), "ring-bases"
    )
    number = F.row_number().over(Window.partitionBy("slot").orderBy("key", "doc_id", "text_crc32", "size"))
    numbered = rows.withColumn("slot", _slot()).withColumn("number", number)
    return numbered.join(F.broadcast(bases), "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("base") + F.col("number") - 1).alias("slot"),
    )


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
