"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A 64-bit fingerprint is cut into ``m`` blocks. Two fingerprints that differ in at most
``k`` bits agree on at least ``m - k`` whole blocks, so they meet under one of the
``C(m, k)`` keys made of ``m - k`` blocks each. The join is on these keys, and every pair
that meets is checked by its Hamming distance. ``m`` follows the number of different
fingerprints, so that few meet by chance; any ``m`` finds the same links.

Equal fingerprints are one node. Of a key's fingerprints a task reports the edges of a
spanning forest of their links, never all pairs. A key with more than ``TILE``
fingerprints is cut into tiles, and each pair of tiles is a group of its own: every pair
of fingerprints still meets, and no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfspace.llm.common import documents, hot_join, one_row_each, shared_table, slices
from halfspace.llm.components import connected_components

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42

# Fingerprints of one key that are compared in one group.
TILE = 4096
# Shingles whose hash bits are added up at a time, so that a text of any length fits.
BLOCK = 1 << 16

_MIX = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """SimHash of the word shingles of a UTF-8 text, A-Z lower-cased, repeats included."""
    found = text.lower().split()  # of bytes: A-Z, and the six ASCII white spaces
    if not found:
        return 0
    joined = b" ".join(found)
    size = min(words, len(found))
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(found) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK], ends[at : at + BLOCK], strict=True)
        hashes = np.array([hashed(joined[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    over_half = ones * 2 > len(starts)
    return int(np.packbits(over_half, bitorder="little").view("<u8")[0])


def mixed(prints: np.ndarray) -> np.ndarray:
    """Node ids of fingerprints: one to one, but spread like hashes."""
    x = prints.astype(np.uint64) * _MIX
    return x ^ (x >> np.uint64(32))


def digest(text: Column) -> Column:
    """SHA-256 of a text's bytes; NULL stays NULL."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def fingerprints(docs: DataFrame, words: int = SHINGLE, digests: bool = False) -> DataFrame:
    """doc_id, ``print`` (the fingerprint's bits as a bigint) and ``node`` of each row.

    With ``digests``, also ``sha``, the digest of its text.
    """
    more = ["sha"] if digests else []

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = part.column("text").to_pylist()
            prints = np.array([fingerprint(t or b"", words) for t in texts], np.uint64)
            yield pa.record_batch(
                [part.column("doc_id"), prints.view(np.int64), mixed(prints).view(np.int64)]
                + [part.column(name) for name in more],
                names=["doc_id", "print", "node", *more],
            )

    text = F.col("text")
    raw = docs.select(
        F.col("doc_id").cast("bigint"), text.cast("binary"), digest(text).alias("sha")
    ).select("doc_id", "text", *more)
    kinds = ["doc_id bigint", "print bigint", "node bigint", *(f"{name} binary" for name in more)]
    return raw.mapInArrow(rows, ", ".join(kinds))


def block_layout(count: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(shift, width) of the fewest blocks whose keys outnumber ``count`` fingerprints."""
    for m in range(distance + 1, 17):
        edges = [round(i * BITS / m) for i in range(m + 1)]
        blocks = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
        if sum(width for _, width in blocks[: m - distance]) >= np.log2(max(count, 2)) + 1:
            break
    return blocks


def _keys(blocks: list[tuple[int, int]], distance: int):
    """An array of the keys of a fingerprint: its blocks without ``distance`` of them."""
    keys = []
    for number, chosen in enumerate(combinations(blocks, len(blocks) - distance)):
        mask = sum(((1 << width) - 1) << shift for shift, width in chosen)
        mask -= (mask >> 63) << 64  # as a signed number
        keys.append(F.xxhash64(F.lit(number), F.col("print").bitwiseAND(F.lit(mask).cast("bigint"))))
    return F.array(*keys)


def forest(prints: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Index pairs of a spanning forest of the links among different fingerprints."""
    edges = []
    left = np.arange(len(prints))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(prints[left] ^ prints[node]) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                edges += [(node, int(x)) for x in found]
                queue += found.tolist()
    return edges


def _linked(distance: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges within runs of equal (key, tile); the input is sorted by them."""
        held = np.empty((0, 3), np.int64)

        def edges(runs: np.ndarray) -> pa.RecordBatch | None:
            prints = runs[:, 2].view(np.uint64) if runs.flags.c_contiguous else None
            prints = np.ascontiguousarray(runs[:, 2]).view(np.uint64) if prints is None else prints
            same = (runs[1:, 0] == runs[:-1, 0]) & (runs[1:, 1] == runs[:-1, 1])
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            sizes = np.diff(np.append(starts, len(runs)))
            a, b = [], []
            for size in (2, 3):  # nearly all runs: compared for all of them at once
                at = starts[sizes == size]
                for i, j in combinations(range(size), 2):
                    near = np.bitwise_count(prints[at + i] ^ prints[at + j]) <= distance
                    a.append(prints[at[near] + i])
                    b.append(prints[at[near] + j])
            for start, size in zip(starts[sizes > 3], sizes[sizes > 3], strict=True):
                run = prints[start : start + size]
                pairs = np.array(forest(run, distance), np.int64).reshape(-1, 2)
                a.append(run[pairs[:, 0]])
                b.append(run[pairs[:, 1]])
            a, b = mixed(np.concatenate(a)).view(np.int64), mixed(np.concatenate(b)).view(np.int64)
            return pa.record_batch([np.minimum(a, b), np.maximum(a, b)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "tile", "print")]
            held = np.concatenate([held, np.stack(columns, axis=1)])
            last = len(held) - 1
            if last < 0:
                continue
            changes = np.flatnonzero((held[:, :2] != held[last, :2]).any(axis=1))
            cut = int(changes[-1]) + 1 if len(changes) else 0
            if cut:
                yield edges(held[:cut])
                held = held[cut:]
        if len(held):
            yield edges(held)

    return rows


def links(prints: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Edges ``a``, ``b`` (node ids) that connect all fingerprints within ``distance``.

    ``prints`` holds each fingerprint once, as ``print``.
    """
    blocks = block_layout(prints.count(), distance)
    keyed = prints.select(F.explode(_keys(blocks, distance)).alias("key"), "print")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"))
    tiles = F.ceil(F.col("n") / tile).cast("int")
    # A written table, so Spark knows its size and broadcasts it only if it is small.
    crowded = shared_table(sizes.where(F.col("n") > tile).select("key", tiles.alias("tiles")), "blocks")
    mine = F.pmod(F.xxhash64("print"), F.col("tiles")).cast("int")
    others = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: t != mine),
        lambda t: F.least(t, mine).cast("bigint") * F.col("tiles") + F.greatest(t, mine),
    )
    alone = F.array(F.lit(0).cast("bigint"))
    spread = keyed.join(crowded, "key", "left").select(
        "key",
        F.explode(F.when(F.col("tiles").isNull(), alone).otherwise(others)).alias("tile"),
        "print",
    )
    met = spread.repartition("key", "tile").sortWithinPartitions("key", "tile")
    return met.mapInArrow(_linked(distance), "a bigint, b bigint").distinct()


def _classes(docs: DataFrame, words: int, distance: int, digests: bool = False) -> DataFrame:
    """The fingerprints of every row, with its component's ``label`` and ``component_id``."""
    rows = shared_table(fingerprints(docs, words, digests), "prints")
    nodes = shared_table(
        rows.groupBy("print", "node").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")),
        "nodes",
    )
    edges = shared_table(links(nodes.select("print"), distance), "links")
    labels = connected_components(edges)
    labelled = shared_table(
        nodes.join(labels, "node", "left").select(
            "node", "n", "least", F.coalesce("label", "node").alias("label")
        ),
        "labelled",
    )
    smallest = shared_table(
        labelled.groupBy("label").agg(
            F.min("least").alias("component_id"), F.count("*").alias("n_nodes")
        ),
        "smallest",
    )
    of_node = shared_table(
        hot_join(labelled, smallest, ["label"], "n_nodes").select(
            "node", "n", "label", "component_id"
        ),
        "classes",
    )
    return hot_join(rows, of_node, ["node"], "n")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Rows whose fingerprints differ in at most ``distance`` bits are linked;
    ``component_id`` is the smallest id reachable over links, the row's own included.

    NULL, empty and blank texts have fingerprint zero and are linked as any other. A row
    without an id is linked, but its id is not a candidate for the smallest, unless the
    component has no other (then ``component_id`` is NULL). Equal texts are rows of one
    component; rows that repeat an id lie where their texts do. Other columns are ignored;
    an empty table gives an empty result.
    """
    return _classes(docs, words, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_representatives(
    docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all columns.

    One row stays for each component, whatever the ids: of rows that repeat the smallest
    id, or of a component whose rows all lack one, the one whose text has the smallest
    digest. Components are told apart by their label, and rows by id and digest.
    """
    classes = _classes(docs, words, distance, digests=True)
    first = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = first.groupBy("label", "component_id").agg(F.min(F.struct("sha")).alias("least"))
    return one_row_each(
        docs,
        kept.select(F.col("component_id").alias("doc_id"), F.col("least.sha").alias("sha")),
        {"doc_id": F.col("doc_id").cast("bigint"), "sha": digest(F.col("text"))},
    )


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
