"""Passages that occur more than once, by a column-wise multi-document construction.

A string of ``length`` bytes (a window) is tied to its anchor: the ``GRAM``-byte string
in it with the smallest hash, the leftmost of several. The choice depends on the window's
bytes alone, so equal windows have equal anchors at equal places. Neighbouring windows
with one anchor are a segment. Only segments whose anchor's key occurs again are cut out
of the texts. Laid over each other at their anchors, they are a collection of short
documents in which equal windows begin in one column.

The collection's Burrows-Wheeler order is built column by column from the right. In a
round each document inserts one symbol, and the order of the suffixes that begin in this
column and the common prefixes of neighbours follow from those of the column before.
Windows are repeated where a common prefix reaches ``length``. Suffixes of other columns
can't share a window, so a round needs the order of one column only, and each byte of a
segment is touched once.

The collection lies in files in the shared folder, grouped by key; a task reads its keys
one after another and holds one batch of groups. Equal segments are one document with a
count. A group of more than ``MOST_SEGMENTS`` different ones is halved by columns, and
each half is dealt out anew by the bytes that all its windows share, until groups are
small; where a half is one column, equal keys are equal windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfspace.llm.common import documents, hot_join, shared_table, slices
from halfspace.workspace import fresh_dir

LENGTH = 200
GRAM = 48
# Different segments with one key that a task takes together.
MOST_SEGMENTS = 16_384
# Bytes of segments that are laid over each other at a time, and window starts that are
# hashed at a time; a group or a text may be longer.
BATCH_BYTES = 4 * 1024 * 1024
BLOCK = 1 << 20

ANCHORS = "row bigint, start bigint, stop bigint, until bigint, first int, key bigint"
SEGMENTS = "row bigint, start bigint, until bigint, first int, key bigint, bytes binary, times bigint"
FOUND = "key bigint, sid binary, spans array<struct<low:int,high:int>>"
DONE = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary"

_FACTOR = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93
_PLACE_BITS = 21


class Anchors:
    """Finds the segments of texts: runs of windows that have one anchor."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, min(gram, length)
        size = BLOCK + length
        inverse = pow(_FACTOR, -1, 1 << 64)
        self.powers = self._powers(_FACTOR, size)
        self.inverses = self._powers(inverse, size)
        self.letters = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)

    @staticmethod
    def _powers(factor: int, size: int) -> np.ndarray:
        factors = np.full(size, factor, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of each ``gram`` bytes, wherever they stand."""
        weighted = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], out=weighted[1:])
        sums = weighted[self.gram :] - weighted[: -self.gram]
        sums *= self.inverses[: len(sums)]
        sums ^= sums >> np.uint64(32)
        sums *= np.uint64(_MIX)
        sums ^= sums >> np.uint64(32)
        return sums

    def segments(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Arrays text, start, stop, until, first and key, a block of the texts at a time.

        ``data`` holds texts one after another, and ``ends`` where each ends. ``start``
        and ``stop`` are a segment's first and last window, counted in its text, and
        ``first`` is the column of ``start``, its place less the anchor's. Segments that
        follow each other and are equal are one, with windows as far as ``until``.
        """
        begins = np.concatenate([[0], ends[:-1]])
        span = self.length - self.gram + 1
        low = np.uint64((1 << _PLACE_BITS) - 1)
        for at in range(0, len(data) - self.length + 1, BLOCK):
            piece = data[at : at + BLOCK + self.length - 1]
            count = len(piece) - self.length + 1
            hashes = self.hashes(piece)
            ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
            anchor = (_least(ranked, span) & low).astype(np.int64)
            inside = ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + count)]
            text = np.zeros(count, np.int64)
            np.add.at(text, inside - at, 1)
            text = np.cumsum(text) + np.searchsorted(ends, at, "right")
            windows = np.flatnonzero(np.arange(at, at + count) + self.length <= ends[text])
            if not len(windows):
                continue
            changes = (np.diff(anchor[windows]) != 0) | (np.diff(windows) != 1)
            firsts = windows[np.concatenate([[True], changes])]
            lasts = windows[np.concatenate([changes, [True]])]
            anchors = anchor[firsts]
            key = hashes[anchors].view(np.int64)
            of = text[firsts]
            same = np.flatnonzero(
                (key[1:] == key[:-1])
                & (of[1:] == of[:-1])
                & (firsts[1:] == lasts[:-1] + 1)
                & (np.diff(lasts) == np.diff(firsts))
            )
            keep, until = np.ones(len(firsts), bool), lasts.copy()
            raw = piece.tobytes() if len(same) else b""
            for i in same.tolist():
                a, b, n = firsts[i], firsts[i + 1], lasts[i] - firsts[i] + self.length
                keep[i + 1] = raw[a : a + n] != raw[b : b + n]
            # A dropped segment lengthens the last kept one before it.
            groups = np.cumsum(keep) - 1
            np.maximum.at(until, np.flatnonzero(keep)[groups], lasts)
            shift = at - begins[of]
            columns = of, firsts + shift, lasts + shift, until + shift, firsts - anchors, key
            yield tuple(column[keep] for column in columns)


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` neighbours (van Herk: block-wise running minima)."""
    n = len(values)
    padded = np.full(-(-n // span) * span, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - span + 1], ahead[span - 1 : n])


def repeated_windows(
    groups: np.ndarray, first: np.ndarray, texts: list[bytes], length: int
) -> list[np.ndarray]:
    """For each segment, which of its windows another segment of its group has as well.

    ``groups`` are numbers in rising order, and ``first`` is the column of each
    segment's first byte. One round for each column, from the last to the first:

    ``order`` holds the segments that have bytes behind the column, sorted by group and
    by these bytes, and ``common[i]`` is the common prefix of neighbours i - 1 and i.
    Each of them, and each segment that ends here, puts its symbol in front. A stable
    sort by group and symbol gives the new order. Neighbours with one symbol have it and
    the least prefix between them in common; others nothing.
    """
    sizes = np.array([len(text) for text in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    base = np.cumsum(sizes) - sizes - first  # where column 0 of each segment would be
    end = first + sizes
    last = end - length
    windows = sizes - length + 1
    out = np.zeros(int(windows.sum()), bool)
    at = np.cumsum(windows) - windows - first
    entering = np.argsort(-end, kind="stable")
    entered = 0
    order = np.zeros(0, np.int64)
    common = np.zeros(1, np.int64)
    falling = -end[entering]
    for column in range(int(end.max()) - 1, int(first.min()) - 1, -1):
        until = int(np.searchsorted(falling, -column, "left"))
        if until > entered:
            new = entering[entered:until]
            entered = until
            common = np.concatenate([np.zeros(len(new), np.int64), common])
            order = np.concatenate([new, order])
        here = first[order] <= column
        if not here.all():
            # What leaves hands its prefix on to its follower.
            at_kept = np.flatnonzero(here)
            if not len(at_kept):
                order, common = order[:0], np.zeros(1, np.int64)
                continue
            begins = np.concatenate([[0], at_kept[:-1] + 1])
            common = np.concatenate([np.minimum.reduceat(common[: at_kept[-1] + 1], begins), [0]])
            order = order[at_kept]
        symbol = groups[order] << 8 | data[base[order] + column]
        moved = np.argsort(symbol, kind="stable")
        symbol = symbol[moved]
        alike = np.flatnonzero(symbol[1:] == symbol[:-1])
        prefixes = np.zeros(len(order) + 1, np.int64)
        if len(alike):
            bounds = np.empty(2 * len(alike), np.int64)
            bounds[::2] = moved[alike] + 1
            bounds[1::2] = moved[alike + 1] + 1
            prefixes[alike + 1] = np.minimum.reduceat(common, bounds)[::2] + 1
        order, common = order[moved], prefixes
        enough = np.maximum(common[:-1], common[1:]) >= length
        hit = order[enough]
        hit = hit[last[hit] >= column]
        out[at[hit] + column] = True
    return np.split(out, np.cumsum(windows)[:-1])


def _runs(marked: np.ndarray) -> np.ndarray:
    """First and last place of each run of marked places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return np.stack([edges[::2], edges[1::2] - 1], axis=1)


def _anchors_of(length: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, GRAM)
        names = [field.split()[0] for field in ANCHORS.split(", ")]
        for part in slices(batches, "text"):
            texts = part.column("text")
            ends = np.cumsum(pa.compute.binary_length(texts).to_numpy()).astype(np.int64)
            data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
            rows = part.column("row").to_numpy()
            for text, *rest in finder.segments(data, ends):
                *places, first, key = rest
                columns = [rows[text], *places, first.astype(np.int32), key]
                yield pa.record_batch([pa.array(c) for c in columns], names)

    return anchors


def _cut(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in SEGMENTS.split(", ")]
        types = [*[pa.int64()] * 3, pa.int32(), pa.int64(), pa.binary(), pa.int64()]

        def batch(held: list[tuple]) -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        held, size = [], 0
        for part in slices(batches, "text"):
            rows = (part.column(c).to_pylist() for c in ("row", "text", "places"))
            for row, text, places in zip(*rows, strict=True):
                for place in places:
                    start, stop, until = place["start"], place["stop"], place["until"]
                    piece = text[start : stop + length]
                    held.append((row, start, until, place["first"], place["key"], piece, 1 + (until > stop)))
                    size += len(piece)
                    if size > BATCH_BYTES:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    return cut


def _compare(length: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in FOUND.split(", ")[:2]] + ["spans"]
        pair = pa.struct([("low", pa.int32()), ("high", pa.int32())])
        types = [pa.int64(), pa.binary(), pa.list_(pair)]

        def results(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            keys, sids, firsts, texts = (list(c) for c in zip(*held, strict=True))
            numbers = np.cumsum([0, *(a != b for a, b in zip(keys[1:], keys, strict=False))])
            marks = repeated_windows(numbers, np.array(firsts, np.int64), texts, length)
            rows = [
                (key, sid, [{"low": first + a, "high": first + b} for a, b in _runs(mark).tolist()])
                for key, sid, first, mark in zip(keys, sids, firsts, marks, strict=True)
                if mark.any()
            ]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        held, size = [], 0
        for part in slices(batches, "bytes"):
            rows = zip(*(part.column(c).to_pylist() for c in ("key", "sid", "first", "bytes")), strict=True)
            for row in rows:
                if size > BATCH_BYTES and row[0] != held[-1][0]:
                    yield from results(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from results(held)

    return compare


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in DONE.split(", ")[:2]] + ["spans", "kept"]
    pair = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    for part in slices(batches, "text"):
        texts, spans, kept = part.column("text").to_pylist(), [], []
        for text, found in zip(texts, part.column("found").to_pylist(), strict=True):
            runs: list[list[int]] = []
            for piece in sorted((p["start"], p["stop"]) for p in found or ()):
                if runs and piece[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], piece[1])
                else:
                    runs.append([*piece])
            edges = [0, *(edge for run in runs for edge in run), len(text)]
            left = (text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            kept.append(b"".join(left) if runs else text)
            spans.append([{"start": a, "stop": b} for a, b in runs])
        sizes = pa.array([len(text) for text in texts], pa.int64())
        columns = [part.column("doc_id"), sizes, pa.array(spans, pa.list_(pair)), pa.array(kept, pa.binary())]
        yield pa.record_batch(columns, names)


def _bucketed(docs: DataFrame) -> DataFrame:
    """The texts with a number for each row, in files by that number.

    Two joins by ``row`` follow, and the files spare the texts a shuffle in both.
    """
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    name = f"halfspace_texts_{uuid.uuid4().hex}"
    writer = numbered.repartition(count, "row").write.format("parquet").bucketBy(count, "row")
    path = fresh_dir(spark, "repeat-texts")
    writer.option("compression", "zstd").option("path", path).saveAsTable(name)
    table = spark.table(name)
    # The files stay, as the table is an external one; the name has done its work.
    spark.sql(f"DROP TABLE {name}")
    return table


def _found(distinct: DataFrame, length: int, most: int) -> DataFrame:
    """key, sid and the repeated windows of different segments, as columns low to high.

    ``distinct`` has key, sid, first, bytes, times, and the columns ``least`` to
    ``greatest`` among which windows with this key begin.
    """
    counts = distinct.groupBy("key").agg(F.count("*").alias("held"))
    counts = shared_table(counts.where("held > 1"), "repeat-groups")
    whole = distinct.where("times > 1").select(
        "key",
        "sid",
        F.expr(f"array(named_struct('low', first, 'high', first + length(bytes) - {length}))").alias("spans"),
    )
    # Equal anchors with different surroundings; those of a large group are dealt anew.
    rows = distinct.join(counts, "key")
    small = rows.where(F.col("held") <= most).select("key", "sid", "first", "bytes")
    compared = small.repartition("key").sortWithinPartitions("key", "sid").mapInArrow(_compare(length), FOUND)
    found = whole.unionByName(compared)
    if counts.where(F.col("held") > most).isEmpty():
        return found
    middle = F.expr("cast(floor((least + greatest + 1) / 2) as int)")
    halves = rows.where(F.col("held") > most).withColumn("middle", middle).select(
        F.col("key").alias("old_key"),
        F.col("sid").alias("old_sid"),
        "first",
        "bytes",
        "times",
        F.expr(f"first + length(bytes) - {length}").alias("last"),
        F.explode(
            F.expr("array(struct(least, middle - 1 as greatest), struct(middle as least, greatest))")
        ).alias("range"),
    )
    halves = halves.select(
        "old_key",
        "old_sid",
        "times",
        "first",
        "bytes",
        F.expr("greatest(first, range.least)").alias("low"),
        F.expr("least(last, range.greatest)").alias("high"),
        "range.least",
        "range.greatest",
    ).where("low <= high AND least <= greatest")
    halves = halves.select(
        "old_key",
        "old_sid",
        "times",
        "least",
        "greatest",
        F.col("low").alias("first"),
        F.expr(f"substring(bytes, low - first + 1, high - low + {length})").alias("bytes"),
        F.expr(f"substring(bytes, greatest - first + 1, least + {length} - greatest)").alias("core"),
    )
    key = F.xxhash64("old_key", "least", "core").alias("key")
    halves = shared_table(
        halves.select(
            "old_key", "old_sid", "times", "least", "greatest", "first", "bytes", key, _digest().alias("sid")
        ),
        "repeat-halves",
    )
    again = _distinct(halves)
    below = _found(again, length, most).groupBy("key", "sid").agg(
        F.flatten(F.collect_list("spans")).alias("spans")
    )
    below = shared_table(
        again.select("key", "sid", "rows").join(below, ["key", "sid"]), "repeat-halves-found"
    )
    links = halves.select("key", "sid", "old_key", "old_sid")
    mapped = hot_join(links, below, ["key", "sid"], "rows")
    return found.unionByName(
        mapped.select(F.col("old_key").alias("key"), F.col("old_sid").alias("sid"), "spans")
    )


def _digest() -> Column:
    """Tells segments apart by their bytes and by the column that these begin in."""
    column = F.concat(F.col("first").cast("string"), F.lit(":")).cast("binary")
    return F.unhex(F.sha2(F.concat(column, "bytes"), 256))


def _distinct(segments: DataFrame) -> DataFrame:
    """One row for each different segment with a key; equal ones meet inside the tasks first."""
    return shared_table(
        segments.groupBy("key", "sid").agg(
            F.min("first").alias("first"),
            F.min("least").alias("least"),
            F.min("greatest").alias("greatest"),
            F.first("bytes").alias("bytes"),
            F.sum("times").alias("times"),
            F.count("*").alias("rows"),
        ),
        "repeat-distinct",
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST_SEGMENTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans and kept.

    Texts are UTF-8 bytes. ``spans`` are the maximal runs of bytes (start, stop) covered
    by strings of ``length`` bytes that start at least twice in all texts, and ``kept``
    is what is left.

    A NULL or empty text, and one shorter than ``length``, has nothing to remove. Rows
    are texts of their own, so a row that repeats an id or a text is a second
    place of its strings; a NULL id stays NULL. Ties don't arise. Other columns are
    ignored; an empty table gives an empty result. A text of any length is hashed in
    blocks, but it and its spans are one task's work.
    """
    if length < 1:
        raise ValueError("length has to be 1 at least")
    texts = _bucketed(docs)
    anchors = shared_table(texts.select("row", "text").mapInArrow(_anchors_of(length), ANCHORS), "anchors")
    weight = F.when(F.col("until") > F.col("stop"), 2).otherwise(1)
    again = anchors.groupBy("key").agg(F.sum(weight).alias("times"), F.count("*").alias("rows"))
    again = shared_table(again.where("times > 1").select("key", "rows"), "repeat-keys")
    place = F.struct("start", "stop", "until", "first", "key")
    wanted = hot_join(anchors, again, ["key"], "rows").groupBy("row").agg(F.collect_list(place).alias("places"))
    cut = texts.select("row", "text").join(wanted, "row").mapInArrow(_cut(length), SEGMENTS)
    segments = shared_table(cut.withColumn("sid", _digest()), "repeat-segments")
    columns = {"least": F.lit(min(GRAM, length) - length), "greatest": F.lit(0)}
    distinct = _distinct(segments.withColumns(columns))
    found = _found(distinct, length, most).groupBy("key", "sid").agg(
        F.flatten(F.collect_list("spans")).alias("spans")
    )
    found = shared_table(distinct.select("key", "sid", "rows").join(found, ["key", "sid"]), "repeat-found")
    places = segments.select("row", "start", "until", "first", "key", "sid", F.length("bytes").alias("size"))
    spans = hot_join(places, found, ["key", "sid"], "rows").select(
        "row",
        F.expr(
            f"""CASE WHEN until > start + size - {length}
                     THEN array(named_struct('start', start, 'stop', until + {length}))
                     ELSE transform(spans, s -> named_struct('start', start + s.low - first,
                                                             'stop', start + s.high - first + {length})) END"""
        ).alias("found"),
    )
    by_row = spans.groupBy("row").agg(F.flatten(F.collect_list("found")).alias("found"))
    return texts.join(by_row, "row", "left").select("doc_id", "text", "found").mapInArrow(_remove, DONE)


def op13_repeated_passages(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
