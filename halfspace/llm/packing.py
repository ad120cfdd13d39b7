"""Bounded-space online packing of tokens into sequences.

Each task reads its rows once, in order, and keeps a fixed number of open windows. Whole
windows of a long document become sequences of their own. What is left of it goes to the
open window it fits best. When it fits none and no more may be opened, the fullest
window is emitted, after the piece has given it its head if the gap is worth a cut.
Windows that are still open at the end of a task are merged: groups of tasks hand
their leftovers to one task, which packs them the same way.

The tokens are those of a byte-level BPE given as a tokenizer file.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfspace.llm.common import documents, shared_table, slices

WINDOW = 2048
OPEN_WINDOWS = 64
# A gap of fewer tokens is padded; a larger one takes the head of the next piece.
LEAST_CUT = 16
# Tasks whose leftovers are merged together: this many times OPEN_WINDOWS windows at most.
MERGE = 8
END_ID = 1

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, leftover boolean"
)
COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


class Tokenizer:
    """The ids of a byte-level BPE.

    ``encode`` gives what the tokenizer file's library gives by default when it adds no
    special tokens: the file's added tokens are cut out of the text wherever it holds
    them, and each is one id. ``ids`` and ``exact`` take such a token as plain text.

    The vocabulary is read from the tokenizer file. Its merges are listed by the id they
    make, so an id is also a rank, and the ranks are handed to tiktoken, which merges in
    the same order several times as fast. A text that its regular expression gives up
    on goes to the tokenizer file's own library.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        added = model.get("added_tokens", [])
        special = {token["content"]: token["id"] for token in added}
        byte_of = _printable_bytes()
        ranks = {
            bytes(byte_of[c] for c in token): number
            for token, number in model["model"]["vocab"].items()
            if token not in special
        }
        self.path = path
        self.special = special
        # The longest first, as of several that begin at one place the library takes it.
        longest = sorted(special, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest))})") if special else None
        # Tokens that also take white space, or whole words only, are left to the library.
        options = ("single_word", "lstrip", "rstrip", "normalized")
        self.simple = not any(token.get(option) for token in added for option in options)
        self.fast = tiktoken.Encoding(
            "vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.slow = self.default = None

    def encode(self, text: str) -> list[int]:
        if not self.cut or (self.simple and not self.cut.search(text)):
            return self.ids(text)
        if not self.simple:
            return self._by_default(text)
        out = []
        for piece in self.cut.split(text):
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                out += self.ids(piece)
        return out

    def _by_default(self, text: str) -> list[int]:
        if self.default is None:
            from tokenizers import Tokenizer as Library

            self.default = Library.from_file(self.path)
        return self.default.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as error:  # a Rust panic is not an Exception
            if isinstance(error, KeyboardInterrupt | SystemExit | MemoryError):
                raise
            return self.exact(text)

    def exact(self, text: str) -> list[int]:
        if self.slow is None:
            from tokenizers import Tokenizer as Library

            self.slow = Library.from_file(self.path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids


def _printable_bytes() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 stands for itself; the other bytes, in order, for what follows 255.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Window:
    free: int
    pieces: list = field(default_factory=list)


class Packer:
    """Packs pieces (doc_id, start, ids, doc_tokens) with a fixed number of open windows."""

    def __init__(self, size: int, most_open: int, least_cut: int):
        self.size, self.most_open, self.least_cut = size, most_open, least_cut
        self.open: list[Window] = []

    def add(self, doc_id, start: int, ids: array, total: int) -> Iterator[Window]:
        """Place a piece; yields the windows that are done."""
        whole = len(ids) - len(ids) % self.size
        for at in range(0, whole, self.size):
            yield Window(0, [(doc_id, start + at, ids[at : at + self.size], total)])
        start, ids = start + whole, ids[whole:]
        while ids:
            n = len(ids)
            fits = [w for w in self.open if w.free >= n]
            if fits:
                best = min(fits, key=lambda w: w.free)
            elif len(self.open) < self.most_open:
                best = Window(self.size)
                self.open.append(best)
            else:
                best = min(self.open, key=lambda w: w.free)
                if best.free >= self.least_cut:
                    head = best.free
                    best.pieces.append((doc_id, start, ids[:head], total))
                    start, ids = start + head, ids[head:]
                self.open.remove(best)
                yield best
                continue
            best.pieces.append((doc_id, start, ids, total))
            best.free -= n
            if not best.free:
                self.open.remove(best)
                yield best
            return


def _batch(windows: list[tuple[int, Window, bool]]) -> pa.RecordBatch:
    rows = []
    for sequence, window, leftover in windows:
        offset = 0
        for doc_id, start, ids, total in window.pieces:
            rows.append((doc_id, start, len(ids), ids.tobytes(), total, sequence, offset, leftover))
            offset += len(ids)
    columns = list(zip(*rows, strict=True))
    types = [*[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 3, pa.bool_()]
    names = [*COLUMNS, "leftover"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _emit(windows: Iterator[Window], base: int) -> Iterator[tuple[int, Window, bool]]:
    for number, window in enumerate(windows):
        yield base + number, window, False


def _in_batches(rows, most: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _little_endian(ids: list[int]) -> array:
    numbers = array("I", ids)
    if numbers.itemsize != 4:
        raise TypeError("ids are kept as 32-bit numbers")
    return numbers


def pack(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    window: int = WINDOW,
    most_open: int = OPEN_WINDOWS,
    least_cut: int = LEAST_CUT,
) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, ids, doc_tokens,
    sequence_id and offset; ``ids`` are little-endian unsigned 32-bit numbers.

    A document is the ids of its text and then ``END_ID``. An added token of the
    vocabulary file that a text spells out is that token's id. Each id lies in exactly one
    piece. A sequence holds at most ``window`` ids.

    A NULL or empty text is the end id alone. Rows are packed as they come: a row
    without an id or one that repeats an id is packed as any other. A text of any length
    is one task's work, its ids held at once. Other columns are ignored; an empty table
    gives an empty result.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(vocabulary, pattern)
        packer = Packer(window, most_open, least_cut)
        base = TaskContext.get().partitionId() << 32
        done = 0

        def windows():
            for part in slices(batches, "text"):
                rows = zip(*(part.column(c).to_pylist() for c in ("doc_id", "text")), strict=True)
                for doc_id, text in rows:
                    ids = _little_endian(tokenizer.encode(text) if text else [])
                    ids.append(END_ID)
                    yield from packer.add(doc_id, 0, ids, len(ids))

        def rows():
            nonlocal done
            for window_ in windows():
                yield base + done, window_, False
                done += 1
            for window_ in packer.open:
                yield base + done, window_, True
                done += 1

        yield from _in_batches(rows())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            group, packer, base, done = None, None, 0, 0
            for part in slices(batches, "ids"):
                names = ("group", "doc_id", "start", "ids", "doc_tokens")
                for row in zip(*(part.column(c).to_pylist() for c in names), strict=True):
                    if row[0] != group:
                        for window_ in packer.open if packer else ():
                            yield base + done, window_, False
                            done += 1
                        group, done = row[0], 0
                        packer, base = Packer(window, most_open, 1), (1 << 30 | group) << 32
                    ids = array("I")
                    ids.frombytes(row[3])
                    for window_ in packer.add(row[1], row[2], ids, row[4]):
                        yield base + done, window_, False
                        done += 1
            for window_ in packer.open if packer else ():
                yield base + done, window_, False
                done += 1

        yield from _in_batches(rows())

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    pieces = shared_table(texts.mapInArrow(first, PIECES), "pieces", by=["leftover"])
    group = (F.shiftright("sequence_id", 32) / MERGE).cast("bigint")
    leftovers = pieces.where("leftover").select("*", group.alias("group"))
    # Large windows first, as best fit does best on them; the rest is for a stable order.
    order = ["group", F.desc("length"), "sequence_id", "offset"]
    merged = leftovers.repartition("group").sortWithinPartitions(*order).mapInArrow(merge, PIECES)
    return pieces.where("NOT leftover").select(*COLUMNS).unionByName(merged.select(*COLUMNS))


def public_vocabulary() -> tuple[str, str]:
    """The vocabulary file and split pattern of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return digests(pack(documents(spark, sf_dir), *public_vocabulary()))
