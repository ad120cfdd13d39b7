"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a text has a node for each boundary between characters and an edge for each
vocabulary piece. A byte-pair model's segmentation of a prefix is one path, whose last
piece is fixed by the prefix: it is the one edge into the node that is stable next to the
piece before it, which means that merging the two pieces' characters gives these two
pieces again. So the search keeps for each boundary its last piece and a back pointer,
and only edges from the last ``longest`` boundaries matter. Whenever the paths from all of
these meet in one boundary, the ids up to it are committed and the window moves on; its
size depends on the vocabulary, not on the text.

No piece holds a word's end and the space after it (this is checked when the model is
loaded), so all paths meet where a word begins. Short words are searched from their end
and remembered, by all tasks of a worker process together.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfspace.llm.common import documents, slices

SPACE = "▁"
STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

# Words and runs remembered at a time, and how long they may be.
MEMO = 300_000
MEMO_CHARS = 48
# Pairs of pieces whose stability is remembered at a time.
PAIRS = 2_000_000
NO_PIECE = float("-inf")


class Pieces:
    """A byte-pair model's vocabulary, and what of it is stable."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        special = [
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
            for i in range(size)
        ]
        self.byte = {int(self.text[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.special = np.array(special)
        self.id = {self.text[i]: i for i in range(size) if not special[i]}
        self.scores = {p: model.get_score(i) for p, i in self.id.items()}
        self.longest = max(map(len, self.id))
        self.characters = frozenset(p for p in self.id if len(p) == 1)
        inner = [p for p in self.id if p.strip(SPACE) and SPACE in p.lstrip(SPACE)]
        lone = {c for p in self.id for c in p} - self.id.keys()
        if inner or lone or len(self.byte) != 256:
            raise ValueError("the model's pieces cross words, or lack characters or bytes")
        self.stable: dict[int, bool] = {}

    @cached_property
    def onward(self) -> dict:
        """Pieces by their characters: a node is the piece that ends there, and what is below."""
        root: list = [None, {}]
        for piece, number in self.id.items():
            node = root
            for character in piece:
                node = node[1].setdefault(character, [None, {}])
            node[0] = number
        return root[1]

    @cached_property
    def backward(self) -> dict:
        """Pieces by their characters from the last on.

        A node is (length, piece) of the pieces that the characters to it end with, the
        longest first, and what is below.
        """
        root: list = [[], {}]
        for piece in self.id:
            node = root
            for character in reversed(piece):
                node = node[1].setdefault(character, [[], {}])
            node[0] = [(len(piece), self.id[piece])]
        pending = [root]
        while pending:
            above = pending.pop()
            for node in above[1].values():
                node[0] = node[0] + above[0] if node[0] else above[0]
                pending.append(node)
        return root[1]

    def merge(self, text: str) -> list[int]:
        """Byte-pair merges of a short text: the best pair first, the leftmost of equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            found = [scores.get(left + right, NO_PIECE) for left, right in zip(parts, parts[1:])]
            best = max(found)
            if best == NO_PIECE:
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.id[p] for p in parts]

    def follows(self, before: int, piece: int) -> bool:
        """Whether a piece is stable after another, or at a start (``before`` is -1)."""
        if before < 0:
            fits = self.merge(self.text[piece]) == [piece]
        else:
            fits = self.merge(self.text[before] + self.text[piece]) == [before, piece]
        if len(self.stable) >= PAIRS:
            self.stable.clear()
        self.stable[before + 1 << 24 | piece] = fits
        return fits

    def lay(self, text: str, at: int, last: list[int | None], back: list[int]) -> None:
        """Lay the edges that begin at a boundary, if a path ends there.

        A boundary's last piece is kept in ``last``, the piece's characters in ``back``.
        """
        before = last[at]
        if before is None:
            return
        below, stable, first = self.onward, self.stable, before + 1 << 24
        end = at
        for character in text[at : at + self.longest]:
            node = below.get(character)
            if node is None:
                return
            end += 1
            piece, below = node
            if piece is not None and last[end] is None:
                fits = stable.get(first | piece)
                if fits is None:
                    fits = self.follows(before, piece)
                if fits:
                    last[end] = piece
                    back[end] = end - at

    def settle(self, text: str, end: int, last: list[int | None]) -> int:
        """The last piece of the path to a boundary, or -2 if none ends there.

        Goes back from the boundary, so only edges that its path may have are looked at;
        boundaries settled on the way are kept in ``last``.
        """
        below, ending = self.backward, ()
        try:
            for character in text[end - 1 :: -1]:
                ending, below = below[character]
        except KeyError:
            pass
        stable = self.stable
        for length, piece in ending:
            before = last[end - length]
            if before is None:
                before = self.settle(text, end - length, last)
            if before == -2:
                continue
            fits = stable.get(before + 1 << 24 | piece)
            if fits is None:
                fits = self.follows(before, piece)
            if fits:
                last[end] = piece
                return piece
        last[end] = -2
        return -2


def path(last: list[int | None], back: list[int], end: int) -> list[int]:
    """The pieces from the first boundary to another."""
    out = []
    while end > 0:
        out.append(last[end])
        end -= back[end]
    return out[::-1]


class Search:
    """The streaming search over one run of characters.

    ``last`` and ``back`` hold, for each boundary since the last committed one, the last
    piece of the path to it (None where no path ends) and how many characters it has.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.tail = ""  # characters from the committed boundary on
        self.last: list[int | None] = [-1]
        self.back = [0]
        self.next = 0  # first boundary whose edges are not laid yet

    def push(self, text: str) -> list[int]:
        """Add characters; returns the ids that are certain now."""
        self.tail += text
        self.last += [None] * len(text)
        self.back += [0] * len(text)
        longest = self.pieces.longest
        while self.next + longest <= len(self.tail):
            self.pieces.lay(self.tail, self.next, self.last, self.back)
            self.next += 1
        # Paths that may go on end at boundaries up to ``longest`` beyond the last laid one.
        live = {e for e in range(self.next, len(self.last)) if self.last[e] is not None}
        while len(live) > 1:
            latest = max(live)
            live.remove(latest)
            live.add(latest - self.back[latest])
        meet = live.pop() if live else 0
        return self._commit(meet)

    def _commit(self, end: int) -> list[int]:
        if end == 0:
            return []
        ids = path(self.last, self.back, end)
        self.tail = self.tail[end:]
        self.last = self.last[end:]
        self.back = self.back[end:]
        self.next = max(0, self.next - end)
        return ids

    def finish(self) -> list[int]:
        """The rest of the ids; the search can then take a new run."""
        while self.next < len(self.tail):
            self.pieces.lay(self.tail, self.next, self.last, self.back)
            self.next += 1
        ids = path(self.last, self.back, len(self.tail))
        self.__init__(self.pieces)
        return ids


def packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if numbers.itemsize != 4:
        raise TypeError("ids are kept as 32-bit numbers")
    if sys.byteorder != "little":
        numbers.byteswap()
    return numbers.tobytes()


def unpacked(data: bytes | None) -> np.ndarray:
    return np.frombuffer(data or b"", "<u4")


class Codec:
    """Encodes texts and decodes ids, as the model's own library does.

    A text begins with one space that is not its own, spaces are written as ``SPACE``, and
    characters without a piece as their bytes.
    """

    def __init__(self, path: str, block: int = 4096):
        self.path, self.block = path, block

    @cached_property
    def pieces(self) -> Pieces:
        return Pieces(self.path)

    @cached_property
    def words(self) -> dict[str, bytes]:
        """Ids of words that follow one space."""
        return {}

    @cached_property
    def older(self) -> dict[str, bytes]:
        """The words remembered before ``words`` was emptied last."""
        return {}

    @cached_property
    def runs(self) -> dict[str, list[int]]:
        """Ids of runs of known characters."""
        return {}

    def _run(self, characters: str) -> list[int]:
        """The ids of a run of known characters; a short one needs no window."""
        n = len(characters)
        if n > MEMO_CHARS:
            search, ids = Search(self.pieces), []
            for at in range(0, n, self.block):
                ids += search.push(characters[at : at + self.block])
            return ids + search.finish()
        last: list[int | None] = [-1] + [None] * n
        ids, end, texts = [], n, self.pieces.text
        while end:
            piece = last[end]
            if piece is None:
                piece = self.pieces.settle(characters, end, last)
            ids.append(piece)
            end -= len(texts[piece])
        return ids[::-1]

    def _remembered_run(self, characters: str) -> list[int]:
        ids = self.runs.get(characters)
        if ids is None:
            ids = self._run(characters)
            if len(characters) <= MEMO_CHARS:
                if len(self.runs) >= MEMO:
                    self.runs.clear()
                self.runs[characters] = ids
        return ids

    def _stretch(self, stretch: str) -> list[int]:
        """A stretch in runs of known characters; unknown ones are bytes, and merge with none."""
        known = self.pieces.characters
        if known.issuperset(stretch):
            return self._run(stretch)
        unknown = [i for i, character in enumerate(stretch) if character not in known]
        ids, start = [], 0
        for i in unknown:
            ids += self._remembered_run(stretch[start:i])
            ids += [self.pieces.byte[b] for b in stretch[i].encode()]
            start = i + 1
        return ids + self._remembered_run(stretch[start:])

    def encode(self, text: str) -> bytes:
        """The ids, as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            stretches = STRETCH.findall(SPACE + text.replace(" ", SPACE))
            return b"".join(packed(self._remembered_stretch(s)) for s in stretches)
        tokens, words = text.split(" "), self.words
        if len(words) >= MEMO:
            # The words of the last memory that come again are taken over.
            self.older = dict(words)
            words.clear()
        new, older = set(tokens).difference(words), self.older
        for word in new:
            words[word] = older.get(word) or packed(self._stretch(SPACE + word))
        ids = b"".join(map(words.__getitem__, tokens))
        for word in new:
            if len(word) > MEMO_CHARS:
                del words[word]
        return ids

    def _remembered_stretch(self, stretch: str) -> list[int]:
        return self._remembered_run(stretch) if self._plain(stretch) else self._stretch(stretch)

    def _plain(self, stretch: str) -> bool:
        return self.pieces.characters.issuperset(stretch)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids. Bytes that are not UTF-8 give U+FFFD, control ids nothing."""
        ids = np.asarray(ids, np.int64)
        text, byte_of = self.pieces.text, self.pieces.byte_of
        parts, pending, start = [], bytearray(), 0
        for at in np.flatnonzero(self.pieces.special[ids]).tolist():
            if at > start:
                parts.append(pending.decode("utf-8", "replace"))
                pending.clear()
                parts.extend(map(text.__getitem__, ids[start:at].tolist()))
            start = at + 1
            byte = byte_of.get(int(ids[at]))
            if byte is not None:
                pending.append(byte)
        parts.append(pending.decode("utf-8", "replace"))
        parts.extend(map(text.__getitem__, ids[start:].tolist()))
        return "".join(parts).replace(SPACE, " ").removeprefix(" ")


def kept_codec(process: Broadcast, model: str) -> Codec:
    """The worker process's codec.

    A worker process loads a broadcast value once, so what its first task puts into a
    broadcast dictionary is there for its later tasks.
    """
    if model not in process.value:
        process.value[model] = Codec(model)
    return process.value[model]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_ids and ids (little-endian unsigned 32-bit numbers) of each row's text.

    A NULL or empty text has no ids. A text of any length is searched in blocks. Equal
    texts have equal ids. Other columns are ignored; an empty table gives an empty result.
    """
    process = docs.sparkSession.sparkContext.broadcast({})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_codec(process, model)
        for part in slices(batches, "text"):
            coded = [codec.encode(t or "") for t in part.column("text").to_pylist()]
            sizes = pa.array([len(c) // 4 for c in coded], pa.int64())
            ids = pa.array(coded, pa.binary())
            yield pa.record_batch([part.column("doc_id"), sizes, ids], ["doc_id", "n_ids", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, n_ids bigint, ids binary"
    )


def decode(coded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encode`` with their text.

    The text is the one that was encoded, except that U+2581 has become a space. NULL ids
    give an empty text.
    """
    process = coded.sparkSession.sparkContext.broadcast({})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_codec(process, model)
        for part in slices(batches, "ids"):
            texts = [codec.decode(unpacked(d)) for d in part.column("ids").to_pylist()]
            columns = [part.column(c) for c in ("doc_id", "n_ids", "ids")]
            yield pa.record_batch([*columns, pa.array(texts)], ["doc_id", "n_ids", "ids", "text"])

    kind = dict(coded.dtypes)["doc_id"]
    return coded.select("doc_id", "n_ids", "ids").mapInArrow(
        rows, f"doc_id {kind}, n_ids bigint, ids binary, text string"
    )


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    """Encodes each document and decodes its ids; digests of both."""
    model = public_model()
    return decode(encode(documents(spark, sf_dir), model), model).select(
        "doc_id",
        "n_ids",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("text").alias("text_crc32"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
