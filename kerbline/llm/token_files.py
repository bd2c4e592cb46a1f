"""Token ids of a corpus in binary segments of patched frame-of-reference blocks.

A segment is one bytes value, held in a row of a Parquet table: Spark commits those on any file system and repeats lost
tasks, which raw files written by workers would not survive. Layout, little endian:

    magic 8 bytes | n_docs, n_ids, n_blocks, n_exceptions u64 | doc ids i64 | doc lengths u64 (highest bit: no id)
    | block starts u64 (word offsets, one more than blocks) | block minima u32 | exception starts u64 (one more) | widths u8
    | exception positions u16 | exception high parts u32 | packed words u64

A block holds 1024 ids. Its minimum is subtracted; the width is that of the chosen percentile of what is left; the low
bits of all ids are packed at this width, and ids that need more have their high part in the block's exception list.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbline.llm.hashing import slices
from kerbline.llm.stage import store

BLOCK = 1024
PERCENTILE = 95
SEGMENT_IDS = 1 << 18
CACHED_PIECES = 500_000
END_ID = 2
_MAGIC = b"TOKPFOR2"
_NO_ID = 1 << 63
_BITS = np.arange(BLOCK, dtype=np.uint64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 1024 values below 2**width as rows of 16 * width words."""
    at = _BITS * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    low = values << shift
    high = np.where(shift == 0, 0, values >> ((np.uint64(64) - shift) & np.uint64(63)))
    out = np.zeros((len(values), 16 * width + 1), np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[:, word[first]] = np.bitwise_or.reduceat(low, first, axis=1)
    last = np.append(first[1:], BLOCK) - 1
    out[:, word[last] + 1] |= high[:, last]
    return out[:, :-1]


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    at = _BITS * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    padded = np.concatenate([packed, np.zeros((len(packed), 1), np.uint64)], axis=1)
    low = padded[:, word] >> shift
    high = np.where(shift == 0, 0, padded[:, word + 1] << ((np.uint64(64) - shift) & np.uint64(63)))
    return (low | high) & np.uint64((1 << width) - 1)


def encode_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One segment of whole documents."""
    n_blocks = -(-len(ids) // BLOCK)
    grid = np.zeros(n_blocks * BLOCK, np.uint64)
    grid[: len(ids)] = ids
    if len(ids):
        grid[len(ids) :] = ids[-1]
    grid = grid.reshape(n_blocks, BLOCK)
    low = grid.min(axis=1) if n_blocks else np.zeros(0, np.uint64)
    rest = grid - low[:, None]
    typical = np.percentile(rest, percentile, axis=1, method="higher") if n_blocks else np.zeros(0)
    widths = np.maximum(1, np.ceil(np.log2(typical.astype(np.float64) + 1))).astype(np.uint8)
    starts = np.concatenate([[0], np.cumsum(16 * widths.astype(np.int64))])
    words = np.zeros(starts[-1], np.uint64)
    over = rest >> widths[:, None].astype(np.uint64)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        packed = _pack(rest[rows] & np.uint64((1 << int(width)) - 1), int(width))
        words[starts[rows][:, None] + np.arange(16 * int(width))] = packed
    block, position = np.nonzero(over)
    exceptions = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=n_blocks))])
    counts = np.array([len(doc_ids), len(ids), n_blocks, len(block)], np.uint64)
    parts = [
        counts, np.array([doc or 0 for doc in doc_ids], np.int64),
        np.array([n | _NO_ID if doc is None else n for doc, n in zip(doc_ids, lengths, strict=True)], np.uint64), starts.astype(np.uint64), low.astype(np.uint32),
        exceptions.astype(np.uint64), widths, position.astype(np.uint16), over[block, position].astype(np.uint32), words,
    ]
    return _MAGIC + b"".join(part.tobytes() for part in parts)


class Segment:
    """Reads a segment, whole or block by block."""

    def __init__(self, content: bytes):
        if content[:8] != _MAGIC:
            raise ValueError("not a token segment")
        self._at, self._content = 8, content
        n_docs, self.n_ids, n_blocks, n_exceptions = (int(n) for n in self._take(np.uint64, 4))
        self.doc_ids, lengths = self._take(np.int64, n_docs), self._take(np.uint64, n_docs)
        self.without_id = lengths >= _NO_ID
        self.lengths = (lengths & np.uint64(_NO_ID - 1)).astype(np.int64)
        self._starts, self._low = self._take(np.uint64, n_blocks + 1).astype(np.int64), self._take(np.uint32, n_blocks)
        self._exceptions, self._widths = self._take(np.uint64, n_blocks + 1).astype(np.int64), self._take(np.uint8, n_blocks)
        self._position, self._high = self._take(np.uint16, n_exceptions), self._take(np.uint32, n_exceptions)
        self._words = self._take(np.uint64, int(self._starts[-1]))

    def _take(self, kind: type, count: int) -> np.ndarray:
        out = np.frombuffer(self._content, kind, count, self._at)
        self._at += out.nbytes
        return out

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of blocks first..last-1, found by the index alone."""
        out = np.zeros((last - first, BLOCK), np.uint64)
        widths = self._widths[first:last]
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            at = self._starts[first + rows][:, None] + np.arange(16 * int(width))
            out[rows] = _unpack(self._words[at], int(width))
        begin, end = self._exceptions[first], self._exceptions[last]
        block = np.repeat(np.arange(last - first), np.diff(self._exceptions[first : last + 1]))
        out[block, self._position[begin:end]] |= self._high[begin:end].astype(np.uint64) << widths[block].astype(np.uint64)
        ids = (out + self._low[first:last, None]).astype(np.uint32).ravel()
        return ids[: self.n_ids - first * BLOCK]

    def ids(self) -> np.ndarray:
        return self.blocks(0, len(self._widths))


class _ByteLetters(dict):
    """The printable letters that a byte-level vocabulary writes for the UTF-8 bytes of a character."""

    def __init__(self) -> None:
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in set(plain)]
        self._letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
        super().__init__()

    def __missing__(self, code: int) -> str:
        self[code] = "".join(self._letter[b] for b in chr(code).encode("utf-8", "replace"))
        return self[code]


class PieceEncoder:
    """Encodes texts with a byte-level tokenizer, remembering the ids of up to CACHED_PIECES pieces.

    The vocabulary's split rule always cuts before a single space, and around a single line break, that stands between
    two characters which are not white space; a text can be encoded in pieces between such cuts. A text where a space
    meets other white space, or with the string of a special token, is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._letters = _ByteLetters()
        self._known: dict[str, bytes | None] = {}
        self._break = self.whole("\n")
        self._marks = {mark: self.whole(mark) for mark in ".,"}

    def whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _run(self, run: str) -> bytes:
        """Ids of a run that the split rule leaves whole: letters, with at most one space before them."""
        mapped = run.replace(" ", "\u0120") if run.isascii() else run.translate(self._letters)
        return array("I", [token.id for token in self._model.tokenize(mapped)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece: a word with at most a point or comma after it goes straight to the merges."""
        mark = self._marks.get(piece[-1], b"")
        word = piece[:-1] if mark else piece
        if word.removeprefix(" ").isalpha():
            return ((mark and word[0] == " " and self._known.get(word[1:])) or self._run(word)) + mark
        return self.whole(piece)

    def _learn(self, piece: str) -> bytes | None:
        """Ids of what stands after a space; None if the piece must not be cut off there."""
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        lines = piece.split("\n")
        if len(lines) == 1:
            ids = self._piece(" " + piece)
        elif any(not line or line[0].isspace() or line[-1].isspace() for line in lines):
            return self.whole(" " + piece)
        else:
            ids = (self._known.get(lines[0]) or self._piece(" " + lines[0])) + b"".join(self._break + self._piece(line) for line in lines[1:])
        if len(self._known) >= CACHED_PIECES:
            self._known.clear()
        self._known[piece] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if any(special in text for special in self._special):
            return self.whole(text)
        first, *pieces = text.split(" ")
        if not pieces:
            return self.whole(text)
        if not first or first[-1].isspace():
            return self.whole(text)
        known = self._known.get
        ids = [known(piece) or self._learn(piece) for piece in pieces]
        return self.whole(text) if None in ids else self.whole(first) + b"".join(ids)


@lru_cache(maxsize=2)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encode every whole text, append end_id, and write segments in ascending id order.

    Returns the stored table: part, segment, offset (ids of the part before the segment), n_ids, content. Rows with the
    same id follow one another by text hash; a null id counts as smallest and stays null. A null text is an empty one and has the end id alone. An empty table gives no segments. Only the two named columns
    are read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        held: list[tuple[int | None, bytes]] = []
        offset = number = size = 0
        end = np.array([end_id], np.uint32).tobytes()

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(one for _, one in held), np.uint32)
            content = encode_segment([doc for doc, _ in held], [len(one) // 4 for _, one in held], ids)
            return pa.RecordBatch.from_pylist([{"part": part, "segment": number, "offset": offset, "n_ids": len(ids), "content": content}], schema)

        for batch in batches:
            for piece in slices(batch, "text"):
                texts = [text or "" for text in piece.column("text").to_pylist()]
                for doc, ids in zip(piece.column("doc_id").to_pylist(), map(encoder, texts), strict=True):
                    held.append((doc, ids + end))
                    size += len(ids) // 4 + 1
                    if size >= SEGMENT_IDS:
                        yield segment()
                        held, offset, number, size = [], offset + size, number + 1, 0
        if held:
            yield segment()

    schema = pa.schema([("part", pa.int64()), ("segment", pa.int64()), ("offset", pa.int64()), ("n_ids", pa.int64()), ("content", pa.binary())])
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(ordered.mapInArrow(encode, "part long, segment long, offset long, n_ids long, content binary"))


def read_tokens(segments: DataFrame) -> DataFrame:
    """Per document of the written table, in id order: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 of its ids as little-endian 32-bit integers. Parts are summed up as one row each."""
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column("start").to_pylist(), batch.column("content"), strict=True):
                segment = Segment(content.as_py())
                ids, ends = segment.ids().tobytes(), np.cumsum(segment.lengths)
                begins = ends - segment.lengths
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment.doc_ids, mask=segment.without_id), pa.array(start + begins), pa.array(segment.lengths), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = segments.join(base, "part").select((F.col("base") + F.col("offset")).alias("start"), "content")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    """Path of the public byte-level vocabulary that is installed with Python."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
