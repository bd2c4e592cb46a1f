"""SentencePiece ids of whole texts through tables of distinct chunks.

A chunk is a run of whitespace markers and the characters up to the next run. Where no piece of the vocabulary has a
marker behind another character, and the normaliser changes nothing but spaces, no piece can lie in two chunks: the ids of
a text are those of its chunks, one after another. A task reads its texts as numbers of distinct chunks, has the library
segment each chunk of its table once, all new ones in one call, and joins ids and decoded characters back by position.

The table is the task's own. One for the whole corpus has to bring every chunk of every task together and back again,
which costs far more than segmenting a chunk once in each task that has it (README has the figures).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kerbline.llm.hashing import slices

MARK = "▁"
BATCH_BYTES = 1 << 23
OUT_BYTES = 1 << 22
#: A table with more chunks than this is begun anew, so that a task's memory is bounded; ids do not depend on it.
TABLE_CHUNKS = 1_000_000
#: A text of its own put before a chunk, so that the chunk's first marker is one inside a text.
LEAD = "."
_CHUNK = re.compile(" +[^ ]*")


@lru_cache(maxsize=2)
def _processor(model: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=model)


@lru_cache(maxsize=2)
def stays_in_chunks(model: str) -> bool:
    """Whether pieces cannot cross whitespace markers and texts are normalised by nothing but marking their spaces."""
    processor = _processor(model)
    if any(re.search(f"[^{MARK}]{MARK}", processor.id_to_piece(i)) for i in range(processor.get_piece_size())):
        return False
    every = "".join(chr(code) for code in range(0x110000) if not 0xD800 <= code < 0xE000)
    return all(processor.normalize(text) == MARK + text.replace(" ", MARK) for text in (every, "  a  b ", " "))


def chunks_of(text: str, split: bool = True) -> list[str]:
    """The chunks of a text, each with its markers as spaces; joined they are a space and the text."""
    if not split:
        return [text]
    return _CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


class ChunkTable(dict):
    """Numbers of distinct chunks; by number the ids of a chunk and the bytes that they decode to."""

    def __init__(self, model: str, split: bool):
        super().__init__()
        self._processor, self._split = _processor(model), split
        self._lead = self._processor.encode(LEAD) if split else []
        self._head = len(self._processor.decode(self._lead))
        self._new: list[str] = []
        self.ids: list[bytes] = []
        self.decoded: list[bytes] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self._new.append(chunk)
        return number

    def numbers(self, text: str) -> np.ndarray:
        found = chunks_of(text, self._split)
        return np.fromiter(map(self.__getitem__, found), np.uint32, len(found))

    def segment_new(self) -> None:
        """Have the library segment the chunks that came in since the last call."""
        if not self._new:
            return
        found = self._processor.encode([LEAD + chunk if self._split else chunk for chunk in self._new], num_threads=1)
        texts = self._processor.decode(found, num_threads=1)
        sizes = np.array([len(ids) for ids in found])
        flat = np.concatenate([np.array(ids, "<u4") for ids in found]).tobytes()
        ends = (4 * np.cumsum(sizes)).tolist()
        for end, size, text in zip(ends, sizes.tolist(), texts, strict=True):
            self.ids.append(flat[end - 4 * (size - len(self._lead)) : end])
            self.decoded.append(text[self._head :].encode())
        self._new = []

    def join(self, numbers: np.ndarray) -> tuple[bytes, bytes]:
        """Ids and decoded bytes of a text; its first marker is not part of it."""
        order = numbers.tolist()
        return b"".join(map(self.ids.__getitem__, order)), b"".join(map(self.decoded.__getitem__, order))[int(self._split) :]


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """Per row of docs: doc_id, ids (little-endian unsigned 32-bit integers, with the begin and end ids as asked for) and
    decoded, the text that the library decodes from these ids.

    A null text is an empty one: it has the begin and end ids alone. Null and repeated ids are kept, a row each. Where
    pieces may cross markers (see stays_in_chunks) a text is one chunk. Only the two named columns are read. An empty
    table gives no rows. A task holds its table and 8 MB of text, or a single longer text, at a time.
    """
    split = stays_in_chunks(model)
    processor = _processor(model)
    head = np.array([processor.bos_id()] if begin else [], "<u4").tobytes()
    tail = np.array([processor.eos_id()] if end else [], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model, split)
        for batch in batches:
            for piece in slices(batch, "text", BATCH_BYTES):
                if len(table) > TABLE_CHUNKS:
                    table = ChunkTable(model, split)
                numbered = [table.numbers(text or "") for text in piece.column("text").to_pylist()]
                table.segment_new()
                held, size = [], 0
                for doc, numbers in zip(piece.column("doc_id").to_pylist(), numbered, strict=True):
                    ids, decoded = table.join(numbers)
                    held.append({"doc_id": doc, "ids": head + ids + tail, "decoded": decoded.decode()})
                    size += len(ids) + len(decoded)
                    if size >= OUT_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    named = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return named.mapInArrow(encode, "doc_id long, ids binary, decoded string")


def default_model() -> str:
    """Path of the public piece vocabulary that is installed with Python."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
