"""Operator 13 against the library itself."""

import hashlib

import numpy as np
import pytest

from kerbline.llm import piece_encoding, registry
from kerbline.llm.piece_encoding import MARK, chunks_of, default_model, encode_texts, stays_in_chunks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def processor():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=default_model())


def _plain(processor, text):
    ids = processor.encode(text or "", add_bos=True, add_eos=True)
    return np.array(ids, "<u4").tobytes(), processor.decode(ids)


def test_query_equals_the_library_on_every_document(spark, small, processor):
    got = {r.doc_id: tuple(r)[1:] for r in registry.queries()["op13_sentencepiece"](spark, SF).collect()}
    for row in small.collect():
        ids, text = _plain(processor, row.text)
        assert got.pop(row.doc_id) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert not got


TEXTS = [
    "", " ", "  ", "a", " a", "a ", "  a  b   ", f"{MARK}a", f"a{MARK} b{MARK}", MARK, "\n", " \n \t x y", "<s> a </s>", "<unk>", "<0x41>",
    "\x00a\x00 b", "日本語 テキスト", "😀 😀😀", "ﬁ ａ é", "." * 50, " ." * 50, "x" * 30_000, " " * 5_000, "word " * 20_000, "� \U0010ffff",
]


def test_odd_texts_equal_the_library(spark, processor):
    docs = spark.createDataFrame([(i, text) for i, text in enumerate([*TEXTS, None])], "doc_id long, text string").repartition(3)
    for row in encode_texts(docs, default_model()).collect():
        text = [*TEXTS, None][row.doc_id]
        assert (bytes(row.ids), row.decoded) == _plain(processor, text), repr(text)[:60]


def test_random_texts_equal_the_library(spark, processor):
    random = np.random.default_rng(13)
    letters = list("ab .e\n▁é日😀t ") + [" the", "ing", "  ", "<s>"]
    texts = ["".join(random.choice(letters, random.integers(0, 60))) for _ in range(800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in encode_texts(docs, default_model()).collect():
        assert (bytes(row.ids), row.decoded) == _plain(processor, texts[row.doc_id])


def test_a_model_whose_pieces_cross_markers_gets_whole_texts(spark, processor, monkeypatch):
    monkeypatch.setattr(piece_encoding, "stays_in_chunks", lambda model: False)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in encode_texts(docs, default_model()).collect():
        assert (bytes(row.ids), row.decoded) == _plain(processor, TEXTS[row.doc_id])


def test_small_batches_and_tables_give_the_same(spark, small, monkeypatch):
    whole = {r.doc_id: (bytes(r.ids), r.decoded) for r in encode_texts(small, default_model()).collect()}
    monkeypatch.setattr(piece_encoding, "BATCH_BYTES", 1 << 12)
    monkeypatch.setattr(piece_encoding, "OUT_BYTES", 1 << 12)
    monkeypatch.setattr(piece_encoding, "TABLE_CHUNKS", 300)
    again = encode_texts(small.repartition(5), default_model()).collect()
    assert {r.doc_id: (bytes(r.ids), r.decoded) for r in again} == whole


def test_a_chunk_is_segmented_once(monkeypatch):
    table = piece_encoding.ChunkTable(default_model(), True)
    first, second = table.numbers("to be or not to be"), table.numbers("be it")
    table.segment_new()
    assert first.tolist() == [0, 1, 2, 3, 0, 1] and second.tolist() == [1, 4] and len(table.ids) == 5
    assert table.join(second)[1] == b"be it"


def test_chunks_cover_the_text():
    assert stays_in_chunks(default_model())
    assert chunks_of("a  b ") == [" a", "  b", " "]
    assert chunks_of("") == []


def test_without_begin_and_end(spark, processor):
    docs = spark.createDataFrame([(1, "to be"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: bytes(r.ids) for r in encode_texts(docs, default_model(), begin=False, end=False).collect()}
    assert got == {1: np.array(processor.encode("to be"), "<u4").tobytes(), 2: b""}


def test_odd_rows(odd, none):
    got = encode_texts(odd, default_model()).collect()
    assert len(got) == odd.count()
    assert sum(r.doc_id is None for r in got) == 2
    assert encode_texts(none, default_model()).count() == 0
