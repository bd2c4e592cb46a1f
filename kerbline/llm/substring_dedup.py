"""Removal of repeated 50-byte strings by range-partitioned suffix sorting.

Sorting every suffix of a corpus would move fifty times its size. Two facts keep it small. First, from every window of
WINDOW bytes a rule that sees the window alone (a mod-minimiser) chooses one anchor of ANCHOR bytes in it, so equal
windows have equal anchors, and only windows whose anchor is in two different texts can repeat. Second, neighbouring
windows share their anchor, so a stretch of them travels as one string.

The stretches are range-partitioned by the leading bytes of the suffix that starts at their anchor, at splitters taken
from a sample; suffixes with equal leading bytes never lie on two sides of a boundary. In its bucket each window is a suffix
cut at WINDOW bytes; they are sorted by multikey quicksort, eight bytes a step, where only runs that are still
equal go on to the next step. Runs equal to the end are the repeated strings, and each learns its smallest document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.blobs import pack, rows_by_key, sorted_pack, unpack
from kerbline.llm.hashing import mix, packed_texts, prefix_hash, range_hash, slices, text_bytes, unpacked
from kerbline.llm.stage import store

WINDOW = 50
ANCHOR = 28
STEP = WINDOW - ANCHOR + 1
SEED = 5
BUCKET_BYTES = 8 << 20
BATCH_BYTES = 12 << 20
#: Anchors are chosen in slices of about so many bytes; each takes some sixty bytes of memory.
SLICE_BYTES = 1 << 20
SAMPLE = 20_000
_BIAS = np.uint64(1 << 63)
_ROW = "at long, part int, number int, kind int, blob binary"
_SCHEMA = pa.schema([("at", pa.int64()), ("part", pa.int32()), ("number", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
ABOUT, ENTRIES, SAMPLED = 0, 1, 2


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, row, strict=True)) for row in rows], _SCHEMA)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of windows with the same anchor: text, first window, last window, anchor (all but the text as places
    in data). Texts shorter than a window have none."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none, none, none, none
    seeds = len(data) - SEED + 1
    value = np.zeros(seeds, np.uint64)
    for byte in range(SEED):
        value = (value << np.uint64(8)) | data[byte : byte + seeds]
    least = (mix(value + np.uint64(0x1234567)) & np.uint64(0xFFFFFFFF00000000)) | np.arange(seeds, dtype=np.uint64)
    inside = WINDOW - SEED + 1
    reach = 1
    while 2 * reach <= inside:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[: len(data) - WINDOW + 1], least[inside - reach :])
    counts = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(text)) + np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts)
    place = start + ((least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64) - start) % STEP
    new = np.ones(len(text), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(text)) - 1
    return text[first], start[first], start[last], place[first]


def _leads(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them."""
    out = np.zeros(len(places), np.uint64)
    for byte in range(8):
        out = (out << np.uint64(8)) | data[places + byte]
    return out


def equal_windows(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each window the number of its class of equal windows: multikey quicksort of the suffixes cut at WINDOW bytes.
    Windows that differ from all others early are not looked at further."""
    classes = np.arange(len(starts), dtype=np.int64)
    active, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for step in [*range(0, WINDOW - 7, 8), WINDOW - 8]:
        key = _leads(data, starts[active] + step)
        order = np.lexsort((key, group))
        active, key, group = active[order], key[order], group[order]
        new = np.ones(len(active), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(new) - 1
        more = np.bincount(group)[group] > 1
        active, group = active[more], group[more]
        if not len(active):
            return classes
    first = np.flatnonzero(np.diff(group, prepend=-1))
    classes[active] = np.repeat(active[first], np.diff(np.append(first, len(active))))
    return classes


def _texts(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        for piece in slices(batch, column, SLICE_BYTES):
            held.append(piece)
            size += piece.column(column).nbytes
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _repeated_anchors(rows: DataFrame, buckets: int, one_in: int) -> DataFrame:
    """Per batch of texts the anchors (text, number in it) that another text has too, the batch's texts, and a sample of
    the anchors' leading bytes."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, pieces in enumerate(_texts(batches, "text", BATCH_BYTES)):
            hashes, texts, nths, reps, done, sampled = [], [], [], [], 0, []
            for piece in pieces:
                data, offsets = text_bytes(piece.column("text"))
                text, _, _, place = anchors(data, offsets)
                value = range_hash(prefix_hash(data), place, place + ANCHOR) >> np.uint64(16)
                hashes.append(value)
                texts.append(text + done)
                nths.append(np.arange(len(text)) - np.searchsorted(text, text))
                sampled.append(_leads(data, place[value % np.uint64(one_in) == 0]))
                reps.append(piece.column("rep").to_numpy().view(np.uint64))
                done += piece.num_rows
            value, text, nth = np.concatenate(hashes), np.concatenate(texts), np.concatenate(nths)
            order = np.argsort(value, kind="stable")
            value, text, nth = value[order], text[order], nth[order]
            reps = np.concatenate(reps)
            at = np.searchsorted((value.astype(np.float64) / 2.0**48 * buckets).astype(np.int64), np.arange(buckets + 1))
            yield _rows([(-1 - (part + number) % buckets, part, number, ABOUT, pack(reps))])
            yield _rows([(-1, part, number, SAMPLED, pack(np.concatenate(sampled)))])
            for bucket in np.flatnonzero(np.diff(at)).tolist():
                own = slice(at[bucket], at[bucket + 1])
                used, local = np.unique(text[own], return_inverse=True)
                yield _rows([(bucket, part, number, ENTRIES, pack(sorted_pack(value[own]), np.diff(used, prepend=0), reps[used], local, nth[own]))])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (at,), group in rows_by_key(batches, ["at"]):
            held = []
            for row in group:
                if at < 0:
                    yield _rows([tuple(row.values())])
                    continue
                value, used, reps, local, nth = unpack(row["blob"])
                used = np.cumsum(used)
                held.append((np.cumsum(value, dtype=np.uint64), reps.astype(np.uint64)[local], used[local], nth, row["part"], row["number"]))
            if not held:
                continue
            value, rep = np.concatenate([one[0] for one in held]), np.concatenate([one[1] for one in held])
            order = np.lexsort((rep, value))
            value, rep = value[order], rep[order]
            first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
            last = np.append(first[1:], len(value)) - 1
            several = np.zeros(len(value), bool)
            several[order] = np.repeat(rep[first] != rep[last], last - first + 1)
            ends = np.cumsum([0, *(len(one[0]) for one in held)])
            for one, a, b in zip(held, ends[:-1], ends[1:], strict=True):
                mine = np.flatnonzero(several[a:b])
                if len(mine):
                    mine = mine[np.lexsort((one[3][mine], one[2][mine]))]
                    yield _rows([(at, one[4], one[5], ENTRIES, pack(np.diff(one[2][mine], prepend=0), one[3][mine]))])

    dealt = rows.mapInArrow(split, _ROW).repartition(buckets, "at").sortWithinPartitions("at", "part", "number")
    return store(dealt.mapInArrow(meet, _ROW))


def _by_text(found: DataFrame) -> DataFrame:
    """rep and the packed, sorted numbers of its repeated anchors."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in rows_by_key(batches, ["part", "number"]):
            texts, nths, reps = [], [], np.zeros(0, np.uint64)
            for row in group:
                values = unpack(row["blob"])
                if row["kind"] == ABOUT:
                    reps = values[0].astype(np.uint64)
                else:
                    texts.append(np.cumsum(values[0]))
                    nths.append(values[1])
            if not texts:
                continue
            text, nth = np.concatenate(texts), np.concatenate(nths)
            order = np.lexsort((nth, text))
            text, nth = text[order], nth[order]
            first = np.flatnonzero(np.diff(text, prepend=-1))
            blobs = [pack(np.diff(nth[a:b], prepend=0)) for a, b in zip(first, np.append(first[1:], len(text)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(reps[text[first]].view(np.int64)), pa.array(blobs, pa.binary())], ["rep", "picked"])

    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = found.where(F.col("kind") < SAMPLED).repartition(tasks, "part", "number").sortWithinPartitions("part", "number", "kind")
    return store(own.mapInArrow(gather, "rep long, picked binary"))


def _splitters(found: DataFrame, buckets: int) -> np.ndarray:
    sampled = [unpack(row["blob"])[0] for row in found.where(F.col("kind") == SAMPLED).select("blob").toLocalIterator()]
    values = np.sort(np.concatenate([*sampled, np.zeros(0, np.uint64)]).astype(np.uint64))
    return values[np.linspace(0, len(values) - 1, buckets + 1)[1:-1].astype(np.int64)] if len(values) else values


def _spans(chosen: DataFrame, splitters: np.ndarray, buckets: int) -> DataFrame:
    """rep, removed bytes, number of maximal removed runs, and the packed runs of each text that has any.

    chosen: rep, first (the text's smallest document), packed text and its repeated anchors.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                piece = batch.slice(begin, 2000)
                first = piece.column("first").to_numpy().view(np.uint64) + _BIAS
                picked = piece.column("picked").to_pylist()
                parts, pieces, done, moved = [], [], 0, 0
                texts = pa.RecordBatch.from_arrays([unpacked(piece.column("packed"))], ["text"])
                for few in slices(texts, "text", SLICE_BYTES):
                    data, offsets = text_bytes(few.column("text"))
                    text, low, high, place = anchors(data, offsets)
                    heads = np.searchsorted(text, np.arange(few.num_rows))
                    own = [heads[row] + np.cumsum(unpack(picked[done + row])[0]) for row in range(few.num_rows)]
                    own = np.concatenate(own)
                    text, low, size, place = text[own], low[own], high[own] - low[own] + WINDOW, place[own]
                    whole = mix(range_hash(prefix_hash(data), low, low + size) + (place - low).astype(np.uint64))
                    bucket = np.searchsorted(splitters, _leads(data, place), side="right")
                    parts.append((text + done, low + moved, low - offsets[text], size, whole, bucket))
                    pieces.append(data)
                    done, moved = done + few.num_rows, moved + len(data)
                data = np.concatenate(pieces)
                text, low, inside, size, whole, bucket = (np.concatenate([part[k] for part in parts]) for k in range(6))
                order = np.lexsort((first[text], whole, bucket))
                text, low, inside, size, bucket, whole = text[order], low[order], inside[order], size[order], bucket[order], whole[order]
                new = np.ones(len(text), bool)
                new[1:] = (whole[1:] != whole[:-1]) | (bucket[1:] != bucket[:-1])
                head = np.flatnonzero(new)
                at = np.searchsorted(bucket[head], np.arange(buckets + 1))
                about = pack(piece.column("rep").to_numpy().view(np.uint64), first, text, inside, np.cumsum(new) - 1, size[head], at)
                yield _rows([(-1 - (part + number) % buckets, part, number, ABOUT, about)])
                for b in np.flatnonzero(np.diff(at)).tolist():
                    own = head[at[b] : at[b + 1]]
                    where = np.repeat(low[own] - np.cumsum(size[own]) + size[own], size[own]) + np.arange(size[own].sum())
                    yield _rows([(b, part, number, ENTRIES, pack(data[where], size[own], first[text[own]]))])
                number += 1

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (at,), group in rows_by_key(batches, ["at"]):
            held = []
            for row in group:
                if at < 0:
                    yield _rows([tuple(row.values())])
                    continue
                held.append((*unpack(row["blob"]), row["part"], row["number"]))
            if not held:
                continue
            data = np.concatenate([one[0] for one in held]).astype(np.uint8)
            size, doc = np.concatenate([one[1] for one in held]), np.concatenate([one[2] for one in held]).astype(np.uint64)
            count = size - WINDOW + 1
            begin = np.cumsum(size) - size
            starts = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
            classes = equal_windows(data, starts)
            smallest = np.full(len(starts), np.iinfo(np.uint64).max, np.uint64)
            order = np.argsort(classes, kind="stable")
            head = np.flatnonzero(np.diff(classes[order], prepend=-1))
            smallest[classes[order][head]] = np.minimum.reduceat(np.repeat(doc, count)[order], head)
            least = smallest[classes]
            ends = np.cumsum([0, *(int((one[1] - WINDOW + 1).sum()) for one in held)])
            for one, a, b in zip(held, ends[:-1], ends[1:], strict=True):
                yield _rows([(at, one[3], one[4], ENTRIES, pack(least[a:b]))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in rows_by_key(batches, ["part", "number"]):
            parts = []
            for row in group:
                values = unpack(row["blob"])
                if row["kind"] == ABOUT:
                    reps, first, text, low, distinct, size, at = values
                else:
                    parts.append(values[0].astype(np.uint64))
            if not parts:
                continue
            # Buckets come back in order, so their windows are those of the distinct stretches in order.
            least, count = np.concatenate(parts), size - WINDOW + 1
            begin = np.cumsum(count) - count
            own = count[distinct]
            window = np.repeat(begin[distinct] - np.cumsum(own) + own, own) + np.arange(own.sum())
            start = np.repeat(low - np.cumsum(own) + own, own) + np.arange(own.sum())
            text = np.repeat(text, own)
            gone = least[window] < first.astype(np.uint64)[text]
            text, start = text[gone], start[gone]
            order = np.lexsort((start, text))
            text, start = text[order], start[order]
            if not len(text):
                continue
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (start[1:] > start[:-1] + WINDOW)
            head = np.flatnonzero(new)
            until = start[np.append(head[1:], len(text)) - 1] + WINDOW
            owner, since = text[head], start[head]
            cut = np.flatnonzero(np.diff(owner, prepend=-1))
            for a, b in zip(cut, np.append(cut[1:], len(owner)), strict=True):
                rep = int(reps.astype(np.uint64)[owner[a]].astype(np.int64))
                removed = int((until[a:b] - since[a:b]).sum())
                out.append((rep, removed, int(b - a), pack(sorted_pack(since[a:b]), until[a:b] - since[a:b])))
            yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in out], schema)
            out.clear()

    names = ["rep", "n_removed", "n_spans", "spans"]
    schema = pa.schema([("rep", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.binary())])
    out: list[tuple] = []
    dealt = chosen.mapInArrow(split, _ROW).repartition(buckets, "at").sortWithinPartitions("at", "part", "number")
    tasks = int(chosen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    back = dealt.mapInArrow(sort, _ROW).repartition(tasks, "part", "number").sortWithinPartitions("part", "number", "kind", "at")
    return back.mapInArrow(gather, "rep long, n_removed long, n_spans long, spans binary").dropDuplicates(["rep"])


def _kept(rows: DataFrame, keep_text: bool) -> DataFrame:
    """rep and the hash (and text, where asked for) of what is left when the runs are cut out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                piece = batch.slice(begin, 500)
                left = []
                for packed, spans in zip(unpacked(piece.column("packed")).to_pylist(), piece.column("spans").to_pylist(), strict=True):
                    text, at, parts = packed.encode(), 0, []
                    since, length = unpack(spans) if spans else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                    for start, size in zip(np.cumsum(since, dtype=np.uint64).tolist(), length.tolist(), strict=True):
                        parts.append(text[at:start])
                        at = start + size
                    left.append(b"".join([*parts, text[at:]]))
                columns = [piece.column("rep"), *(piece.column(c) for c in ("n_removed", "n_spans")), pa.array([hashlib.sha256(one).hexdigest() for one in left])]
                kept = pa.array([one.decode(errors="ignore") if keep_text else None for one in left], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, kept], ["rep", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(cut, "rep long, n_removed long, n_spans long, kept_sha256 string, kept string").dropDuplicates(["rep"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row (and `kept`, the remaining text, with keep_text;
    a character cut in two is dropped from it).

    Each byte goes that a WINDOW-byte string covers which also starts in a document of smaller id; all strings are
    judged on the input and never span documents. Equal texts are handled once: copies of a text with a smaller id
    are all covered. A text shorter than WINDOW bytes, null or empty keeps everything. A null id is larger than all
    others; equal ids do not count against each other. An empty table gives an empty result. Only the two named
    columns are read.
    """
    largest = F.lit(2**63 - 1).cast("long")
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text")).withColumn("digest", F.sha2("text", 256))
    named = rows.select(F.coalesce("doc_id", largest).alias("id"), F.xxhash64("digest").alias("rep"), "text")
    known = store(rows.select("doc_id", F.xxhash64("digest").alias("rep"), "digest", F.octet_length("text").cast("long").alias("n_bytes")))
    firsts = store(known.groupBy("rep").agg(F.min(F.coalesce("doc_id", largest)).alias("first")))
    size = known.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(2, -(-size // BUCKET_BYTES))
    found = _repeated_anchors(named.select("rep", "text"), buckets, max(1, size // (16 * SAMPLE)))
    picked = _by_text(found)
    splitters = _splitters(found, buckets)
    texts = packed_texts(named)
    chosen = texts.join(firsts.join(picked, "rep"), "rep").where("id = first").select("rep", "first", "packed", "picked")
    spans = store(_spans(chosen, splitters, buckets))
    # With the texts asked for, those that keep everything are returned too.
    results = _kept(texts.join(spans, "rep", "left" if keep_text else "inner").join(firsts, "rep").where("id = first").select("rep", "packed", "n_removed", "n_spans", "spans"), keep_text)
    joined = known.join(firsts, "rep").join(results, "rep", "left")
    copy = (F.coalesce("doc_id", largest) > F.col("first")) & (F.col("n_bytes") >= WINDOW)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    out = joined.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
    return out if keep_text else out.drop("kept")
