"""Line deduplication over a deletion neighbourhood of one edit.

Two lines are one edit apart (a character inserted, deleted or replaced) exactly if they have a variant in common: the
line without one of its characters, or for the shorter of two the line itself. Each line emits all its variants as
hashed keys; within a key, lines that lack a character at the same place differ by a replacement, and a whole line
differs from any other by an insertion. So links to the earliest line are found in one pass over a key's lines in
order, however many there are, and are verified on the texts.

A line of n characters has n variants, so only lines that may have a neighbour emit them: an edit falls in one of PARTS parts
of a line, and what stands before and behind that part must agree with another line's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.hashing import BASE, mix, packed_texts, power_table, range_hash, slices, unpacked
from kerbline.llm.stage import store

PARTS = 4
#: Shorter lines are compared exactly: one edit makes another word of them.
MIN_CHARS = 20


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and the n + 1 offsets."""
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return data, np.cumsum([0, *map(len, texts)])


def _prefix(characters: np.ndarray) -> np.ndarray:
    out = np.zeros(len(characters) + 1, np.uint64)
    np.cumsum(mix(characters.astype(np.uint64) + np.uint64(1)) * power_table(BASE, len(characters)), out=out[1:])
    return out


def _lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines that are not blank: text, number in it, first and last + 1 character, hash; and the prefix sums."""
    characters, offsets = _characters(texts)
    breaks = np.flatnonzero(characters == 10)
    text_of = np.searchsorted(offsets, breaks, side="right") - 1
    begins = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    order = np.lexsort((begins, np.concatenate([np.arange(len(texts)), text_of])))
    owner = np.concatenate([np.arange(len(texts)), text_of])[order]
    begins, ends = begins[order], np.sort(ends, kind="stable")
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    space = np.isin(characters, [0x20, *range(0x09, 0x0E)])
    filled = np.concatenate([[0], np.cumsum(~space)])
    kept = filled[ends] > filled[begins]
    owner, number, begins, ends = owner[kept], number[kept], begins[kept], ends[kept]
    prefix = _prefix(characters)
    return owner, number, begins, ends, range_hash(prefix, begins, ends) ^ mix((ends - begins).astype(np.uint64)), prefix


def _part_keys(begins: np.ndarray, ends: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """For each line, as one of length n and as the longer of a pair, a key of what is before and behind each part."""
    size = ends - begins
    keys = []
    for length in (size, size - 1):
        for part in range(PARTS):
            low, high = length * part // PARTS, length * (part + 1) // PARTS
            before = range_hash(prefix, begins, begins + low)
            behind = range_hash(prefix, ends - (length - high), ends)
            keys.append(mix(before * np.uint64(3) + behind + (length * PARTS + part).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return np.stack(keys, axis=1).view(np.int64)


def scanned_lines(rows: DataFrame) -> DataFrame:
    """One row per line that is not blank: h (hash), doc_id, rep (of the text), line, and the part keys of lines of
    MIN_CHARS characters or more (once per batch and line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                owner, number, begins, ends, hashes, prefix = _lines(piece.column("text").to_pylist())
                keys = _part_keys(begins, ends, prefix)
                first = np.zeros(len(hashes), bool)
                first[np.unique(hashes, return_index=True)[1]] = True
                first &= ends - begins >= MIN_CHARS
                lists = [key if has else None for key, has in zip(keys.tolist(), first.tolist(), strict=True)]
                owners = pa.array(owner)
                columns = [pa.array(hashes.view(np.int64)), *(piece.column(c).take(owners) for c in ("doc_id", "rep"))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(number), pa.array(lists, pa.list_(pa.int64()))], ["h", "doc_id", "rep", "line", "keys"])

    return rows.mapInArrow(run, "h long, doc_id long, rep long, line long, keys array<long>")


def _sharing(keyed: DataFrame) -> DataFrame:
    """The lines that share a part key with another line, from rows (key, h)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_line = None, None
        for batch in batches:
            key, line = batch.column("key").to_numpy(), batch.column("h").to_numpy()
            same = np.zeros(len(key), bool)
            same[1:] = (key[1:] == key[:-1]) & (line[1:] != line[:-1])
            if len(key) and last_key == key[0] and last_line != line[0]:
                yield pa.RecordBatch.from_arrays([pa.array([last_line, line[0]])], ["h"])
            pairs = np.flatnonzero(same)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(line[np.concatenate([pairs, pairs - 1])]))], ["h"])
            if len(key):
                last_key, last_line = key[-1], line[-1]

    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(tasks, "key").sortWithinPartitions("key", "h").mapInArrow(run, "h long").distinct()


def _variants(lines: DataFrame) -> DataFrame:
    """All variants of all lines: v (hash), place of the missing character (-1: none), and the line's h and order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                characters, _ = _characters(row.column("text").to_pylist())
                prefix, n = _prefix(characters), len(characters)
                inverse = np.uint64(pow(BASE, -1, 2**64))
                # Without character i, what follows moves one place down: its terms are divided by the base once.
                place = np.arange(n)
                less = prefix[place] + (prefix[n] - prefix[place + 1]) * inverse
                v = mix(np.concatenate([less, prefix[n:]]) + mix(np.append(np.full(n, n - 1), n).astype(np.uint64)))
                columns = [pa.array(v.view(np.int64)), pa.array(np.append(place, -1))]
                columns += [row.column(c).take(pa.array(np.zeros(n + 1, np.int64))) for c in ("h", "doc_id", "line")]
                yield pa.RecordBatch.from_arrays(columns, ["v", "place", "h", "doc_id", "line"])

    return lines.mapInArrow(run, "v long, place long, h long, doc_id long, line long")


def _earlier(variants: DataFrame) -> DataFrame:
    """Links (h, earlier) from each line to the earliest lines that a variant shows to be one edit away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, {}
        for batch in batches:
            v, place, line = (batch.column(c).to_numpy() for c in ("v", "place", "h"))
            alone = np.ones(len(v), bool)
            alone[1:] &= v[1:] != v[:-1]
            alone[:-1] &= v[1:] != v[:-1]
            alone[[0, -1]] = False
            links = set()
            for at in np.flatnonzero(~alone).tolist():
                key, gap, own = int(v[at]), int(place[at]), int(line[at])
                if key != current:
                    current, seen = key, {}
                # Earliest lines so far: by the place of the missing character, -1 the line itself, -2 any with a gap.
                for other in {seen.get(gap), seen.get(-1 if gap >= 0 else -2)} - {None, own}:
                    links.add((own, other))
                seen.setdefault(gap, own)
                if gap >= 0:
                    seen.setdefault(-2, own)
            if links:
                yield pa.RecordBatch.from_pylist([{"h": a, "earlier": b} for a, b in links], schema)

    schema = pa.schema([("h", pa.int64()), ("earlier", pa.int64())])
    tasks = int(variants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = variants.repartition(tasks, "v").sortWithinPartitions("v", "doc_id", "line", "h")
    return dealt.mapInArrow(run, "h long, earlier long").distinct()


def within_one_edit(a: str, b: str) -> bool:
    """Whether at most one inserted, deleted or replaced character makes a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _verified(links: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines (h) with an earlier line at most one edit away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [within_one_edit(a, b) for a, b in zip(batch.column("text").to_pylist(), batch.column("other").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("h").filter(pa.array(near, pa.bool_()))], ["h"])

    texts = lines.select("h", "text")
    other = lines.select(F.col("h").alias("earlier"), F.col("text").alias("other"))
    return links.join(texts, "h").join(other, "earlier").select("h", "text", "other").mapInArrow(run, "h long").distinct()


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines (all, blank ones too), n_removed and removed (numbers from 0, ascending) of every row.

    A line goes if an earlier one, by document id and number, is equal or at most one edit away, kept or not; lines of fewer than
    MIN_CHARS characters go only for an equal one, blank lines never. A null or empty text is one blank line. A null id comes
    last. Rows with the same id and text are one document and get the same result each; lines of different
    texts with the same id are ordered by number, then by hash. An empty table gives an empty result. Only the two named columns are read.
    """
    largest = F.lit(2**63 - 1).cast("long")
    text = F.coalesce(docs[text_col], F.lit(""))
    own = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[id_col].cast("long"), largest).alias("doc_id"), F.xxhash64(text).alias("rep"), text.alias("text"))
    lines = store(scanned_lines(own.select("doc_id", "rep", "text")))
    place = F.struct("doc_id", "line", "rep")
    distinct = store(lines.groupBy("h").agg(F.min(place).alias("first"), F.first("keys", ignorenulls=True).alias("keys")))
    sharing = _sharing(distinct.where("keys is not null").select(F.explode("keys").alias("key"), "h"))
    wanted = distinct.select("h", "first").join(sharing, "h").select("h", "first.*")
    by_text = wanted.groupBy("doc_id", "rep").agg(F.collect_list(F.struct("line", "h")).alias("wanted"))
    candidates = store(_texts_of(packed_texts(own.select("doc_id", "rep", "text")).join(by_text, ["doc_id", "rep"])).dropDuplicates(["h"]))
    near = store(_verified(store(_earlier(_variants(candidates))), candidates).withColumn("near", F.lit(True)))
    judged = lines.select("h", "doc_id", "rep", "line").join(distinct.select("h", "first"), "h").join(near, "h", "left")
    gone = judged.where(F.col("near") | (F.struct("doc_id", "line", "rep") > F.col("first")))
    removed = gone.groupBy("doc_id", "rep").agg(F.array_sort(F.collect_set(F.col("line").cast("int"))).alias("removed"))
    sizes = own.select("id", "doc_id", "rep", (F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).cast("long").alias("n_lines"))
    none = F.expr("cast(array() as array<int>)")
    joined = sizes.join(removed, ["doc_id", "rep"], "left").withColumn("removed", F.coalesce("removed", none))
    return joined.select(F.col("id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def _texts_of(packed: DataFrame) -> DataFrame:
    """The wanted lines of packed texts, with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                piece, out = batch.slice(begin, 500), []
                texts = unpacked(piece.column("packed")).to_pylist()
                for text, doc, rep, lines in zip(texts, *(piece.column(c).to_pylist() for c in ("doc_id", "rep", "wanted")), strict=True):
                    parts = text.split("\n")
                    out += [{"h": one["h"], "doc_id": doc, "rep": rep, "line": one["line"], "text": parts[one["line"]]} for one in lines]
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("rep", pa.int64()), ("line", pa.int64()), ("text", pa.string())])
    return packed.mapInArrow(run, "h long, doc_id long, rep long, line long, text string")
