"""Near-duplicate documents by order MinHash and banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often it occurred before. A sketch keeps, for
each of BANDS hash functions, the TUPLE labelled shingles of smallest hash in the order they have in the text, so texts
agree in a band if they share those shingles and their order: likely at a small edit distance only. Texts that agree in
a band are candidates. A candidate pair is aligned: with m matches in the longest common subsequence of the two
shingle sequences, inside the band that a similarity of `least` allows, its similarity is m / (a + b - m).

Buckets are never expanded into all pairs. The smallest and the largest member are compared with all others. A bucket
that this leaves in several classes goes to one task with its texts, which looks for all links that are missing, if it
is of bounded size. Of a larger one, the members outside its largest class are dealt out in blocks, and each block is
held against all members, block by block, in a task for each two blocks. So every pair that agrees in a band is joined or
has been found not to be alike, whatever the size of its bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.blobs import rows_by_key
from kerbline.llm.components import components
from kerbline.llm.hashing import mix, packed_texts, shingles, slices, text_bytes, unpacked, word_hashes
from kerbline.llm.stage import store

BANDS = 16
TUPLE = 3
SHINGLE = 5
LEAST = 0.8
#: A bucket whose number of texts times its number of shingles is at most this is settled in one task, a larger one in
#: blocks of about BLOCK shingles.
WORK = 1_000_000_000
BLOCK = 1 << 20

_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def labelled(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Shingle values made distinct within each text by the number of the same shingle before."""
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((values, text))
    new = np.ones(len(values), bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (text[order][1:] != text[order][:-1])
    run = np.flatnonzero(new)
    seen = np.arange(len(values)) - np.repeat(run, np.diff(np.append(run, len(values))))
    out = np.empty_like(values)
    out[order] = mix(values[order] + seen.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return out


def order_sketch(values: np.ndarray) -> np.ndarray:
    """One key for each band of a text's labelled shingles (all of them, where there are no more than TUPLE)."""
    if not len(values):
        return np.zeros(BANDS, np.uint64)
    hashes = mix(values[:, None] ^ _SEEDS[None, :])
    taken = min(TUPLE, len(values))
    least = np.argpartition(hashes, taken - 1, axis=0)[:taken] if len(values) > taken else np.tile(np.arange(taken)[:, None], BANDS)
    least.sort(axis=0)
    key = np.zeros(BANDS, np.uint64)
    for place in range(taken):
        key = mix(key * np.uint64(0x100000001B3) + values[least[place]])
    return key ^ _SEEDS


def sketches(rows: DataFrame) -> DataFrame:
    """Each row's doc_id with the digest and the order sketch of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                values, ends = shingles(*word_hashes(*text_bytes(piece.column("text"))), SHINGLE)
                values = labelled(values, ends)
                keys = np.stack([order_sketch(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
                columns = [piece.column("doc_id"), piece.column("digest"), lists, pa.array(np.diff(ends))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "keys", "size"])

    known = rows.select("doc_id", F.sha2("text", 256).alias("digest"), "text")
    return known.mapInArrow(run, "doc_id long, digest string, keys array<long>, size long")


def banded_matches(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence over cells at most `band` off the diagonal, one row of bits at a time."""
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(differs[0]) if len(differs) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    places: dict[int, int] = {}
    for column, value in enumerate(b.tolist()):
        places[value] = places.get(value, 0) | 1 << column
    row = every = (1 << len(b)) - 1
    width = (1 << 2 * band + 1) - 1
    for line, value in enumerate(a.tolist()):
        match = places.get(value, 0)
        if match:
            match &= width << line - band if line > band else width >> band - line
        if match:
            hit = row & match
            row = ((row + hit) | (row - hit)) & every
    return head + tail + len(b) - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """Aligned similarity of two shingle sequences, or 0 once it cannot reach `least`."""
    total = len(a) + len(b)
    if not total:
        return 1.0
    needed = least / (1 + least) * total
    if min(len(a), len(b)) < needed - 1e-9:
        return 0.0
    values, sides = np.concatenate([a, b]), np.repeat([1, -1], [len(a), len(b)])
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    shared = (counts - np.abs(np.bincount(inverse, sides).astype(np.int64))).sum() // 2
    if shared < needed - 1e-9:
        return 0.0
    matches = banded_matches(a, b, int(total - 2 * needed) + 1)
    return matches / (total - matches)


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose aligned similarity is at least `least`."""

    def sequences(column: pa.Array) -> list[np.ndarray]:
        values, ends = shingles(*word_hashes(*text_bytes(unpacked(column))), SHINGLE)
        return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                piece = batch.slice(begin, 200)
                both = zip(sequences(piece.column("packed_a")), sequences(piece.column("packed_b")), strict=True)
                near = pa.array(np.flatnonzero([similarity(one, two, least) >= least for one, two in both]))
                yield pa.RecordBatch.from_arrays([piece.column(c).take(near) for c in ("a", "b")], ["a", "b"])

    left = texts.select(F.col("rep").alias("a"), F.col("packed").alias("packed_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("packed").alias("packed_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "packed_a", "packed_b").mapInArrow(run, "a long, b long")


def _labels(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    named = buckets.join(classes.select(F.col("node").alias("rep"), "label"), "rep", "left")
    return named.withColumn("label", F.coalesce("label", "rep"))


def _shared(buckets: DataFrame) -> DataFrame:
    """Members of the buckets with more than one, with the bucket's smallest and largest member."""
    sizes = buckets.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first <> last")
    return store(buckets.join(sizes, "key"))


def near_links(keyed: DataFrame, rows: DataFrame, least: float = LEAST) -> DataFrame:
    """Links between distinct texts, enough to join every class.

    keyed: rep, doc_id, keys and number of shingles of each distinct text; rows: doc_id and text, which have it. Only texts that share a
    bucket are looked up.
    """
    shared = _shared(keyed.select("rep", F.posexplode("keys").alias("band", "key")))
    involved = keyed.select("rep", "doc_id").join(shared.select("rep").distinct(), "rep")
    packed = packed_texts(rows.withColumn("digest", F.sha2("text", 256)).select("doc_id", F.xxhash64("digest").alias("rep"), "text"))
    texts = store(packed.join(involved, ["rep", "doc_id"]).dropDuplicates(["rep"]).select("rep", "packed"))
    stars = shared.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b"))
    other_stars = shared.where("rep <> last").select(F.col("rep").alias("a"), F.col("last").alias("b"))
    links = store(verified(store(stars.union(other_stars).distinct()), texts, least))
    members, sizes = _open(keyed, shared, store(components(links)))
    bounded = sizes.where(F.col("n") * F.col("total") <= WORK)
    links = links.union(store(_links_within(members.join(bounded.select("key"), "key"), texts, least)))
    large = store(shared.join(sizes.where(F.col("n") * F.col("total") > WORK).select("key"), "key").select("rep", "band", "key"))
    if large.isEmpty():
        return links
    # The bounded buckets may have joined much of the large ones.
    members, sizes = _open(keyed, large, store(components(links)))
    return links.union(store(_links_across(members, sizes, texts, least)))


def _open(keyed: DataFrame, shared: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of the buckets that are in several classes, and these buckets' numbers of texts and shingles."""
    members = keyed.select("rep", "size").join(_labels(shared.select("rep", "band", "key"), classes), "rep")
    sizes = members.groupBy("key").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("size").alias("total"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    sizes = store(sizes.where("low <> high").select("key", "n", "total"))
    return store(members.join(sizes.select("key"), "key")), sizes


def _links_within(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between members of a bucket that are not linked yet, enough to join all that are near each other.

    Each member outside the bucket's largest class is held against all others at once: shared labelled shingles bound
    the similarity from above, and only pairs that may reach `least`, and are not joined by then, are aligned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in rows_by_key(batches, ["key"]):
            held = list(rows)
            values, ends = shingles(*word_hashes(*text_bytes(unpacked(pa.array([row["packed"] for row in held])))), SHINGLE)
            reps = [row["rep"] for row in held]
            found = join_bucket(values, ends, [row["label"] for row in held], least)
            yield pa.RecordBatch.from_arrays([pa.array([reps[i] for i, _ in found], pa.int64()), pa.array([reps[j] for _, j in found], pa.int64())], ["a", "b"])

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select("key", "rep", "label").join(texts, "rep").repartition(tasks, "key").sortWithinPartitions("key", "rep")
    return dealt.mapInArrow(run, "a long, b long")


def _links_across(members: DataFrame, sizes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The same links for buckets too large for one task: members outside a bucket's largest class ask, all members
    answer. A task holds one block of those that ask and one of those that answer.
    """
    by_label = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("held"), F.sum("size").alias("shingles"))
    largest = by_label.groupBy("key").agg(F.max(F.struct("held", "label", "shingles")).alias("largest"), F.sum("shingles").alias("total"))
    rest = F.col("total") - F.col("largest.shingles")
    plan = largest.select(
        "key",
        F.col("largest.label").alias("main"),
        F.ceil(F.greatest(rest, F.lit(1)) / BLOCK).alias("asking"),
        F.ceil(F.greatest("total", F.lit(1)) / BLOCK).alias("answering"),
    )
    block = lambda of, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(of))
    planned = members.join(plan, "key").withColumn("outside", F.col("label") != F.col("main"))
    each = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    kept = ["key", "rep", "label", "outside"]
    ask = planned.where("outside").select(*kept, F.lit(True).alias("asks"), block("asking", 1).alias("x"), each("answering").alias("y"))
    answer = planned.select(*kept, F.lit(False).alias("asks"), each("asking").alias("x"), block("answering", 2).alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in rows_by_key(batches, ["key", "x", "y"]):
            held = list(rows)
            if not held[-1]["asks"] or held[0]["asks"]:
                continue
            values, ends = shingles(*word_hashes(*text_bytes(unpacked(pa.array([row["packed"] for row in held])))), SHINGLE)
            sides = [row["asks"] for row in held], [row["outside"] for row in held]
            reps = np.array([row["rep"] for row in held], np.int64)
            found = np.array(join_blocks(values, ends, [row["label"] for row in held], reps, *sides, least), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(reps[found[:, 0]]), pa.array(reps[found[:, 1]])], ["a", "b"])

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = ask.union(answer).join(texts, "rep").repartition(tasks, "key", "x", "y").sortWithinPartitions("key", "x", "y", "asks", "rep")
    return cells.mapInArrow(run, "a long, b long")


def join_blocks(
    values: np.ndarray, ends: np.ndarray, labels: list[int], reps: np.ndarray, asks: list[bool], outside: list[bool], least: float = LEAST
) -> list[tuple[int, int]]:
    """Pairs of a text that asks and one that answers, at least `least` alike, that join the classes given by `labels` as
    far as possible. Of two texts that both ask somewhere (`outside`) the one with the smaller number asks.

    Alike texts share `least` of the larger one's labelled shingles, so any 1 - least of one text's and one more hold a
    shared one. The rarest are looked up.
    """
    _, dense, counts = np.unique(labelled(values, ends), return_inverse=True, return_counts=True)
    size = np.diff(ends)
    text = np.repeat(np.arange(len(size)), size)
    by_rarity = np.lexsort((dense, counts[dense], text))
    place = np.arange(len(dense)) - np.repeat(ends[:-1], size)
    looked_up = by_rarity[place < (size - np.ceil(least * size - 1e-9) + 1)[text]]
    asks, outside = np.array(asks), np.array(outside)
    answering = looked_up[~asks[text[looked_up]]]
    answering = answering[np.argsort(dense[answering], kind="stable")]
    answers, terms = text[answering], dense[answering]
    asking = looked_up[asks[text[looked_up]]]
    bounds = np.searchsorted(text[asking], np.arange(len(size) + 1))
    empty = np.flatnonzero(~asks & (size == 0))
    root = np.unique(np.array(labels), return_inverse=True)[1]
    mark = np.zeros(len(dense) + 1, bool)
    out = []
    for i in np.flatnonzero(asks).tolist():
        own = dense[asking[bounds[i] : bounds[i + 1]]]
        low, high = np.searchsorted(terms, own), np.searchsorted(terms, own, side="right")
        met = np.unique(np.concatenate([answers[a:b] for a, b in zip(low, high, strict=True)])) if size[i] else empty
        met = met[(root[met] != root[i]) & ~(outside[met] & (reps[met] < reps[i]))]
        mark[dense[ends[i] : ends[i + 1]]] = True
        for j in met.tolist():
            if root[i] == root[j]:
                continue
            shared = np.count_nonzero(mark[dense[ends[j] : ends[j + 1]]])
            if shared + 1e-9 < least / (1 + least) * (size[i] + size[j]):
                continue
            if similarity(values[ends[i] : ends[i + 1]], values[ends[j] : ends[j + 1]], least) >= least:
                out.append((i, j))
                root[root == root[j]] = root[i]
        mark[dense[ends[i] : ends[i + 1]]] = False
    return out


def join_bucket(values: np.ndarray, ends: np.ndarray, labels: list[int], least: float = LEAST) -> list[tuple[int, int]]:
    """Pairs of a bucket's texts, at least `least` alike, that join the classes given by `labels` as far as possible."""
    _, dense = np.unique(labelled(values, ends), return_inverse=True)
    counts = np.diff(ends)
    full = np.flatnonzero(counts)
    root = np.unique(np.array(labels), return_inverse=True)[1]
    largest = np.bincount(root).argmax()
    mark = np.zeros(len(dense) + 1, bool)
    out = []
    for i in np.flatnonzero(root != largest).tolist():
        own = dense[ends[i] : ends[i + 1]]
        mark[own] = True
        shared = np.zeros(len(counts), np.int64)
        shared[full] = np.add.reduceat(mark[dense], ends[full]) if len(full) else 0
        mark[own] = False
        near = (shared + 1e-9 >= least / (1 + least) * (counts + counts[i])) & (root != root[i])
        for j in np.flatnonzero(near).tolist():
            if root[i] != root[j] and similarity(values[ends[i] : ends[i + 1]], values[ends[j] : ends[j + 1]], least) >= least:
                out.append((i, j))
                root[root == root[j]] = root[i]
    return out


def _classed(docs: DataFrame, id_col: str, text_col: str, least: float) -> DataFrame:
    """Per row: doc_id, digest of the text, class_id, class_size, and whether it is the row of its class that stays."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    known = store(sketches(rows))
    same = known.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys"), F.first("size").alias("size")
    )
    # A text is known by a 64-bit number of its digest from here on.
    copies = store(same.select("digest", F.xxhash64("digest").alias("rep"), "doc_id", "n", "keys", "size"))
    links = near_links(copies.select("rep", "doc_id", "keys", "size"), rows, least)
    named = copies.select("digest", "rep", F.col("doc_id").alias("least"), "n")
    named = store(_labels(named, components(links)))
    first = F.min(F.struct(F.col("least").isNull(), "least", "digest"))
    found = named.groupBy("label").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"), first.alias("first"))
    by_text = named.join(found, "label").select("digest", "least", "class_id", "class_size", (F.col("digest") == F.col("first.digest")).alias("stays"))
    joined = known.select("doc_id", "digest").join(by_text, "digest")
    stays = F.col("stays") & F.col("doc_id").eqNullSafe(F.col("least"))
    return joined.select("doc_id", "digest", "class_id", "class_size", stays.alias("stays"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """doc_id, class_id (smallest id of the class) and class_size of every row.

    Equal texts are one class from the start, so copies cost one row each and are never paired. A null text is an empty
    one; empty texts are copies of each other. A text of fewer than five words is one shingle. A null id stays in the
    result; a text whose ids are all null is a class without id. Repeated rows are kept. An empty table gives an
    empty result. Only the two named columns are read.
    """
    return _classed(docs, id_col, text_col, least).select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row of docs for each class, with all its columns: that with the smallest id, of equal ids that with the
    smallest text digest. Rows are removed by id and digest, so texts are shuffled only where there are many to remove
    or rows repeat."""
    classed = store(_classed(docs, "doc_id", "text", least))
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    same = lambda other: docs["doc_id"].eqNullSafe(other["doc_id"]) & (digest == other["digest"])
    gone = classed.where("not stays").select("doc_id", "digest").distinct()
    kept = docs.join(gone, same(gone), "left_anti")
    repeated = store(classed.where("stays").groupBy("doc_id", "digest").count().where("count > 1").select("doc_id", "digest"))
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same(repeated), "left_anti").union(once)
