"""Scoring by a hierarchical Pitman-Yor bigram model.

Every context word is a restaurant whose customers are the words that follow it; its tables are customers of the parent
restaurant of single words, which all contexts share; the parent's base is uniform over the V known words and one for
the rest. Seating is sampled by Gibbs: all customers of a dish in a restaurant are seated anew, given the other
tables there and the parent's probability; predictive probabilities are averaged over the samples kept.

A sweep draws the dishes of a restaurant side by side, each given what the others had in the sweep before. That is what
lets blocks work apart, and it is an approximation: a sequential sampler would see each new draw at once. The tests hold
its probabilities against such a sampler.

The table of word pairs is cut in blocks, by hash of the context and of the word, of a bounded number of tokens. A block
knows its pairs; of the totals of a word or context it asks for what it needs, and Spark sums up what the blocks of a
row or column report. So no vocabulary is ever broadcast or held in one task. Pairs that occur once always
have one table; sweeps visit only the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.blobs import pack, rows_by_key, sorted_pack, unpack
from kerbline.llm.hashing import slices, text_bytes, word_hashes
from kerbline.llm.stage import store

HELD_OUT_OF, HELD_OUT = 7, 2
BURN_IN, SAMPLES = 1, 2
STRENGTH = 1.0
EXACT = 100
BLOCK_BYTES = 28 << 20
#: Texts are turned into pairs in batches of about so many bytes.
BATCH_BYTES = 12 << 20
#: Texts' pairs of a block with more tokens than this go to several tasks, each with a copy of the block.
PART_TOKENS = BLOCK_BYTES // 4
#: Counts of a block from so many pairs, and as many as it has distinct ones, are added up before more are read.
MERGE_PAIRS = 8 << 20
_END = np.uint64(0x5EED0E4D5EED0E4D)
_ROW = "i int, j int, kind int, src int, blob binary"
_SCHEMA = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("kind", pa.int32()), ("src", pa.int32()), ("blob", pa.binary())])
CONTEXT, WORD = 0, 1


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, row, strict=True)) for row in rows], _SCHEMA)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT_OF == HELD_OUT


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and word of every token of some texts, an end token behind each, and the n + 1 token offsets."""
    hashes, firsts = word_hashes(*text_bytes(column), lower=True)
    counts = np.diff(firsts)
    ends = np.concatenate([[0], np.cumsum(counts + 1)])
    tokens = np.full(ends[-1], _END, np.uint64)
    tokens[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[ends[:-1]] = _END
    return context, tokens, ends


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of about BATCH_BYTES of text with their tokens' contexts, words and rows."""
    held: list[pa.RecordBatch] = []
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = tokens = 0

    def flush() -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
        meta = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        columns = [np.concatenate([part[k] for part in parts]) for k in range(3)]
        parts.clear()
        return meta, *columns

    for batch in batches:
        for piece in slices(batch, "text"):
            context, word, ends = _pairs(piece.column("text"))
            parts.append((context, word, np.repeat(np.arange(rows, rows + piece.num_rows, dtype=np.int32), np.diff(ends))))
            held.append(piece.select(["doc_id", "held_out"]))
            rows, tokens = rows + piece.num_rows, tokens + len(word)
            if tokens >= BATCH_BYTES // 7:
                yield flush()
                held, parts, rows, tokens = [], [], 0, 0
    if held:
        yield flush()


def _bucket(hashes: np.ndarray, side: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(side) >> np.uint64(32)).astype(np.int64)


#: Sort keys below this fit one number.
KEYS = 2**63


def _in_blocks(context: np.ndarray, word: np.ndarray, row: np.ndarray, rows: int, flag: np.ndarray | None, side: int) -> Iterator[tuple]:
    """Tokens grouped by block: its numbers i and j, its sorted contexts and words, and per distinct (context, word, row)
    their places in these and how many tokens (with `flag` set, if given) there are.

    Everything a token says is put in one number and sorted, or kept in four where that takes over 63 bits.
    """
    names = np.unique(np.append(word, _END))
    n = len(names)
    block = _bucket(context, side) * side + _bucket(word, side)
    u, w = np.searchsorted(names, context), np.searchsorted(names, word)
    if side * side * n * n * 2 * int(rows) < KEYS:
        key = (((block * n + u) * n + w) * rows + row) * 2
        if flag is not None:
            key += flag
        key.sort()
        first = np.flatnonzero(np.diff(key >> 1, prepend=-1))
        uses = np.add.reduceat(key & 1, first) if flag is not None and len(key) else np.diff(np.append(first, len(key)))
        key, text = np.divmod(key[first] >> 1, rows)
        key, w = np.divmod(key, n)
        block, u = np.divmod(key, n)
    else:
        # Too many different words and texts for one number: sorted by four.
        text = np.broadcast_to(row, len(block))
        order = np.lexsort((text, w, u, block))
        columns = [column[order] for column in (block, u, w, text)]
        new = np.ones(len(order), bool)
        new[1:] = np.any([column[1:] != column[:-1] for column in columns], axis=0)
        first = np.flatnonzero(new)
        uses = np.add.reduceat(flag[order].astype(np.int64), first) if flag is not None and len(order) else np.diff(np.append(first, len(order)))
        block, u, w, text = (column[first] for column in columns)
    at = np.searchsorted(block, np.arange(side * side + 1))
    for b in np.flatnonzero(np.diff(at)):
        part = slice(at[b], at[b + 1])
        own_u, u_at = np.unique(u[part], return_inverse=True)
        own_w, w_at = np.unique(w[part], return_inverse=True)
        yield int(b // side), int(b % side), names[own_u], names[own_w], u_at, w_at, text[part], uses[part]


def _summed(held: list[tuple]) -> tuple[np.ndarray, ...]:
    """Sorted contexts, sorted words, and each distinct pair's places in these and its count."""
    context, word, uses = (np.concatenate([one[k] for one in held]) for k in range(3))
    names, u = np.unique(context, return_inverse=True)
    words, w = np.unique(word, return_inverse=True)
    pair, at = np.unique(u * len(words) + w, return_inverse=True)
    return names, words, pair // len(words), pair % len(words), np.bincount(at, uses).astype(np.int64)


def count_pairs(docs: DataFrame, side: int) -> DataFrame:
    """Blocks of pairs: sorted contexts, sorted words, and per distinct pair of any text its context, its word and its
    count in the training texts."""
    merge_pairs = MERGE_PAIRS

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for meta, context, word, row in _batches(batches):
            train = ~meta.column("held_out").to_numpy(zero_copy_only=False)
            for i, j, names, words, u, w, _, uses in _in_blocks(context, word, np.int64(0), 1, train[row], side):
                yield _rows([(i, j, 0, 0, pack(sorted_pack(names), sorted_pack(words), np.diff(u, prepend=0), w, uses))])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (i, j), rows in rows_by_key(batches, ["i", "j"]):
            held: list[tuple] = []
            waiting, limit = 0, merge_pairs
            for row in rows:
                names, words, u, w, uses = unpack(row["blob"])
                held.append((np.cumsum(names, dtype=np.uint64)[np.cumsum(u)], np.cumsum(words, dtype=np.uint64)[w], uses))
                waiting += len(uses)
                if waiting > limit:
                    names, words, u, w, count = _summed(held)
                    held, waiting, limit = [(names[u], words[w], count)], 0, merge_pairs + len(count)
            names, words, u, w, count = _summed(held)
            yield _rows([(i, j, 0, 0, pack(sorted_pack(names), sorted_pack(words), np.diff(u, prepend=0), w, count))])

    parts = docs.mapInArrow(split, _ROW)
    return store(_dealt(parts, side).mapInArrow(merge, _ROW))


def _dealt(rows: DataFrame, side: int) -> DataFrame:
    return rows.repartition(side * side, "i", "j").sortWithinPartitions("i", "j", "kind", "src")


def _block(blob: bytes) -> tuple[np.ndarray, ...]:
    names, words, u, w, count = unpack(blob)
    return np.cumsum(names, dtype=np.uint64), np.cumsum(words, dtype=np.uint64), np.cumsum(u), w, count


def _totals(rows: DataFrame, side: int, combine) -> DataFrame:
    """Rows (i, j, kind = CONTEXT or WORD) of all blocks, brought together by i for contexts and by j for words; src is the
    block's other number."""
    keyed = rows.withColumn("at", F.when(F.col("kind") == CONTEXT, F.col("i")).otherwise(F.col("j")))
    return keyed.repartition(2 * side, "kind", "at").sortWithinPartitions("kind", "at", "src").mapInArrow(combine, _ROW)


def _back(kind: int, at: int, src: int) -> tuple[int, int]:
    return (at, src) if kind == CONTEXT else (src, at)


def index_words(pairs: DataFrame, side: int) -> DataFrame:
    """For every block and side, the number of each of its words among the words of the row or column (kind CONTEXT or
    WORD), and for each row and column (src = -1) the totals by that number: count, tables that never change (pairs
    seen once)."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, words, u, w, count = _block(row["blob"])
                for kind, own, at, src in ((CONTEXT, names, u, row["j"]), (WORD, words, w, row["i"])):
                    sums = np.bincount(at, count, len(own)).astype(np.int64)
                    once = np.bincount(at, count == 1, len(own)).astype(np.int64)
                    yield _rows([(row["i"], row["j"], kind, src, pack(sorted_pack(own), sums, once))])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (kind, at), rows in rows_by_key(batches, ["kind", "at"]):
            held = [(row["src"], *unpack(row["blob"])) for row in rows]
            own = [np.cumsum(one[1], dtype=np.uint64) for one in held]
            every, number = np.unique(np.concatenate(own), return_inverse=True)
            sums = np.bincount(number, np.concatenate([one[2] for one in held])).astype(np.int64)
            once = np.bincount(number, np.concatenate([one[3] for one in held])).astype(np.int64)
            ends = np.cumsum([0, *map(len, own)])
            for (src, *_), a, b in zip(held, ends[:-1], ends[1:], strict=True):
                yield _rows([(*_back(kind, at, src), kind, src, pack(np.diff(number[a:b], prepend=0)))])
            yield _rows([(*_back(kind, at, -1), kind, -1, pack(sums, once))])

    return store(_totals(pairs.mapInArrow(report, _ROW), side, combine))


def _exact_tables(count: int, log_p: np.ndarray, others: np.ndarray, discount: float, stirling: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Numbers of tables of dishes with `count` customers, from their exact conditional distribution."""
    steps = np.log(STRENGTH + discount * (others[:, None] + np.arange(count)))
    weight = np.cumsum(steps, axis=1) + log_p[:, None] * np.arange(1, count + 1) + stirling[count, 1 : count + 1]
    weight = np.exp(weight - weight.max(axis=1, keepdims=True))
    edges = np.cumsum(weight, axis=1)
    return (random.random(len(log_p))[:, None] * edges[:, -1:] > edges).sum(axis=1) + 1


def _seated_tables(count: np.ndarray, p: np.ndarray, others: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Numbers of tables of dishes with many customers, who are seated one after another: with n seated at t tables the
    next opens one with chance a / (n - discount t + a), a = (STRENGTH + discount (others + t)) p. How many are
    seated before that is drawn at once."""
    tables, seated = np.ones(len(count)), np.ones(len(count))
    open_ = np.arange(len(count))
    while len(open_):
        t = tables[open_]
        a = (STRENGTH + discount * (others[open_] + t)) * p[open_]
        start = seated[open_] - discount * t
        with np.errstate(over="ignore"):
            after = start * random.random(len(open_)) ** (-1 / a) + discount * t + 1
        more = after < count[open_]
        open_ = open_[more]
        tables[open_] += 1
        seated[open_] = np.floor(after[more])
    return tables.astype(np.int64)


def _stirling(discount: float, most: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers up to `most` customers."""
    out = np.full((most + 1, most + 2), -np.inf)
    out[1, 1] = 0
    with np.errstate(divide="ignore"):
        for n in range(1, most):
            t = np.arange(1, n + 2)
            out[n + 1, 1 : n + 2] = np.logaddexp(out[n, : n + 1], np.log(np.maximum(n - discount * t, 1e-300)) + out[n, 1 : n + 2])
    return out


def sample_tables(count: np.ndarray, p: np.ndarray, others: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """New numbers of tables of dishes, given the other tables of each one's restaurant and the parent's probability."""
    out = np.minimum(count, 1)
    stirling = _stirling(discount, EXACT)
    log_p = np.log(p)
    order = np.argsort(count, kind="stable")
    for size in range(2, EXACT + 1):
        a, b = np.searchsorted(count[order], [size, size + 1])
        for begin in range(a, b, 1 + (1 << 20) // size):
            at = order[begin : min(b, begin + 1 + (1 << 20) // size)]
            out[at] = _exact_tables(size, log_p[at], others[at], discount, stirling, random)
    large = np.flatnonzero(count > EXACT)
    out[large] = _seated_tables(count[large], p[large], others[large], discount, random)
    return out


class Parent:
    """The numbers of the parent restaurant that every task needs, and the discounts."""

    def __init__(self, discount: float, parent_discount: float, vocabulary: int, tokens: int):
        self.discount, self.parent_discount, self.vocabulary, self.tokens = discount, parent_discount, vocabulary, tokens
        self.customers = self.tables = 0

    def chance(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        spread = (STRENGTH + self.parent_discount * self.tables) / (self.vocabulary + 1)
        return (customers - self.parent_discount * tables + spread) / (STRENGTH + self.customers)


def _discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones else 0.5


def active_pairs(pairs: DataFrame, index: DataFrame, side: int) -> DataFrame:
    """What sweeps need of each block: the numbers of its contexts and words, and the pairs counted twice or more."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (i, j), rows in rows_by_key(batches, ["i", "j"]):
            blobs = {row["kind"]: row["blob"] for row in rows}
            _, _, u, w, count = _block(blobs[2])
            more = np.flatnonzero(count > 1)
            numbers = [np.cumsum(unpack(blobs[kind])[0]) for kind in (CONTEXT, WORD)]
            own_u, u_at = np.unique(numbers[CONTEXT][u[more]], return_inverse=True)
            own_w, w_at = np.unique(numbers[WORD][w[more]], return_inverse=True)
            yield _rows([(i, j, 2, 0, pack(np.diff(own_u, prepend=0), np.diff(own_w, prepend=0), u_at, w_at, count[more]))])

    rows = index.where("src >= 0").union(pairs.withColumn("kind", F.lit(2)))
    return store(_dealt(rows, side).mapInArrow(pick, _ROW))


def _sweep(active: DataFrame, answers: DataFrame | None, side: int, parent: Parent, step: int) -> DataFrame:
    """Seat all customers of repeated pairs anew: new tables (kind 3), and what contexts and words have of them now."""

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (i, j), rows in rows_by_key(batches, ["i", "j"]):
            blobs = {row["kind"]: row["blob"] for row in rows}
            own_u, own_w, u, w, count = unpack(blobs[2])
            if step == 0:
                tables = np.minimum(count, 1)
            else:
                before = unpack(blobs[3])[0]
                total = unpack(blobs[CONTEXT])[0]
                chance = parent.chance(*unpack(blobs[WORD]))
                random = np.random.default_rng([step, i, j])
                tables = sample_tables(count, chance[w], np.maximum(total[u] - before, 0), parent.discount, random)
            yield _rows([(i, j, 3, 0, pack(tables))])
            yield _rows([(i, j, CONTEXT, j, pack(own_u, np.bincount(u, tables, len(own_u)).astype(np.int64)))])
            yield _rows([(i, j, WORD, i, pack(own_w, np.bincount(w, tables, len(own_w)).astype(np.int64)))])

    rows = active if answers is None else active.union(answers)
    return store(_dealt(rows, side).mapInArrow(seat, _ROW))


def _answers(reports: DataFrame, index: DataFrame, side: int, parent: Parent, step: int, whole: bool) -> DataFrame:
    """Totals of tables by row and column, for the words each block reported (or, `whole`, all of its words): tables of
    contexts; customers and tables of words in the parent restaurant, which is seated anew. Rows of kind 4 have the
    parent's sums."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (kind, at), rows in rows_by_key(batches, ["kind", "at"]):
            totals, wanted, customers = None, [], None
            for row in rows:
                if row["src"] == -1:
                    totals = unpack(row["blob"])
                    customers = totals[1].copy()
                elif row["src"] < 1 << 20:
                    numbers, tables = unpack(row["blob"])
                    np.add.at(customers, np.cumsum(numbers), tables)
                    if not whole:
                        wanted.append((row["src"], np.cumsum(numbers)))
                else:
                    wanted.append((row["src"] - (1 << 20), np.cumsum(unpack(row["blob"])[0])))
            if kind == WORD:
                base = np.full(len(customers), 1 / (parent.vocabulary + 1))
                random = np.random.default_rng([step, 1 << 30, at])
                tables = sample_tables(customers, base, np.full(len(customers), parent.tables), parent.parent_discount, random)
                yield _rows([(int(customers.sum()) & 0x3FFFFFFF, int(customers.sum()) >> 30, 4, int(tables.sum()), pack(np.zeros(0, np.int64)))])
            for src, numbers in wanted:
                extra = [tables[numbers]] if kind == WORD else [totals[0][numbers]] if whole else []
                if kind == WORD and whole:
                    extra.append(totals[0][numbers])
                yield _rows([(*_back(kind, at, src), kind, src, pack(customers[numbers], *extra))])

    rows = index.where("src < 0").union(reports.where(F.col("kind") < 2))
    if whole:
        rows = rows.union(index.where("src >= 0").withColumn("src", (F.col("src") + (1 << 20)).cast("int")))
    return store(_totals(rows, side, combine))


def _settle(answers: DataFrame, parent: Parent) -> DataFrame:
    sums = answers.where("kind = 4").agg(F.sum(F.col("i").cast("long") + F.col("j").cast("long") * (1 << 30)), F.sum(F.col("src").cast("long"))).first()
    parent.customers, parent.tables = int(sums[0] or 0), int(sums[1] or 0)
    return answers.where(F.col("kind") < 2)


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", burn_in: int = BURN_IN, samples: int = SAMPLES
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens (words and one end), n_known, train_tokens, base_score, score (log10) and
    perplexity, the inverse of the mean chance of a token. `samples` seatings (up to ten) after `burn_in` sweeps count.

    Learns from the rows whose crc32(id as text) mod 7 is not 2; a null id counts as the empty text. A-Z are lowered. A
    null or empty text is its end token alone. A word never seen in training has no seat and gets its share of the
    base. Repeated rows count and are scored each time. Without training rows all probabilities are the base's. An
    empty table gives an empty result. Only the two named columns are read.
    """
    if not 1 <= samples <= 10:
        raise ValueError("1 to 10 samples")
    doc = docs[id_col].cast("long")
    rows = docs.select(doc.alias("doc_id"), held_out(docs[id_col]).alias("held_out"), docs[text_col].alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    side = max(2, int(np.ceil(np.sqrt(size / BLOCK_BYTES))))
    pairs = count_pairs(rows, side)
    index = index_words(pairs, side)
    parent = _parent(pairs, index)
    active = active_pairs(pairs, index, side)
    kept: list[tuple[DataFrame, DataFrame, int, int]] = []
    answers = None
    for step in range(burn_in + samples + 1):
        reports = _sweep(active, answers, side, parent, step)
        state = reports.where("kind = 3")
        if step > burn_in:
            whole = _settle(_answers(reports, index, side, parent, step, True), parent)
            kept.append((state, whole, parent.customers, parent.tables))
        if step < burn_in + samples:
            answers = _settle(_answers(reports, index, side, parent, step, False), parent).union(state)
    scored = _scored(rows, pairs, kept, side, parent)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def perplexities(scored: DataFrame) -> DataFrame:
    """Of scored rows, for the training and the held-out ones: rows, tokens, perplexity over all their tokens, and that
    of the base."""

    def over_all(score: str) -> Column:
        return F.pow(F.lit(10.0), -F.sum(score) / F.sum("n_tokens"))

    return scored.groupBy("held_out").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("n_tokens").alias("tokens"),
        over_all("score").alias("perplexity"),
        over_all("base_score").alias("base_perplexity"),
    )


def _parent(pairs: DataFrame, index: DataFrame) -> Parent:
    """Discounts from how many pairs, and words by distinct contexts, are seen once and twice; vocabulary and tokens."""

    def pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                count = unpack(blob)[4]
                yield pa.RecordBatch.from_arrays([pa.array([int((count == n).sum())]) for n in (1, 2)], ["a", "b"])

    def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                sums, once = unpack(blob)
                values = [int((once == 1).sum()), int((once == 2).sum()), int((sums > 0).sum()), int(sums.sum())]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["a", "b", "v", "n"])

    one = pairs.select("blob").mapInArrow(pair_counts, "a long, b long").agg(F.sum("a"), F.sum("b")).first()
    words = index.where(f"src < 0 and kind = {WORD}").select("blob").mapInArrow(word_counts, "a long, b long, v long, n long")
    two = words.agg(F.sum("a"), F.sum("b"), F.sum("v"), F.sum("n")).first()
    return Parent(_discount(one[0] or 0, one[1] or 0), _discount(two[0] or 0, two[1] or 0), two[2] or 0, two[3] or 0)


def _scored(rows: DataFrame, pairs: DataFrame, kept: list[tuple[DataFrame, DataFrame, int, int]], side: int, parent: Parent) -> DataFrame:
    """Send every text's pairs to their blocks, add up their log probabilities there, and bring the parts together by text."""
    sums = [(customers, tables) for _, _, customers, tables in kept]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for meta, context, word, row in _batches(batches):
            total = np.bincount(row, minlength=meta.num_rows)
            ids = meta.column("doc_id")
            about = pack(ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), meta.column("held_out").to_numpy(zero_copy_only=False).astype(np.int64), total, ids.fill_null(0).to_numpy().view(np.uint64))
            yield _rows([(-1, part, 0, number, about)])
            for i, j, names, words, u, w, texts, uses in _in_blocks(context, word, row, meta.num_rows, None, side):
                order = np.argsort(texts, kind="stable")
                blob = pack(np.array([part, number]), sorted_pack(names), sorted_pack(words), np.diff(texts[order], prepend=0), u[order], w[order], uses[order])
                yield _rows([(i, j, 100, part + 7919 * number & 0x7FFFFFFF, blob)])
            number += 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (i, j, _), group in rows_by_key(batches, ["i", "j", "salt"]):
            blobs: dict[int, bytes] = {}
            model = None
            for row in group:
                if i < 0:
                    yield _rows([(j, row["src"], 0, 0, row["blob"])])
                    continue
                if row["kind"] < 100:
                    blobs[row["kind"]] = row["blob"]
                    continue
                model = model or _model(blobs, sums, parent)
                names, words, keys, base, known, log_p = model
                where, own_u, own_w, text, u, w, uses = unpack(row["blob"])
                u = np.searchsorted(names, np.cumsum(own_u, dtype=np.uint64))[u]
                w = np.searchsorted(words, np.cumsum(own_w, dtype=np.uint64))[w]
                at = np.searchsorted(keys, u * len(words) + w)
                texts, text = np.unique(np.cumsum(text), return_inverse=True)
                out = [np.bincount(text, uses * values) for values in (base[w], log_p[at], known[w])]
                yield _rows([(int(where[0]), int(where[1]), 1, 0, pack(np.diff(texts, prepend=0), out[0], out[1], out[2].astype(np.int64)))])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in rows_by_key(batches, ["i", "j"]):
            about, sums_ = None, None
            for row in group:
                if row["kind"] == 0:
                    about = unpack(row["blob"])
                    sums_ = np.zeros((3, len(about[0])))
                    continue
                texts, *values = unpack(row["blob"])
                for line, value in zip(sums_, values, strict=True):
                    line[np.cumsum(texts)] += value
            empty, held, n_tokens, ids = about
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids.astype(np.uint64).view(np.int64), mask=empty.astype(bool)), pa.array(held.astype(bool)), pa.array(n_tokens), pa.array(sums_[2].astype(np.int64)),
                    pa.array(np.full(n, parent.tokens)), pa.array(sums_[0]), pa.array(sums_[1]),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    # Kinds: 2 pairs; 10 + k tables of sample k; 20 + k and 30 + k its contexts and words; 100 the texts' pairs.
    joined = pairs.withColumn("kind", F.lit(2))
    for k, (state, whole, *_) in enumerate(kept):
        joined = joined.union(state.withColumn("kind", F.lit(10 + k)))
        joined = joined.union(whole.withColumn("kind", (F.col("kind") * 10 + 20 + k).cast("int")))
    hot = _hot_blocks(pairs)
    parts_of = F.coalesce("parts", F.lit(1))
    blocks = joined.join(hot, ["i", "j"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts_of - 1)))
    asked = rows.mapInArrow(split, _ROW).join(hot, ["i", "j"], "left").withColumn("salt", F.pmod(F.hash("src"), parts_of))
    everything = blocks.union(asked).drop("parts")
    dealt = everything.repartition(side * side, "i", "j", "salt").sortWithinPartitions("i", "j", "salt", "kind", "src")
    parts = dealt.mapInArrow(score, _ROW)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(tasks, "i", "j").sortWithinPartitions("i", "j", "kind")
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.mapInArrow(total, kinds)


def _hot_blocks(pairs: DataFrame) -> DataFrame:
    """Blocks with more than PART_TOKENS training tokens, and in how many parts the texts' pairs are to be scored."""
    most = PART_TOKENS

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            needed = [-(-int(unpack(blob)[4].sum()) // most) for blob in batch.column("blob").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("j"), pa.array(needed, pa.int32())], ["i", "j", "parts"])

    return store(pairs.select("i", "j", "blob").mapInArrow(parts, "i int, j int, parts int").where("parts > 1"))


def _model(blobs: dict[int, bytes], sums: list[tuple[int, int]], parent: Parent) -> tuple[np.ndarray, ...]:
    """Of a block: its contexts and words, the keys of its pairs, each word's base score and whether it is known, and
    each pair's log10 probability averaged over the samples."""
    names, words, u, w, count = _block(blobs[2])
    chance = np.zeros(len(u))
    word_count = np.zeros(len(words), np.int64)
    more = np.flatnonzero(count > 1)
    for k, (customers, tables) in enumerate(sums):
        own = np.minimum(count, 1)
        own[more] = unpack(blobs[10 + k])[0]
        context_tables, context_count = unpack(blobs[20 + k])
        seated, parent_tables, word_count = unpack(blobs[30 + k])
        parent.customers, parent.tables = customers, tables
        p = parent.chance(seated, parent_tables)
        lower = (STRENGTH + parent.discount * context_tables[u]) * p[w]
        chance += (count - parent.discount * own + lower) / (STRENGTH + context_count[u])
    base = np.log10((word_count + 1) / (parent.tokens + parent.vocabulary + 1))
    return names, words, u * len(words) + w, base, word_count > 0, np.log10(chance / len(sums))
