"""Mixing sources to target weights, in DataFrame functions only.

The words of a source, document after document, are cut into blocks of a fixed number of words. The mix is a list of
slots, each filled with one block. Slots are dealt to output shards at random, which makes the sources of a shard a
multinomial draw whose totals over all shards are the targets. The slots of a source are numbered through over its
shards; slot k takes block permutation(k mod blocks), so a block is used again only when every block has been used.
Blocks are joined to slots by index: `mixed_blocks` returns the shards with their texts, `mix_sources` what each
document gives to them, `mixed_documents` the same words as copies of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbline.llm.stage import WORD, store, word_count

BLOCK_WORDS = 256
SHARD_SLOTS = 4096
CHUNK_ROWS = 2_000
ROUNDS = 12
MOST = 3


def source_targets(sizes: DataFrame, most: float = MOST) -> DataFrame:
    """Target words of each source: weights 1, 2, 3, repeating in code point order (null last), shares of all words.

    No target exceeds `most` times its source; what is over is shared anew by weight. With sources ordered by the level
    at which they fill up, the level all others reach is found in one pass. Sums are over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = W.orderBy(F.col("source").asc_nulls_last())
    filling = W.orderBy("fills_at", "rank")
    ranked = (
        by_source.withColumn("rank", F.row_number().over(named))
        .withColumn("weight", (F.col("rank") - 1) % 3 + F.lit(1))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
    )
    before = F.coalesce(F.sum("cap").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    every = F.sum("source_size").over(filling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    levels = ranked.withColumn("level", (every - before) / rest)
    first = F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "rank", "level"))).over(
        filling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    target = F.least("cap", F.coalesce(first["level"], F.col("fills_at")) * F.col("weight"))
    return levels.select("source", "rank", "source_size", target.alias("target"))


def permuted(index: Column, count: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0..count-1 for each key: in each round an index and its mirror image about a keyed
    point change places or stay, as a hash of the larger of both decides."""

    def one_round(x: Column, step: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(key, step, F.lit("point")), count) - x, count)
        swap = F.pmod(F.xxhash64(key, step, F.greatest(x, mirror)), F.lit(2)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), one_round)


def placed(sizes: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add `start`, the words of the source before a document.

    Documents are ordered by a chunk drawn from the id's hash, then by id. Chunks are summed on their own first, so that
    a source with most of the documents is placed by many tasks.
    """
    chunks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(chunk_rows)).cast("long")).alias("chunks")
    per_source = sizes.groupBy("source").agg(chunks).withColumnRenamed("source", "s")
    chunked = sizes.join(per_source, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.col("chunks"))
    )
    totals = chunked.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select(
        F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base")
    )
    inside = W.partitionBy("source", "chunk").orderBy("doc_id", "digest", "size").rowsBetween(W.unboundedPreceding, -1)
    return (
        chunked.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
        .select("doc_id", "source", "size", "digest", (F.col("base") + F.col("within")).alias("start"))
    )


def mixed_slots(targets: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """One row per slot of the mix: shard, source rank, block, and the words it takes (all but a source's last slot
    take a whole block)."""
    wanted = F.round("target").cast("long")
    live = targets.where(F.col("source_size") > 0).select(
        "rank",
        F.col("source_size"),
        wanted.alias("wanted"),
        F.ceil(F.col("source_size") / block_words).cast("long").alias("blocks"),
    )
    # Whole passes over a source take all its words; what is left is taken in blocks of full length.
    planned = (
        live.withColumn("passes", F.floor(F.col("wanted") / F.col("source_size")))
        .withColumn("rest", F.col("wanted") - F.col("passes") * F.col("source_size"))
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.least(F.ceil(F.col("rest") / block_words), F.col("blocks")))
        .where(F.col("slots") > 0)
    )
    every = F.sum("slots").over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    planned = planned.withColumn("shards", F.ceil(every / shard_slots).cast("long"))
    parts = planned.withColumn("part", F.explode(F.expr(f"sequence(0L, slots - 1, {shard_slots}L)")))
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows here, many after the next step
    draws = parts.repartition(tasks).withColumn("draw", F.explode(F.expr(f"sequence(part, least(part + {shard_slots - 1}L, slots - 1))")))
    shard = F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "rank", "draw"), F.col("shards"))
    keys = ["rank", "wanted", "blocks", "passes", "rest"]
    counts = draws.groupBy(*keys, shard.alias("shard")).agg(F.count(F.lit(1)).alias("drawn"))
    before = W.partitionBy("rank").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    numbered = counts.withColumn("first", F.coalesce(F.sum("drawn").over(before), F.lit(0)))
    slots = numbered.repartition(tasks).withColumn("slot", F.explode(F.expr("sequence(first, first + drawn - 1)")))
    done = F.col("slot") - F.col("passes") * F.col("blocks")
    takes = F.when(done < 0, F.lit(block_words)).otherwise(F.least(F.lit(block_words), F.col("rest") - done * block_words))
    block = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), F.col("rank")))
    return slots.select("shard", "rank", "slot", block.alias("block"), takes.cast("long").alias("takes"))


def document_uses(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, block_words: int, shard_slots: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Documents with their place and target; and a row for each slot that takes words of a document.

    A use has the slot's shard and place in it, and the words taken: `low` up to `until`, counted from the start of the
    source. `copy` numbers the uses of a block, whole ones first.
    """
    sizes = store(
        docs.select(
            docs[id_col].alias("doc_id"),
            docs[source_col].alias("source"),
            word_count(docs[text_col]).alias("size"),
            F.xxhash64(docs[text_col]).alias("digest"),
        )
    )
    targets = store(source_targets(sizes))
    # Stored, since a plan takes exploded rows to be as few as those they were made from, and would broadcast them.
    slots = store(mixed_slots(targets, block_words, shard_slots, seed))
    known = targets.select(F.col("source").alias("s"), "rank", "source_size", "target")
    docs_placed = store(placed(sizes).join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    covered = docs_placed.where("size > 0").select(
        "rank", "start", "size", F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})").alias("covered")
    )
    in_shard = W.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), F.lit("place"), "rank", "slot"), "rank", "slot")
    of_block = W.partitionBy("rank", "block").orderBy(F.col("takes").desc(), "slot")
    dealt = slots.withColumn("place", F.row_number().over(in_shard)).withColumn("copy", F.row_number().over(of_block).cast("long"))
    met = covered.withColumn("block", F.explode("covered")).drop("covered").join(dealt, ["rank", "block"])
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    until = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("takes"))
    return docs_placed, met.select(
        "rank", "start", "shard", "place", "slot", "block", "copy", low.alias("low"), until.alias("until")
    ).where("low < until")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 0,
) -> DataFrame:
    """How many words of each document the mix takes, repeats counted, and how many shards they go to.

    One row per input row: doc_id, size, source_size, target (both of the source), taken, shards. A null or empty text
    has size 0 and nothing is taken of it. A null source is a source of its own. Repeated ids and repeated rows are
    separate documents. An empty table gives an empty result. Only the three named columns are read, others may have
    any name.
    """
    docs_placed, uses = document_uses(docs, id_col, text_col, source_col, block_words, shard_slots, seed)
    by_shard = uses.groupBy("rank", "start", "shard").agg(F.sum(F.col("until") - F.col("low")).alias("words"))
    taken = by_shard.groupBy("rank", "start").agg(F.sum("words").alias("taken"), F.count(F.lit(1)).alias("shards"))
    live = docs_placed.where("size > 0").join(taken, ["rank", "start"], "left")
    none = F.lit(0).cast("long")
    empty = docs_placed.where("size = 0").withColumn("taken", none).withColumn("shards", none)
    columns = ["doc_id", "size", "source_size", "target", *(F.coalesce(c, none).alias(c) for c in ("taken", "shards"))]
    return live.select(*columns).union(empty.select(*columns))


def _with_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, docs_placed: DataFrame, found: DataFrame) -> DataFrame:
    """`found`, keyed by rank and start, beside its documents: the whole input row as one struct, so no name can clash.

    Rows meet by id, source, text hash and number among equals, which follows from the other columns; so repeated rows
    stay apart.
    """
    same = ["doc_id", "source", "digest"]
    equals = W.partitionBy(*same)
    plan = (
        docs_placed.where("size > 0")
        .withColumn("nth", F.row_number().over(equals.orderBy("start")))
        .join(found, ["rank", "start"])
        .withColumnsRenamed({name: f"_{name}" for name in [*same, "nth"]})
    )
    columns = {name: docs[f"`{name}`"] for name in docs.columns}
    others = F.to_json(F.struct(*[column.alias(name) for name, column in columns.items() if name != text_col]))
    rows = docs.select(
        F.struct(*columns.values()).alias("row"),
        columns[id_col].alias("doc_id"),
        columns[source_col].alias("source"),
        F.xxhash64(columns[text_col]).alias("digest"),
        others.alias("others"),
    ).withColumn("nth", F.row_number().over(equals.orderBy("others")))
    matches = [*[F.col(name).eqNullSafe(F.col(f"_{name}")) for name in same], F.col("nth") == F.col("_nth")]
    return rows.drop("others").join(plan, matches)


def _words_of(text: Column, spans: Column, each: Callable[[Column, Column], Column]) -> Column:
    """`each` of the words taken and the span, for every span; the text is cut into words once."""
    tokens = F.array(F.regexp_extract_all(text, F.lit(f"({WORD})")))

    def cut(words: Column) -> Column:
        return F.transform(spans, lambda s: each(F.slice(words, (s["from"] + 1).cast("int"), s["words"].cast("int")), s))

    return F.transform(tokens, cut)[0]


def mixed_blocks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 0,
) -> DataFrame:
    """The mix itself: one row per slot of every output shard.

    shard, place (from 1, in an order drawn per shard), source, block, words (long) and text, the block's words joined
    by spaces. How many slots of a shard a source gets is drawn; over all shards a source has the slots its target asks
    for. Null and empty texts give no words. An empty table gives an empty result.
    """
    docs_placed, uses = document_uses(docs, id_col, text_col, source_col, block_words, shard_slots, seed)
    span = F.struct("shard", "place", "block", (F.col("low") - F.col("start")).alias("from"), (F.col("until") - F.col("low")).alias("words"))
    found = uses.groupBy("rank", "start").agg(F.collect_list(span).alias("spans"))
    met = _with_rows(docs, id_col, text_col, source_col, docs_placed, found)

    def piece(words: Column, s: Column) -> Column:
        return F.struct(s["shard"].alias("shard"), s["place"].alias("place"), s["block"].alias("block"), s["words"].alias("words"), F.array_join(words, " ").alias("text"))

    pieces = met.select("source", "start", F.explode(_words_of(F.col("row")[text_col], F.col("spans"), piece)).alias("piece"))
    parts = F.sort_array(F.collect_list(F.struct("start", "piece.text")))
    return (
        pieces.groupBy("piece.shard", "piece.place", "source", "piece.block")
        .agg(F.sum("piece.words").alias("words"), parts.alias("parts"))
        .select("shard", "place", "source", "block", "words", F.array_join(F.col("parts.text"), " ").alias("text"))
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """The mixed corpus as documents: up to three copies of a document, each of its words in the blocks that the mix
    uses that often. A copy that is used whole keeps its text; a partial one is its words joined by spaces.

    Input and output have the same columns, of any names beside doc_id, text and source; n_chars, where there is one, is
    that of the new text. Documents without words are never taken. Repeated rows stay apart.
    """
    docs_placed, uses = document_uses(docs, "doc_id", "text", "source", block_words, shard_slots, seed)
    span = F.struct((F.col("low") - F.col("start")).alias("from"), (F.col("until") - F.col("low")).alias("words"))
    copies = uses.groupBy("rank", "start", "copy").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    met = _with_rows(docs, "doc_id", "text", "source", docs_placed, copies)
    kept = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    whole = F.col("row")["text"]
    some = F.array_join(F.flatten(_words_of(whole, F.col("spans"), lambda words, s: words)), " ")
    cut = met.select("row", F.when(kept == F.col("size"), whole).otherwise(some).alias("text"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[changed.get(name, F.col("row").getField(name)).alias(name) for name in docs.columns])
