"""The shards of the mix: what is drawn, what they hold, and that documents keep their columns."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kerbline.llm import mixing
from kerbline.llm.stage import word_count

WORD = r"[^\x20\x09-\x0D]+"
BLOCK, SLOTS = 16, 64


def sizes_of(docs):
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("digest"))


def plan(docs):
    sizes = sizes_of(docs)
    targets = mixing.source_targets(sizes)
    return mixing.placed(sizes), targets, mixing.mixed_slots(targets, BLOCK, SLOTS)


def words_by_source(docs, docs_placed):
    """The words of each source in the order in which its documents stand."""
    texts = {(r.doc_id, r.digest): r.text for r in docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").collect()}
    words = defaultdict(list)
    for row in sorted((r for r in docs_placed.collect() if r.size), key=lambda r: r.start):
        assert len(words[row.source]) == row.start
        words[row.source] += re.findall(WORD, texts[row.doc_id, row.digest])
    return words


@pytest.mark.parametrize("which", ["small", "odd"])
def test_shards_hold_the_words_of_their_slots(request, which):
    docs = request.getfixturevalue(which)
    docs_placed, targets, slots = plan(docs)
    words = words_by_source(docs, docs_placed)
    source = {r["rank"]: r.source for r in targets.collect()}
    want = Counter()
    for slot in slots.collect():
        block = words[source[slot["rank"]]][slot.block * BLOCK : (slot.block + 1) * BLOCK][: slot.takes]
        want[slot.shard, source[slot["rank"]], slot.block, len(block), " ".join(block)] += 1
    got = mixing.mixed_blocks(docs, block_words=BLOCK, shard_slots=SLOTS).collect()
    assert Counter((r.shard, r.source, r.block, r.words, r.text) for r in got) == want
    places = defaultdict(list)
    for row in got:
        places[row.shard].append(row.place)
    assert all(sorted(found) == list(range(1, len(found) + 1)) for found in places.values())


def test_a_document_gives_to_as_many_shards_as_its_slots_fell_in(small):
    docs_placed, targets, slots = plan(small)
    source = {r["rank"]: r.source for r in targets.collect()}
    by_block = defaultdict(list)
    for slot in slots.collect():
        by_block[source[slot["rank"]], slot.block].append((slot.shard, slot.takes))
    want = {}
    for row in docs_placed.collect():
        taken, shards = 0, set()
        for block in range(row.start // BLOCK, (row.start + row.size - 1) // BLOCK + 1) if row.size else ():
            for shard, takes in by_block[row.source, block]:
                some = min(row.start + row.size, block * BLOCK + takes) - max(row.start, block * BLOCK)
                if some > 0:
                    taken += some
                    shards.add(shard)
        want[row.doc_id] = (taken, len(shards))
    got = {r.doc_id: (r.taken, r.shards) for r in mixing.mix_sources(small, block_words=BLOCK, shard_slots=SLOTS).collect()}
    assert got == want and max(shards for _, shards in got.values()) > 1


def test_sources_of_a_shard_are_drawn_about_their_share(small):
    _, _, slots = plan(small)
    drawn = Counter((r.shard, r["rank"]) for r in slots.collect())
    slots_of, shards = Counter(), {shard for shard, _ in drawn}
    for (_, rank), count in drawn.items():
        slots_of[rank] += count
    assert len(shards) == -(-sum(slots_of.values()) // SLOTS)
    squares = places = 0.0
    for rank, total in slots_of.items():
        mean = total / len(shards)
        squares += sum((drawn[shard, rank] - mean) ** 2 / mean for shard in shards)
        places += len(shards) - 1
    # Chi-square of a multinomial draw: its mean is `places`, its variance twice that. Even dealing would give about 0.
    assert abs(squares - places) < 6 * (2 * places) ** 0.5


def test_another_seed_draws_other_shards_and_the_same_totals(small):
    first, second = (mixing.mixed_blocks(small, block_words=BLOCK, shard_slots=SLOTS, seed=seed) for seed in (0, 1))
    counts = [Counter((r.shard, r.source) for r in frame.select("shard", "source").collect()) for frame in (first, second)]
    totals = [Counter(), Counter()]
    for count, total in zip(counts, totals, strict=True):
        for (_, source), number in count.items():
            total[source] += number
    assert counts[0] != counts[1] and totals[0] == totals[1]


def test_documents_keep_every_column(spark, odd):
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and [f.dataType for f in mixed.schema] == [f.dataType for f in odd.schema]
    named = odd.select("doc_id", "text", "source", F.lit("x").alias("row"), F.lit(2).alias("nth"), F.lit(3).alias("a.b"), F.lit(4).alias("copy"))
    rows = mixing.mixed_documents(named).collect()
    assert rows and all((r["row"], r["nth"], r["a.b"], r["copy"]) == ("x", 2, 3, 4) for r in rows)
    assert len(rows) == mixed.count()


def test_repeated_rows_with_other_columns_stay_apart(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "a", kind) for kind in ("p", "q", "q")], "doc_id long, text string, source string, kind string")
    assert Counter(r.kind for r in mixing.mixed_documents(docs).collect()) == {"p": 1, "q": 2}


def test_no_documents(none):
    assert mixing.mixed_blocks(none).count() == 0
