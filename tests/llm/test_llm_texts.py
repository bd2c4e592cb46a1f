"""Operators on texts: each against a plain version on small tables, and on odd rows."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.llm import fingerprints, language_model, line_dedup, mixing, near_dedup, substring_dedup, token_files

WORD = r"[^\x20\x09-\x0D]+"


def texts(docs):
    return [(row.doc_id, row.text or "") for row in docs.select("doc_id", "text").collect()]


def key(row):
    return tuple((value is None, str(value)) for value in row)


# -- lines ----------------------------------------------------------------


def plain_lines(rows):
    """Numbers of the lines to remove, by (id, text)."""
    order = sorted({(math.inf if doc is None else doc, text) for doc, text in rows}, key=lambda r: (r[0], r[1]))
    seen, by_length, out = set(), defaultdict(list), {}
    for doc, text in order:
        gone = []
        for number, line in enumerate(text.split("\n")):
            if not line.strip():
                continue
            long = len(line) >= line_dedup.MIN_CHARS
            near = long and any(line_dedup.within_one_edit(line, other) for n in (-1, 0, 1) for other in by_length[len(line) + n])
            if line in seen or near:
                gone.append(number)
            if line not in seen:
                seen.add(line)
                if long:
                    by_length[len(line)].append(line)
        out[doc, text] = gone
    return out


def check_lines(docs):
    rows = texts(docs)
    expected = plain_lines(rows)
    want = Counter((doc, len(text.split("\n")), str(expected[math.inf if doc is None else doc, text])) for doc, text in rows)
    got = Counter((r.doc_id, r.n_lines, str(r.removed)) for r in line_dedup.removed_lines(docs).collect())
    assert got == want


def test_lines_equal_the_plain_version(small):
    check_lines(small)


def test_lines_one_edit_apart(spark):
    base = "the quick brown fox jumps over the lazy dog"
    lines = [base, base[1:], base.replace("fox", "fix"), base + "s", "the quick brown fox  jumps over the lazy dog", base.upper()]
    lines += [base[:5] + "é" + base[6:], base[2:], "short", "shore", "short"]
    docs = spark.createDataFrame([(i, f"{line}\n\n{line[::-1]}") for i, line in enumerate(lines)], "doc_id long, text string")
    check_lines(docs)
    assert line_dedup.removed_lines(docs).where("n_removed > 0").count() > 4


def test_edit_distance_of_one():
    assert line_dedup.within_one_edit("abc", "abc") and line_dedup.within_one_edit("abc", "abxc")
    assert line_dedup.within_one_edit("", "a") and line_dedup.within_one_edit("abc", "axc")
    assert not line_dedup.within_one_edit("abc", "acb") and not line_dedup.within_one_edit("abc", "abxxc")


def test_lines_of_odd_rows(odd, none):
    got = line_dedup.removed_lines(odd)
    assert got.count() == odd.count()
    assert got.where("doc_id in (3, 4, 5) and n_removed > 0").isEmpty()
    assert line_dedup.removed_lines(none).count() == 0


# -- near duplicates ------------------------------------------------------


def shingle_sequence(text):
    words = re.findall(WORD, text)
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def aligned(a, b):
    if not a and not b:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], max(row[j], row[j - 1], before + (x == y))
    return row[-1] / (len(a) + len(b) - row[-1])


def test_near_classes_equal_the_plain_version(small):
    rows = dict(texts(small))
    ids = sorted(rows)
    sets = {doc: set(shingle_sequence(text)) for doc, text in rows.items()}
    root = {doc: doc for doc in ids}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if rows[a] == rows[b] or (sets[a] & sets[b] and aligned(shingle_sequence(rows[a]), shingle_sequence(rows[b])) >= 0.8):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    got = {row.doc_id: row.class_id for row in near_dedup.near_classes(small).collect()}
    assert got == {doc: find(doc) for doc in ids}


def test_a_family_of_edited_copies_is_one_class(spark):
    words = [f"w{i}" for i in range(300)]
    family = [" ".join([*words[:at], f"new{at}", *words[at + 1 :]]) for at in range(0, 300, 3)]
    shuffled = " ".join(reversed(words))
    docs = spark.createDataFrame(list(enumerate([*family, shuffled])), "doc_id long, text string")
    got = {row.doc_id: (row.class_id, row.class_size) for row in near_dedup.near_classes(docs).collect()}
    assert all(got[i] == (0, 100) for i in range(100)) and got[100] == (100, 1)


def test_null_ids_stay_null_in_token_files(odd):
    got = token_files.read_tokens(token_files.write_tokens(odd, token_files.default_tokenizer())).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, *sorted(r.doc_id for r in odd.collect() if r.doc_id is not None)]


def test_long_texts_of_one_word_are_aligned_in_short_time():
    one = np.full(20_000, 7)
    other = one.copy()
    one[[5, -5]], other[[6_000, 11_000]] = 3, 4
    before = time.perf_counter()
    assert near_dedup.similarity(one, other) > 0.99
    assert time.perf_counter() - before < 5


def test_alignment_is_exact_inside_its_band():
    import numpy as np

    random = np.random.default_rng(3)
    for _ in range(60):
        a = random.integers(0, 12, random.integers(1, 40)).astype(np.uint64)
        b = np.delete(a, random.integers(0, len(a))) if random.random() < 0.7 else random.integers(0, 12, 20).astype(np.uint64)
        true = aligned(a.tolist(), b.tolist())
        got = near_dedup.similarity(a, b)
        assert got == pytest.approx(true) if true >= 0.8 else got < 0.8


def test_bucket_links_join_all_that_are_near(spark):
    import numpy as np

    base = np.arange(100, dtype=np.uint64)
    rows = [base, base + np.uint64(0), np.append(base[:90], np.arange(500, 505, dtype=np.uint64)), np.arange(1000, 1100, dtype=np.uint64)]
    ends = np.cumsum([0, *map(len, rows)])
    links = near_dedup.join_bucket(np.concatenate(rows), ends, [0, 1, 2, 3])
    assert len(links) == 2 and all(3 not in link for link in links)


def test_buckets_over_the_work_of_a_task_are_searched_whole(spark, monkeypatch):
    import numpy as np

    random = np.random.default_rng(7)
    rows = []
    for group in range(14):
        words = [f"w{i}" for i in range(70)] + [f"g{group}x{i}" for i in range(30)]
        for _ in range(3):
            own = list(words)
            own[int(random.integers(0, 100))] = f"r{len(rows)}"
            own[int(random.integers(0, 100))] = f"s{len(rows)}"
            rows.append(" ".join(own))
    sequences = [shingle_sequence(text) for text in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and aligned(sequences[i], sequences[j]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "WORK", 300)
    for block in (500, 1 << 20):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        assert {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()} == dict(enumerate(root))


def test_blocks_of_a_bucket_join_as_the_bucket_does():
    import numpy as np

    random = np.random.default_rng(11)
    for _ in range(20):
        base = random.integers(0, 60, (4, 40)).astype(np.uint64)
        rows = [np.where(random.random(40) < 0.05, random.integers(0, 60, 40), base[i % 4]).astype(np.uint64)[: random.integers(34, 41)] for i in range(30)]
        rows += [np.zeros(0, np.uint64)] * 2
        ends = np.cumsum([0, *map(len, rows)])
        labels = list(range(len(rows)))

        def classes(links, labels=labels):
            root = list(labels)
            for i, j in links:
                root = [root[i] if r == root[j] else r for r in root]
            return {tuple(i for i, r in enumerate(root) if r == one) for one in root}

        whole = classes(near_dedup.join_bucket(np.concatenate(rows), ends, labels))
        twice, both_ends = np.concatenate(rows * 2), np.cumsum([0, *map(len, rows * 2)])
        reps = np.array(labels * 2)
        links = near_dedup.join_blocks(twice, both_ends, labels * 2, reps, [False] * len(rows) + [True] * len(rows), [True] * (2 * len(rows)))
        assert classes([(reps[i], reps[j]) for i, j in links]) == whole


def test_near_classes_of_odd_rows(odd, none):
    got = near_dedup.near_classes(odd)
    assert got.count() == odd.count()
    found = {row.doc_id: row.class_id for row in got.where("doc_id is not null").collect()}
    assert found[1] == found[2] == 1 and found[3] == found[4] == 3 and found[6] == 6
    assert near_dedup.near_classes(none).count() == 0
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").distinct().collect()) == sorted(str(x) for x in {r.class_id for r in got.collect()})


# -- token files ----------------------------------------------------------


def plain_tokens(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def test_token_files_hold_every_id_in_order(small):
    got = token_files.read_tokens(token_files.write_tokens(small, token_files.default_tokenizer())).orderBy("start").collect()
    assert [tuple(row) for row in got] == plain_tokens(texts(small))


def test_pieces_are_encoded_as_whole_texts_are():
    encoder = token_files.PieceEncoder(token_files.default_tokenizer())
    spaced = ["", " ", "a  b", " a", "a ", "a\n b", "a \n b", "x\t y  z  ", "\n", "I'm don't  's", "<|endoftext|> hi", "1 2 3", "…  …"]
    spaced += ["a b\n\nc d", "a b\nc d.\nE, f", "ab   cd", "a　b c", "x ab́c", "one two. one two,\none", "日本 語。 x\ny"]
    for text in spaced * 2:
        assert encoder(text) == encoder.whole(text), repr(text)


def test_segments_read_back_whole_and_by_block():
    import numpy as np

    random = np.random.default_rng(9)
    for size in (0, 1, 1023, 1024, 5000):
        ids = random.zipf(1.3, size).clip(0, 50_256).astype(np.uint32)
        segment = token_files.Segment(token_files.encode_segment([4, -5], [size // 2, size - size // 2], ids))
        assert (segment.ids() == ids).all() and segment.doc_ids.tolist() == [4, -5]
        if size > 1024:
            assert (segment.blocks(1, 2) == ids[1024:2048]).all()
    with pytest.raises(ValueError):
        token_files.Segment(b"something else")


def test_tokens_of_odd_rows(odd, none):
    tokenizer = token_files.default_tokenizer()
    got = token_files.read_tokens(token_files.write_tokens(odd, tokenizer)).orderBy("start").collect()
    assert len(got) == odd.count() and [row.start for row in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    assert {row.n_tokens for row in got if row.doc_id in (3, 4)} == {1}
    assert token_files.read_tokens(token_files.write_tokens(none, tokenizer)).count() == 0


# -- repeated substrings --------------------------------------------------


def plain_repeats(rows):
    first = {}
    order = sorted(((math.inf if doc is None else doc, text.encode()) for doc, text in rows), key=lambda r: r[0])
    for doc, data in order:
        for i in range(len(data) - 49):
            first[data[i : i + 50]] = min(doc, first.get(data[i : i + 50], math.inf))
    out = Counter()
    for doc, data in order:
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < doc:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[None if doc == math.inf else doc, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def check_repeats(docs):
    got = substring_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, got.collect())) == plain_repeats(texts(docs))


def test_repeats_equal_the_plain_version(small):
    check_repeats(small)


def test_repeats_of_odd_rows(odd, none):
    check_repeats(odd)
    assert substring_dedup.remove_repeats(none).count() == 0
    kept = {row.doc_id: row.kept for row in substring_dedup.remove_repeats(odd, keep_text=True).collect()}
    assert kept[2] == "" and kept[4] == ""


def test_equal_windows_are_found_by_sorting():
    import numpy as np

    data = np.frombuffer((b"abcdefghij" * 12 + b"x" + b"abcdefghij" * 6)[:190], np.uint8)
    starts = np.arange(len(data) - 49)
    classes = substring_dedup.equal_windows(data, starts)
    for a in starts.tolist():
        for b in starts.tolist():
            assert (classes[a] == classes[b]) == (data[a : a + 50].tobytes() == data[b : b + 50].tobytes())


# -- fingerprints ---------------------------------------------------------


def test_fingerprints_follow_the_edited_texts(small):
    rows = sorted(texts(small), reverse=True)
    got = {row.doc_id: row for row in fingerprints.fingerprint_documents(small).collect()}
    errors = []
    for at, (doc, text) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (set(shingle_sequence(one)) for one in (text, edited, after))
        assert got[doc].n_chars == len(text) and got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [abs(got[doc].near_edited - len(a & b) / len(a | b)), abs(got[doc].near_next - len(a & c) / len(a | c))]
    assert max(errors) < 0.12 and sum(errors) / len(errors) < 0.025


def test_fingerprints_of_odd_rows(odd, none):
    got = fingerprints.fingerprint_documents(odd).collect()
    assert len(got) == odd.count()
    by_chars = {(row.doc_id, row.n_chars): row for row in got}
    assert by_chars[3, 0].fingerprint == by_chars[4, 0].fingerprint == ""
    assert all(0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1 for row in got)
    assert len({row.fingerprint for row in got if row.doc_id in (1, 2)}) == 1
    assert fingerprints.fingerprint_documents(none).count() == 0
    alone = fingerprints.fingerprint_documents(odd.where("doc_id = 9")).first()
    assert alone.near_next == 1.0


# -- language model -------------------------------------------------------


def test_scores_match_the_base_and_beat_it(small):
    rows = texts(small)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = {doc: [*re.findall(WORD, text.translate(lower)), None] for doc, text in rows}
    train = {doc for doc in tokens if zlib.crc32(str(doc).encode()) % 7 != 2}
    counts = Counter(token for doc in train for token in tokens[doc])
    total = sum(counts.values())
    held = [0.0, 0.0]
    for row in language_model.score_documents(small).collect():
        base = sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in tokens[row.doc_id])
        assert (row.held_out, row.n_tokens, row.train_tokens) == (row.doc_id not in train, len(tokens[row.doc_id]), total)
        assert row.n_known == sum(counts[t] > 0 for t in tokens[row.doc_id])
        assert row.base_score == pytest.approx(base) and row.score < 0
        if row.held_out:
            held = [held[0] + row.base_score, held[1] + row.score]
    assert held[1] > held[0]


def test_tables_are_seated_as_the_exact_distribution_says():
    import numpy as np

    count, p, others, discount = 3, 0.3, 5, 0.6
    stirling = language_model._stirling(discount, 4)
    weights = []
    for t in (1, 2, 3):
        opened = np.prod([language_model.STRENGTH + discount * (others + k) for k in range(t)])
        weights.append(opened * p**t * math.exp(stirling[count, t]))
    n = 40_000
    drawn = language_model.sample_tables(np.full(n, count), np.full(n, p), np.full(n, others), discount, np.random.default_rng(1))
    for t in (1, 2, 3):
        assert (drawn == t).mean() == pytest.approx(weights[t - 1] / sum(weights), abs=0.01)
    many = language_model.sample_tables(np.array([5000, 0, 1]), np.array([0.2, 0.1, 0.1]), np.array([3, 0, 0]), discount, np.random.default_rng(2))
    assert 1 <= many[0] <= 5000 and many[1:].tolist() == [0, 1]


def test_batches_too_large_for_one_sort_key_are_cut_the_same_way(monkeypatch):
    import numpy as np

    random = np.random.default_rng(4)
    context, word = (np.sort(random.integers(0, 2**62, 50).astype(np.uint64))[random.integers(0, 50, 2000)] for _ in range(2))
    row, flag = np.sort(random.integers(0, 9, 2000)), random.random(2000) < 0.5
    for rows, texts, flags in ((9, row, flag), (1, np.int64(0), flag), (9, row, None)):
        monkeypatch.setattr(language_model, "KEYS", 2**63)
        one = [[np.asarray(x).tolist() for x in part] for part in language_model._in_blocks(context, word, texts, rows, flags, 4)]
        monkeypatch.setattr(language_model, "KEYS", 0)
        assert one == [[np.asarray(x).tolist() for x in part] for part in language_model._in_blocks(context, word, texts, rows, flags, 4)]
    whole = list(language_model._in_blocks(context, word, np.int64(0), 2**60, None, 4))
    assert whole


def test_scores_of_odd_rows(odd, none):
    got = language_model.score_documents(odd).collect()
    assert len(got) == odd.count()
    assert {row.n_tokens for row in got if row.doc_id in (3, 4, 5)} == {1}
    assert len({row.score for row in got if row.doc_id in (3, 4, 5)}) == 1
    assert language_model.score_documents(none).count() == 0


# -- mixing ---------------------------------------------------------------


def plain_targets(sizes):
    """Targets by sharing anew what goes over three times a source, until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: 1 + i % 3 for i, name in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = [name for name in names if name not in capped]
        share = {name: rest * weight[name] / sum(weight[n] for n in free) for name in free}
        over = [name for name in free if share[name] > 3 * sizes[name]]
        if not over:
            return capped | share
        capped |= {name: 3.0 * sizes[name] for name in over}


@pytest.mark.parametrize("which", ["small", "odd"])
def test_mix_comes_near_its_targets(request, which):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.source, len(re.findall(WORD, r.text or ""))) for r in docs.select("doc_id", "source", "text").collect()]
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    targets = plain_targets(sizes)
    mixed = mixing.mix_sources(docs).collect()
    assert Counter((r.doc_id, r.size) for r in mixed) == Counter((doc, size) for doc, _, size in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in mixed)
    by_target = defaultdict(int)
    for row in mixed:
        by_target[row.source_size, round(row.target, 6)] += row.taken
    wanted = defaultdict(float)
    for source, target in targets.items():
        wanted[sizes[source], round(target, 6)] += target
    assert set(by_target) == set(wanted)
    assert all(abs(by_target[k] - wanted[k]) <= mixing.BLOCK_WORDS + 1 for k in wanted)
    assert sorted(map(key, mixed)) == sorted(map(key, mixing.mix_sources(docs.repartition(5)).collect()))


def test_permutations_are_bijections(spark):
    for count in (1, 2, 7, 100):
        frame = spark.range(count).select(mixing.permuted(F.col("id"), F.lit(count).cast("long"), F.lit(5)).alias("p"))
        assert sorted(r.p for r in frame.collect()) == list(range(count))


def test_mixed_documents_hold_what_the_mix_takes(small, none):
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(small).collect()}
    got = defaultdict(int)
    original = dict(texts(small))
    for row in mixing.mixed_documents(small).collect():
        got[row.doc_id] += len(re.findall(WORD, row.text))
        assert row.n_chars == len(row.text)
        assert set(re.findall(WORD, row.text)) <= set(re.findall(WORD, original[row.doc_id]))
    assert got == {doc: words for doc, words in taken.items() if words}
    assert mixing.mix_sources(none).count() == 0 and mixing.mixed_documents(none.select("doc_id", "text", "lang", "source", "n_chars")).count() == 0
