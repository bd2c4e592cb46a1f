"""Operators with a trained or fitted model, and the pipeline."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbline.llm import decontamination, hashing, quality, registry, toxicity
from kerbline.llm.blobs import pack, unpack
from kerbline.llm.components import components

SF = "/root/testdata/sf0.001"


def test_hashes_do_not_depend_on_where_a_word_stands():
    texts = ["alpha beta  gamma", "", None, "gamma\talpha", " beta\n"]
    values, firsts = hashing.word_hashes(*hashing.text_bytes(pa.array(texts)))
    alpha, beta, gamma, gamma2, alpha2, beta2 = values.tolist()
    assert firsts.tolist() == [0, 3, 3, 3, 5, 6]
    assert (alpha, beta, gamma) == (alpha2, beta2, gamma2) and len({alpha, beta, gamma}) == 3
    runs, ends = hashing.shingles(values, firsts, 5)
    assert ends.tolist() == [0, 1, 1, 1, 2, 3]


def test_blobs_read_back():
    arrays = [np.array([0, 255, 70_000]), np.zeros(0, np.int64), np.array([1.5, -2.0]), np.array([2**63 + 5], np.uint64)]
    for one, two in zip(arrays, unpack(pack(*arrays)), strict=True):
        assert one.tolist() == two.tolist()


def test_components_join_chains_and_leave_pairs_apart(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- toxicity -------------------------------------------------------------


@pytest.fixture(scope="module")
def insults(spark):
    """A thousand texts; every fourth has inflected insults, and unseen forms of them in the held-out part."""
    random = np.random.default_rng(4)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ter", "non", "sul") for c in ("a", "en", "is", "um")]
    rows = []
    for doc in range(1000):
        text = random.choice(words, 60).tolist()
        held = zlib.crc32(str(doc).encode()) % 5 == 0
        if doc % 4 == 0:
            for at in (7, 31, 52):
                text[at] = ("grumbold" if not held else "grumboldd") + str(random.choice(["", "s", "ish"]))
        rows.append((doc, " ".join(text), int(doc % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxic_texts_are_found_by_forms_never_seen(insults):
    model = toxicity.train(insults.select("doc_id", "text"), insults.select("doc_id", "toxic"))
    scored = toxicity.score_texts(insults, model).join(insults.select("doc_id", "toxic"), "doc_id")
    held = scored.where(toxicity.held_out(F.col("doc_id"))).collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    kept = toxicity.keep_clean(insults, model)
    assert kept.columns == insults.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scored.where("predicted = 0").collect())


def test_toxicity_learns_nothing_from_held_out_labels(insults):
    labels = insults.select("doc_id", "toxic")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.train(insults, table.select("doc_id", "toxic")) for table in (labels, flipped))
    assert (one[0] == two[0]).all() and one[1] == two[1]


def test_toxicity_of_odd_rows(odd, none, labels):
    model = toxicity.train(odd, odd.select("doc_id", F.lit(0).alias("toxic")))
    got = toxicity.score_texts(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert toxicity.score_texts(none, toxicity.train(none, labels.where("false"))).count() == 0
    assert toxicity.keep_clean(odd, model).columns == odd.columns


# -- quality --------------------------------------------------------------


def plain_posterior(rows, prior):
    """rows: (group prior, n, sum) by site; the strength by moments and each site's shrunk mean."""
    n = np.array([r[1] for r in rows], float)
    s = np.array([r[2] for r in rows], float)
    p = np.array([r[0] for r in rows], float)
    excess = (n * (s / n - p) ** 2).sum() - (p * (1 - p)).sum()
    strength = max((p * (1 - p)).mean() / max(excess / n.sum(), 1e-6) - 1, 1.0)
    return strength, (s + strength * p) / (n + strength)


def test_quality_equals_the_plain_formulas(small, labels):
    model = quality.train(small, labels)
    got = quality.score_documents(small, model, host=small["source"], path=small["lang"]).collect()
    site = {r.doc_id: (r.source, r.lang) for r in small.collect()}
    p = {r.doc_id: r.text_chance for r in got}
    mean = np.mean(list(p.values()))
    hosts = sorted({s for s, _ in site.values()})
    of = lambda test: [p[doc] for doc, where in site.items() if test(where)]
    _, host_mean = plain_posterior([(mean, len(v := of(lambda w, h=h: w[0] == h)), sum(v)) for h in hosts], mean)
    host_mean = dict(zip(hosts, host_mean, strict=True))
    paths = sorted(set(site.values()))
    sums = {path: (len(v := of(lambda w, q=path: w == q)), sum(v)) for path in paths}
    strength, _ = plain_posterior([(host_mean[path[0]], *sums[path]) for path in paths], mean)
    logit = lambda x: np.log(x / (1 - x))
    for row in got:
        n, s = sums[site[row.doc_id]]
        others = (s - p[row.doc_id] + strength * host_mean[site[row.doc_id][0]]) / (n - 1 + strength)
        score = 1 / (1 + np.exp(-(logit(p[row.doc_id]) + logit(np.clip(others, 0.001, 0.999)) - logit(mean))))
        assert row.path_posterior == pytest.approx(np.clip(others, 0.001, 0.999), abs=1e-6)
        assert row.score == pytest.approx(score, abs=1e-6) and row.keep == (row.score >= 0.5)


def test_quality_agrees_with_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    scored = quality.score_documents(docs, quality.train(docs, labels), host=docs["source"], path=docs["lang"])
    held = scored.join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    assert sum(r.keep == bool(r.quality) for r in held) >= 0.97 * len(held)


def test_sparse_sites_are_shrunk_most(spark):
    rows = [(i, "good text here" if i % 2 else "### $$$ &&&", "big") for i in range(400)] + [(1000, "### $$$ &&&", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = np.zeros(quality.FEATURES)
    weights[list(quality._CLASSES).index("symbol")] = -4.0
    got = {r.doc_id: r for r in quality.score_documents(docs, (np.zeros(len(weights)), np.ones(len(weights)), np.r_[1.0, weights]), docs["source"], docs["source"]).collect()}
    mean = np.mean([r.text_chance for r in got.values()])
    assert got[1000].text_chance < got[1000].host_posterior <= mean + 1e-9
    assert abs(got[0].host_posterior - mean) < 0.01


def test_quality_of_odd_rows(odd, none, labels):
    model = quality.train(odd, labels.where("false"))
    got = quality.score_documents(odd, model, host=odd["source"], path=odd["lang"]).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score_documents(none, model, host=none["source"], path=none["lang"]).count() == 0


# -- decontamination ------------------------------------------------------


def test_every_copied_item_is_found_and_clean_texts_are_not(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "benchmark"))
    got = {(r.doc_id, item) for r in decontamination.find_items(docs, items).collect() for item in r["items"]}
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    copied = {(doc, r.item_id) for r in items.collect() for doc, text in texts if r.text in (text or "")}
    assert copied and copied <= got and len(got) <= len(copied) * 1.05 + 1


def test_paraphrases_need_the_answer(spark):
    def words(kind, n):
        return [f"{kind}{chr(97 + i % 26)}{chr(97 + i * 7 % 26)}" for i in range(n)]

    item = f"{' '.join(words('q', 24))}. {' '.join(words('ans', 6))}."
    changed = [w if i % 3 else f"other{i}" for i, w in enumerate(words("q", 24))]
    filler = " ".join(f"plain{i % 50}" for i in range(200))
    rows = [
        (1_000_001, f"{filler} {item} {filler}"),
        (1_000_002, f"{filler} {' '.join(changed)}. {' '.join(words('ans', 6))}. {filler}"),
        (1_000_003, f"{filler} {' '.join(w if i % 2 else f'x{i}' for i, w in enumerate(words('q', 24)))}. {filler}"),
        (1_000_004, filler),
    ]
    # Among the supplied documents: the latent space needs a corpus.
    supplied, benchmark = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "benchmark"))
    docs = supplied.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    own = spark.createDataFrame([(1009, item), (1010, None), (1011, "...")], "item_id long, text string")
    items = benchmark.select("item_id", "text").union(own)
    got = {r.doc_id - 1_000_000: r["items"] for r in decontamination.find_items(docs, items).where("doc_id > 1000000").collect()}
    assert got == {1: [1009], 2: [1009], 3: [], 4: []}
    left = decontamination.without_items(docs, items).where("doc_id > 1000000").collect()
    assert sorted(r.doc_id for r in left) == [1_000_003, 1_000_004]


def test_every_edited_copy_is_found_as_by_brute_force(spark):
    """Copies and paraphrases with words replaced, against an alignment of every window with every item."""
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "benchmark"))
    kept = docs.where("length(text) > 300").orderBy("doc_id").limit(160).select("doc_id", "text").collect()
    random = np.random.default_rng(17)
    pool = [word for row in kept for word in row.text.split()]
    bench = [(row.item_id, row.text) for row in items.orderBy("item_id").collect()]
    rows = []
    for at, row in enumerate(kept):
        words = bench[at % len(bench)][1].split()
        free = len(words) if at % 2 else len(words) - len(words) // 3
        share = (0.4, 0.2, 0.45, 0.29, 0.5, 0.29)[at % 6]
        for place in random.choice(free, min(free, int(share * len(words))), replace=False):
            words[place] = pool[random.integers(len(pool))]
        text = row.text.split()
        middle = len(text) // 2
        rows.append((row.doc_id, " ".join([*text[:middle], *words, *text[middle:]])))
    model = decontamination.Items.of([one for one, _ in bench], [text for _, text in bench])
    want = set()
    for doc, text in rows:
        numbers, ends = decontamination._term_numbers(pa.array([text]), model.terms)
        for item, sequence, answer in zip(model.ids, model.sequences, model.answers, strict=True):
            around = len(sequence) // 2
            for first, last in zip(*decontamination.passages(ends), strict=True):
                if decontamination.matches(sequence, answer, numbers[max(0, first - around) : last + around]):
                    want.add((doc, item))
    edited = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, item) for r in decontamination.find_items(edited, items).collect() for item in r["items"]}
    assert len(want) > 60 and got == want


def test_decontamination_of_odd_rows(spark, odd, none):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = decontamination.find_items(odd, items).collect()
    assert len(got) == odd.count() and not any(r.contaminated for r in got)
    assert decontamination.find_items(none, items).count() == 0
    assert decontamination.find_items(odd, items.where("false")).where("contaminated").count() == 0
    assert decontamination.without_items(odd, items).count() == odd.count()


def test_the_latent_space_is_that_of_a_plain_decomposition(spark):
    """All directions kept, the terms' vectors span what numpy's singular vectors span; fewer kept, they are the leading ones."""
    random = np.random.default_rng(3)
    size, passages = 12, [random.integers(0, 12, random.integers(1, 9)).astype(np.int32) for _ in range(60)]
    idf = np.append(random.uniform(0.5, 3, size - 1), 0.0)
    queries = [random.integers(0, 12, 6).astype(np.int64) for _ in range(4)]
    matrix = np.zeros((64, size))
    for row, terms in enumerate([*passages, *queries]):
        np.add.at(matrix[row], terms, idf[terms])
    stored = spark.createDataFrame([(bytearray(p.tobytes()),) for p in passages], "terms binary").repartition(3)
    flat, ends = np.concatenate(queries), np.concatenate([[0], np.cumsum([len(q) for q in queries])])
    _, singular, right = np.linalg.svd(matrix)
    for rank in (size, 3):
        vectors = decontamination.latent_vectors(stored, (flat, ends), idf, rank)
        want = idf[:, None] * right[:rank].T
        assert np.allclose(vectors @ vectors.T, want @ want.T, atol=1e-3)


def test_candidates_come_from_the_cosine(spark, monkeypatch):
    """With no passage alike enough, nothing is found: the lookup alone yields no candidate."""
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "benchmark"))
    monkeypatch.setattr(decontamination, "MIN_COSINE", 100.0)
    assert decontamination.find_items(docs, items).where("contaminated").count() == 0


def _own_corpus(spark):
    """Texts of 1 to 90 words, most of which share few rare words with the items, and four items."""
    random = np.random.default_rng(11)
    pool = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    texts = [" ".join(pool[i] for i in random.zipf(1.3, n) % 60) for n in random.integers(1, 90, 120)]
    items = [" ".join(pool[i] for i in random.choice(60, n, replace=False)) for n in (6, 20, 33, 50)]
    model = decontamination.Items.of(list(range(4)), items)
    rows = spark.createDataFrame([(text,) for text in [*texts, "", None]], "text string").repartition(3)
    return model, texts, decontamination.numbered(rows, model)


def _plain_passages(sequence):
    starts = range(0, max(1, len(sequence) - decontamination.STRIDE), decontamination.STRIDE)
    return [sequence[at : at + decontamination.PASSAGE] for at in starts]


def test_the_latent_space_is_fitted_to_every_passage_and_all_are_searched(spark):
    items, texts, rows = _own_corpus(spark)
    size = len(items.terms)
    model = decontamination.fit(rows, items)
    numbers = [decontamination._term_numbers(pa.array([text]), items.terms)[0] for text in texts]
    corpus = [passage for text in numbers for passage in _plain_passages(text)]
    own = [passage for sequence in items.sequences for passage in _plain_passages(sequence)]
    counts = np.array([sum(term in passage for passage in corpus) for term in range(size)])
    idf = decontamination.term_weights(items, counts, len(corpus))

    def rows_of(passages):
        return np.array([np.bincount(p[p < size], minlength=size) * idf for p in passages])

    _, _, right = np.linalg.svd(np.concatenate([rows_of(corpus), rows_of(own)]))
    assert model.vectors.shape[1] == size < decontamination.RANK
    assert np.allclose(model.vectors @ model.vectors.T, (idf[:, None] * right.T) @ (idf[:, None] * right.T).T, atol=1e-3)

    unit = [decontamination._unit(rows_of(some) @ right.T) for some in (corpus, own)]
    least = decontamination.MIN_COSINE * np.sqrt(np.array([min(1, len(p) / decontamination.PASSAGE) for p in own]))
    flat, ends = np.concatenate(numbers), np.concatenate([[0], np.cumsum([len(text) for text in numbers])])
    near = np.concatenate([tile for _, tile in decontamination.candidates(flat, ends, model)])
    cosine = unit[0] @ unit[1].T
    clear = np.abs(cosine - least) > 1e-3
    assert near.shape == cosine.shape and (near == (cosine >= least))[clear].all() and near.any() and not near.all()


def test_the_count_of_rare_words_only_checks_what_the_cosine_yields(spark):
    """Each candidate is counted in its own window; a count that asks for nothing leaves every candidate, whatever its words."""
    items, texts, rows = _own_corpus(spark)
    model = decontamination.fit(rows, items)
    lookup = model.lookup
    numbers, ends = decontamination._term_numbers(pa.array(texts), items.terms)
    first, last = decontamination.passages(ends)
    near = np.concatenate([tile for _, tile in decontamination.candidates(numbers, ends, model)])
    found, without = [], 0
    for item, sequence in enumerate(items.sequences):
        own = [term for term in range(len(items.terms)) if item in lookup.owners[lookup.starts[term] : lookup.starts[term + 1]]]
        for at in np.flatnonzero(near[:, model.bounds[item] : model.bounds[item + 1]].any(axis=1)).tolist():
            text, around = np.searchsorted(ends, first[at], side="right") - 1, len(sequence) // 2
            window = numbers[max(ends[text], first[at] - around) : min(ends[text + 1], last[at] + around)]
            found.append((item, at, int(np.isin(window, own).sum())))
            without += found[-1][2] == 0
    checked = [(item, at) for item, at, many in found if many >= lookup.needed[item]]
    assert without and 0 < len(checked) < len(found)
    assert [tuple(pair) for pair in decontamination._possible(numbers, ends, first, last, model).tolist()] == checked
    lookup.needed[:] = 0
    assert [tuple(pair) for pair in decontamination._possible(numbers, ends, first, last, model).tolist()] == [pair[:2] for pair in found]


# -- registry and pipeline ------------------------------------------------


def test_there_is_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry.queries()) == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_queries_equal_their_sql(spark, name):
    import compare

    assert compare.differences(registry.queries()[name](spark, SF), compare.connect(SF), registry.oracle_sql()[name]) == []


def test_the_pipeline_is_its_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids, current = {r.doc_id for r in docs.select("doc_id").collect()}, docs
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, SF).cache()
        assert current.columns == docs.columns
        left = {r.doc_id for r in current.select("doc_id").collect()}
        assert left <= ids, name
        ids = left
        if name == "benchmark decontamination":
            assert not any(item in r.text for r in current.collect() for item in items)
        if name == "toxicity":
            assert sum(labels.get(doc, 0) for doc in left) <= sum(labels.values())
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in got.collect()} == ids and got.count() == current.count()
