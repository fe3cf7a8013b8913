"""Odd inputs of every operator: NULLs, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martweave.llm import ann, chat, decontaminate, langid, licenses, near, packing, substrings, toxicity, url_filter
from martweave.llm.queries import tokenizer_json
from martweave.llm.words import ALNUM, SPACED, split_words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """A NULL id, NULL and empty texts, one text without letters, repeated rows, copies and a long text."""
    base = words(80, 1)
    rows = [
        (1, base, "en", "a", 1),
        (1, base, "en", "a", 1),
        (2, base, "en", "b", 1),
        (None, base + " tail", None, None, None),
        (3, None, "de", "b", None),
        (4, "", "de", "b", 0),
        (5, " \n\t ", None, "b", 4),
        (6, "123 456 !!", "de", "c", 9),
        (7, "ÄÖ été … 漢字 word", "fr", "c", 9),
        (8, words(30_000, 2), "en", "c", 1),
        (9, "three short words", "en", "c", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def test_words_are_those_of_the_pattern():
    texts = ["Ab-c9 É!", None, "", "x", "y\x0bz\x85"]
    found = split_words(pa.array(texts), ALNUM, True)
    assert found.counts.tolist() == [3, 0, 0, 1, 2]
    assert found.hashes[3] != found.hashes[4]
    assert split_words(pa.array(["AB"]), ALNUM, True).hashes[0] == split_words(pa.array(["x ab"]), ALNUM, True).hashes[1]
    assert split_words(pa.array(["y\x0bz\x85"]), SPACED, False).counts.tolist() == [2]


def test_toxicity(spark, docs, no_docs):
    neutral = [(i, f"{w if i % 8 == 0 else ''} {words(8, i)}", "en", "s", 1) for i, w in enumerate(["women", "muslims", "jews", "men"] * 40)]
    rude = [(200 + i, f"you idiot {w} {words(6, 200 + i)}", "en", "s", 1) for i, w in enumerate(["women", "muslims", "jews"] * 14)]
    table = spark.createDataFrame(neutral + rude, DOCS)
    labels = spark.createDataFrame([(r[0], 1, int(r[0] >= 200)) for r in neutral + rude], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(toxicity.training_words(table, labels))
    probe = spark.createDataFrame([(1, "gay women and muslims met"), (2, "what an idiot you are"), (3, None), (4, "")], "doc_id bigint, text string")
    scored = {r.doc_id: r for r in toxicity.score_texts(probe, model).collect()}
    assert [scored[i]["_toxic"] for i in (1, 2, 3, 4)] == [0, 1, 0, 0]
    assert scored[3]["_score"] == scored[4]["_score"]
    # The penalty is what keeps the terms, most of whose texts are toxic here, from counting.
    free = toxicity.fit(toxicity.training_words(table, labels), penalty=0.0)
    term = split_words(pa.array(["jews"]), ALNUM, True).hashes[0]
    weight = {m: abs(float(m_.weights[m_.hashes == term][0])) for m, m_ in (("kept", model), ("free", free))}
    assert weight["kept"] < weight["free"]

    clashing = docs.withColumn("_score", F.lit("mine"))
    assert toxicity.classify(clashing, labels.limit(0)).count() == docs.count()
    assert toxicity.classify(no_docs, labels).count() == 0


def test_toxic_word_beginnings(spark):
    """Toxic texts repeat a stem whose endings differ; calm ones have it once at most, or repeat another."""
    rng = random.Random(3)

    def text(i, stem, times):
        own = [f"{stem}{''.join(rng.choices('abcdefghij', k=4))}" for _ in range(times)] + words(20, 7000 + i).split()
        rng.shuffle(own)
        return " ".join(own)

    rows = [(i, text(i, "réeux", 3), "fr", "s", 1) for i in range(40)]
    rows += [(100 + i, text(100 + i, ("réeux", "calmè")[i % 2], (1, 3)[i % 2]), "fr", "s", 1) for i in range(120)]
    table = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(r[0], 1, int(r[0] < 100)) for r in rows], "doc_id bigint, quality int, toxic int")
    scored = {r.doc_id: r for r in toxicity.classify(table, labels).collect()}
    held = [r.doc_id for r in table.where(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()]
    assert sum(i < 100 for i in held) > 5
    assert [scored[i]["_toxic"] for i in held] == [int(i < 100) for i in held]


def test_scores_are_those_of_the_training_features(spark):
    texts = ["Éa abcd abcde abcdefgh abcdx", "women Womens womenfolk", "漢字漢字漢 漢字漢字", "", None, "x abcd x abcd"]
    sets = toxicity._feature_sets(pa.array(texts))
    hashes = np.unique(np.concatenate(sets))
    model = toxicity.ToxicityModel(hashes, np.linspace(-1, 1, len(hashes)) + 0.01, 0.2)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = [1 / (1 + np.exp(-0.2 - model.weights[np.searchsorted(hashes, s)].sum())) for s in sets]
    found = [r["_score"] for r in toxicity.score_texts(rows, model).orderBy("doc_id").collect()]
    assert np.allclose(found, expected)
    # Five words and beginnings of four to eight letters; those of four and five are there several times.
    assert [len(s) for s in sets] == [5 + 1 + 2 + 1 + 1 + 1 + 2, 3 + 5 + 1 + 2, 2 + 2 + 1, 0, 0, 2 + 1 + 1]


def test_beginnings_of_identity_terms_are_no_features():
    sets = toxicity._feature_sets(pa.array([f"x{i} {w}like {w} idiot" if i % 2 else f"x{i} calm" for i, w in enumerate(["muslims", "women"] * 40)]))
    rows = pa.table({"doc_id": pa.array(range(80)), "words": pa.array([s.view(np.int64) for s in sets]), "toxic": pa.array([i % 2 for i in range(80)], pa.int32())})
    model = toxicity.fit(rows)
    begun = toxicity._feature_sets(pa.array(["women", "women women", "idiot"]))
    terms = split_words(pa.array(["women"]), ALNUM, True).hashes
    assert not np.isin(model.hashes, np.setdiff1d(np.concatenate(begun[:2]), terms)).any()
    assert np.isin(begun[2], model.hashes).all()


def test_training_features_stay_with_the_tasks(spark, monkeypatch):
    """What reaches the driver is a small part of the features; the model is that of all rows in memory. Ids and texts are repeated."""
    rows = [(i % 380, f"{'you idiot' if i % 3 == 0 else ''} {words(60, i % 350)}", int(i % 3 == 0)) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(5)
    got = []
    plain = type(table).toArrow
    monkeypatch.setattr(type(table), "toArrow", lambda self: got.append(plain(self)) or got[-1])
    training = toxicity.training_words(table.drop("toxic"), table.select("doc_id", "toxic"), 200)
    model = toxicity.fit(training)
    monkeypatch.undo()
    every = training.orderBy(F.xxhash64("doc_id"), "doc_id", "name").select("doc_id", "words", "toxic").toArrow()
    assert every.num_rows == 200
    assert sum(t.nbytes for t in got) < every.nbytes / 5
    held = toxicity.fit(every)
    assert len(held.hashes) > len(toxicity.IDENTITY_TERMS) and held.bias == model.bias
    assert held.hashes.tolist() == model.hashes.tolist() and held.weights.tolist() == model.weights.tolist()


def test_held_out_labels_are_never_read(spark):
    rows = [(i, f"word{i % 7} idiot" if i % 2 else f"word{i % 7} calm", "en", "s", 1) for i in range(60)]
    table = spark.createDataFrame(rows, DOCS)
    true = [(i, 1, i % 2) for i in range(60)]
    odd = spark.createDataFrame(true, "doc_id bigint, quality int, toxic int")
    flipped = odd.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.classify(table, odd).select("doc_id", "_score").collect() == toxicity.classify(table, flipped).select("doc_id", "_score").collect()


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
        ("licensed under the apache license version 3.0", ""),
        ("Released under the terms of the MIT License.", "mit"),
        ("This new work is licensed under the GNU General Public License, as published by the Free Software Foundation, version 3", "gpl,gpl-3.0"),
        ("This is licensed under the GNU General Public License version 3", "gpl"),
        ("Copyright 2020 some body. All rights reserved", "copyright,reserved"),
        ("Copyright one two three four five six seven eight nine all rights reserved", "reserved"),
    ],
)
def test_templates(text, labels):
    found = [licenses.compile_template(*t) for t in licenses.TEMPLATES] + [licenses.compile_template(v, k) for k, v in licenses.BASE.items()]
    own = [lowered for lowered in "".join(c if c.isalnum() else " " for c in text.lower()).split()]
    assert ",".join(sorted({a.label for a in found if licenses.find(a, own)})) == labels


def test_licenses(spark, docs, no_docs):
    rows = spark.createDataFrame([(1, "cc by CC-BY all rights reserved", "x"), (2, None, "y")], "doc_id bigint, text string, _license string")
    first, second = (r["_license"] for r in licenses.scan_licenses(rows).orderBy("doc_id").collect())
    assert (first.n_words, first.n_base, first.first_word, first.last_word, first.base_labels) == (7, 3, 0, 4, "cc-by,reserved")
    assert (second.n_words, second.n_base, second.first_word, second.labels, second.score) == (0, 0, None, "", 0.0)
    assert licenses.scan_licenses(docs).count() == docs.count()
    assert licenses.scan_licenses(no_docs).count() == 0


def test_hilbert_neighbours():
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = packing.hilbert_key(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_packing(spark, docs, no_docs):
    pieces = packing.pack(docs, tokenizer_json(), with_ids=True).collect()
    assert all(len(p.ids) == 4 * p.length for p in pieces)
    one = next(p.doc_tokens for p in pieces if p.doc_id == 1)
    assert sum(p.length for p in pieces if p.doc_id == 1) == 2 * one
    long = sorted((p.start, p.length, bytes(p.ids)) for p in pieces if p.doc_id == 8)
    assert [a for a, _, _ in long] == [0, *np.cumsum([n for _, n, _ in long])[:-1]]
    whole = packing._encoder(tokenizer_json()).tokenizer.encode(words(30_000, 2), add_special_tokens=False).ids
    assert np.frombuffer(b"".join(b for _, _, b in long), "<u4").tolist() == [*whole, 1]
    assert {p.doc_id: p.doc_tokens for p in pieces if p.doc_id in (3, 4, 5)} == {3: 1, 4: 1, 5: 1}
    assert packing.pack(no_docs, tokenizer_json()).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "Don't stop... it's 'fine', 5.5%,,",
        "a. b.c .d e,.",
        "ß ǅ İ x̌ é.",
        "<|endoftext|> <|startoftext|>a",
        "…. «x», x\u2003y",
        "<|ENDOFTEXT|>",
        "<|EndOfText|> <|STARTOFTEXT|> <|endoftext|> <|ENDOFTEXT|>",
        "Stop. Über!! X<|endoftext|>Y,. A<|ENDOFTEXT|>B<|StartOfText|><|startoftext|>É. \tEnd...",
    ],
)
def test_word_by_word_ids_are_the_tokenizers(text):
    encoder = packing._encoder(tokenizer_json())
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text.encode()])[0], encoder.dtype).tolist() == whole


def brute_hits(text, items):
    own = [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
    hit, found = set(), set()
    for item_id, item in items:
        words_ = "".join(c if c.isalnum() else " " for c in (item or "").lower()).split()
        k = min(10, len(words_))
        windows = {tuple(words_[p : p + k]) for p in range(len(words_) - k + 1)} if k else set()
        for p in range(len(own) - k + 1) if k else ():
            if tuple(own[p : p + k]) in windows:
                hit.update(range(p, p + k))
                found.add(str(item_id))
    return len(own), len(hit), sorted(found)


def test_decontamination(spark, docs, no_docs):
    long_item, other = words(40, 5), words(25, 6)
    items = [(1, long_item), (2, other), (3, "three short"), (4, None), (5, ""), (6, long_item), (7, "x x x")]
    rows = [
        (1, f"{words(9, 7)} {' '.join(long_item.split()[3:13])} {words(4, 8)}"),
        (2, " ".join(long_item.split()[3:12])),
        (3, f"{long_item} {other.upper()} three short x x x x x"),
        (4, "x x x"),
        (5, None),
        (6, ""),
        (7, " ".join([long_item] * 3)),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    table = spark.createDataFrame(rows + [rows[0]], "doc_id bigint, text string")
    found = decontaminate.decontaminate(table, benchmark).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        assert (r.n_words, r.n_hit, list(r.item_ids)) == brute_hits(dict(rows)[r.doc_id], items)
    kept = decontaminate.drop_contaminated(table.withColumn("key1", F.lit("x")), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 6] and kept.columns == ["doc_id", "text", "key1"]
    assert decontaminate.decontaminate(no_docs, benchmark).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, benchmark.limit(0)).collect()} == {0}


def brute_cut(texts, k=35):
    from collections import Counter

    own = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[p : p + k]) for w in own for p in range(len(w) - k + 1))
    out = []
    for w in own:
        gone = {i for p in range(len(w) - k + 1) if count[tuple(w[p : p + k])] > 1 for i in range(p, p + k)}
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def test_repeated_passages(spark, no_docs):
    passage, other = words(60, 9), words(36, 10)
    texts = [
        f"{words(20, 11)} {passage}  {words(20, 12)}",
        f"{words(5, 13)} {passage}\n{words(7, 14)} {other}",
        " ".join(passage.split()[:34]),
        " ".join(passage.split()[10:45]),
        f"{other} {words(3, 15)}",
        " ".join(["again"] * 50),
        " ".join(["again"] * 35),
        " ".join(["again"] * 34),
        f"{words(50, 16)} {words(3, 17)} {words(50, 16)}",
        None,
        "",
        words(36, 18),
        words(36, 18),
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("_kept", F.lit(1))
    found = {r.doc_id: r for r in substrings.remove_repeats(table).collect()}
    for i, (n, gone, left) in enumerate(brute_cut(texts)):
        assert (found[i]["_n_words"], found[i]["_n_removed"], " ".join((found[i]["_kept"] or "").split())) == (n, gone, left), i
    assert found[9]["_kept"] is None
    assert substrings.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeated_passages_of_random_texts(spark, seed):
    """Few different words and a short window: many repeats that end, branch and overlap."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choices("abcd", k=rng.randrange(60))) for _ in range(60)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in substrings.remove_repeats(table, window=10).collect()}
    for i, (n, gone, left) in enumerate(brute_cut(texts, 10)):
        assert (found[i]["_n_words"], found[i]["_n_removed"], " ".join(found[i]["_kept"].split())) == (n, gone, left)


def test_samples_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    a, b = rng.uniform(0.5, 3, 400), rng.uniform(0.5, 3, 400)
    doc = np.repeat([0, 1], 400)
    found = near.sample(doc, np.tile(hashes, 2), np.concatenate([a, b]), 2, 2000)
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((found[0] == found[1]).mean() - expected) < 0.05


def test_near_duplicates(spark, docs, no_docs):
    found = near.near_duplicates(docs.withColumn("key1", F.lit(0))).collect()
    assert len(found) == docs.count()
    group = [r for r in found if r.class_size == 4]
    assert len(group) == 4 and {r.class_id for r in group} == {1} and sum(r.stays for r in group) == 1
    assert {r.class_size for r in found if r.doc_id in (3, 4)} == {2}
    kept = near.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7, 8, 9]
    assert near.near_duplicates(no_docs).count() == 0 and near.keep_one_of_each(no_docs).count() == 0


def test_a_large_group_of_near_copies_is_one_class(spark):
    base = words(200, 20).split()
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(150)] + [(1000 + i, words(200, 100 + i)) for i in range(20)]
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.class_id for r in found if r.doc_id < 1000} == {0}
    assert all(r.class_size == 1 for r in found if r.doc_id >= 1000)


def test_large_buckets_lose_no_link(spark):
    """Copies of one text with ever more edits: many pairs below the similarity, chains above it."""
    rng = random.Random(7)
    base, rows = words(120, 30).split(), []
    for i in range(260):
        own = list(base)
        for at in rng.sample(range(120), rng.randrange(1, 9)):
            own[at] = f"e{i}x{at}" if i % 3 else f"e{at}"
        rows.append((i, " ".join(own)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    idf = near.idf_table(table)
    sim = near._alike(pa.array([t for _, t in rows]), 260, idf)
    halves = near._alike(pa.array([t for _, t in rows]), 100, idf)
    assert np.allclose(halves, sim[:100, 100:])
    first = pa.array([rows[3][1]] * 260)
    assert np.allclose(np.delete(sim[3], 3), np.delete(near.weighted_jaccard(first, pa.array([t for _, t in rows]), idf), 3))
    label = np.arange(260)
    while True:
        low = np.minimum(label, np.where(sim >= 0.8, label[None], 260).min(axis=1))
        if (low == label).all():
            break
        label = low
    assert len(set(label.tolist())) > 3
    assert {r.doc_id: r.class_id for r in near.near_duplicates(table).collect()} == dict(enumerate(label.tolist()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    labels = {r.vid: r.label for r in near.components(edges).collect()}
    assert labels == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_components_join_links_a_few_times_only(spark, monkeypatch):
    """A chain of dense groups: all rounds together join no more rows than a few times the links."""
    ids = random.Random(4).sample(range(10**6), 800)
    links = [(ids[g + i], ids[g + j]) for g in range(0, 800, 20) for i in range(20) for j in range(i)] + list(zip(ids, ids[1:], strict=False))
    edges = spark.createDataFrame(links + links[:50] + [(-5, -5)], "a bigint, b bigint")
    counts, plain = [], type(edges).join

    def counted(*args, **kwargs):
        joined = plain(*args, **kwargs)
        counts.append(joined.count())
        return joined

    monkeypatch.setattr(type(edges), "join", counted)
    labels = {r.vid: r.label for r in near.components(edges).collect()}
    assert labels == dict.fromkeys(ids, min(ids)) | {-5: -5}
    assert sum(counts) < 5 * len(links)


def test_languages(spark, docs, no_docs):
    vocabulary = {"en": "the house with people and water", "de": "das schöne wetter über nacht", "ru": "это очень хороший дом"}
    rows = [(i, " ".join(random.Random(i).choices(vocabulary[g].split(), k=12)), g, "s", 1) for i, g in enumerate(list(vocabulary) * 30)]
    model = langid.fit(langid.training_counts(spark.createDataFrame(rows, DOCS)))
    probe = [(1, "the house and the people"), (2, "очень хороший дом"), (3, None), (4, "12 !"), (5, ""), (6, "the house with people and water das schöne wetter über nacht über das wetter nacht")]
    found = {r.doc_id: r for r in langid.identify(spark.createDataFrame(probe, "doc_id bigint, text string"), model, with_spans=True).collect()}
    assert [found[i]["_lang"] for i in range(1, 6)] == ["en", "ru", "und", "und", "und"]
    assert [(s.lang, s.start, s.words) for s in found[6]["_lang_spans"]] == [("en", 0, 6), ("de", 6, 9)]
    nothing = langid.fit(langid.training_counts(no_docs))
    assert {r["_lang"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0


def test_viterbi_equals_plain_search():
    rng = np.random.default_rng(4)
    first = np.array([0, 7, 7, 12, 13])
    scores = rng.normal(0, 2, (13, 3))
    got = langid.best_path(scores, first, 1.5)
    import itertools

    for a, b in zip(first, first[1:], strict=False):
        def value(path, a=a):
            return sum(scores[a + i, p] for i, p in enumerate(path)) - 1.5 * sum(x != y for x, y in itertools.pairwise(path))

        if b > a:
            assert tuple(got[a:b]) == max(itertools.product(range(3), repeat=b - a), key=value)


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 4)))]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 4), (2003, [float("nan"), 1.0, 1.0, 1.0]), (2004, [float("inf"), 1.0, 1.0, 1.0]), (2005, [None, 1.0, 1.0, 1.0])]
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (2006, [1.0, 2.0]), rows[5]]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit("x"))
    found = ann.nearest(table, F.col("vec_id") % 100 == 0).collect()
    asked = {r.query_id for r in found}
    assert asked == {0, 100, 200, 1000}
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 1000] == list(range(1001, 1011))
    points = {i: np.array(v) for i, v in rows[:330]}
    for q in (0, 100, 200):
        best = sorted((float(np.sqrt(((points[i] - points[q]) ** 2).sum())), i) for i in points if i != q)[:10]
        own = sorted((r["rank"], r.vec_id) for r in found if r.query_id == q)
        assert len({i for _, i in own} & {i for _, i in best}) >= 9
    few = spark.createDataFrame(rows[:3], "vec_id bigint, embedding array<double>")
    assert sorted(r["rank"] for r in ann.nearest(few, F.lit(True)).where("query_id = 0").collect()) == [1, 2]
    assert ann.nearest(few.limit(0), F.lit(True)).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://A.Com", "http://x.com?q", "a://b://c/d?e", "http://www.example.com/en/1#z", "http://notexample.com/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("_url", F.lit(1))
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/")]
    got = [(r["_url"].host, r["_url"].path, r["_url"].rule) for r in url_filter.filter_urls(pages, rules).orderBy("page_id").collect()]
    assert got == [
        ("", "", None),
        ("", "", None),
        ("", "", None),
        ("a.com", "", None),
        ("x.com", "", None),
        ("b:", "//c/d", None),
        ("www.example.com", "/en/1", "www.example.com/en/"),
        ("notexample.com", "/en/", "com/"),
    ]
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "\\l<[\\b", "</s>[INST] ok [/INST]", "<|end|>\n<|turn|>user\n", "\\n\n"])
def test_escapes_are_reversible(text):
    formatted, start, end, _ = chat.format_turn("a<b\n", [{"type": "text", "text": text}])
    assert chat.read_turn(formatted) == ("a<b\n", text)
    assert chat.unescape(formatted[start:end]) == text
    assert formatted.count(chat.TURN) == formatted.count(chat.END) == 1


def test_typed_parts(spark):
    parts = [
        {"type": "text", "text": "see ["},
        {"type": "image", "ref": "i.png", "width": 56, "height": 29},
        None,
        {"type": "audio", "ref": "a.wav", "seconds": 1.5},
        {"type": "document", "ref": "d.pdf", "pages": 3},
        {"type": "text", "text": None},
    ]
    rows = spark.createDataFrame(
        [(1, 0, "user", None, parts), (1, 1, "assistant", "fine", None), (1, 1, None, None, None), (None, None, "assistant", "x", None)],
        f"conv_id bigint, turn bigint, role string, text string, parts array<{chat.PART_TYPE}>",
    )
    found = {(r.conv_id, r.turn, r.loss_end): r for r in chat.format_turns(rows).collect()}
    first = found[1, 0, 0]
    assert first.formatted == "<|turn|>user\nsee \\b<|image|><|audio|><|document|><|end|>\n"
    assert [(a.ordinal, a.kind, a.ref, a.tokens) for a in first.attachments] == [(0, "image", "i.png", 4), (1, "audio", "a.wav", 38), (2, "document", "d.pdf", 1536)]
    digest = {r.conv_id: r for r in chat.digest_conversations(chat.format_turns(rows)).collect()}
    assert (digest[1].n_turns, digest[1].loss_chars, digest[None].loss_chars) == (3, 4, 1)
    assert chat.digest_conversations(chat.format_turns(rows.limit(0))).count() == 0


def test_pipeline_stages(spark, sf_dir, docs, no_docs, tmp_path):
    """Every stage takes odd documents; all but the last return the columns of documents."""
    odd = docs.withColumn("key1", F.lit("x"))
    for table in (odd, no_docs):
        rows = table
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, rows, sf_dir)
            path = str(tmp_path / f"{table is odd}-{i}-{name}")
            made.write.parquet(path)
            rows = spark.read.parquet(path)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert rows.columns == table.columns, name
        assert (rows.count() > 0) == (table is odd)


def brute_classes(texts):
    """Least id of each text's class, from the weighted Jaccard similarity of all pairs."""
    bags = {}
    for i, text in texts.items():
        own = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        n = min(5, len(own))
        bags[i] = Counter(tuple(own[p : p + n]) for p in range(len(own) - n + 1)) if n else Counter()
    frequency = Counter(g for bag in bags.values() for g in bag)
    weight = {g: 1 + math.log(min((len(texts) + 1) / (f + 1), 8)) for g, f in frequency.items()}
    label = {i: i for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        common, either = ((bags[a] & bags[b]), (bags[a] | bags[b]))
        if sum(n * weight[g] for g, n in common.items()) >= 0.8 * sum(n * weight[g] for g, n in either.items()):
            low, high = sorted((label[a], label[b]))
            label = {i: low if k == high else k for i, k in label.items()}
    return label


def test_the_whole_pipeline_equals_plain_python(spark, tmp_path):
    """``run`` over a small corpus against the five stages in plain Python, given the toxicity scores."""
    passage, leak, hidden = words(45, 501), words(40, 502), words(40, 503)
    window = " ".join(hidden.split()[5:17])
    texts = {i: f"{words(20, 600 + i)} you {'idiot' if i < 30 else 'friend'} {words(60, 700 + i)}" for i in range(110)}
    for i in range(40, 46):
        edited = texts[i].split()
        edited[70] = "edited"
        texts[i + 10] = " ".join(edited)
    texts[60] = texts[61] = texts[40]
    # The toxic copy has the smaller id, and it must not take the clean one along.
    texts[0] = texts[70].replace("friend", "idiot")
    for i in (72, 73):
        texts[i] = f"{words(50, 800 + i)} {passage}\n{words(50, 900 + i)} <|ENDOFTEXT|>"
    texts[74] = f"{words(9, 810)} {' '.join(leak.split()[3:15])} {words(50, 811)}"
    # A benchmark window that leaves with a repeated passage, and one that stays.
    texts[75] = f"{words(50, 820)} {words(20, 821)} {window} {words(20, 822)} {words(50, 823)}"
    texts[76] = f"{words(50, 824)} {words(20, 821)} {window} {words(20, 822)} {words(50, 825)}"
    texts[77] = f"{words(50, 826)} {window}"
    items = [(1, leak), (2, hidden)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], DOCS)
    labels = spark.createDataFrame([(i, 1, int(i < 30)) for i in texts], "doc_id bigint, quality int, toxic int")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))

    score = {r.doc_id: r["_score"] for r in toxicity.classify(docs, labels).collect()}
    clean = {i: t for i, t in texts.items() if score[i] < 0.7}
    assert sorted(clean) == list(range(30, 110))
    label = brute_classes(clean)
    single = {i: clean[i] for i in sorted(set(label.values()))}
    assert len(clean) - len(single) == 8
    cut = {i: left for i, (_, _, left) in zip(single, brute_cut(list(single.values())), strict=True)}
    assert [i for i in cut if len(cut[i].split()) < len(single[i].split())] == [72, 73, 75, 76]
    last = {i: t for i, t in cut.items() if not brute_hits(t, items)[1]}
    assert sorted(set(cut) - set(last)) == [74, 77]

    tokenizer = packing._encoder(tokenizer_json()).tokenizer
    found, sequences = {}, {}
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        found.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    assert sorted(found) == sorted(last)
    for i, own in found.items():
        ids = np.array([*tokenizer.encode(last[i], add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + p.length].tobytes())), i
            at += p.length
        assert at == len(ids)
    for own in sequences.values():
        ends = np.cumsum([0, *(p.length for p in sorted(own, key=lambda p: p.offset))]).tolist()
        assert sorted(p.offset for p in own) == ends[:-1] and ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0
