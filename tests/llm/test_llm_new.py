"""Vector codes, conversation repair and the set join: brute force and odd inputs."""

import hashlib
import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martweave.llm import chat, codes, decontaminate, langid, licenses, near, packing, repair, set_join, substrings, toxicity, url_filter
from martweave.llm.queries import tokenizer_json
from martweave.llm.words import ship

VECTORS = "vec_id bigint, embedding array<double>, label int, code string"


def plain_codes(ids, vectors, labels):
    """Product codes in Python integers; rows in the order of ids."""
    whole = [[codes.SCALE * a // b for a, b in (x.as_integer_ratio() for x in v)] for v in vectors]
    width = len(whole[0]) // 8
    parts = [[row[p * width : (p + 1) * width] for row in whole] for p in range(8)]
    books = [[list(v) for v in own[:16]] for own in parts]

    def nearest(p):
        return [min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), i) for i, e in enumerate(books[p])) for v in parts[p]]

    for _ in range(6):
        for p in range(8):
            own = nearest(p)
            for i in range(len(books[p])):
                mine = [v for v, (_, e) in zip(parts[p], own, strict=True) if e == i]
                if mine:
                    books[p][i] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    found = [nearest(p) for p in range(8)]
    error = [sum(f[r][0] for f in found) for r in range(len(ids))]
    total = Counter()
    for label, e in zip(labels, error, strict=True):
        total[label] += e
    text = ",".join(str(x) for book in books for e in book for x in e)
    rows = [(i, "".join(f"{f[r][1]:02x}" for f in found), error[r], total[labels[r]]) for r, i in enumerate(ids)]
    return rows, hashlib.sha256(text.encode()).hexdigest()


def coded(frame):
    out, books = codes.compress(frame)
    rows = codes.with_label_errors(out).select("vec_id", "code", "error", "label_error").collect()
    return sorted(map(tuple, rows), key=repr), codes.digest(books) if books.size else None


@pytest.mark.parametrize(("n", "scale"), [(5, 1.0), (300, 1.0), (60, 1e-4), (80, 1e7), (80, 1e30)])
def test_codes_equal_plain_integers(spark, n, scale):
    """Few rows, ties, and components far beyond what squares of 64 bits hold."""
    rng = np.random.default_rng(n)
    vectors = (rng.standard_normal((n, 16)) * scale).tolist()
    vectors[-1] = vectors[0]
    labels = [None if i % 3 == 0 else i % 3 for i in range(n)]
    rows = spark.createDataFrame([(i, v, y, "x") for i, (v, y) in enumerate(zip(vectors, labels, strict=True))], VECTORS)
    expected, books = plain_codes(range(n), vectors, labels)
    fits = [(i, c, *(e if e < 2**63 else None for e in rest)) for i, c, *rest in expected]
    found, digest = coded(rows.repartition(5))
    assert digest == books
    assert found == sorted(fits, key=repr)


def test_codes_of_odd_rows(spark):
    good = [0.5] * 8
    rows = [(3, good, 1, ""), (3, good, 1, ""), (None, good, None, ""), (4, None, 1, ""), (5, [*good[:7], None], 1, ""), (6, [*good[:7], float("nan")], 1, ""), (7, [*good[:7], float("inf")], 1, "")]
    found, _ = coded(spark.createDataFrame(rows, VECTORS))
    assert found == sorted([(3, "00" * 8, 0, 0), (3, "00" * 8, 0, 0), (None, "00" * 8, 0, 0)], key=repr)
    assert coded(spark.createDataFrame(rows[3:], VECTORS)) == ([], None)
    assert coded(spark.createDataFrame([], VECTORS)) == ([], None)
    for bad in ([0.5] * 9, [0.5] * 16):
        with pytest.raises(ValueError, match="equal parts"):
            codes.compress(spark.createDataFrame([(1, good, 1, ""), (2, bad, 1, "")], VECTORS))


def test_bounds_spare_distances_and_ties_go_to_the_lower_entry():
    rng = np.random.default_rng(1)
    centres = rng.integers(-9000, 9000, (16, 8))
    parts = np.concatenate([centres + rng.integers(-50, 50, (16, 8)) for _ in range(20)])
    entries = np.concatenate([centres[:15], centres[:1]])
    far = codes.pivot_distances(parts, entries[:4])
    code, least, tried = codes.assign(parts, far, entries, entries[:4])
    every = ((parts[:, None] - entries[None]) ** 2).sum(axis=-1)
    assert (code == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all()
    assert tried < 0.3 * every.size


def test_labels_too_many_to_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(i, [float(i)] * 8, i % 3 or None, "") for i in range(50)], VECTORS)
    expected = coded(rows)
    monkeypatch.setattr(codes, "broadcast_if_small", lambda df: df)
    assert coded(rows) == expected


TURNS = "conv_id bigint, turn bigint, role string, text string, audit string"


def plain_repair(rows):
    """Counts, cost, audit and hash of (turn, role, text) rows in order, by trying all edits."""
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(repair.BLANKS)
        fault = "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    named = {"u": "user", "a": "assistant"}
    ways = {"": (0, "", ())}

    def put(into, state, way):
        if state not in into or way < into[state]:
            into[state] = way

    def inserted(ways):
        ways = dict(ways)
        for _ in range(4):
            for state, (cost, audit, lines) in list(ways.items()):
                put(ways, after[state], (cost + 2, audit + "I", (*lines, named[after[state]] + ":")))
        return ways

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for state, (cost, audit, lines) in inserted(ways).items():
            put(new, state, (cost + 3, audit + "D", lines))
            if fault not in ("b", "d"):
                more = int(fault == "t")
                if role[:1] == after[state] or (state == "" and role[:1] == "s"):
                    put(new, role[:1], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                put(new, after[state], (cost + 2 + more, audit + "R", (*lines, f"{named[after[state]]}:{text}")))
        ways = new
    cost, audit, lines = min(way for state, way in inserted(ways).items() if state in ("", "a"))
    counts = Counter(faults)
    return gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_repair_equals_all_edits(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(400):
        for turn in sorted(rng.sample(range(30), rng.randint(1, 14))):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User"])
            rows.append((conv, turn, role, rng.choice(["Yes.", "No", "", " \t", f"Same{turn}!", "Well? ", "é…"]), "x"))
    # One row of runs beyond a segment, with changes of role and fault.
    long = [("user", "A.") if i % 9000 < 4500 else ("assistant", f"{i}") for i in range(20_000)]
    rows += [(400, i, role, text, "x") for i, (role, text) in enumerate(long)]
    found = {r[0]: tuple(r)[1:] for r in repair.repair(spark.createDataFrame(rows, TURNS)).collect()}
    own = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        own[conv].append((turn, role, text))
    short = {c: plain_repair(r) for c, r in own.items() if c < 400}
    assert {c: found[c] for c in short} == short
    assert found[400][5] == len(found[400][6].replace("I", "").replace("K", "").replace("R", "")) * 3 + 2 * found[400][6].count("I") + 2 * found[400][
        6
    ].count("R") + sum(1 for e, (_, t) in zip(found[400][6].replace("I", ""), long, strict=True) if e != "D" and t != "A.")


def test_powers_of_runs_equal_single_steps():
    rng = random.Random(2)
    for _ in range(200):
        symbols = [s for s in (rng.randrange(12) for _ in range(6)) for _ in range(rng.choice([1, 1, 2, 5]))]
        runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
        assert repair.repair_runs(runs) == repair.repair_runs([(s, 1) for s in symbols])
    # Users only: every second one gets the other role. No table by steps could hold so many.
    assert repair._before(6, 10**12, repair._at_end())[0] == 10**12


def test_repair_of_odd_rows(spark):
    rows = [
        (1, None, None, None, ""),
        (1, 0, "user", "Hi.", ""),
        (1, 0, "user", "Hi.", ""),
        (1, 0, "assistant", "Ho.", ""),
        (None, 3, "assistant", "Ho.", ""),
        (2, None, "user", "x", ""),
    ]
    found = {r[0]: tuple(r)[1:] for r in repair.repair(spark.createDataFrame(rows, TURNS)).collect()}
    assert found[1] == plain_repair([(None, " ", " "), (0, "assistant", "Ho."), (0, "user", "Hi."), (0, "user", "Hi.")])
    assert found[None] == plain_repair([(3, "assistant", "Ho.")])
    assert found[2] == plain_repair([(None, "user", "x")])
    none = spark.createDataFrame([], TURNS)
    assert repair.repair(none).count() == 0
    gone = repair.repair(none, spark.createDataFrame(rows, TURNS)).collect()
    assert sorted((tuple(r) for r in gone), key=repr) == sorted([(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in (1, 2, None)], key=repr)
    long = spark.createDataFrame([(1, 1, "user", "word " * 400_000 + ".", ""), (1, 2, "assistant", "x" * 3_000_000, "")], TURNS)
    assert [r.audit for r in repair.repair(long).collect()] == ["KK"]


def test_damage(spark):
    rows = [(c, t, r, "A. b! c?", "") for c in (1, 2, None) for t in [*range(60), None] for r in ("assistant", None)]


    expected = []
    for conv, turn, role, text, _ in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role = "user" if fate == 4 else " " if role is None else role
        text = {1: "", 2: "A b c"}.get(fate, text)
        expected += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    assert Counter(map(tuple, repair.damaged(spark.createDataFrame(rows, TURNS)).collect())) == Counter(expected)


DOCS = "doc_id bigint, text string, component_id string, n bigint"


def plain_sets(rows):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text, *_ in rows:
        words = [w for w in "".join(" " if c in repair.BLANKS else c for c in (text or "").translate(upper)).split(" ") if w]
        sets.append({tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set())
    label = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.combinations(range(len(rows)), 2):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 85 * len(sets[i] | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
        break
    least = {}
    for x, (doc_id, *_) in zip(label, rows, strict=True):
        known = least.get(x)
        least[x] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return Counter((row[0], len(s), least[x]) for row, s, x in zip(rows, sets, label, strict=True))


def joined(spark, rows):
    return Counter(map(tuple, set_join.set_join(spark.createDataFrame(rows, DOCS).repartition(4)).collect()))


@pytest.mark.parametrize("small", [False, True])
def test_set_join_equals_all_pairs(spark, monkeypatch, small):
    """Chains of edits around the threshold, one passage in many documents; ``small`` sizes run every way of comparing."""
    if small:
        for name, value in {"_MEMBERS": 2, "_LOT": 3, "_FEW": 3, "_BLOCK": 2, "_PIECE_TOKENS": 300}.items():
            monkeypatch.setattr(set_join, name, value)
    rng = random.Random(8)
    letters = "abcdefghijklmnop"

    def text(n):
        return ["".join(rng.choices(letters, k=4)) for _ in range(n)]

    passage, rows = text(40), []
    for family in range(8):
        base = text(60)
        for _ in range(8):
            base = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                base[rng.randrange(len(base))] = rng.choice(letters)
            rows.append((100 * family + len(rows), " ".join(base).upper() if rng.random() < 0.3 else "  ".join(base), "x", 1))
    # Mostly one passage, but each pair below or about the threshold.
    rows += [(2000 + i, " ".join(passage + text(rng.choice([2, 4, 6, 9]))), "x", 1) for i in range(40)]
    rng.shuffle(rows)
    assert joined(spark, rows) == plain_sets(rows)


def test_set_join_of_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(30))
    rows = [(1, base, "", 1), (1, base, "", 1), (2, base, "", 1), (None, base + " tail", "", 1), (None, None, "", 1), (3, None, "", 1), (4, "", "", 1), (5, " \t", "", 1)]
    rows += [(6, "Three short words", "", 1), (7, "three  short words", "", 1), (8, "three short", "", 1), (None, "alone here", "", 1), (9, "a a a a a a a", "", 1), (10, "a a a a", "", 1)]
    assert joined(spark, rows) == plain_sets(rows)
    assert joined(spark, []) == Counter()
    long = " ".join(f"w{i}" for i in range(300_000))
    found = joined(spark, [(1, long, "", 1), (2, long + " more", "", 1), (3, "w1 w2 w3 w4 w5", "", 1)])
    assert found == Counter({(1, 299_997, 1): 1, (2, 299_998, 1): 1, (3, 2, 3): 1})


def test_many_copies_are_one_set(spark):
    near = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(" ".join(f"w{i}" for i in range(60))), F.when(F.col("id") % 2 == 0, F.concat(F.lit(" x"), F.col("id"))).otherwise("")).alias("text"))
    rows = set_join.set_join(near).collect()
    assert len(rows) == 3000 and {r.component_id for r in rows} == {0}


def test_thinned_links_connect_alike():
    links = np.array([[5, 9], [9, 11], [5, 11], [2, 3]])
    assert set_join._thinned(links).tolist() == [[5, 9], [9, 11], [2, 3]]
    assert set_join._shared(np.array([1, 2], np.uint64), np.array([0, 1]), np.array([1, 1], np.uint64), np.array([0, 1])).tolist() == [True, False]


def test_blocks_link_no_ends_that_are_connected():
    links = np.array([[5, 9], [9, 11], [5, 11], [2, 3]])
    assert set_join._thinned(links, np.array([[5, 5], [5, 11], [5, 11], [2, 3]])).tolist() == [[9, 11], [2, 3]]


def test_wide_windows_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="at most 71"):
        substrings.remove_repeats(docs, window=72)


def test_text_ids_and_models_of_nothing(spark):
    rows = [(f"d{i}", f"calm words {i} here" if i % 2 else f"you idiot {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(d, 1, int("idiot" in t)) for d, t in rows], "doc_id string, quality int, toxic int")
    found = {r.doc_id: r["_toxic"] for r in toxicity.classify(docs, labels).collect()}
    assert sum(found[d] == int("idiot" in t) for d, t in rows) > 55
    assert langid.fit([]).languages == ()


def test_templates_without_mandatory_words(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id bigint, text string")
    found = licenses.scan_licenses(docs, templates=[("free", "<<opt>>some<</opt>> <<var 0-2>>")]).select("doc_id", "_license.n_words").collect()
    assert sorted(map(tuple, found)) == [(1, 2), (2, 0)]


def test_megabytes_in_one_row_go_through_every_text_operator(spark):
    """One text of four megabytes, without and with line breaks, beside its copy and short ones."""
    long = " ".join(f"word{i % 9973} Idiot{i}" for i in range(250_000))
    rows = [(1, long), (2, long), (3, "word1 idiot1 cc by 4 0"), (4, "x" * 3_000_000), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert toxicity.classify(docs, labels).count() == 5
    scanned = {r.doc_id: r["_license"].n_words for r in licenses.scan_licenses(docs).collect()}
    assert scanned == {1: 500_000, 2: 500_000, 3: 6, 4: 1, 5: 0}
    pieces = packing.pack(docs, tokenizer_json()).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert len(pieces) == 5 and all(r.n == r["all"] for r in pieces)
    items = spark.createDataFrame([(1, " ".join(long.split(" ")[499_900:499_912]))], "item_id bigint, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.decontaminate(docs, items).collect()} == {1: 12, 2: 12, 3: 0, 4: 0, 5: 0}
    cut = {r.doc_id: (r["_n_words"], r["_n_removed"]) for r in substrings.remove_repeats(docs).collect()}
    assert cut == {1: (500_000, 500_000), 2: (500_000, 500_000), 3: (6, 0), 4: (1, 0), 5: (0, 0)}
    assert {r.doc_id: r.class_id for r in near.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    model = langid.fit(langid.training_counts(docs.withColumn("lang", F.lit("en"))))
    assert {r.doc_id: r["_lang"] for r in langid.identify(docs, model).collect()} == {1: "en", 2: "en", 3: "en", 4: "en", 5: "und"}
    turns = docs.select(F.lit(1).cast("bigint").alias("conv_id"), F.col("doc_id").alias("turn"), F.lit("assistant").alias("role"), "text")
    (row,) = chat.digest_conversations(chat.format_turns(turns)).collect()
    assert row.loss_chars == sum(len(t or "") for _, t in rows)


def test_repeated_rows_and_nulls_of_urls(spark):
    urls = ["https://Spam-Casino.example/x", None, "", "no scheme", "http://a.com/en/" + "y" * 2_000_000]
    pages = spark.createDataFrame([(i % 5, urls[i % 5], "mine") for i in range(10)], "page_id bigint, url string, host string")
    found = url_filter.filter_urls(pages, (("allow", "com", "/"),)).collect()
    assert len(found) == 10
    assert Counter((r.page_id, r["_url"]["verdict"]) for r in found).most_common(1)[0][1] == 2
    assert all(n == 2 for n in Counter((r.page_id, r["_url"]["host"], r["_url"]["verdict"]) for r in found).values())


def test_a_preamble_of_all_items_meets_no_more_places_than_hits(spark):
    """A thousand items begin alike with eight words; documents hold the preamble, two of them a whole item."""
    preamble = "which of the following statements is always true"
    items = [(i, f"{preamble} a{i} b{i} c{i} d{i} e{i}") for i in range(1000)]
    docs = [(i, f"x{i} y{i} {preamble} z{i} w{i} v{i} u{i}") for i in range(300)] + [(1000, f"so {items[17][1]} then"), (1001, items[18][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    windows = decontaminate.benchmark_windows(spark.createDataFrame(items, "item_id bigint, text string"))
    found = decontaminate.document_hits(frame, windows).select("doc_id", F.inline("hits"))
    named = windows.withColumn("window_id", F.xxhash64("hash", "len", "around"))
    distinct = named.select("window_id", "hash", "len", F.col("around").alias("item_around")).dropDuplicates(["window_id"])
    met = decontaminate._by_window(found, "around").join(decontaminate._by_window(distinct, "item_around"), ["hash", "len", "window"])
    assert found.join(distinct, ["hash", "len"]).count() > 50_000
    assert {r.doc_id for r in met.select("doc_id").distinct().collect()} == {1000, 1001} and met.count() < 200
    hit = {r.doc_id: (r.n_hit, r.item_ids) for r in decontaminate.decontaminate(frame, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert {d: h for d, h in hit.items() if h[0]} == {1000: (13, ["17"]), 1001: (13, ["18"])}


def test_ranges_merge_without_an_object_per_stretch():
    """Repeats of 10,000 texts, 40 a text: 16 bytes each in arrays, several hundred as Python objects."""
    rng = np.random.default_rng(3)
    n_texts, per_text = 10_000, 40
    start = np.cumsum(rng.integers(1, 60, (n_texts, per_text)), axis=1).astype(np.int32)
    n = np.minimum(np.diff(start, append=start[:, -1:] + 9), rng.integers(1, 29, start.shape)).astype(np.int32)
    part = rng.integers(0, 4, start.size) == 0
    windows = pa.array(rng.integers(0, 2, start.size) * 5, pa.int64(), mask=~part)
    stretches = pa.StructArray.from_arrays([pa.array(start.ravel()), pa.array(n.ravel()), windows], ["start", "n", "windows"])
    found = pa.ListArray.from_arrays(pa.array(np.arange(n_texts + 1, dtype=np.int32) * per_text), stretches)
    batch = pa.RecordBatch.from_arrays([found], ["found"])
    tracemalloc.start()
    merged = [substrings._merged(p.column("found"), 35) for p in substrings._bounded(batch, "found")]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000
    spans = pa.chunked_array(merged)
    assert len(spans) == n_texts
    for i in range(0, n_texts, 97):
        covered = set()
        for s in found[i].as_py():
            for at in range(s["n"]):
                if s["windows"] is None or s["windows"] >> at & 1:
                    covered.update(range(s["start"] + at, s["start"] + at + 35))
        assert sorted(covered) == [w for s in spans[i].as_py() for w in range(s["start"], s["end"])]


def test_batches_of_texts_are_small(spark):
    """A batch stands in the executor and in its worker at once."""
    docs = spark.range(0, 6_000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("words "), 500).alias("text"))
    ship(spark)
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n bigint").toArrow()["n"].to_pylist()
    assert sum(sizes) > 18_000_000 and max(sizes) < 6_000_000
