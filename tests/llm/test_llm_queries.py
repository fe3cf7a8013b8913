"""Registered training-text queries: against SQL where there is some, else against brute force and held-out labels."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martweave.llm import near
from martweave.llm.queries import QUERIES, URL_RULES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_equals_sql(spark, sf_dir, tables, name):
    run, sql = QUERIES[name]
    result = run(spark, sf_dir)
    found = tables.execute(sql)
    columns = [d[0] for d in found.description]
    assert sorted(result.columns) == sorted(columns)
    actual = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=repr)
    assert actual == sorted(found.fetchall(), key=repr)


def test_toxicity_on_held_out_rows(spark, sf_dir, tables):
    rows = {r.doc_id: r for r in QUERIES["op1_toxicity"][0](spark, sf_dir).collect()}
    labels = dict(tables.execute("SELECT doc_id, toxic FROM labels").fetchall())
    assert len(rows) == tables.execute("SELECT count(*) FROM documents").fetchall()[0][0]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    seen = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    hit = sum(p and y for p, y in seen)
    assert hit / sum(p for p, _ in seen) > 0.9
    assert hit / sum(y for _, y in seen) > 0.5


def test_language_on_held_out_rows(spark, sf_dir, tables):
    rows = QUERIES["op7_language"][0](spark, sf_dir).collect()
    langs = dict(tables.execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.97


def test_packing_is_an_exact_round_trip(spark, sf_dir, tables):
    pieces = QUERIES["op3_packing"][0](spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    texts = dict(tables.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0


def test_near_duplicates_equal_all_pairs(spark, sf_dir, tables):
    """Classes by comparing all pairs of texts that share a shingle, with the weighted Jaccard similarity."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r for r in QUERIES["op6_near_duplicates"][0](spark, sf_dir).collect()}
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    frequency = Counter()
    bags = {}
    for i, text in texts.items():
        words = WORD.findall(lowered(text))
        n = min(5, len(words))
        bags[i] = Counter(" ".join(words[p : p + n]) for p in range(len(words) - n + 1)) if n else Counter()
        frequency.update(bags[i].keys())
    weight = {s: 1 + math.log(min((len(texts) + 1) / (f + 1), 8)) for s, f in frequency.items()}
    holders = defaultdict(list)
    for i, bag in bags.items():
        for s in bag:
            holders[s].append(i)
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    totals = {i: sum(n * weight[s] for s, n in bag.items()) for i, bag in bags.items()}
    for a, b in pairs:
        common = sum(min(n, bags[b][s]) * weight[s] for s, n in bags[a].items() if s in bags[b])
        if common >= 0.8 * (totals[a] + totals[b] - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert {i: r.class_id for i, r in rows.items()} == {i: find(i) for i in texts}
    assert sorted(i for i, r in rows.items() if r.stays) == sorted({find(i) for i in texts})
    assert near.idf_table(docs).min() >= 1


def test_neighbours_against_brute_force(spark, sf_dir, tables):
    rows = QUERIES["op8_neighbours"][0](spark, sf_dir).collect()
    ids, vectors = zip(*tables.execute("SELECT vec_id, embedding FROM embeddings").fetchall(), strict=True)
    ids, vectors = np.array(ids), np.array(vectors, float)
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        found[r.query_id].append(r)
    asked = ids[ids % 100 == 0]
    assert set(found) == set(asked.tolist())
    hits = 0
    for q in asked:
        far = np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(axis=1))
        own = found[int(q)]
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert all(abs(r.score - far[ids == r.vec_id][0]) < 1e-12 for r in own)
        best = ids[np.lexsort((ids, np.where(ids == q, np.inf, far)))[:10]]
        hits += len({r.vec_id for r in own} & set(best.tolist()))
    assert hits / (10 * len(asked)) >= 0.9


def test_urls_against_plain_rules(spark, sf_dir, tables):
    rows = {r.page_id: r for r in QUERIES["op9_urls"][0](spark, sf_dir).collect()}
    judged = Counter()
    for page_id, url in tables.execute("SELECT page_id, url FROM pages").fetchall():
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = lowered(host)
        fits = [(len(h + p), h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        r = rows[page_id]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        if fits:
            assert r.verdict == max(fits)[2]
        else:
            judged[bool(re.search("casino|bets|pills|ads-track|adult|spam", host)), r.verdict] += 1
    assert judged[True, "block"] > 3 * judged[True, "allow"]
    assert judged[False, "allow"] > 50 * judged[False, "block"]


def test_conversation_minus_seven(spark, sf_dir):
    (row,) = QUERIES["op10_chat"][0](spark, sf_dir).where("conv_id = -7").collect()
    text = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())
