"""Registered queries: each operator over its whole table, with the SQL it must equal where SQL can say it."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.llm import ann, chat, codes, decontaminate, langid, licenses, near, packing, repair, set_join, substrings, toxicity, url_filter
from martweave.llm.oracles import CODES_SQL, REPAIR_SQL, SET_JOIN_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.classify(docs, _table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), F.col("_toxic").alias("predicted"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return found.select("doc_id", *(F.col(f"_license.{n}").alias(n) for n in names))


def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file, read on the driver and sent along."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text()


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_json())


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"], with_text=False)
    return cut.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_kept_sha256").alias("kept_sha256"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "class_size", "stays")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(langid.training_counts(docs))
    found = langid.identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_lang_score").alias("score"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", *(F.col(f"_url.{n}").alias(n) for n in ("host", "path", "rule", "verdict")))


_PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(_PROBE, "conv_id bigint, turn bigint, role string, text string")
    return chat.digest_conversations(chat.format_turns(turns.unionByName(probe)))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(_table(spark, sf_dir, "embeddings"))
    found = codes.with_label_errors(coded)
    return found.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(turns), turns)


def op13_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.set_join(_table(spark, sf_dir, "documents").select("doc_id", "text"))


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LICENSE_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS words FROM documents),
t AS (
    SELECT doc_id, len(words) AS n_words, words, ' ' || array_to_string(words, ' ') || ' ' AS line FROM w
),
p AS (
    SELECT *,
        list_filter(range(1, n_words), lambda i: words[i] = 'cc' AND words[i + 1] = 'by') AS cc,
        list_filter(range(1, n_words - 1), lambda i: words[i] = 'general' AND words[i + 1] = 'public' AND words[i + 2] = 'license') AS gpl,
        list_filter(range(1, n_words - 1), lambda i: words[i] = 'all' AND words[i + 1] = 'rights' AND words[i + 2] = 'reserved') AS reserved
    FROM t
),
l AS (
    SELECT *, list_concat(cc, gpl, reserved) AS places, [
        CASE WHEN len(cc) > 0 THEN {{'l': 'cc-by', 's': 2.0 / 4}} END,
        CASE WHEN len(gpl) > 0 THEN {{'l': 'gpl', 's': 3.0 / 5}} END,
        CASE WHEN len(reserved) > 0 THEN {{'l': 'reserved', 's': 3.0 / 5}} END] AS base,
    [
        CASE WHEN regexp_matches(line, ' licensed under the apache license (as published by the apache software foundation )?version 2 0 ') THEN {{'l': 'apache-2.0', 's': 8.0 / 10}} END,
        CASE WHEN regexp_matches(line, ' released under the (terms of the )?mit license ') THEN {{'l': 'mit', 's': 5.0 / 7}} END,
        CASE WHEN regexp_matches(line, ' permission is hereby granted free of charge to any person obtaining a copy of ([^ ]+ ){{1,4}}and associated documentation files ') THEN {{'l': 'mit', 's': 18.0 / 20}} END,
        CASE WHEN regexp_matches(line, ' this ([^ ]+ ){{1,4}}is licensed under the gnu general public license (as published by the free software foundation )?version 3 ') THEN {{'l': 'gpl-3.0', 's': 11.0 / 13}} END,
        CASE WHEN regexp_matches(line, ' licensed under (the )?cc by nc (license )?4 0 ') THEN {{'l': 'cc-by-nc-4.0', 's': 7.0 / 9}} END,
        CASE WHEN regexp_matches(line, ' redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met ') THEN {{'l': 'bsd', 's': 20.0 / 22}} END,
        CASE WHEN regexp_matches(line, ' copyright ([^ ]+ ){{0,8}}all rights reserved ') THEN {{'l': 'copyright', 's': 4.0 / 6}} END
    ] AS full_texts
    FROM p
)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, (list_min(places) - 1)::BIGINT AS first_word,
    (list_max(places) - 1)::BIGINT AS last_word,
    coalesce(array_to_string(list_sort(list_distinct(list_transform(list_filter(base, lambda x: x IS NOT NULL), lambda x: x.l))), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_transform(list_filter(list_concat(base, full_texts), lambda x: x IS NOT NULL), lambda x: x.l))), ','), '') AS labels,
    coalesce(list_max(list_transform(list_filter(list_concat(base, full_texts), lambda x: x IS NOT NULL), lambda x: x.s::DOUBLE)), 0.0)::DOUBLE AS score
FROM l
"""

_CHAT_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
f AS (
    SELECT *, '<|turn|>' || replace(replace(replace(replace(role, '\', '\\'), '<', '\l'), '[', '\b'), chr(10), '\n') || chr(10)
        || replace(replace(replace(text, '\', '\\'), '<', '\l'), '[', '\b') || '<|end|>' || chr(10) AS formatted
    FROM t
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, formatted)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, formatted), '')) AS loss_sha256,
    sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

_DECONTAMINATION_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS words FROM benchmark),
iw AS (
    SELECT item_id, k, array_to_string(words[p : p + k - 1], ' ') AS w
    FROM (SELECT *, least(len(words), 10) AS k, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p FROM i WHERE len(words) > 0)
),
dw AS (
    SELECT r, k, p, array_to_string(words[p : p + k - 1], ' ') AS w
    FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(words) >= k)
),
hit AS (SELECT DISTINCT dw.r, dw.p, dw.k, iw.item_id FROM dw JOIN iw USING (k, w)),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(p, p + k)) AS place FROM hit) GROUP BY r),
listed AS (
    SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(listed.n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""

_SUBSTRING_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (
    SELECT r, p, md5(array_to_string(words[p : p + 34], ' ')) AS h
    FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS p FROM d WHERE len(words) >= 35)
),
again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
covered AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS place FROM w SEMI JOIN again USING (h)),
each AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM d),
kept AS (
    SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS line FROM each ANTI JOIN covered USING (r, place) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

QUERIES = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_licenses": (op2_licenses, _LICENSE_SQL),
    "op3_packing": (op3_packing, None),
    "op4_decontamination": (op4_decontamination, _DECONTAMINATION_SQL),
    "op5_substrings": (op5_substrings, _SUBSTRING_SQL),
    "op6_near_duplicates": (op6_near_duplicates, None),
    "op7_language": (op7_language, None),
    "op8_neighbours": (op8_neighbours, None),
    "op9_urls": (op9_urls, None),
    "op10_chat": (op10_chat, _CHAT_SQL),
    "op11_vector_codes": (op11_vector_codes, CODES_SQL),
    "op12_conversation_repair": (op12_conversation_repair, REPAIR_SQL),
    "op13_set_join": (op13_set_join, SET_JOIN_SQL),
}
