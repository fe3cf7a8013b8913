"""Languages of mixed texts: script ranges narrow the candidates, Viterbi labels the words.

Each word gets a score per language from its hashed byte n-grams (naive Bayes, fitted on a bounded
sample). Languages that do not use the word's script drop out. The best path over all words of a
text, with a penalty for each switch, labels its spans; the language of most letters is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.llm.words import Words, map_texts, mixed, pieces, ship, split_words

SAMPLE_ROWS = 8_000
SWITCH_PENALTY = 6.0
_FOLDS, _TEST_FOLD = 4, 2
_BITS = 15
_GRAMS = (1, 2, 3, 4)
_CLIP = 4.0

#: Letters: ASCII ones and every byte beyond ASCII, so that a word is a run of them.
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True

#: Scripts by the first byte of a UTF-8 sequence.
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana_han", "hangul", "other")
_SCRIPT_OF = np.full(256, 255, np.uint8)
for _script, _first, _last in (
    (0, 0x41, 0x5A), (0, 0x61, 0x7A), (0, 0xC3, 0xC9), (1, 0xCD, 0xCF), (2, 0xD0, 0xD4), (3, 0xD6, 0xD7),
    (4, 0xD8, 0xDD), (5, 0xE0, 0xE0), (6, 0xE3, 0xE9), (7, 0xEA, 0xED), (8, 0xE1, 0xE1), (8, 0xF0, 0xF4),
):
    _SCRIPT_OF[_first : _last + 1] = _script


@dataclass(frozen=True)
class LanguageModel:
    """``tables[g]``: log probability by language and hashed n-gram; ``scripts``: which language uses which script."""

    languages: tuple[str, ...]
    tables: tuple[np.ndarray, ...]
    scripts: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Rows no model may learn from: crc32 of the id as text, modulo 4, is 2. NULL ids are held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % _FOLDS == _TEST_FOLD, F.lit(True))


def _has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)


def _gram_ids(words: Words) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n, the hashed n-gram that ends at each byte, words lower-cased and led by a blank; and each byte's word."""
    raw = np.frombuffer(words.data, np.uint8).copy()
    upper = (raw >= 65) & (raw <= 90)
    raw[upper] += 32
    sizes = words.ends - words.starts
    word = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.cumsum(sizes) - sizes
    at = np.arange(len(word)) - np.repeat(begin, sizes)
    letters = raw[np.repeat(words.starts, sizes) + at].astype(np.uint64)
    out, key = [], np.zeros(len(word), np.uint64)
    for n in range(1, max(_GRAMS) + 1):
        byte = np.zeros(len(word), np.uint64)
        if n == 1:
            byte = letters
        else:
            byte[n - 1 :] = letters[: len(letters) - n + 1]
            byte[at == n - 2] = 32
            byte[at < n - 2] = 0
        key = key | (byte << np.uint64(8 * (n - 1)))
        if n in _GRAMS:
            out.append((mixed(key, n) >> np.uint64(64 - _BITS)).astype(np.int64))
    return out, word


def training_counts(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """N-gram and script counts by language over at most ``sample_rows`` training texts.

    The sample is the texts whose ids have the smallest hashes. Counts are summed in tasks; only
    the model's tables, whose size is fixed, reach the driver.
    """
    ship(docs.sparkSession)
    bound = (
        docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
        .select(F.xxhash64("doc_id").alias("key"))
        .orderBy("key")
        .limit(sample_rows)
        .agg(F.max("key"))
        .first()[0]
    )
    if bound is None:
        return []
    sample = (
        docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & (F.xxhash64("doc_id") <= bound))
        .select("doc_id", "lang", "text")
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
        .limit(sample_rows)
        .select("lang", "text")
        .repartition(8)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in pieces(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            words = split_words(batch.column("text"), _LETTERS, True)
            grams, word = _gram_ids(words)
            doc = words.doc_of()[word]
            scripts = _SCRIPT_OF[np.frombuffer(words.data, np.uint8)]
            where = np.searchsorted(words.doc_bytes, np.arange(len(scripts)), side="right") - 1
            for lang in sorted(set(langs)):
                mine = (langs == lang)[doc]
                for g, ids in enumerate(grams):
                    found = np.bincount(ids[mine], minlength=1 << _BITS)
                    sums[lang, g] = sums.get((lang, g), 0) + found
                used = scripts[(langs == lang)[where] & (scripts < 255)]
                sums[lang, -1] = sums.get((lang, -1), 0) + np.bincount(used, minlength=len(SCRIPTS))
        keys = sorted(sums)
        values = [sums[k].astype(np.int64) for k in keys]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(values, pa.list_(pa.int64()))],
            ["lang", "part", "counts"],
        )

    return sample.mapInArrow(run, "lang string, part int, counts array<bigint>").toArrow().to_pylist()


def fit(counts: list[dict]) -> LanguageModel:
    sums: dict[tuple[str, int], np.ndarray] = {}
    for row in counts:
        key = row["lang"], row["part"]
        sums[key] = sums.get(key, 0) + np.array(row["counts"], float)
    languages = tuple(sorted({lang for lang, _ in sums}))
    tables = []
    for g in range(len(_GRAMS)):
        seen = np.array([sums.get((lang, g), np.zeros(1 << _BITS)) for lang in languages]).reshape(len(languages), 1 << _BITS)
        log_p = np.log((seen + 0.5) / (seen.sum(axis=1, keepdims=True) + 0.5 * (1 << _BITS)))
        # Only differences between languages matter; one odd n-gram must not decide a word.
        middle = log_p.mean(axis=0) if languages else 0.0
        tables.append(np.clip(log_p - middle, -_CLIP, _CLIP).astype(np.float32))
    scripts = np.array([sums.get((lang, -1), np.zeros(len(SCRIPTS))) for lang in languages]).reshape(len(languages), len(SCRIPTS))
    return LanguageModel(languages, tuple(tables), scripts > 0.01 * scripts.sum(axis=1, keepdims=True))


def word_scores(words: Words, model: LanguageModel) -> np.ndarray:
    """Score of each word in each language; languages that do not write the word's script get the lowest."""
    grams, word = _gram_ids(words)
    begin = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    out = np.zeros((len(words.hashes), len(model.languages)), np.float32)
    raw_scripts = _SCRIPT_OF[np.frombuffer(words.data, np.uint8)]
    kind = raw_scripts[words.starts] if len(words.starts) else np.zeros(0, np.uint8)
    allowed = np.concatenate([model.scripts, np.zeros((len(model.languages), 256 - len(SCRIPTS)), bool)], axis=1)[:, kind].T
    any_allowed = allowed.any(axis=1)
    for j in range(len(model.languages)):
        total = np.zeros(len(word) + 1)
        by_byte = np.zeros(len(word), np.float32)
        for table, ids in zip(model.tables, grams, strict=True):
            by_byte += table[j][ids]
        np.cumsum(by_byte, out=total[1:])
        out[:, j] = total[begin[1:]] - total[begin[:-1]]
        out[any_allowed & ~allowed[:, j], j] = -1e6
    return out


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Viterbi over the words of many texts in step: the language of each word.

    Texts are ordered by length, so step t handles those with more than t words as one array.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    starts, sizes = first[:-1][order], counts[order]
    n, k = len(scores), scores.shape[1]
    stay = np.zeros((n, k), bool)
    best = np.zeros(n, np.int16)
    labels = np.zeros(n, np.int16)
    if not n:
        return labels
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")
    value = np.zeros((len(sizes), k))
    rows = np.arange(len(sizes))
    for t in range(int(sizes[0])):
        a = active[t]
        at = starts[:a] + t
        v = value[:a]
        if t:
            top = v.argmax(axis=1)
            best[at] = top
            switched = v[rows[:a], top][:, None] - penalty
            stay[at] = v >= switched
            np.maximum(v, switched, out=v)
        v += scores[at]
    label = value.argmax(axis=1).astype(np.int16)
    for t in range(int(sizes[0]) - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        labels[at] = label[:a]
        if t:
            here = label[:a]
            label[:a] = np.where(stay[at, here], here, best[at])
    return labels


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] | None = None, with_spans: bool = False) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with ``_lang``, ``_lang_score`` and, if asked for, ``_lang_spans``.

    Spans are (language, first word, words), in words of letters. The score is the share of the
    text's letter bytes in its language. ``und`` with score 0 for NULL, for texts without a letter
    and for a model without languages; ties go to the first language by name.
    """
    added = {"_lang": T.StringType(), "_lang_score": T.DoubleType()}
    if with_spans:
        added["_lang_spans"] = T.StructType.fromDDL("v array<struct<lang:string,start:bigint,words:bigint>>")[0].dataType
    languages, k = model.languages, len(model.languages)

    def label(texts: pa.Array) -> list[pa.Array]:
        n = len(texts)
        has_letter = _has_letter(texts)
        if not k:
            langs, shares, spans = ["und"] * n, [0.0] * n, [[]] * n
        else:
            words = split_words(texts, _LETTERS, True)
            path = best_path(word_scores(words, model), words.first)
            sizes = words.ends - words.starts
            mass = np.bincount(words.doc_of() * k + path, sizes, minlength=n * k).reshape(n, k)
            top, total = mass.argmax(axis=1), mass.sum(axis=1)
            found = has_letter & (total > 0)
            langs = [languages[i] if ok else "und" for i, ok in zip(top.tolist(), found.tolist(), strict=True)]
            shares = np.where(found, mass[np.arange(n), top] / np.maximum(total, 1), 0.0)
            spans = [_runs(path[a:b], languages) for a, b in zip(words.first, words.first[1:], strict=False)] if with_spans else []
        out = [pa.array(langs, pa.string()), pa.array(shares, pa.float64())]
        if with_spans:
            span = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("words", pa.int64())])
            out.append(pa.array(spans, pa.list_(span)))
        return out

    return map_texts(docs, label, added, keep)


def _runs(path: np.ndarray, languages: Sequence[str]) -> list[dict]:
    edges = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    return [{"lang": languages[path[a]], "start": a, "words": b - a} for a, b in zip(edges, edges[1:], strict=False) if b > a]
