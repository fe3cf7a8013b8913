"""Toxicity by a counterfactually regularised classifier.

A logistic regression over the words of a text and the beginnings of its words, which endings leave
as they are; a beginning counts again where it is repeated. In a copy of each training text the
identity terms are swapped for others, or one is put in where there is none; the squared change of
the score is penalised, so that naming a group costs nothing by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.llm.linear import Sparse, fit_logistic, sigmoid
from martweave.llm.words import ALNUM, Words, beginnings, map_texts, mixed, pieces, ship, split_words
from martweave.session import parked, scratch_scope

#: Terms that name groups of people; swapping one for another must not change a score.
IDENTITY_TERMS = (
    "women men woman man girls boys gay straight lesbian bisexual transgender queer muslim muslims christian christians jewish jews "
    "hindu buddhist atheist black white asian latino african european american arab indian chinese mexican immigrant immigrants "
    "refugee refugees disabled deaf blind old young frauen männer juden muslime christen femmes hommes juifs musulmans mujeres hombres judíos"
).split()

SAMPLE_ROWS = 10_000
MAX_FEATURES = 4_096
MIN_TEXTS = 4
#: Letters of the beginnings of words that are features.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Salt of the feature that a beginning is there several times.
_SEVERAL = 100
_FOLDS = 3
_TEST_FOLD = 1


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by feature hash; a text's score is the logistic of their sum over its distinct features."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see: crc32 of the id as text, modulo 3, is 1. NULL ids are held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % _FOLDS == _TEST_FOLD, F.lit(True))


def _places(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Places and hashes of the words, then those of the beginnings of each length; whether repeats count."""
    yield np.arange(len(words.hashes)), words.hashes, False
    for at, own in beginnings(words, BEGINNINGS, True):
        yield at, own, True


def _feature_sets(texts: pa.Array) -> list[np.ndarray]:
    """Each text's features: words, beginnings of words, and beginnings that it repeats."""
    words = split_words(texts, ALNUM, True)
    doc_of = words.doc_of()
    docs, hashes = [], []
    for at, own, repeats in _places(words):
        order = np.lexsort((own, doc_of[at]))
        doc, own = doc_of[at][order], own[order]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
        docs.append(doc[new])
        hashes.append(own[new])
        if repeats:
            again = np.zeros(len(own), bool)
            again[1:] = ~new[1:] & new[:-1]
            docs.append(doc[again])
            hashes.append(mixed(own[again], _SEVERAL))
    doc, found = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((found, doc))
    return np.split(found[order], np.searchsorted(doc[order], np.arange(1, len(texts))))


def training_words(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Distinct features and label of at most ``sample_rows`` labelled training texts, kept in scratch.

    The sample is the labelled ids with the smallest hashes, so it is the same at every run and, up
    to the bound, holds all labelled rows. Contradicting labels of one id count as toxic.
    """
    ship(docs.sparkSession)
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [s.view(np.int64) for s in _feature_sets(batch.column("text"))]
            digests = [hashlib.sha256(s).digest() for s in sets]
            columns = [batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64())), batch.column("toxic").cast(pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "words", "toxic", "digest"])

    found = texts.mapInArrow(run, f"doc_id {dict(texts.dtypes)['doc_id']}, words array<bigint>, toxic int, digest binary")
    found = parked(found.withColumns({"name": F.xxhash64("words"), "row": F.monotonically_increasing_id()}), "training-words")
    # An id may stand in several rows; the bound holds for rows, whatever their number.
    first = found.select("row", "doc_id", "name").orderBy(F.xxhash64("doc_id"), "doc_id", "name").limit(sample_rows).select("row")
    return found.join(F.broadcast(first), "row", "left_semi")


class _Held:
    """Training rows (doc_id, words, toxic) in memory."""

    def __init__(self, rows: pa.Table) -> None:
        self.sets = [s.values.to_numpy().view(np.uint64) for s in rows["words"]]
        self.heads = rows.select(["doc_id", "toxic"]).append_column("digest", pa.array([hashlib.sha256(s).digest() for s in self.sets], pa.binary()))

    def strong(self, kept: np.ndarray, y: np.ndarray, excluded: np.ndarray, max_features: int) -> np.ndarray:
        sets = [self.sets[i] for i in kept]
        words, at, total = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        toxic = np.bincount(at, np.repeat(y, [len(s) for s in sets]), minlength=len(words))
        spread = _spread(words, total, toxic, y, excluded)
        strong = np.flatnonzero(spread > _by_chance(len(words)))
        return words[strong[np.argsort(-spread[strong], kind="stable")][:max_features]]

    def places(self, kept: np.ndarray, known: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(known, np.intersect1d(self.sets[i], known, assume_unique=True)) for i in kept]


class _Stored:
    """Training rows in scratch. Their features are counted and looked up by tasks; the driver sees ids, labels and chosen features."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows
        self.heads = rows.select("doc_id", "toxic", "digest", "row").orderBy(F.xxhash64("doc_id"), "doc_id", "name").toArrow()

    def _kept(self, kept: np.ndarray) -> DataFrame:
        places = pa.table({"row": self.heads["row"].take(pa.array(kept)), "place": pa.array(np.arange(len(kept)))})
        return self.rows.select("row", "words", "toxic").join(F.broadcast(self.rows.sparkSession.createDataFrame(places)), "row")

    def strong(self, kept: np.ndarray, y: np.ndarray, excluded: np.ndarray, max_features: int) -> np.ndarray:
        words = self._kept(kept).select("toxic", F.explode("words").alias("word"))
        counts = parked(words.groupBy("word").agg(F.count(F.lit(1)).alias("total"), F.sum("toxic").alias("toxic")), "features")
        least = _by_chance(counts.count())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                word, total, toxic = (c.to_numpy() for c in batch.columns)
                spread = _spread(word.view(np.uint64), total, toxic.astype(float), y, excluded)
                strong = np.flatnonzero(spread > least)
                yield pa.RecordBatch.from_arrays([pa.array(word[strong]), pa.array(spread[strong])], ["word", "spread"])

        # Hashes are ordered as unsigned numbers.
        found = counts.where(F.col("total") >= MIN_TEXTS).mapInArrow(run, "word bigint, spread double")
        found = found.orderBy(F.desc("spread"), F.col("word").bitwiseXOR(F.lit(-(2**63)))).limit(max_features)
        return found.toArrow()["word"].to_numpy().view(np.uint64)

    def places(self, kept: np.ndarray, known: np.ndarray) -> list[np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = batch.column(1)
                own = sets.flatten().to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                hit = known[at] == own
                ends = np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())])]
                found = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(at[hit].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0), found], ["place", "found"])

        rows = self._kept(kept).select("place", "words").mapInArrow(run, "place bigint, found array<int>").toArrow()
        found = rows["found"].take(pa.array(np.argsort(rows["place"].to_numpy())))
        return [s.values.to_numpy() for s in found]


def _spread(words: np.ndarray, total: np.ndarray, toxic: np.ndarray, y: np.ndarray, excluded: np.ndarray) -> np.ndarray:
    """Chi-square of each feature's presence between the labels; 0 for those in few texts and the excluded."""
    expected = total * y.mean()
    spread = (toxic - expected) ** 2 / np.maximum(expected * (1 - y.mean()) * (1 - total / len(y)), 1e-9)
    spread[(total < MIN_TEXTS) | np.isin(words, excluded)] = 0
    return spread


def _by_chance(tried: int) -> float:
    """A feature must stand out beyond what the number of features tried makes likely by chance."""
    return 2 * np.log(max(tried, 2))


def fit(
    rows: DataFrame | pa.Table,
    identity_terms: Sequence[str] = tuple(IDENTITY_TERMS),
    penalty: float = 1.0,
    l2: float = 1e-4,
    max_features: int = MAX_FEATURES,
    seed: int = 5,
) -> ToxicityModel:
    """Model from ``training_words`` or a table of (doc_id, words, toxic). Without rows of both labels the score is their share everywhere.

    Features are those whose presence differs most between the labels (chi-square) among those in
    ``MIN_TEXTS`` texts or more, and the identity terms. Beginnings of identity terms are none: a
    term counts as a word only, so that a swap changes nothing but what the penalty sees.
    """
    training = _Held(rows) if isinstance(rows, pa.Table) else _Stored(rows)
    heads = training.heads
    # Ids may be of any type, so their ranks are sorted.
    ranks = np.unique(heads["doc_id"].to_numpy(zero_copy_only=False), return_inverse=True)[1]
    order = np.lexsort((ranks, heads["toxic"].to_numpy()))
    unique = dict(zip(heads["digest"].take(pa.array(order)).to_pylist(), order.tolist(), strict=True))
    kept = np.array(list(unique.values()), np.int64)
    y = heads["toxic"].to_numpy()[kept].astype(float)
    named = split_words(pa.array(list(identity_terms)), np.ones(256, bool), True)
    terms = named.hashes
    begun = np.concatenate([own for _, own in beginnings(named, BEGINNINGS, True)])
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return ToxicityModel(terms, np.zeros(len(terms)), float(np.log(share / (1 - share))))
    known = np.union1d(training.strong(kept, y, np.concatenate([begun, mixed(begun, _SEVERAL)]), max_features), terms)
    places = training.places(kept, known)
    place = np.concatenate(places)
    x = Sparse(np.cumsum([0, *map(len, places)]), place, np.ones(len(place)))
    change = _counterfactuals(x, len(y), np.searchsorted(known, terms), np.random.default_rng(seed))
    w, b = fit_logistic(x, y, len(known), l2, rounds=300, rate=0.1, pairs=(change, np.full(len(y), penalty)))
    return ToxicityModel(known, w, b)


def _counterfactuals(x: Sparse, n_rows: int, terms: np.ndarray, rng: np.random.Generator) -> Sparse:
    """For each text, the features that a swap of its identity terms adds (+1) and removes (-1).

    A text without any gets one put in: a neutral mention must not move its score either.
    """
    indptr, indices, values = [0], [], []
    is_term = np.isin(x.indices, terms)
    for i in range(n_rows):
        at = slice(x.indptr[i], x.indptr[i + 1])
        own = x.indices[at][is_term[at]]
        new = rng.choice(terms, size=max(1, len(own)))
        indices += [*new.tolist(), *own.tolist()]
        values += [1.0] * len(new) + [-1.0] * len(own)
        indptr.append(len(indices))
    return Sparse(np.array(indptr), np.array(indices, np.int64), np.array(values))


def score_texts(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with ``_score`` (0 to 1) and ``_toxic`` (1 from the threshold on).

    NULL and empty texts get the score of a text without known words. Whole texts are read; every
    row, repeated ones included, is scored on its own.
    """
    used = np.flatnonzero(model.weights)
    hashes, weights, bias = model.hashes[used], model.weights[used], model.bias
    # Most features are unknown by their first bits already.
    begun = np.zeros(1 << 16, bool)
    begun[hashes >> np.uint64(48)] = True

    def score(texts: pa.Array) -> list[pa.Array]:
        words = split_words(texts, ALNUM, True)
        total = np.zeros(len(texts))
        for place, own, repeats in _places(words) if len(hashes) else ():
            for found, least in ((own, 1), (mixed(own, _SEVERAL), 2))[: 1 + repeats]:
                maybe = np.flatnonzero(begun[found >> np.uint64(48)])
                at = np.minimum(np.searchsorted(hashes, found[maybe]), len(hashes) - 1)
                hit = hashes[at] == found[maybe]
                doc = np.searchsorted(words.first, place[maybe[hit]], side="right") - 1
                pairs, times = np.unique(doc * len(hashes) + at[hit], return_counts=True)
                pairs = pairs[times >= least]
                total += np.bincount(pairs // len(hashes), weights[pairs % len(hashes)], minlength=len(texts))
        scores = sigmoid(total + bias)
        return [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32), pa.int32())]

    return map_texts(docs, score, {"_score": T.DoubleType(), "_toxic": T.IntegerType()}, keep)


def classify(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS, keep: Sequence[str] | None = None
) -> DataFrame:
    """Fit on the training rows of ``labels``, then score all ``docs``."""
    with scratch_scope(docs.sparkSession):
        model = fit(training_words(docs, labels, sample_rows))
    return score_texts(docs, model, threshold, keep)
