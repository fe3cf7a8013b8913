"""URL filter: allow and block rules first, then a logistic regression on hashed character n-grams.

The model is fitted on a small labelled URL table, a parameter; n-grams of host and path are kept
apart. A NULL URL, or one without ``://``, has an empty host and path, fits no rule and is judged by the model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.llm.linear import Sparse, fit_logistic, sigmoid
from martweave.llm.words import mixed, ship, spans_hash, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
N_FEATURES = 1 << 16
_GRAMS = (3, 4, 5)

#: Training table: the words hosts and paths are made of. Label 1 is to be blocked.
_BLOCK_NAMES = (
    "casino-win casino-royal online-casino mega-casino free-bets sport-bets bets-daily best-odds-bets cheap-pills diet-pills "
    "pills-direct buy-pills-now ads-track ad-tracker track-ads click-ads popup-ads win-prize-now free-prizes adult-cams "
    "hot-singles poker-cash slots-win jackpot-slots payday-loans fast-loans crypto-doubler replica-watches spam-mailer spam-links spam-offers warez-crack"
).split()
_ALLOW_NAMES = (
    "library gardening weather-report cityhall museum recipes newsroom university openmaps wikiworld thestar the-harbour bookshop "
    "northern-times astronomy teacher-notes railways science-daily health-council orchestra thinking-aloud stories ontheroad "
    "handwriting heritage inthefield tradition another-season rethinking ninth-street ontology thread there anthem creation motion "
    "houses resting ending herding rehearsal theatre edition notion blending"
).split()
_BLOCK_PATHS = ("/bonus/win", "/en/free-spins", "/promo?aff=1", "/de/bets/odds", "/fr/pills/cheap", "/track/click.html")
_ALLOW_PATHS = ("/en/2140", "/de/381.html", "/fr/9051/", "/es/77", "/news/item-12", "/about.html", "/en/613.html", "/")
_TOPS = ("example.com", "example.org", "example.net", "test")
_FRONTS = ("", "www.", "m.", "blog.")


def _labelled() -> list[tuple[str, int]]:
    rows = []
    for label, names, paths in ((1, _BLOCK_NAMES, _BLOCK_PATHS + _ALLOW_PATHS), (0, _ALLOW_NAMES, _ALLOW_PATHS)):
        for i, name in enumerate(names):
            for j in range(4):
                k = i + j
                rows.append((f"http://{_FRONTS[(k + j) % 4]}{name}.{_TOPS[k % 4]}{paths[(i + 3 * j) % len(paths)]}", label))
    return rows


LABELLED_URLS = _labelled()


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, NULL without one. A rule is (action, host, path)."""
    found = None
    for action, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    empty = F.lit(None).cast("struct<rule:string,verdict:string>")
    return found.otherwise(empty) if found is not None else empty


def url_features(hosts: Sequence[str | None], paths: Sequence[str | None]) -> Sparse:
    """Presence of each hashed n-gram; ``^`` and ``$`` mark the ends, hosts and paths hash apart."""
    rows, ids = [], []
    for part, texts in enumerate((hosts, paths)):
        marked = [f"^{t}$".encode() if t else b"" for t in texts]
        sizes = np.array([len(t) for t in marked], np.int64)
        values = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64) + np.uint64(1)
        row = np.repeat(np.arange(len(marked)), sizes)
        room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(values))
        for n in _GRAMS:
            at = np.flatnonzero(room >= n)
            rows.append(row[at])
            ids.append(mixed(spans_hash(values, at, n), 2 * n + part) % np.uint64(N_FEATURES))
    pairs = np.unique(np.concatenate(rows).astype(np.int64) * N_FEATURES + np.concatenate(ids).astype(np.int64))
    row = pairs // N_FEATURES
    return Sparse(np.searchsorted(row, np.arange(len(hosts) + 1)), pairs % N_FEATURES, np.ones(len(pairs)))


def _split(url: str) -> tuple[str, str]:
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    return rest[:cut].lower(), path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]


def train(labelled: Sequence[tuple[str, int]] = LABELLED_URLS, l2: float = 3e-4) -> tuple[np.ndarray, float]:
    parts = [_split(url) for url, _ in labelled]
    x = url_features([h for h, _ in parts], [p for _, p in parts])
    return fit_logistic(x, np.array([label for _, label in labelled], float), N_FEATURES, l2, rounds=200, rate=0.05)


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    labelled: Sequence[tuple[str, int]] = LABELLED_URLS,
    threshold: float = 0.5,
    url: str = "url",
) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict in a struct ``_url``; other columns stay.

    The score is the model's probability that the page is to be blocked. Every row, repeated ones
    included, is judged on its own.
    """
    ship(pages.sparkSession)
    weights, bias = train(labelled)
    used = np.flatnonzero(weights)
    known, small = used.astype(np.int64), weights[used]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(N_FEATURES)
        dense[known] = small
        for batch in batches:
            parts = batch.column(batch.num_columns - 1)
            hosts, paths = (parts.field(name).to_pylist() for name in ("host", "path"))
            score = sigmoid(url_features(hosts, paths).dot(dense) + bias)
            verdict = [v or ("block" if s >= threshold else "allow") for v, s in zip(parts.field("verdict").to_pylist(), score, strict=True)]
            out = pa.StructArray.from_arrays(
                [parts.field("host"), parts.field("path"), parts.field("rule"), pa.array(score, pa.float64()), pa.array(verdict, pa.string())],
                ["host", "path", "rule", "score", "verdict"],
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], [*batch.schema.names[:-1], "_url"])

    pages = pages.drop("_url")
    (parts,) = unused(pages, "parts")
    host, path = url_host(F.col(url)), url_path(F.col(url))
    split = pages.select("*", F.struct(host.alias("host"), path.alias("path")).alias(parts))
    host, path = F.col(parts)["host"], F.col(parts)["path"]
    rule = longest_rule(host, path, rules)
    split = split.withColumn(parts, F.struct(host.alias("host"), path.alias("path"), rule["rule"].alias("rule"), rule["verdict"].alias("verdict")))
    judged = T.StructType.fromDDL("host string, path string, rule string, score double, verdict string")
    return split.mapInArrow(judge, T.StructType([*pages.schema.fields, T.StructField("_url", judged)]))
