"""License scans with template markup, compiled to automata over words.

Markup: ``<<opt>>`` ... ``<</opt>>`` may be absent, ``<<var MIN-MAX>>`` stands for so many words of any
wording. All other words are mandatory and must stand exactly, in order. Words are runs of ASCII
letters, digits and characters beyond ASCII; the case of A-Z does not matter.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martweave.llm.words import ALNUM, map_texts, split_words

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed wording of well-known licence statements, with markup.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license <<opt>>as published by the apache software foundation<</opt>> version 2.0"),
    ("mit", "released under the <<opt>>terms of the<</opt>> mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of <<var 1-4>> and associated documentation files"),
    (
        "gpl-3.0",
        "this <<var 1-4>> is licensed under the gnu general public license <<opt>>as published by the free software foundation<</opt>> version 3",
    ),
    ("cc-by-nc-4.0", "licensed under <<opt>>the<</opt>> cc by nc <<opt>>license<</opt>> 4.0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("copyright", "copyright <<var 0-8>> all rights reserved"),
)


@dataclass(frozen=True)
class Automaton:
    """``steps[s]``: (word or None for any, next state); ``skips[s]``: states reached without a word."""

    label: str
    mandatory: tuple[str, ...]
    steps: tuple[tuple[tuple[str | None, int], ...], ...]
    skips: tuple[tuple[int, ...], ...]

    @property
    def strength(self) -> float:
        """Grows with the mandatory words, below 1."""
        return len(self.mandatory) / (len(self.mandatory) + 2)


def compile_template(label: str, template: str) -> Automaton:
    mandatory: list[str] = []
    steps: list[list[tuple[str | None, int]]] = [[]]
    skips: list[list[int]] = [[]]
    opened: list[int] = []

    def step(word: str | None) -> None:
        steps[-1].append((word, len(steps)))
        steps.append([])
        skips.append([])

    for token in re.findall(r"<<[^>]*>>|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", template.lower()):
        if token == "<<opt>>":
            opened.append(len(steps) - 1)
        elif token == "<</opt>>":
            skips[opened.pop()].append(len(steps) - 1)
        elif match := re.fullmatch(r"<<var (\d+)-(\d+)>>", token):
            low, high = map(int, match.groups())
            optional = []
            for i in range(high):
                if i >= low:
                    optional.append(len(steps) - 1)
                step(None)
            for state in optional:
                skips[state].append(len(steps) - 1)
        else:
            if not opened:
                mandatory.append(token)
            step(token)
    return Automaton(label, tuple(mandatory), tuple(map(tuple, steps)), tuple(map(tuple, skips)))


def find(automaton: Automaton, words: Sequence[str | None]) -> list[tuple[int, int]]:
    """Every start at which the automaton accepts, with the longest end."""
    last = len(automaton.steps) - 1

    def closed(states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in automaton.skips[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    first = closed({0})
    firsts = {w for s in first for w, _ in automaton.steps[s]}
    found = []
    for start, word in enumerate(words):
        if word not in firsts and None not in firsts:
            continue
        states, at, end = first, start, None
        while states and at < len(words):
            states = closed({t for s in states for w, t in automaton.steps[s] if w is None or w == words[at]})
            at += 1
            if last in states:
                end = at
        if end is not None:
            found.append((start, end))
    return found


def _phrases(base: dict[str, str]) -> list[Automaton]:
    return [compile_template(label, phrase) for phrase, label in base.items()]


SCAN_TYPE = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,score:double,"
    "spans:array<struct<label:string,start:bigint,end:bigint>>>"
)


def scan_licenses(
    docs: DataFrame,
    base: dict[str, str] = BASE,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with a struct ``_license``: n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` holds (label, start, end) in words for every accepted place. The score is the strength
    of the strongest label found, 0 without one. NULL and empty texts have no words; every row,
    repeated ones included, is scanned on its own, as a whole.
    """
    phrases, patterns = _phrases(base), [compile_template(*t) for t in templates]
    vocabulary = sorted({w for a in phrases + patterns for s in a.steps for w, _ in s if w})
    known = split_words(pa.array(vocabulary), ALNUM, True).hashes
    order = np.argsort(known)
    sorted_known = known[order].tolist()
    names = [vocabulary[i] for i in order]
    index = {w: i for i, w in enumerate(names)}
    needs = [np.array([index[w] for w in a.mandatory], np.int64) for a in phrases + patterns]

    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    arrow = pa.struct(
        [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))]
    )

    def scan(texts: pa.Array) -> list[pa.Array]:
        hashes = np.array(sorted_known, np.uint64)
        words = split_words(texts, ALNUM, True)
        at = np.minimum(np.searchsorted(hashes, words.hashes), len(hashes) - 1)
        is_known = hashes[at] == words.hashes
        hit = np.flatnonzero(is_known)
        seen = np.zeros((len(texts), len(names)), bool)
        seen[np.searchsorted(words.first, hit, side="right") - 1, at[hit]] = True
        possible = np.stack([seen[:, need].all(axis=1) for need in needs], axis=1)
        rows = []
        for d, count in enumerate(words.counts.tolist()):
            out = {"n_words": count, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "spans": []}
            if possible[d].any():
                own = slice(words.first[d], words.first[d + 1])
                spelled = [names[i] if known else None for i, known in zip(at[own].tolist(), is_known[own].tolist(), strict=True)]
                _describe(out, spelled, possible[d], phrases, patterns)
            rows.append(out)
        return [pa.array(rows, arrow)]

    return map_texts(docs, scan, {"_license": T.StructType.fromDDL(f"v {SCAN_TYPE}")[0].dataType}, keep)


def _describe(out: dict, own: list[str | None], possible: np.ndarray, phrases: list[Automaton], patterns: list[Automaton]) -> None:
    base, labels, strength, starts = set(), set(), 0.0, []
    for i, automaton in enumerate(phrases + patterns):
        for start, end in find(automaton, own) if possible[i] else ():
            if i < len(phrases):
                base.add(automaton.label)
                starts.append(start)
            labels.add(automaton.label)
            strength = max(strength, automaton.strength)
            out["spans"].append({"label": automaton.label, "start": start, "end": end})
    out |= {"n_base": len(starts), "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": strength}
    if starts:
        out |= {"first_word": min(starts), "last_word": max(starts)}
