"""Licence scans with a generalised suffix automaton over licence words.

All templates and base phrases go into one automaton (a few thousand states,
shipped with the task).  Streaming a document's words through it gives the
matching statistics: at each word, the longest suffix read so far that occurs
in any template.  Runs of at least MIN_RUN words that cannot be extended within
a template are its long matches; matches that keep their order in a template, at most MAX_GAP
words apart, are chained into covered spans.  A template counts as found when
a chain covers at least MIN_COVER of its words.  Templates are opening notices
and whole short licences, so a body whose heading was cut is found too.  Base phrases are read off the
automaton too: a phrase ends at a word when its state lies on the suffix path
of the current state.

Defined results: null and empty text have no words: counts 0, words null,
labels '', score 0.  Work and memory are linear in one document's words.
Rows are scanned one by one, so repeated rows get equal results and an empty
table gives an empty table.  Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField, StructType)

from .common import map_texts, words_of
from .license_texts import WHOLE

# Base phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Opening notices of common licences, as words.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                 "compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
              "general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

MIN_RUN, MAX_GAP, MIN_COVER = 4, 12, 0.8

FIELDS = [
    StructField("n_words", LongType()), StructField("n_base", LongType()),
    StructField("first_word", LongType()), StructField("last_word", LongType()),
    StructField("base_labels", StringType()), StructField("labels", StringType()),
    StructField("score", DoubleType()),
    StructField("spans", ArrayType(StructType([
        StructField("label", StringType()), StructField("start", LongType()),
        StructField("end", LongType()), StructField("coverage", DoubleType())]))),
]


class Automaton:
    """Suffix automaton of several word sequences.

    `ends[v]` maps each sequence that holds the strings of state v to the
    smallest place where they end in it; `out[v]` lists the phrases that are a
    suffix of v's strings, as (length, phrase).
    """

    def __init__(self, texts: list[list[bytes]], phrases: list[int]):
        self.step, self.link, self.size, self.ends = [{}], [-1], [0], [{}]
        for t, words in enumerate(texts):
            last = 0
            for at, w in enumerate(words, 1):
                last = self._extend(last, w)
                self.ends[last].setdefault(t, at)
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        for v in reversed(order):
            up = self.ends[self.link[v]]
            for t, at in self.ends[v].items():
                up[t] = min(at, up.get(t, at))
        self.out: list[tuple] = [()] * len(self.size)
        for p in phrases:
            v = 0
            for w in texts[p]:
                v = self.step[v][w]
            self.out[v] += ((len(texts[p]), p),)
        for v in order:
            self.out[v] += self.out[self.link[v]] if self.link[v] > 0 else ()
        self.vocabulary = frozenset(self.step[0])

    def _state(self, size: int, step: dict, link: int) -> int:
        self.size.append(size)
        self.step.append(step)
        self.link.append(link)
        self.ends.append({})
        return len(self.size) - 1

    def _split(self, p: int, w: bytes) -> int:
        """The state for p's longest string followed by w, cloned out of the one reached if that is longer."""
        q = self.step[p][w]
        if self.size[q] == self.size[p] + 1:
            return q
        new = self._state(self.size[p] + 1, dict(self.step[q]), self.link[q])
        self.ends[new] = dict(self.ends[q])
        self.link[q] = new
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.step[last]:
            return self._split(last, w)
        new = self._state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w)
        return new

    def scan(self, words: list[bytes]) -> tuple[list, list]:
        """Phrase places (start, phrase) and long matches (end, length, state, next state).

        A match ends where no template goes on (next state None) or, for the templates of its state that are
        not in the next one's, where others do.
        """
        step, link, size, out, known, ends = self.step, self.link, self.size, self.out, self.vocabulary, self.ends
        places, runs, v, n = [], [], 0, 0
        for i, w in enumerate(words):
            if w not in known:
                if n >= MIN_RUN:
                    runs.append((i, n, v, None))
                v = n = 0
                continue
            if w not in step[v]:
                if n >= MIN_RUN:
                    runs.append((i, n, v, None))
                while v and w not in step[v]:
                    v = link[v]
                n = size[v]
            u = v
            v = step[v][w]
            if n >= MIN_RUN and len(ends[v]) < len(ends[u]):
                runs.append((i, n, u, v))
            n += 1
            for length, p in out[v]:
                if n >= length:
                    places.append((i - length + 1, p))
        if n >= MIN_RUN:
            runs.append((len(words), n, v, None))
        return places, runs


def _chains(runs: list[tuple], automaton: Automaton, lengths: list[int]) -> dict[int, tuple]:
    """Per template its best chain: (covered words, start, end) in the document."""
    best: dict[int, tuple] = {}
    open_: dict[int, list] = {}
    for end, n, v, after in runs:
        on = automaton.ends[after] if after is not None else ()
        for t, at in automaton.ends[v].items():
            if t in on:
                continue
            live = [c for c in open_.get(t, ()) if c[2] >= end - n - MAX_GAP]
            now = (n, end - n, end, at)
            for covered, start, stop, upto in live:
                fresh = min(n, end - stop, at - upto)       # words new in both the document and the template
                if fresh > 0 and upto < at and covered + fresh > now[0]:
                    now = (covered + fresh, start, end, at)
            open_[t] = [*live, now]
            if now[0] > best.get(t, (0,))[0]:
                best[t] = now[:3]
    return {t: (min(c, lengths[t]), a, b) for t, (c, a, b) in best.items()}


def scanner(templates=(*TEMPLATES, *WHOLE), phrases=BASE_PHRASES):
    """A function from a batch of texts to the columns of FIELDS."""
    texts = [words_of(p.encode()) for p, _ in phrases] + [words_of(t.encode()) for _, t in templates]
    names = [label for _, label in phrases] + [label for label, _ in templates]
    n_phrases, lengths = len(phrases), [len(t) for t in texts]
    automaton = Automaton(texts, list(range(n_phrases)))

    def one(text):
        words = words_of(text)
        places, runs = automaton.scan(words)
        base = {names[p] for _, p in places}
        spans = [(names[t], start, end, covered / lengths[t])
                 for t, (covered, start, end) in _chains(runs, automaton, lengths).items() if t >= n_phrases]
        found = base | {s[0] for s in spans if s[3] >= MIN_COVER}
        score = 1.0 if base else max((s[3] for s in spans), default=0.0)
        starts = [s for s, _ in places]
        return (len(words), len(places), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(found)), score,
                [{"label": a, "start": b, "end": c, "coverage": d} for a, b, c, d in sorted(spans)])

    return lambda batch: [list(c) for c in zip(*map(one, batch))] or [[] for _ in FIELDS]


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts and labels, score, covered template spans) for every row of `df`."""
    return map_texts(df, [id_col], text_col, FIELDS, scanner)
