"""License scans: marked-up notice templates compiled into token automata.

A template is plain wording with two kinds of regions: ``<<opt>> ... <</opt>>`` may be left out, ``<<var N>>``
stands for up to N words of any kind. Compilation gives a nondeterministic automaton over words, which is run as a
lazily built deterministic one from every place where the template's opening mandatory words stand. A place is
accepted only if all mandatory wording follows exactly; the longest acceptance counts.

Edge cases: null and empty texts have no words, no matches and score 0; an empty table gives an empty result;
repeated rows are scanned one by one; other columns of the input are left alone. A text is scanned in one pass and
in time linear in its words, since each start reads at most a template's longest wording.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, slices, table

#: Phrases and labels of the base scan.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Public notice wordings. <<var N>>: up to N words; <<opt>>...<</opt>>: may be missing.
TEMPLATES = {
    "mit-notice": "released under the <<opt>>terms of the<</opt>> mit license",
    "mit": """permission is hereby granted free of charge to any person obtaining a copy of this software and
        associated documentation files the software to deal in the software without restriction including without
        limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
        and to permit persons to whom the software is furnished to do so subject to the following conditions the above
        copyright notice and this permission notice <<opt>>including the next paragraph<</opt>> shall be included in all
        copies or substantial portions of the software""",
    "isc": """permission to use copy modify and or distribute this software for any purpose with or without fee is
        hereby granted provided that the above copyright notice and this permission notice appear in all copies""",
    "apache-2.0": """licensed under the apache license version 2 0 <<opt>>the license you may not use this file except
        in compliance with the license<</opt>>""",
    "gpl-notice": """licensed under the <<opt>>terms of the<</opt>> gnu <<opt>>lesser<</opt>> <<opt>>affero<</opt>>
        general public license <<opt>>as published by the free software foundation<</opt>> <<opt>>either<</opt>>
        version <<var 2>>""",
    "gpl-or-later": """you can redistribute it and or modify it under the terms of the gnu <<opt>>lesser<</opt>>
        general public license as published by the free software foundation either version <<var 2>> of the license
        or at your option any later version""",
    "bsd": """redistribution and use in source and binary forms with or without modification are permitted provided
        that the following conditions are met <<opt>>1<</opt>> redistributions of source code must retain the above
        copyright notice this list of conditions and the following disclaimer""",
    "zlib": """this software is provided as is without any express or implied warranty in no event will the
        <<var 3>> be held liable for any damages arising from the use of this software""",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by-notice": """licensed under a creative commons attribution <<opt>>noncommercial<</opt>>
        <<opt>>sharealike<</opt>> <<opt>>noderivatives<</opt>> <<var 2>> <<opt>>international<</opt>> license""",
    "copyright-notice": "copyright <<opt>>c<</opt>> <<var 8>> all rights reserved",
}

_MARK = re.compile(r"<<(opt|/opt|var \d+)>>")


class Automaton:
    """A template's automaton: nodes 0..n, word edges, any-word edges and empty edges; the last node accepts."""

    def __init__(self, template: str):
        self.words: list[dict[bytes, int]] = [{}]
        self.free: list[int | None] = [None]
        self.skip: list[list[int]] = [[]]
        opened: list[int] = []
        opening: list[bytes] = []
        plain = True
        for k, part in enumerate(_MARK.split(template)):
            if k % 2 == 0:
                for w in alnum_words(part):
                    at = len(self.words) - 1
                    self.words[at][w] = self._node()
                    if plain:
                        opening.append(w)
                continue
            plain = False
            if part == "opt":
                # a node of its own, so that skipping does not leave the region's inner edges reachable
                self.skip[-1].append(here := self._node())
                opened.append(here)
            elif part == "/opt":
                end = self._node()
                self.skip[end - 1].append(end)
                self.skip[opened.pop()].append(end)
            else:
                start, nodes = len(self.words) - 1, []
                for _ in range(int(part[4:])):
                    at = len(self.words) - 1
                    self.free[at] = self._node()
                    nodes.append(at)
                self.skip[start] += [n + 1 for n in nodes]
                for n in nodes[1:]:
                    self.skip[n].append(len(self.words) - 1)
        if opened or not opening:
            raise ValueError("a template begins with mandatory words and closes its regions")
        self.opening, self.accept = opening, len(self.words) - 1
        self._states: dict[frozenset[int], int] = {}
        self._sets: list[frozenset[int]] = []
        self._next: list[dict[bytes, int]] = []
        self._named: list[frozenset[bytes]] = []
        self._other: list[int | None] = []
        self.start = self._state({0})

    def _node(self) -> int:
        self.words.append({})
        self.free.append(None)
        self.skip.append([])
        return len(self.words) - 1

    def _state(self, nodes: set[int]) -> int:
        todo, seen = list(nodes), set(nodes)
        while todo:
            for n in self.skip[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        key = frozenset(seen)
        if key not in self._states:
            self._states[key] = len(self._sets)
            self._sets.append(key)
            self._next.append({})
            self._named.append(frozenset(w for n in key for w in self.words[n]))
            self._other.append(None)
        return self._states[key]

    def _step(self, state: int, word: bytes) -> int:
        """The next state, -1 if none. Words without an edge of their own share one entry, so tables stay small."""
        if word in self._named[state]:
            if (to := self._next[state].get(word)) is None:
                to = self._next[state][word] = self._move(state, word)
        elif (to := self._other[state]) is None:
            to = self._other[state] = self._move(state, None)
        return to

    def _move(self, state: int, word: bytes | None) -> int:
        nodes = self._sets[state]
        to = {self.free[n] for n in nodes} | {self.words[n].get(word) for n in nodes} - {None}
        to.discard(None)
        return self._state(to) if to else -1

    def longest(self, words: list[bytes], at: int) -> int:
        """Words of the longest accepted wording that starts at a word; 0 if none."""
        state, best = self.start, 0
        for i in range(at, len(words)):
            state = self._step(state, words[i])
            if state < 0:
                break
            if self.accept in self._sets[state]:
                best = i + 1 - at
        return best


class Scanner:
    def __init__(self, templates: dict[str, str], base: dict[str, str]):
        self.base = [(b" " + p.encode() + b" ", label, len(p.split())) for p, label in base.items()]
        self.automata = [(label, a, b" " + b" ".join(a.opening) + b" ") for label, a in ((k, Automaton(t)) for k, t in templates.items())]

    @staticmethod
    def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
        """First word of each place of a phrase; neighbours may share a space. Words are counted on from the place before."""
        at, last, word = joined.find(phrase), 0, 0
        while at >= 0:
            word += joined.count(b" ", last, at)
            yield word
            last, at = at, joined.find(phrase, at + 1)

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, int, int, bool]]]:
        """Number of words, and (label, first word, words, is it a base phrase) of each match in text order."""
        words = alnum_words(text)
        joined = b" " + b" ".join(words) + b" "
        found = [(label, start, n, True) for phrase, label, n in self.base for start in self._places(joined, phrase)]
        for label, automaton, opening in self.automata:
            for start in self._places(joined, opening):
                if n := automaton.longest(words, start):
                    found.append((label, start, n, False))
        return len(words), sorted(found, key=lambda m: (m[1], m[0], m[2]))


MATCHES = "array<struct<label:string,first_word:bigint,n_words:bigint,is_base:boolean>>"


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, base: dict[str, str] | None = None
) -> DataFrame:
    """Per row: id, n_words and all matches (label, first word, length, base or template). Narrow: no shuffle."""
    chosen = (TEMPLATES if templates is None else templates, BASE if base is None else base)
    kind = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("is_base", pa.bool_())]))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*chosen)
        for batch in slices(batches, "t"):
            done = [scanner.scan(t) for t in batch.column("t").to_pylist()]
            matches = [[{"label": a, "first_word": b, "n_words": c, "is_base": d} for a, b, c, d in m] for _, m in done]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([n for n, _ in done], pa.int64()), pa.array(matches, kind)], ["id", "n_words", "matches"]
            )

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return plain.mapInArrow(run, f"id {id_type}, n_words bigint, matches {MATCHES}").withColumnRenamed("id", id_col)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; score: the share of a text's words that stand inside a match."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["is_base"])
    # matches come in order of their first word: the words covered are what each adds beyond the end reached before it
    covered = F.aggregate(
        "matches",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, m: F.struct(
            F.greatest(s["end"], m["first_word"] + m["n_words"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), m["first_word"] + m["n_words"] - F.greatest(s["end"], m["first_word"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["first_word"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"),
    )
