"""License scan: templates with optional and replaceable regions, compiled to token automata.

A template is a line of words with marks::

    word          mandatory, must stand exactly here
    [ ... ]       optional region
    ( a | b c )   one of several wordings
    {m-n}         replaceable region: m to n arbitrary words

All templates become one nondeterministic automaton over words, run unanchored over the whole text
(a match may begin at every word) with its subset states built when first met and remembered.
A text is accepted for a label if all mandatory wording of a template is there, in place, and only
optional and replaceable regions differ.

Words are lower-cased (A-Z only) runs of digits, a-z and characters beyond ASCII.  Documents are
read once, with no shuffle.  Defined results: null or empty text has no words and no matches;
repeated rows give repeated results; a null id stays null.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.llm.common import ID, keyed, load, register, small_batches

# the three base phrases and their labels (fixed by the query's contract)
BASE = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]

# wordings of common notices and license texts (fixed values)
TEMPLATES = [
    ("mit-notice",
     "(released | licensed | distributed | available) under [the terms of] the mit license"),
    ("mit-text",
     "permission is hereby granted free of charge to any person obtaining a copy of this "
     "(software | font software) [and associated documentation files {0-4}] to deal in the "
     "software without restriction including without limitation the rights to use copy modify "
     "merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2.0-notice",
     "licensed under the apache license version 2 0 [the license {0-60} you may not use "
     "(this file | these files | this work) except in compliance with the license]"),
    ("gpl-notice",
     "licensed under the (gnu | gnu lesser | gnu affero) general public license "
     "[as published by the free software foundation] [(version | v) (1 | 2 | 3)]"),
    ("gpl-3.0-notice",
     "licensed under [the terms of] the gnu general public license "
     "[as published by the free software foundation] (version 3 | v3 | version 3 0)"),
    ("gpl-text",
     "is free software you can redistribute it and or modify it under the terms of the gnu "
     "[(lesser | library | affero)] general public license as published by the free software "
     "foundation either version {1-3} of the license or [at your option] any later version"),
    ("bsd-text",
     "redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met"),
    ("isc-text",
     "permission to use copy modify and or distribute this software for any purpose with or "
     "without fee is hereby granted provided that the above copyright notice and this permission "
     "notice appear in all copies"),
    ("mpl-2.0-notice",
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc0-notice", "(dedicated to the public domain | released into the public domain) "
                   "[{0-12} cc0 [1 0]]"),
    ("cc-by-notice",
     "licensed under [(a | the)] (cc by | creative commons attribution) "
     "[(3 0 | 4 0)] [international] [license]"),
    ("cc-by-nc-4.0-notice",
     "licensed under [(a | the)] (cc by nc | creative commons attribution noncommercial | "
     "creative commons attribution non commercial) 4 0"),
    ("spdx-tag", "spdx license identifier {1-4}"),
]

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
STATES = 20_000            # remembered subset states before they are built anew
TOKENS = re.compile(r"\{(\d+)-(\d+)\}|[\[\]()|]|[^\s\[\](){}|]+")


class Automaton:
    """Nondeterministic word automaton of several templates with remembered subset states."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.step: list[dict[bytes, list[int]]] = []    # state -> word -> states
        self.any: list[list[int]] = []                  # state -> states after any word
        self.free: list[list[int]] = []                 # state -> states without a word
        self.ends: dict[int, int] = {}                  # accepting state -> template
        self.starts: list[int] = []
        for number, (_, text) in enumerate(templates):
            items = [m.group(0) for m in TOKENS.finditer(text.lower())]
            start = self.state()
            end = self.sequence(items, start)
            if items:
                raise ValueError(f"unbalanced template: {text}")
            self.starts.append(start)
            self.ends[end] = number
        self.words = {w for s in self.step for w in s}
        self.reset()

    def state(self) -> int:
        self.step.append({})
        self.any.append([])
        self.free.append([])
        return len(self.step) - 1

    def sequence(self, items: list[str], at: int) -> int:
        """Consume items up to a closing mark; returns the last state."""
        while items and items[0] not in ("]", ")", "|"):
            item = items.pop(0)
            end = self.state()
            if item == "[":
                self.free[at].append(end)
                inner = self.state()
                self.free[at].append(inner)
                self.free[self.sequence(items, inner)].append(end)
                self.close(items, "]")
            elif item == "(":
                while True:
                    inner = self.state()
                    self.free[at].append(inner)
                    self.free[self.sequence(items, inner)].append(end)
                    if not items or items[0] != "|":
                        break
                    items.pop(0)
                self.close(items, ")")
            elif item.startswith("{"):
                low, high = map(int, TOKENS.match(item).groups())
                here = at
                for i in range(high):
                    if i >= low:
                        self.free[here].append(end)
                    after = self.state()
                    self.any[here].append(after)
                    here = after
                self.free[here].append(end)
            else:
                self.step[at].setdefault(item.encode(), []).append(end)
            at = end
        return at

    @staticmethod
    def close(items: list[str], mark: str):
        if not items or items.pop(0) != mark:
            raise ValueError(f"missing {mark}")

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def after(self, states: frozenset[int], word: bytes | None, begin: bool) -> frozenset[int]:
        out: set[int] = set(self.starts) if begin else set()
        for s in states:
            out.update(self.any[s])
            if word is not None:
                out.update(self.step[s].get(word, ()))
        return self.closure(out)

    def reset(self):
        first = self.closure(self.starts)
        self.sets = [first]
        self.number = {first: 0}
        self.moves: list[dict[bytes | None, int]] = [{}]
        self.accepts: list[tuple[int, ...]] = [()]

    def move(self, state: int, word: bytes | None) -> int:
        to = self.moves[state].get(word)
        if to is None:
            if len(self.sets) > STATES:
                here = self.sets[state]
                self.reset()
                state = self.add(here)
            to = self.moves[state][word] = self.add(self.after(self.sets[state], word, True))
        return to

    def add(self, states: frozenset[int]) -> int:
        n = self.number.get(states)
        if n is None:
            n = self.number[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            self.accepts.append(tuple(sorted({self.ends[s] for s in states if s in self.ends})))
        return n

    def accepted(self, words: list[bytes]):
        """``(template, index of the last word)`` of every match, in text order."""
        known, state = self.words, 0
        idle = not any(self.any[s] for s in self.sets[0])      # no template begins with any word
        for i, w in enumerate(words):
            if w not in known:
                if state == 0 and idle:
                    continue
                w = None
            to = self.moves[state].get(w)
            state = self.move(state, w) if to is None else to
            if self.accepts[state]:
                for t in self.accepts[state]:
                    yield t, i

    def start_of(self, template: int, words: list[bytes], last: int) -> int:
        """Latest word at which the template matches up to ``last``."""
        for at in range(last, -1, -1):
            states = self.closure([self.starts[template]])
            for i in range(at, last + 1):
                states = self.after(states, words[i] if words[i] in self.words else None, False)
                if not states:
                    break
            if any(self.ends.get(s) == template for s in states):
                return at
        raise AssertionError("not a match")


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


def scan(documents: DataFrame, templates: list[tuple[str, str]], id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``id_col, n_words, matches``: per text an array of ``(label, first_word, last_word)``, one
    for every place where a template of ``templates`` (label, template) ends."""
    small_batches(documents.sparkSession)
    match = T.StructType().add("label", T.StringType()).add("first_word", T.LongType()).add(
        "last_word", T.LongType())
    schema = T.StructType().add(ID, T.LongType()).add("n_words", T.LongType()).add(
        "matches", T.ArrayType(match))
    arrow = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                ("last_word", pa.int64())]))

    def run(batches):
        automaton = Automaton(templates)
        for b in batches:
            n, found = [], []
            for text in b.column(1).to_pylist():
                words = words_of(text)
                n.append(len(words))
                found.append([{"label": templates[t][0],
                               "first_word": automaton.start_of(t, words, i), "last_word": i}
                              for t, i in automaton.accepted(words)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(found, arrow)],
                [ID, "n_words", "matches"])

    return (keyed(documents, id_col, text_col).mapInArrow(run, schema)
            .withColumnRenamed(ID, id_col))


def labels_text(matches: Column) -> Column:
    """Distinct labels, sorted, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(
        F.transform(matches, lambda m: m["label"]))), ",")


@register("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(load(spark, sf_dir, "documents"), BASE + TEMPLATES)
    base_labels = [label for label, _ in BASE]
    base = F.filter("matches", lambda m: m["label"].isin(base_labels))
    starts = F.transform(F.col("base"), lambda m: m["first_word"])
    score = F.when(F.size("matches") == 0, 0.0).when(
        F.size("matches") > F.size("base"), 1.0).otherwise(0.5)
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels_text(F.col("base")).alias("base_labels"),
        labels_text(F.col("matches")).alias("labels"), score.alias("score"),
        F.size("matches").cast("bigint").alias("n_matches"))


__all__ = ["scan", "Automaton", "BASE", "TEMPLATES", "words_of"]
