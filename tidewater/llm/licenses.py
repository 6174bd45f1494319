"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license templates.

A text block is any run of the block's number of words, from whichever word it begins. A template is contained in a
block if the block has at least the threshold's share of the template's different words. Candidates are looked for in
a grid of overlapping spans of twice the block's words, which hold every block whole. The join orders words by their
frequency in the whole corpus, rarest first. A template's prefix is so long that a span without any of its words cannot
reach the threshold; spans that share a prefix word are candidates if they have enough words (length filter) and if
enough words can still follow in both orders (positional filter). A block then slides over the span, word by word, and
is counted exactly. Words that no template has cannot count and are left out, which only sharpens the filters.

Templates are parameters and few; they go to the tasks with the function. Rows stay where they are: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches, strings

#: Phrases that name a license, as words.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Public license notices, as words.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Words:
    """Words of a batch of texts: all in one array, with the text each belongs to and its place there."""

    values: pa.Array
    row: np.ndarray
    place: np.ndarray
    counts: np.ndarray


def words_of(texts: pa.Array) -> Words:
    spaced = pc.replace_substring_regex(pc.ascii_lower(texts), SEPARATORS, " ")
    split = pc.split_pattern(pc.utf8_trim(spaced, " "), " ")
    values = split.flatten()
    counts = np.asarray(pc.list_value_length(split)).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    place = np.arange(len(row)) - np.repeat(starts, counts)
    # a text without words splits into one empty word
    filled = np.asarray(pc.binary_length(values)) > 0
    if not filled.all():
        values, row, place = values.filter(pa.array(filled)), row[filled], place[filled]
        counts = np.bincount(row, minlength=len(counts))
    return Words(values, row, place, counts)


@dataclass(frozen=True)
class Templates:
    """Templates as sets of word ranks, their prefixes and how many words must be found."""

    words: tuple[str, ...]  # by rank: rarest first
    labels: tuple[str, ...]
    sets: tuple[frozenset[int], ...]
    needed: tuple[int, ...]
    block: int

    @classmethod
    def ordered(cls, templates: list[tuple[str, str]], counts: dict[str, int], threshold: float, block: int) -> Templates:
        vocabulary = {w for _, text in templates for w in text.split()}
        words = tuple(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))
        rank = {w: i for i, w in enumerate(words)}
        sets = tuple(frozenset(rank[w] for w in text.split()) for _, text in templates)
        longest = max((len(text.split()) for _, text in templates), default=0)
        return cls(words, tuple(label for label, _ in templates), sets, tuple(ceil(threshold * len(s) - 1e-9) for s in sets), max(block, 2 * longest))

    def prefix_index(self) -> dict[int, list[tuple[int, int]]]:
        """Prefix word to (template, position in the template's order)."""
        index: dict[int, list[tuple[int, int]]] = {}
        for t, (members, needed) in enumerate(zip(self.sets, self.needed)):
            for at, word in enumerate(sorted(members)[: len(members) - needed + 1]):
                index.setdefault(word, []).append((t, at))
        return index


def join_block(block: list[int], templates: Templates, index: dict[int, list[tuple[int, int]]]) -> list[tuple[int, float]]:
    """(template, containment) of every template that a block holds; ``block`` is its words' ranks in order, each once."""
    candidates = set()
    seen: dict[int, int] = {}  # words shared so far, per template
    for position, word in enumerate(block):
        for t, at in index.get(word, ()):
            shared = seen[t] = seen.get(t, 0) + 1
            # prefix words are met in order, so all that both have before this one are counted
            possible = shared - 1 + min(len(block) - position, len(templates.sets[t]) - at)
            if len(block) >= templates.needed[t] and possible >= templates.needed[t]:
                candidates.add(t)
    found = []
    for t in sorted(candidates):
        common = len(templates.sets[t].intersection(block))
        if common >= templates.needed[t]:
            found.append((t, common / len(templates.sets[t])))
    return found


def template_counts(df: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, text_col: str = "text") -> dict[str, int]:
    """How often each word of a template stands in the whole corpus; one number per word reaches the driver."""
    vocabulary = sorted({w for _, text in templates for w in text.split()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in small_batches(batches, "text", 8 << 20):
            at = pc.index_in(words_of(strings(batch["text"])).values, pa.array(vocabulary, pa.large_string())).fill_null(len(vocabulary))
            counts += np.bincount(np.asarray(at), minlength=len(counts))
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary), pa.array(counts[:-1])], ["word", "n"])

    rows = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in rows.collect()}


def phrase_places(words: Words, phrases: dict[str, str]) -> list[tuple[str, int, np.ndarray]]:
    """(label, words of the phrase, indexes of its first words) of every phrase."""
    vocabulary = sorted({w for p in phrases for w in p.split()})
    codes = np.asarray(pc.index_in(words.values, pa.array(vocabulary, pa.large_string())).fill_null(-1))
    result = []
    for phrase, label in phrases.items():
        parts = [vocabulary.index(w) for w in phrase.split()]
        starts = np.flatnonzero(codes[: len(codes) - len(parts) + 1] == parts[0]) if len(codes) >= len(parts) else np.empty(0, np.int64)
        for step, part in enumerate(parts[1:], 1):
            starts = starts[codes[starts + step] == part]
        starts = starts[words.row[starts] == words.row[starts + len(parts) - 1]] if len(starts) else starts
        result.append((label, len(parts), starts))
    return result


def sliding_counts(places: np.ndarray, ranks: np.ndarray, begin: int, window: int) -> np.ndarray:
    """Different words in each of the ``window`` blocks that begin at ``begin`` and after it; words in order of place."""
    order = np.lexsort((places, ranks))
    at, of = places[order], ranks[order]
    # a word counts by its first place in a block: from the one that ends with it, or leaves its last place out
    before = np.where(np.concatenate(([False], of[1:] == of[:-1])), np.concatenate(([0], at[:-1])), -1)
    first = np.clip(np.maximum(before + 1, at - window + 1) - begin, 0, window)
    after = np.clip(at + 1 - begin, 0, window)
    return np.cumsum(np.bincount(first, minlength=window + 1) - np.bincount(after, minlength=window + 1))[:window]


def block_matches(words: Words, templates: Templates) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(row, first word, template, containments) where a template is held by any of the blocks that begin there and after.

    There is one containment for each word that a block may begin with, 0 below the threshold; a block begins in one
    item only per template.
    """
    index = templates.prefix_index()
    ranks = np.asarray(pc.index_in(words.values, pa.array(templates.words, pa.large_string())).fill_null(-1))
    known = np.flatnonzero(ranks >= 0)
    if not len(known):
        return
    row, place, rank, window = words.row[known], words.place[known], ranks[known], templates.block // 2 * 2
    # every word lies in the span of its block and in the one before
    key = np.concatenate([np.stack([row, place // window - back, rank], 1)[place // window >= back] for back in (0, 1)])
    key = np.unique(key, axis=0)
    edges = np.flatnonzero((key[1:, :2] != key[:-1, :2]).any(1)) + 1
    starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(key)]))
    least = min(templates.needed)
    prefix = np.zeros(len(templates.words), bool)
    prefix[list(index)] = True
    has_prefix = np.add.reduceat(prefix[key[:, 2]].astype(np.int64), starts) > 0
    members = np.zeros((len(templates.sets), len(templates.words)), bool)
    for t, one in enumerate(templates.sets):
        members[t, list(one)] = True
    row_starts = np.searchsorted(row, np.arange(len(words.counts) + 1))
    for a, b in zip(starts[has_prefix & (ends - starts >= least)].tolist(), ends[has_prefix & (ends - starts >= least)].tolist()):
        for t, _ in join_block(key[a:b, 2].tolist(), templates, index):
            r, begin = int(key[a, 0]), int(key[a, 1]) * window
            low, high = row_starts[r] + np.searchsorted(place[row_starts[r] : row_starts[r + 1]], (begin, begin + 2 * window))
            own = members[t][rank[low:high]]
            counts = sliding_counts(place[low:high][own], rank[low:high][own], begin, window)
            held = np.where(counts >= templates.needed[t], counts / len(templates.sets[t]), 0.0)
            if held.any():
                yield r, begin, t, held


def runs_of(found: list[tuple[int, int, np.ndarray]], templates: Templates) -> list[dict]:
    """Blocks of one text as runs: from which to which word a block may begin and hold the template, and its best share."""
    result: list[dict] = []
    for t, begin, held in sorted(found, key=lambda x: x[:2]):
        inside = np.concatenate(([False], held > 0, [False]))
        for a, b in np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2).tolist():
            last, best = result[-1] if result else {}, float(held[a:b].max())
            if a == 0 and last.get("template") == t and last["last_start"] == begin - 1:
                last |= {"last_start": begin + b - 1, "containment": max(last["containment"], best)}
            else:
                result.append({"template": t, "first_start": begin + a, "last_start": begin + b - 1, "label": templates.labels[t], "containment": best})
    return result


SCHEMA = (
    "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "blocks array<struct<first_word: long, label: string, containment: double>>, "
    "runs array<struct<first_start: long, last_start: long, label: string, containment: double>>"
)


def scan_licenses(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.9,
    block: int = 64,
) -> DataFrame:
    """One row per input row: ``id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks, runs``.

    ``n_base`` counts all places of the phrases, ``first_word`` and ``last_word`` are the smallest and largest start
    (null without any), ``labels`` joins the phrases' labels and those of templates contained in any block, ``runs``
    lists all these blocks, those that begin at neighbouring words as one run with its best containment, and ``blocks``
    lists those of them that begin at a whole number of half blocks. ``score`` is 1 with a phrase, else the best
    containment of all blocks, else 0. A block is at least twice the longest template. Null text counts as
    empty and has no words; a null id stays; rows that repeat give equal rows; an empty table gives an empty result;
    other columns are ignored.
    """
    ready = Templates.ordered(templates, template_counts(df, templates, text_col), threshold, block)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 8 << 20):
            words = words_of(strings(batch["text"]))
            n = batch.num_rows
            places: list[list[int]] = [[] for _ in range(n)]
            base: list[set[str]] = [set() for _ in range(n)]
            for label, _, starts in phrase_places(words, phrases):
                for r, p in zip(words.row[starts].tolist(), words.place[starts].tolist()):
                    places[r].append(p)
                    base[r].add(label)
            blocks: list[list[dict]] = [[] for _ in range(n)]
            found: list[list[tuple]] = [[] for _ in range(n)]
            half = ready.block // 2
            for r, begin, t, held in block_matches(words, ready):
                found[r].append((t, begin, held))
                for at in range(0, len(held), half):
                    if held[at]:
                        blocks[r].append({"first_word": begin + at, "label": ready.labels[t], "containment": float(held[at])})
            runs = [runs_of(f, ready) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(words.counts.astype(np.int64)),
                    pa.array([len(p) for p in places], pa.int64()),
                    pa.array([min(p, default=None) for p in places], pa.int64()),
                    pa.array([max(p, default=None) for p in places], pa.int64()),
                    pa.array([",".join(sorted(b)) for b in base]),
                    pa.array([",".join(sorted(b | {x["label"] for x in m})) for b, m in zip(base, runs)]),
                    pa.array([1.0 if b else max((x["containment"] for x in m), default=0.0) for b, m in zip(base, runs)], pa.float64()),
                    pa.array(blocks, pa.list_(pa.struct([("first_word", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))),
                    pa.array(runs, pa.list_(pa.struct([("first_start", pa.int64()), ("last_start", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))),
                ],
                ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks", "runs"],
            )

    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(work, SCHEMA).withColumnRenamed("id", id_col)
