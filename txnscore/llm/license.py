"""License scans: an exact set-similarity join of text blocks with templates.

A template is the word set of a license notice; a block is ``BLOCK_WORDS``
consecutive words of a text, a new one every ``BLOCK_WORDS / 2`` words (a text with
fewer words is one block), so a notice of half a block lies whole in some block.
A block matches a template when it holds at least ``PERCENT`` hundredths of the
template's distinct words. Template words are put in one global order, the
rarest of the corpus first (first pass: one count per template word). Then each
block is joined with the templates by the filters of an exact join, with
``need`` for the least number of shared words:

* prefix: two sets that share ``need`` words share one among the first
  ``size - need + 1`` of either, so only the templates whose prefix holds a word
  of the block's prefix are looked at (an inverted list of prefix words);
* length: the block holds ``need`` words of templates at all;
* position: behind the first shared word both still have enough words left.

What passes is counted word by word. No matching block is lost. Besides, the
places where a short phrase's words stand consecutively are found (``PHRASES``).

The templates are a parameter; their words are sent to every task and may be
``MOST_WORDS`` at most. Texts are read whole, a block of texts at a time; a
document's blocks stay in its row, so the only shuffle is that of the counts.

Defined results: null, empty or blank text has no words, places or labels and
score 0; repeated rows give equal rows; the order of equally rare words is that
of the words themselves; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.llm.common import blocks, find_words, hash_spans, lower_ascii, ship, utf8

BLOCK_WORDS, PERCENT, MOST_WORDS = 64, 90, 50_000

#: Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Sentences of public license notices, each with the label it stands for.
TEMPLATES = [
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("artistic", "under the terms of the Artistic License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc0", "waived all copyright and related or neighboring rights to this work"),
    ("epl", "made available under the terms of the Eclipse Public License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "redistribute it and/or modify it under the terms of the GNU General Public License as published by"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided as-is, without any express or implied warranty"),
]

#: Bytes that part words: all ASCII but digits and lower-case letters (after lower-casing).
GAPS = np.ones(256, bool)
GAPS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

MATCHES = "doc_id long, block long, first long, template int, label string, shared int, size int"
LABELS = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")


def _column_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, lower-cased, and the rows' word offsets."""
    data, offsets = utf8(column)
    data = lower_ascii(data)
    starts, ends, rows = find_words(data, offsets, GAPS)
    return hash_spans(data, starts, ends), rows


def template_words(text: str) -> list[str]:
    """The distinct words of a template, sorted."""
    data, offsets = utf8(pa.array([text], pa.large_string()))
    data = lower_ascii(data)
    starts, ends, _ = find_words(data, offsets, GAPS)
    raw = data.tobytes()
    return sorted({raw[a:z].decode() for a, z in zip(starts, ends)})


def _hashes(words: list[str]) -> np.ndarray:
    return _column_words(pa.array(words, pa.large_string()))[0]


class Lookup:
    """Numbers of known hashes; -1 for any other."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)


def vocabulary(templates) -> list[str]:
    out = sorted({w for _, t in templates for w in template_words(t)})
    if len(out) > MOST_WORDS or not out:
        raise ValueError(f"templates hold {len(out)} words; between 1 and {MOST_WORDS} can be sent to every task")
    return out


def word_counts(docs: DataFrame, words: list[str]) -> list[int]:
    """How often each of ``words`` stands in all texts (at most one row a word comes back)."""
    ship(docs.sparkSession)
    hashes = _hashes(words)

    def task(batches):
        known, total = Lookup(hashes), np.zeros(len(words), np.int64)
        for b in blocks(batches):
            nth = known.find(_column_words(b.column("text"))[0])
            total += np.bincount(nth[nth >= 0], minlength=len(words))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["nth", "n"])

    found = docs.select("text").mapInArrow(task, "nth long, n long").groupBy("nth").agg(F.sum("n").alias("n")).collect()
    counts = dict.fromkeys(range(len(words)), 0) | {r["nth"]: r["n"] for r in found}
    return [counts[k] for k in range(len(words))]


class Join:
    """Templates prepared for the join: ``ranked`` are all their words, rarest first."""

    def __init__(self, templates, ranked: list[str], percent: int):
        place = {w: k for k, w in enumerate(ranked)}
        self.known = Lookup(_hashes(ranked))
        self.sets = [np.array(sorted(place[w] for w in template_words(t)), np.int64) for _, t in templates]
        self.size = np.array([len(s) for s in self.sets])
        self.need = -(-percent * self.size // 100)  # least number of shared words
        self.least = int(self.need.min())
        self.holds = np.zeros((len(ranked), len(templates)), bool)
        for t, s in enumerate(self.sets):
            self.holds[s, t] = True
        # inverted list of the prefix words: for each word its templates and the word's place there
        prefix = [(int(w), t, at) for t, s in enumerate(self.sets) for at, w in enumerate(s[:self.size[t] - self.need[t] + 1])]
        prefix.sort()
        word, self.list_template, self.list_at = (np.array(c, np.int64) for c in zip(*prefix))
        self.list_from = np.searchsorted(word, np.arange(len(ranked) + 1))

    def blocks_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of blocks of each text, and the number of the first one."""
        half = BLOCK_WORDS // 2
        n = np.diff(rows)
        count = np.where(n > 0, np.maximum(-(-(n - half) // half), 1), 0)
        return count, np.concatenate([[0], np.cumsum(count)])

    def match(self, nth: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block, template, shared words) of all matching pairs; ``nth``: the rank
        of every word of the texts, -1 for other words."""
        half = BLOCK_WORDS // 2
        count, first = self.blocks_of(rows)
        at = np.flatnonzero(nth >= 0)
        text = np.searchsorted(rows, at, "right") - 1
        own = (at - rows[text]) // half  # a word lies in this block and in the one before
        late = np.minimum(own, count[text] - 1)
        block = np.concatenate([first[text] + late, (first[text] + own - 1)[own > 0]])
        word = np.concatenate([nth[at], nth[at][own > 0]])
        pair = np.unique(block * len(self.holds) + word)  # the block's set, rarest word first
        block, word = pair // len(self.holds), pair % len(self.holds)
        begin = np.flatnonzero(np.diff(block, prepend=-1))
        size = np.diff(np.append(begin, len(block)))
        number = np.repeat(np.arange(len(begin)), size)
        place, size = np.arange(len(block)) - begin[number], size[number]
        # prefix of the block, as long as the least demanding template asks, then the inverted lists
        head = np.flatnonzero(place <= size - self.least)
        times = np.diff(self.list_from)[word[head]]
        source = np.repeat(head, times)
        slot = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.list_from[word[head]], times)
        template, there = self.list_template[slot], self.list_at[slot]
        need = self.need[template]
        # length, and positions behind the shared word
        good = (size[source] >= need) & (1 + np.minimum(size[source] - place[source], self.size[template] - there) - 1 >= need)
        found = np.unique(number[source[good]] * len(self.sets) + template[good])
        group, template = found // len(self.sets), found % len(self.sets)
        # verification: the shared words one by one
        length = np.diff(np.append(begin, len(block)))[group]
        each = np.repeat(np.arange(len(group)), length)
        inside = np.arange(len(each)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begin[group], length)
        shared = np.bincount(each[self.holds[word[inside], template[each]]], minlength=len(group))
        good = shared >= self.need[template]
        return block[begin[group[good]]], template[good], shared[good]


def prepared(docs: DataFrame, templates, percent: int) -> Join:
    words = vocabulary(templates)
    counts = word_counts(docs, words)
    return Join(templates, [w for _, w in sorted(zip(counts, words))], percent)


def matches(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """MATCHES: every block and template that meet the threshold; ``block`` counts
    from 0 in its text, ``first`` is its first word, ``shared`` of the template's ``size``
    distinct words stand in it."""
    join = prepared(docs, templates, percent)
    names = pa.array([label for label, _ in templates])

    def task(batches):
        for b in blocks(batches):
            words, rows = _column_words(b.column("text"))
            block, template, shared = join.match(join.known.find(words), rows)
            first = join.blocks_of(rows)[1]
            text = np.searchsorted(first, block, "right") - 1
            inside = block - first[text]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(text)), pa.array(inside), pa.array(inside * (BLOCK_WORDS // 2)),
                 pa.array(template, pa.int32()), names.take(pa.array(template)), pa.array(shared, pa.int32()),
                 pa.array(join.size[template], pa.int32())],
                names=[c.split()[0] for c in MATCHES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(task, MATCHES)


def places(words: np.ndarray, rows: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """The word numbers at which ``phrase`` (hashes) stands inside one text."""
    at = np.flatnonzero(words == phrase[0])
    for k in range(1, len(phrase)):
        at = at[at + k < len(words)]
        at = at[words[at + k] == phrase[k]]
    ends = rows[np.searchsorted(rows, at, "right")]
    return at[at + len(phrase) <= ends]


def labelled(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT, phrases=PHRASES) -> DataFrame:
    """LABELS for every row of ``docs`` (doc_id, text). score: 1 where a phrase
    stands, else the highest share of a template's words in a matching block, else 0."""
    join = prepared(docs, templates, percent)
    wanted = [(_hashes(p.split()), label) for p, label in phrases.items()]

    def task(batches):
        for b in blocks(batches):
            words, rows = _column_words(b.column("text"))
            n = b.num_rows
            base, own = [set() for _ in range(n)], {}
            count, first, last = np.zeros(n, np.int64), np.full(n, 1 << 62), np.full(n, -1)
            for phrase, label in wanted:
                at = places(words, rows, phrase)
                text = np.searchsorted(rows, at, "right") - 1
                count += np.bincount(text, minlength=n)
                np.minimum.at(first, text, at - rows[text])
                np.maximum.at(last, text, at - rows[text])
                for d in np.unique(text).tolist():
                    base[d].add(label)
            block, template, shared = join.match(join.known.find(words), rows)
            text = np.searchsorted(join.blocks_of(rows)[1], block, "right") - 1
            score = np.zeros(n)
            np.maximum.at(score, text, shared / join.size[template])
            score[count > 0] = 1.0
            for d, t in zip(text.tolist(), template.tolist()):
                own.setdefault(d, set()).add(templates[t][0])
            none = count == 0
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(rows)), pa.array(count), pa.array(first, mask=none),
                 pa.array(last, mask=none), pa.array([",".join(sorted(s)) for s in base], pa.string()),
                 pa.array([",".join(sorted(s | own.get(d, set()))) for d, s in enumerate(base)], pa.string()),
                 pa.array(score)],
                names=[c.split()[0] for c in LABELS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(task, LABELS)


def op12(spark, sf_dir: str) -> DataFrame:
    return labelled(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    """The same rows by comparing every block with every template."""
    quote = lambda w: "'" + w.replace("'", "''") + "'"
    listed = ", ".join(f"({quote(label)}, [{', '.join(map(quote, template_words(t)))}])" for label, t in TEMPLATES)
    found = " union all ".join(
        f"select doc_id, i - 1 as place, {quote(label)} as label from p where "
        + " and ".join(f"words[i + {k}] = {quote(w)}" for k, w in enumerate(phrase.split()))
        for phrase, label in PHRASES.items())
    half = BLOCK_WORDS // 2
    return f"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
p as (select doc_id, words, unnest(range(1, len(words) + 1)) as i from w),
f as ({found}),
b as (select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word,
             string_agg(distinct label, ',' order by label) as base_labels from f group by doc_id),
t(label, words) as (values {listed}),
k as (select doc_id, words[s + 1 : s + {BLOCK_WORDS}] as words from (
        select doc_id, words, unnest(range(0, greatest(len(words) - {half}, 1), {half})) as s from w where len(words) > 0)),
m as (select k.doc_id, t.label, len(list_intersect(k.words, t.words)) / len(t.words)::double as share
      from k, t where 100 * len(list_intersect(k.words, t.words)) >= {PERCENT} * len(t.words)),
a as (select doc_id, label, share from m union all select doc_id, label, 1.0 from f),
l as (select doc_id, string_agg(distinct label, ',' order by label) as labels, max(share) as score from a group by doc_id)
select w.doc_id, cast(len(w.words) as bigint) as n_words, cast(coalesce(b.n_base, 0) as bigint) as n_base,
       cast(b.first_word as bigint) as first_word, cast(b.last_word as bigint) as last_word,
       coalesce(b.base_labels, '') as base_labels, coalesce(l.labels, '') as labels,
       cast(coalesce(l.score, 0) as double) as score
from w left join b using (doc_id) left join l using (doc_id)
"""


SQL = _sql()
