"""Runs of repeated word sequences, found with suffix trees.

A run is a stretch of consecutive words with smallest period q, at least
``TIMES`` periods and ``SHORTEST`` words long, that no neighbouring word extends.
For every text

1. words that can lie in no run part it into stretches: inside a run every word
   has an equal one within a period, so a word whose nearest equal in its
   stretch is further than a ``TIMES``-th of the stretch away, or which the
   stretch holds fewer than ``TIMES`` times, is outside all runs (repeated a few
   rounds; exact at any number of them). A text without stretches has no runs;
2. Ukkonen's algorithm builds the suffix trees of the stretches and of their
   reversal (stretches are joined by signs of their own, so nothing matches
   across). An Euler tour with a sparse table of minima gives the lowest common
   ancestor of two leaves, hence the longest common extension of two places, in
   constant time;
3. the longest Lyndon word at every place, in the order of the words and in the
   reverse order, is the root of a possible run; it is extended to both
   sides by common extensions. Every run has such a root, so none is missed.

Words are compared by 64-bit hashes inside one text. A block of texts is read
at a time; a tree takes some hundred bytes for each word of a text's stretches.

Defined results: null, empty or blank text has no words and no runs; repeated
rows give equal rows; a null doc_id is left as it is (and never edited by
``planted``); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnscore.llm.common import blocks, find_words, hash_spans, mix, ship, uncollected, utf8

SHORTEST, TIMES = 6, 4
#: Rounds of parting a text into stretches.
ROUNDS = 8

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
DIGEST = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


class SuffixTree:
    """Suffix tree of a list of small integers whose last one occurs once.

    ``ranks``: the place of every suffix in the order of the symbols;
    ``extension``: longest common extensions of arrays of places."""

    def __init__(self, text: list[int], symbols: int):
        self.text, self.symbols = text, symbols
        self._grow()
        self._tour()

    def _grow(self) -> None:
        """Ukkonen: one symbol at a time, from the active point on."""
        text, k, n = self.text, self.symbols, len(self.text)
        start, stop, link, child, leaf = [0], [0], [0], {}, [-1]
        node, edge, length, suffix = 0, 0, 0, 0
        for i, sign in enumerate(text):
            fresh = 0  # the inner node that waits for its suffix link
            while suffix <= i:
                if not length:
                    edge = i
                key = node * k + text[edge]
                to = child.get(key)
                if to is None:
                    child[key] = len(start)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    begin = start[to]
                    size = stop[to] - begin
                    if length >= size:
                        edge += size
                        length -= size
                        node = to
                        continue
                    if text[begin + length] == sign:
                        length += 1
                        if fresh:
                            link[fresh] = node
                        break
                    inner = len(start)
                    start.append(begin)
                    stop.append(begin + length)
                    link.append(0)
                    leaf.append(-1)
                    child[key] = inner
                    start[to] = begin + length
                    child[inner * k + text[begin + length]] = to
                    child[inner * k + sign] = len(start)
                    if fresh:
                        link[fresh] = inner
                    fresh = inner
                start.append(i)
                stop.append(n)
                link.append(0)
                leaf.append(suffix)
                suffix += 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = suffix
        self.start, self.stop, self.leaf, self.child = start, stop, leaf, child

    def _tour(self) -> None:
        """Euler tour: the text depths of the nodes in the order of walking along
        every edge down and up, and where each leaf is met."""
        start, stop, leaf, symbols = self.start, self.stop, self.leaf, self.symbols
        below = self.below = [[] if x < 0 else None for x in leaf]  # children by their first symbol
        child = self.child
        for key in sorted(child):
            below[key // symbols].append(child[key])
        first = [0] * len(self.text)
        depths = [0]
        todo, seen = [], depths.append
        for c in reversed(below[0]):  # behind every child its parent's depth, as ~depth
            todo += (~0, c)
        while todo:
            node = todo.pop()
            if node < 0:
                seen(~node)
                continue
            depth = depths[-1] + stop[node] - start[node]
            children = below[node]
            if children is None:
                first[leaf[node]] = len(depths)
            else:
                for c in reversed(children):
                    todo += (~depth, c)
            seen(depth)
        self.first = np.array(first, np.int64)
        least = [np.array(depths, np.int32)]
        while 2 << (len(least) - 1) <= len(depths):
            half, last = 1 << (len(least) - 1), least[-1]
            wide = last.copy()  # the tail of a row is never asked for
            np.minimum(last[:-half], last[half:], out=wide[:-half])
            least.append(wide)
        self.least = np.stack(least)

    def ranks(self) -> list[int]:
        """The place of every suffix in the order of the symbols."""
        out = np.empty(len(self.first), np.int64)
        out[np.argsort(self.first)] = np.arange(len(out))
        return out.tolist()

    def ranks_down(self, low: int) -> list[int]:
        """The same when the symbols from ``low`` on are in reverse order (the
        smaller ones stay in front)."""
        out, todo, leaf, below, nth = [0] * len(self.text), [0], self.leaf, self.below, 0
        text, start = self.text, self.start
        while todo:
            node = todo.pop()
            children = below[node]
            if children is None:
                out[leaf[node]] = nth
                nth += 1
                continue
            todo += children
            if text[start[children[0]]] < low:  # to the top of the stack
                small = sum(text[start[c]] < low for c in children)
                todo[-len(children):] = children[small:] + children[:small]
        return out

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``i`` and ``j`` (i != j)."""
        a, b = self.first[i], self.first[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        return np.minimum(self.least[level, a], self.least[level, b - (1 << level) + 1]).astype(np.int64)


def lyndon_ends(rank: list[int]) -> np.ndarray:
    """End of the longest Lyndon word at every place: the next smaller suffix."""
    out, open_ = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return np.array(out, np.int64)


def stretches(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``words`` that may lie in a run, and the number of the stretch
    of each; ``texts``: the text of every word."""
    at = np.arange(len(words))
    part = texts
    for _ in range(ROUNDS):
        if not len(at):
            break
        head = np.ones(len(at), bool)
        head[1:] = (at[1:] != at[:-1] + 1) | (texts[at[1:]] != texts[at[:-1]])
        part = np.cumsum(head) - 1
        size = np.bincount(part)
        w = mix(words[at] + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(w, kind="stable")  # equal words of a stretch stay in text order
        same = np.zeros(len(at) + 1, bool)
        same[1:-1] = w[order[1:]] == w[order[:-1]]
        far = np.iinfo(np.int64).max // 8
        step = np.full(len(at) + 1, far)
        step[1:-1][same[1:-1]] = np.diff(at[order])[same[1:-1]]
        group = np.cumsum(~same[:-1]) - 1
        near = np.minimum(step[:-1], step[1:])
        room = size[part[order]]
        good = (TIMES * near <= room) & (np.bincount(group)[group] >= TIMES) & (room >= SHORTEST)
        keep = np.zeros(len(at), bool)
        keep[order[good]] = True
        if keep.all():
            break
        at, part = at[keep], part[keep]
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (texts[at[1:]] != texts[at[:-1]])
    return at, np.cumsum(head) - 1


@uncollected()
def runs_of(words: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of one text's stretches: indices into
    ``words``, sorted by start and period; ``parts``: the stretch of every word."""
    _, signs = np.unique(words, return_inverse=True)
    ends = np.flatnonzero(np.diff(parts, append=parts[-1] + 1))
    # a sign of its own behind each stretch, below all words: its number counts down from there
    cuts = len(ends)
    text = np.insert(signs + cuts, ends + 1, np.arange(cuts))
    place = np.insert(np.arange(len(words)), ends + 1, -1)
    symbols = cuts + int(signs.max()) + 2
    n = len(text)
    tree = SuffixTree(text.tolist(), symbols)
    # the reversal ends with one more sign, so its last one occurs once
    back = SuffixTree([*text[::-1].tolist(), symbols - 1], symbols)
    found = []
    real = np.flatnonzero(place >= 0)
    for ranks in (tree.ranks(), tree.ranks_down(cuts)):  # parting signs stay below the words
        end = lyndon_ends(ranks)[real]
        i, j = real[end < n], end[end < n]
        period = j - i
        right = tree.extension(i, j)
        left = np.zeros(len(i), np.int64)
        inner = i > 0
        left[inner] = back.extension(n - i[inner], n - j[inner])
        length = left + period + right
        long = length >= np.maximum(SHORTEST, TIMES * period)
        found.append(np.stack([place[(i - left)[long]], period[long], length[long]], axis=1))
    start, period, length = np.unique(np.concatenate(found), axis=0).T
    return start, length, period


def block_runs(words: np.ndarray, rows: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs (start, length, period) of every text that has some; ``rows``: the
    word offsets of the texts."""
    texts = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    at, part = stretches(words, texts)
    out = {}
    if len(at):
        bounds = np.flatnonzero(np.diff(texts[at], prepend=-1))
        for a, z in zip(bounds, [*bounds[1:], len(at)]):
            start, length, period = runs_of(words[at[a:z]], part[a:z])
            if len(start):
                d = int(texts[at[a]])
                out[d] = (at[a:z][start] - rows[d], length, period)
    return out


def dropped(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def planted(doc: int | None, n: int) -> np.ndarray | None:
    """The places that the words of the contract's edited texts come from: those of
    every tenth doc_id end in a run. None where the text stays."""
    if doc is None or not n:
        return None
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def _texts(batch, edit):
    """(doc_id, words as bytes, runs) for every row of a batch."""
    column = batch.column("text")
    data, offsets = utf8(column)
    starts, ends, rows = find_words(data, offsets)
    ids = batch.column("doc_id").to_pylist()
    order = [edit(d, int(n)) if edit else None for d, n in zip(ids, np.diff(rows))]
    source = np.arange(len(starts))
    for k, o in enumerate(order):
        if o is not None:
            source[rows[k]:rows[k + 1]] = rows[k] + o
    words = hash_spans(data, starts, ends)[source]
    runs = block_runs(words, rows)
    raw = data.tobytes()
    for k, d in enumerate(ids):
        own = raw[offsets[k]:offsets[k + 1]].split()  # at the bytes that part words here
        if order[k] is not None:
            own = [own[i] for i in order[k].tolist()]
        found = runs.get(k)
        kept = own
        if found:
            kept = [w for w, gone in zip(own, dropped(len(own), *found).tolist()) if not gone]
        yield d, len(own), found or ((), (), ()), b" ".join(kept)


def collapse(docs: DataFrame, edit=None) -> DataFrame:
    """RUNS for every row of ``docs`` (doc_id, text): all runs, by start and
    period, and the text with every run cut to its first period.

    ``edit(doc_id, n)``: the places that a text's words are taken from, or None."""
    ship(docs.sparkSession)
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])),
             pa.string()]

    def task(batches):
        for b in blocks(batches):
            out = [(d, n, [dict(zip(("start", "length", "period"), map(int, r))) for r in zip(*runs)], kept.decode())
                   for d, n, runs, kept in _texts(b, edit)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(task, RUNS)


def digest(docs: DataFrame, edit=None) -> DataFrame:
    """DIGEST for every row of ``docs`` (doc_id, text): the longest run (ties: the
    first, then the shortest period) and digests of the runs and the collapsed text."""
    ship(docs.sparkSession)
    names = [c.split()[0] for c in DIGEST.split(", ")]

    def task(batches):
        for b in blocks(batches):
            out = []
            for d, _, runs, kept in _texts(b, edit):
                rows = [tuple(map(int, r)) for r in zip(*runs)]
                start, length, period = min(rows, key=lambda r: (-r[1], r[0], r[2])) if rows else (None, None, None)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in rows)
                out.append((d, len(rows), start, length, period, 1000 * length // period if rows else None,
                            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k < 6 else pa.string()) for k, c in enumerate(zip(*out))], names=names)

    return docs.select("doc_id", "text").mapInArrow(task, DIGEST)


def op11(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), planted)
