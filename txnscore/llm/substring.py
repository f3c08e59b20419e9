"""Substring deduplication with suffix automata of reference passages.

A word that lies in a window of ``WINDOW`` words which also starts in a document
with a smaller doc_id is removed; windows are judged on the input.

1. Every window has an anchor, the least hash of its ``SEED``-word runs: equal
   windows have equal anchors. A shuffle by anchor finds those of two or more
   documents and the least document of each, its pivot. A block of texts sends
   one row per anchor, however many of its documents share it.
2. Runs of windows with shared anchors become segments: of a pivot's own, the
   reference passages; of the others, texts to be held against their pivot.
   A pivot that many documents meet is dealt to several groups.
3. For each pivot a suffix automaton of its passages is built and the segments
   stream through it. The matching statistics (longest match ending at each
   word) give the windows that the pivot holds, to be removed.
4. The exact way for the rest: a window that its pivot lacks is lacked by the
   pivot in every document, so these windows are complete among themselves; the
   least document of each is found by a grouped minimum on its 128-bit hash.

The reference side (all repeated text) has no bound, so a passage is sent to
the documents that need it instead of being broadcast to all.

Defined results: null or empty text has no words; fewer words than a window
lose nothing; rows that repeat a doc_id are judged each against smaller ids
only; a null doc_id neither loses words nor makes others lose any; an empty
table gives no rows; extra columns are ignored; long texts are read whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from txnscore.llm.common import blocks, find_words, hash_ngrams, hash_spans, ship, signed, utf8, written
from txnscore.llm.partenum import SIGNED, _batch, _least, meet

WINDOW, SEED = 13, 5
#: Segments held against one automaton before its pivot is dealt to one more group.
GROUP_SEGMENTS = 512

SEGMENT = "pivot long, doc long, row long, start long, words string"


class Automaton:
    """Suffix automaton over words; separate passages never join."""

    def __init__(self, passages: list[list[str]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        for words in passages:
            last = 0
            for w in words:
                last = self._extend(last, w)

    def _extend(self, last: int, w: str) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(w)
        if q is not None:  # known from an earlier passage
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: str, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        return clone

    def statistics(self, words: list[str]) -> list[int]:
        """Length of the longest known run of words that ends at each word."""
        nxt, link, length = self.next, self.link, self.length
        out, at, n = [], 0, 0
        for w in words:
            to = nxt[at].get(w)
            while to is None and at:
                at = link[at]
                n = length[at]
                to = nxt[at].get(w)
            if to is None:
                n = 0
            else:
                at, n = to, n + 1
            out.append(n)
        return out


def _windows(column: pa.Array):
    """Words (data, starts, ends, rows) and each window's first word and anchor."""
    data, offsets = utf8(column)
    starts, ends, rows = find_words(data, offsets)
    words = hash_spans(data, starts, ends)
    seeds, at = hash_ngrams(words, rows, SEED)
    of_word = np.zeros(len(words) + 1, np.int64)  # seed index by first word
    of_word[at] = np.arange(len(at))
    _, first = hash_ngrams(words, rows, WINDOW)
    anchor = seeds[of_word[first]] if len(first) else np.zeros(0, np.uint64)
    for k in range(1, WINDOW - SEED + 1):
        anchor = np.minimum(anchor, seeds[of_word[first] + k])
    return (data, starts, ends, rows), words, first, signed(anchor)


def anchors(docs: DataFrame) -> DataFrame:
    """Rows of SIGNED: the distinct anchors of every document. sig2 is 0 for the
    least document of the block with an anchor (size -1: others share it), else 1."""

    def task(batches):
        for b in blocks(batches):
            ids = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            (_, _, _, rows), _, first, anchor = _windows(b.column("text"))
            doc = ids[np.searchsorted(rows, first, "right") - 1]
            order = np.lexsort((doc, anchor))
            a, d = anchor[order], doc[order]
            once = np.ones(len(a), bool)
            once[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
            a, d = a[once], d[once]
            _, pivot = _least(a, np.zeros(len(a), np.int64), d)
            lead = d == pivot
            followed = np.zeros(len(a), np.int64)
            followed[:-1][lead[:-1] & ~lead[1:]] = -1
            for at in range(0, len(a), 100_000):
                p = slice(at, at + 100_000)
                yield _batch(a[p], (~lead[p]).astype(np.int64), d[p], pivot[p], followed[p])

    return docs.select("doc_id", "text").mapInArrow(task, SIGNED)


def marks(met: DataFrame) -> DataFrame:
    """(doc_id, marks): the shared anchors of each document with their pivots."""
    heads = met.where("sig2 = 0").select("sig", F.col("doc").alias("lead"), F.col("pivot").alias("least"))
    rest = met.where("sig2 = 1").select("sig", "doc", F.col("pivot").alias("lead"))
    rest = rest.join(heads.where("lead != least"), ["sig", "lead"], "left").select(
        "sig", "doc", F.coalesce("least", "lead").alias("pivot"))
    rows = met.where("sig2 = 0").select("sig", "doc", "pivot").unionByName(rest)
    return rows.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("sig", "pivot")).alias("marks"))


def segments(marked: DataFrame) -> DataFrame:
    """Rows of SEGMENT from documents with marks: the longest runs of words whose
    windows have one pivot (doc = pivot: a reference passage)."""

    def task(batches):
        for b in blocks(batches):
            (data, starts, ends, rows), _, first, anchor = _windows(b.column("text"))
            list_at = np.concatenate([[0], np.cumsum(b.column("marks").value_lengths().to_numpy(zero_copy_only=False))])
            flat = b.column("marks").flatten()
            sig, least = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            out = []
            for d, (doc, row) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("row").to_pylist())):
                lo, hi = np.searchsorted(first, [rows[d], rows[d + 1]])
                own, own_pivot = sig[list_at[d]:list_at[d + 1]], least[list_at[d]:list_at[d + 1]]
                if lo == hi or not len(own):
                    continue
                order = np.argsort(own)
                own, own_pivot = own[order], own_pivot[order]
                at = np.minimum(np.searchsorted(own, anchor[lo:hi]), len(own) - 1)
                hit = own[at] == anchor[lo:hi]
                pivot = own_pivot[at]
                cut = np.flatnonzero(np.concatenate(
                    [[True], (hit[1:] != hit[:-1]) | (hit[1:] & (pivot[1:] != pivot[:-1])), [True]]))
                for x, y in zip(cut, cut[1:]):
                    if hit[x]:
                        w = slice(first[lo + x], first[lo + y - 1] + WINDOW)
                        text = b" ".join([data[s:e].tobytes() for s, e in zip(starts[w], ends[w])])
                        out.append((int(pivot[x]), doc, row, int(first[lo + x] - rows[d]), text.decode("utf-8")))
            yield _rows(out, SEGMENT)

    return marked.select("doc_id", "row", "text", "marks").mapInArrow(task, SEGMENT)


def _rows(out: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    kind = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    columns = list(zip(*out)) if out else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kind[k]) for c, k in zip(columns, kinds)], names=names)


FOUND = "doc long, row long, at long, matched boolean, h1 long, h2 long"


def match(cut: DataFrame) -> DataFrame:
    """Every window of the segments held against their pivot's automaton: matched,
    or its hash (rows of FOUND; ``at``: the window's first word)."""
    need = cut.where("doc != pivot").groupBy("pivot").agg(F.count(F.lit(1)).alias("n"))
    need = written(need.select("pivot", (F.floor(F.col("n") / GROUP_SEGMENTS) + 1).cast("long").alias("groups")),
                   "substring-groups")
    dealt = cut.join(need, "pivot")
    passages = dealt.where("doc = pivot").select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("groups") - 1)).alias("salt")).drop("groups")
    texts = dealt.where("doc != pivot").withColumn(
        "salt", F.pmod(F.xxhash64("doc", "start"), F.col("groups"))).drop("groups")
    both = passages.unionByName(texts).withColumn("side", (F.col("doc") != F.col("pivot")).cast("int"))
    both = both.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "side")

    def task(batches):
        group, held, automaton, out = None, [], None, []
        for b in batches:
            for pivot, salt, side, doc, row, start, text in zip(*(c.to_pylist() for c in b.columns)):
                if group != (pivot, salt):
                    group, held, automaton = (pivot, salt), [], None
                words = text.split(" ")
                if not side:
                    held.append(words)
                    continue
                if automaton is None:
                    automaton = Automaton(held)
                    held = []
                stats = automaton.statistics(words)
                lost = [i for i in range(WINDOW - 1, len(words)) if stats[i] < WINDOW]
                gone = np.ones(len(words), bool)
                gone[:WINDOW - 1] = False
                gone[lost] = False
                # matched windows in runs: a row for the first and the last of each
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                for x, y in zip(edge[::2], edge[1::2]):
                    out.append((doc, row, start + int(x) - WINDOW + 1, True, start + int(y) - 1, None))
                for i in lost:
                    at = i - WINDOW + 1
                    h = hashlib.blake2b(" ".join(words[at:i + 1]).encode(), digest_size=16).digest()
                    out.append((doc, row, start + at, False, int.from_bytes(h[:8], "little", signed=True),
                                int.from_bytes(h[8:], "little", signed=True)))
                if len(out) > 20_000:
                    yield _rows(out, FOUND)
                    out = []
        yield _rows(out, FOUND)

    return both.select("pivot", "salt", "side", "doc", "row", "start", "words").mapInArrow(task, FOUND)


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, row, spans): word spans to remove, first and last word; ``row`` is
    the text's hash, which tells rows with one doc_id apart."""
    ship(docs.sparkSession)
    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text", F.xxhash64("text").alias("row"))
    met = written(meet(anchors(known)), "substring-met")
    cut = written(segments(known.join(marks(met), "doc_id")), "substring-segments")
    found = written(match(cut), "substring-found")
    lost = found.where("not matched")
    first = written(lost.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                    .where("first != last").select("h1", "h2", "first"), "substring-first")
    again = lost.join(first, ["h1", "h2"]).where("doc > first").select("doc", "row", "at", (F.col("at") + WINDOW - 1).alias("last"))
    sure = found.where("matched").select("doc", "row", "at", F.col("h1").alias("last"))
    return sure.unionByName(again).groupBy(F.col("doc").alias("doc_id"), "row").agg(
        F.collect_list(F.struct("at", "last")).alias("spans"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``rest`` (a struct), and of its text: doc_id, kept
    (without the removed spans), n_words, n_removed and kept_sha256, the digest of
    the kept words."""
    gone = written(spans(docs), "substring-spans")
    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text", F.struct("*").alias("rest"))
    rows = rows.join(gone, ["doc_id", "row"], "left")
    extra = "doc_id long, kept string, n_words long, n_removed long, kept_sha256 string"

    def task(batches):
        for b in blocks(batches):
            data, offsets = utf8(b.column("text"))
            starts, ends, words = find_words(data, offsets)
            texts, total, removed, digests = [], [], [], []
            for d, cut in enumerate(b.column("spans").to_pylist()):
                s, e = starts[words[d]:words[d + 1]] - offsets[d], ends[words[d]:words[d + 1]] - offsets[d]
                keep = np.ones(len(s), bool)
                for c in cut or ():
                    keep[c["at"]:c["last"] + 1] = False
                text = data[offsets[d]:offsets[d + 1]].tobytes()
                digests.append(hashlib.sha256(
                    b" ".join([text[x:y] for x, y in zip(s[keep].tolist(), e[keep].tolist())])).hexdigest())
                if not keep.all():
                    # a removed word goes with the space behind it, up to the next word
                    left, at = [], 0
                    follow = np.append(s[1:], len(text))
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], (~keep).astype(np.int8), [0]])))
                    for x, y in zip(edge[::2], edge[1::2]):
                        left.append(text[at:s[x]])
                        at = follow[y - 1]
                    text = b"".join([*left, text[at:]])
                texts.append(text.decode("utf-8"))
                total.append(len(s))
                removed.append(int((~keep).sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column("rest"), b.column("doc_id"), pa.array(texts, pa.string()), pa.array(total, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=["rest", *(c.split()[0] for c in extra.split(", "))])

    kinds = {"long": LongType(), "string": StringType()}
    schema = StructType([StructField("rest", docs.schema), *(StructField(n, kinds[k]) for n, k in map(str.split, extra.split(", ")))])
    return rows.select("doc_id", "text", "spans", "rest").mapInArrow(task, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their texts deduplicated (n_chars follows); a row
    that loses all its words goes."""
    done = deduplicate(docs).where("n_removed < n_words or n_words = 0")
    new = {"text": F.when(F.col("rest.text").isNotNull(), F.col("kept")), "n_chars": F.length("kept").cast("long")}
    return done.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return deduplicate(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = """
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
w as (
  select r, doc_id, i, list_aggregate(words[i:i + 12], 'string_agg', ' ') as win
  from (select r, doc_id, words, unnest(range(1, len(words) - 11)) as i from d where len(words) >= 13)),
f as (select r, i from (select r, i, doc_id, min(doc_id) over (partition by win) as first from w) where doc_id > first),
g as (select distinct r, unnest(range(i, i + 13)) as p from f),
k as (select r, list(p) as gone from g group by r)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(case when gone is null then words else
    list_filter(words, lambda x, i: not list_contains(gone, i)) end, ' '), '')) as kept_sha256
from d left join k using (r)
"""
