"""Alignment of two tokenizers' tokens over whole texts.

A is a byte-level BPE vocabulary, B a piece vocabulary with byte fallback; both
spell a space and the text in bytes. Byte offsets at which a token of A and one
of B end together cut the text into groups; the two tokens that end there are
linked.

1. Texts are cut into chunks in front of white space behind a sign (no token of
   either vocabulary crosses such a place: ``Pair`` checks the vocabularies) and
   the distinct chunks are encoded by the libraries. A worker keeps at most
   ``CACHE`` encoded chunks of ``CACHE_IDS`` ids; they are only saved work.
2. The ends of all tokens of a block of texts are two sorted lists. Merge path:
   binary searches on the diagonals of their merge matrix part the merging into
   pieces of ``PIECE`` ends each, whatever the lists hold. The pieces are merged at
   once, step by step, and emit the places where both lists hold one end; a
   shared end that falls on the border of two pieces is stitched. Shared ends
   give the groups.
3. Link counts of id pairs are added up per task, then over the corpus. The
   ``HOT`` most frequent pairs (a bounded table) go to every task; links of all
   other pairs are joined with their counts by a shuffle, which no frequent pair
   enters. Tables that are read twice are written to the shared folder.

Defined results: texts that are null, empty or whose bytes either vocabulary
does not spell have no tokens: zeros and an empty digest. Strings of special
tokens are plain text. Repeated rows count each; a null doc_id stays null; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.llm.bpe import _byte_letters
from txnscore.llm.common import blocks, ship, uncollected, written

PIECE = 128
#: Text bytes aligned at a time: a token takes some hundred bytes on the way.
BLOCK = 1 << 19
CACHE, CACHE_IDS = 200_000, 3_000_000
#: Pairs whose counts every task holds; counts of pairs a task holds before it adds them up, or emits them.
HOT, HELD_PAIRS = 200_000, 600_000
#: Texts scored at a time.
SCORED_ROWS = 1000
SPACE_SIGN, LITERAL = "▁", "\n "
#: Fixed value: where byte-level vocabularies part words.
WORDS_A = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

GROUPS = "doc_id long, groups array<struct<a:array<int>,b:array<int>>>"
FOUND = ("row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
         "links array<int>, counts array<long>")


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Pair:
    """Both encoders, and the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {letter: bytes([k]) for k, letter in enumerate(_byte_letters())}
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size_a, self.size_b = max(vocab.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for token, k in vocab.items():
            self.bytes_a[k] = b"".join([byte.get(c, c.encode()) for c in token])
        self.bytes_b = []
        for k in range(self.size_b):
            piece = self.b.id_to_piece(k)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k)
                                else piece.replace(SPACE_SIGN, " ").encode())
        # white space may only begin a token, or follow white space in it
        # merging by ids is merging by rank where the ids follow the order of the merges
        made = [spec["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError("the ids of A do not follow its merges")
        ranks = {self.bytes_a[k]: k for k in spec["model"]["vocab"].values() if k not in {t["id"] for t in spec["added_tokens"]}}
        self.a = tiktoken.Encoding("a", pat_str=WORDS_A, mergeable_ranks=ranks, special_tokens={})
        inner = regex.compile(r"\S |\S\n")
        spelt = [t.decode("utf-8", "replace") for t in [*self.bytes_a, *self.bytes_b]]
        if any(map(inner.search, spelt)) or any("\n" in t and len(t) > 1 for t in spelt[self.size_a:]):
            raise ValueError("a token goes over the place between a sign and white space")
        if self.size_a * self.size_b >= 1 << 31:
            raise ValueError("id pairs do not fit 31 bits")
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # decimal ids with the sign behind them: A ',' and '|', B ',' and ';'
        self.forms = [f"{k}{sign}" for size, signs in ((self.size_a, ",|"), (self.size_b, ",;"))
                      for sign in signs for k in range(size)]
        self.space = [self.b.piece_to_id(SPACE_SIGN)]
        self.wide = regex.compile(r"\s\s")
        self.cut = regex.compile(r"(?<=\S) ")
        self._empty()

    def _empty(self) -> None:
        """Known chunks: their numbers, and the ids of each in one array a side."""
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.at = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.good = np.zeros(0, bool)

    def chunks(self, text: str) -> list[str]:
        """Keys of the parts of " " + text in front of a space, and where no white
        space meets white space in front of a line's end too. A key is its part
        without the space in front; one that begins with a line's end is the part
        itself, or behind LITERAL a part whose space such an end follows."""
        if not text[0].isspace() and not self.wide.search(text):
            return text.replace("\n", " \n").split(" ")
        first, *rest = self.cut.split(" " + text)
        return [LITERAL + " " + c if c[:1] == "\n" else c for c in (first[1:], *rest)]

    def learn(self, new: list[str]) -> None:
        """Encode chunks that are not known yet."""
        spelt = [c.removeprefix(LITERAL) if c[:1] == "\n" else " " + c for c in new]
        a = list(map(self.a.encode_ordinary, spelt))
        # the library puts a space in front, but not of an empty text
        own = self.b.encode([s.removeprefix(" ") for s in spelt], num_threads=1)
        b = [ids[1:] if s[0] == "\n" else ids or self.space for s, ids in zip(spelt, own)]
        # A's tokens are pieces of the bytes themselves; B's may have been spelt otherwise
        good = [b"".join(map(self.bytes_b.__getitem__, y)) == s.encode() for s, y in zip(spelt, b)]
        n = len(self.known)
        self.known.update(zip(new, range(n, n + len(new))))
        self.good = np.append(self.good, good)
        for side, ids in enumerate((a, b)):
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(size.sum()))
            self.ids[side] = np.append(self.ids[side], flat)
            self.at[side] = np.append(self.at[side], self.at[side][-1] + np.cumsum(size))

    @uncollected()
    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """(ids of A, texts' offsets in them, ids of B, texts' offsets in them); a text
        that is not spelt has no tokens."""
        cut = [self.chunks(t) if t else [] for t in texts]
        here = set(itertools.chain.from_iterable(cut))
        if len(self.known) + len(here) > CACHE:
            self._empty()
        if new := [c for c in here if c not in self.known]:
            self.learn(new)
        count = np.fromiter(map(len, cut), np.int64, len(cut))
        nth = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(cut)), np.int64, int(count.sum()))
        text = np.repeat(np.arange(len(cut)), count)
        bad = np.zeros(len(cut), bool)
        bad[text[~self.good[nth]]] = True
        keep = ~bad[text]
        nth, text = nth[keep], text[keep]
        out = []
        for ids, at in zip(self.ids, self.at):
            size = at[nth + 1] - at[nth]
            total = np.concatenate([[0], np.cumsum(size)])
            flat = ids[np.repeat(at[nth] - total[:-1], size) + np.arange(total[-1])]
            out += (flat, total[np.searchsorted(text, np.arange(len(cut) + 1))])
        if len(self.ids[0]) > CACHE_IDS:
            self._empty()
        return tuple(out)


@functools.lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merging of two sorted arrays stands after 0, piece, 2 piece, ...
    and all steps (elements taken of each; of equal ones that of ``a`` goes first):
    binary searches on all diagonals of the merge matrix at once."""
    total = len(a) + len(b)
    steps = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while len(open_ := np.flatnonzero(low < high)):
        mid = (low[open_] + high[open_]) // 2
        up = a[mid] <= b[steps[open_] - mid - 1]
        low[open_[up]] = mid[up] + 1
        high[open_[~up]] = mid[~up]
    return low, steps - low


def shared_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Indices (in a, in b) of the values that both strictly increasing arrays hold.

    Every piece of the merge path walks its own elements; all pieces take a step
    at a time together."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = diagonals(a, b, piece)
    end_a, end_b = i[1:], j[1:]
    first_b, border = j[:-1].copy(), i[:-1].copy()
    i, j = i[:-1].copy(), j[:-1].copy()
    top = max(a[-1], b[-1]) + 1
    aa, bb = np.append(a, top), np.append(b, top)  # one read behind the end
    pairs = np.full((2, piece, len(i)), -1, np.int64)  # of every step and piece: the places of a shared end
    last = np.full(len(i), -1, np.int64)  # the end of a that the piece took in the step before
    for step in range(piece):
        value = bb[j]
        take = (i < end_a) & ((j >= end_b) | (aa[i] <= value))
        other = ~take & (j < end_b)
        same = other & (last == value)
        pairs[0, step, same], pairs[1, step, same] = i[same] - 1, j[same]
        last = np.where(take, aa[i], -1)
        i += take
        j += other
    at_a, at_b = (x.T.ravel() for x in pairs)
    # stitching: the last of a piece is an end of a, the first of the next piece the same end of b
    cut = np.flatnonzero((border[1:] > 0) & (first_b[1:] < len(b))) + 1
    cut = cut[a[border[cut] - 1] == b[first_b[cut]]]
    return np.sort(np.append(at_a[at_a >= 0], border[cut] - 1)), np.sort(np.append(at_b[at_b >= 0], first_b[cut]))


class Aligned:
    """The groups of a block of texts."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        self.pair = pair
        self.a, self.from_a, self.b, self.from_b = pair.encode(texts)
        ends_a, ends_b = np.cumsum(pair.length_a[self.a]), np.cumsum(pair.length_b[self.b])
        self.last_a, self.last_b = shared_ends(ends_a, ends_b)  # the last tokens of every group
        self.from_group = np.searchsorted(self.last_a, self.from_a)
        self.n_a, self.n_b, self.n_groups = (np.diff(x) for x in (self.from_a, self.from_b, self.from_group))

    def links(self) -> np.ndarray:
        """The id pair of every link, as one number."""
        return self.a[self.last_a].astype(np.int64) * self.pair.size_b + self.b[self.last_b]

    @uncollected()
    def listed(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every text."""
        form_a, form_b = self.a.astype(np.int64), self.b.astype(np.int64) + 2 * self.pair.size_a
        form_a[self.last_a] += self.pair.size_a
        form_b[self.last_b] += self.pair.size_b
        size_a, size_b = np.diff(self.last_a, prepend=-1), np.diff(self.last_b, prepend=-1)
        line = np.empty(len(form_a) + len(form_b), np.int64)
        line[np.arange(len(form_a)) + np.repeat(self.last_b + 1 - size_b, size_a)] = form_a
        line[np.arange(len(form_b)) + np.repeat(self.last_a + 1, size_b)] = form_b
        line, form = line.tolist(), self.pair.forms.__getitem__
        at = (self.from_a + self.from_b).tolist()
        return ["".join(map(form, line[x:z]))[:-1] for x, z in zip(at, at[1:])]


def align(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """GROUPS for every row of ``docs`` (doc_id, text): the ids of every group."""
    ship(docs.sparkSession)

    def task(batches):
        pair = load(*(paths or default_paths()))
        ids = pa.list_(pa.int32())
        for b in blocks(batches, limit=BLOCK):
            al = Aligned(pair, b.column("text").to_pylist())
            side = [pa.ListArray.from_arrays(pa.array(np.append(0, last + 1), pa.int32()), pa.array(x, pa.int32()))
                    for x, last in ((al.a, al.last_a), (al.b, al.last_b))]
            groups = pa.StructArray.from_arrays(side, names=["a", "b"])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(al.from_group, pa.int32()), groups).cast(
                    pa.list_(pa.struct([("a", ids), ("b", ids)])))], names=["doc_id", "groups"])

    return docs.select("doc_id", "text").mapInArrow(task, GROUPS)


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, counts) of several lists added up."""
    pairs, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    head = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[head], np.add.reduceat(counts, head) if len(head) else counts


def found(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Rows of FOUND: one for every row of ``docs`` (counts null; ``links``: its id
    pairs), and rows without ``row`` that hold a task's link counts of id pairs."""
    ship(docs.sparkSession)
    names = [c.split()[0] for c in FOUND.split(", ")]
    pairs_of, long = pa.list_(pa.int32()), pa.int64()

    def counted(pairs, counts):
        for at in range(0, len(pairs), 100_000):
            part = slice(at, at + 100_000)
            none = [pa.nulls(1, long)] * 5
            yield pa.RecordBatch.from_arrays(
                [*none, pa.nulls(1, pa.string()), pa.array([pairs[part].astype(np.int32)], pairs_of),
                 pa.array([counts[part]], pa.list_(long))], names=names)

    def task(batches):
        pair = load(*(paths or default_paths()))
        row = TaskContext.get().partitionId() << 33
        held, size = [], 0
        for b in blocks(batches, limit=BLOCK):
            al, n = Aligned(pair, b.column("text").to_pylist()), b.num_rows
            links = al.links()
            digest = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in al.listed()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), b.column("doc_id").cast(long), pa.array(al.n_a), pa.array(al.n_b),
                 pa.array(al.n_groups), pa.array(digest, pa.string()),
                 pa.ListArray.from_arrays(pa.array(al.from_group, pa.int32()), pa.array(links, pa.int32())),
                 pa.nulls(n, pa.list_(long))], names=names)
            row += n
            held.append(np.unique(links, return_counts=True))
            size += len(held[-1][0])
            if size > HELD_PAIRS:
                held = [_summed(held)]
                if (size := len(held[0][0])) > HELD_PAIRS // 2:
                    yield from counted(*held.pop())
                    size = 0
        if held:
            yield from counted(*_summed(held))

    return docs.select("doc_id", "text").mapInArrow(task, FOUND)


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how many links hold each id pair, and whether no other pair
    of its B id has more."""
    each = F.explode(F.arrays_zip("links", "counts")).alias("c")
    pairs = rows.where("row is null").select(each).groupBy(F.col("c.links").alias("pair")).agg(F.sum("c.counts").alias("n"))
    pairs = written(pairs, "crosstoken-pairs").withColumn("b", F.col("pair") % size_b)
    top = pairs.groupBy("b").agg(F.max("n").alias("top"))  # a row per B id: bounded by the vocabulary
    return written(pairs.join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")),
                   "crosstoken-counts")


SCORED = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long, rest array<int>"


def scored(rows: DataFrame, hot: tuple[np.ndarray, ...]) -> DataFrame:
    """Rows of SCORED: the sums over the links of hot pairs (sorted pairs, counts,
    best), and the other links."""
    names = [c.split()[0] for c in SCORED.split(", ")]
    sent = rows.sparkSession.sparkContext.broadcast(hot)

    def task(batches):
        load.cache_clear()  # a worker that encoded before needs its room for other things now
        pairs, counts, best = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, SCORED_ROWS):
                b = whole.slice(at, SCORED_ROWS)
                column = b.column("links")
                links, n = column.flatten().to_numpy(zero_copy_only=False), b.num_rows
                ends = np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
                place = np.searchsorted(pairs, links)
                place[place == len(pairs)] = 0
                known = pairs[place] == links if len(pairs) else np.zeros(len(links), bool)
                place = place[known]
                upto = np.append(0, np.cumsum(known))[ends]  # known links before each text
                sums = [np.diff(np.append(0, np.cumsum(values[place].astype(np.int64)))[upto]) for values in (best, counts)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in names[:6]), pa.array(sums[0]), pa.array(sums[1]),
                     pa.ListArray.from_arrays(pa.array(ends - upto, pa.int32()), pa.array(links[~known], pa.int32()))],
                    names=names)

    return rows.where("row is not null").select(*names[:6], "links").mapInArrow(task, SCORED)


def statistics(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum and groups_sha256."""
    import sentencepiece
    size_b = sentencepiece.SentencePieceProcessor(model_file=(paths or default_paths())[1]).get_piece_size()
    rows = written(found(docs, paths), "crosstoken-found")
    counts = pair_counts(rows, size_b)
    hot = counts.orderBy(F.desc("n"), "pair").limit(HOT).toArrow().sort_by("pair")
    own = written(scored(rows, tuple(hot.column(c).to_numpy() for c in ("pair", "n", "best"))), "crosstoken-scored")
    rest = own.where(F.size("rest") > 0).select("row", F.explode("rest").alias("pair"))
    more = rest.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("best").cast("long")).alias("more_best"), F.sum("n").alias("more_sum"))
    return own.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def op13(spark, sf_dir: str) -> DataFrame:
    return statistics(spark.read.parquet(f"{sf_dir}/documents.parquet"))
