"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its word shingles. Sets fall into size bands whose
ends grow by 1 / similarity, so linked sets lie in one band or in neighbours.
Within a band linked sets differ in at most k shingles. The shingle domain is
hashed into parts of two sub-parts; a signature is the content of a sub-part,
for every choice of the one left out (``enumeration``). There are some more than
k + 1 sub-parts, so two sets with at most k differences agree on several, and
since agreeing sub-parts weigh the same in both sets, each set may leave out its
lightest ones (empty or of few shingles, which unrelated sets share by chance)
as long as fewer go than must agree: no linked pair is missed. A set signs for
its own band and for the next one.

Every task first links the sets of a block of texts that share a signature to
the least of them, so a very common signature costs one shuffled row per
block. A shuffle by signature links the blocks' least sets. Then

1. each document is held against the least and the greatest set it met (two
   candidates), verified on the shingles, and components are formed;
2. signatures whose members still lie in different components, those of one
   main component together (``_folded``), are compared
   pair by pair in blocks of ``BLOCK`` sets, outside the largest component's
   own pairs (of equal sets the least document's alone); a parity sketch, which never overstates the difference of two
   sets, drops pairs beyond the limit. The closest pair of every document is
   verified, round by round while that merges components; then every other
   pair of different components is.

So documents of different components share no signature within the limit that
was not verified: the components are those of the exact join. Equal sets are
linked by their 128-bit set hash; nothing but counters reaches the driver.

Defined results: null, empty or blank text has no shingles and links with
nothing (its component is itself); fewer words than a shingle make one shingle;
rows that repeat a doc_id are one document with several texts; a null doc_id
is in component null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.llm.common import (SMALL_BLOCK, blocks, find_words, hash_ngrams, hash_spans, lower_ascii, mix, ship,
                                 signed, utf8, written)
from txnscore.llm.components import components

#: Members of a signature compared at a time, and parity bits per allowed difference.
BLOCK, SKETCH_BITS = 256, 8
#: Sub-parts per necessary one, and the weight up to which light ones are dropped.
SURPLUS, MOST_WEIGHT = 1.3, 8
#: Rows of a written table that one task of the steps over it takes.
ROWS_PER_FILE = 50_000
#: Bits per id of the bitmap that sorts out other rows, and its bits at most (32 MB).
FILTER_BITS, MOST_BITS = 16, 1 << 28

SIGNED = "sig long, sig2 long, doc long, pivot long, size long"


class Limits:
    """Size bands and allowed differences for similarity >= percent / 100."""

    def __init__(self, percent: int):
        self.percent = percent
        self.ends = [1]

    def grow(self, size: int) -> None:
        while self.ends[-1] < size:
            self.ends.append((self.ends[-1] + 1) * 100 // self.percent)

    def band(self, sizes: np.ndarray) -> np.ndarray:
        """Index of the size band of each set (sizes from 1)."""
        self.grow(int(sizes.max(initial=1)))
        return np.searchsorted(np.array(self.ends), sizes)

    def differences(self, total):
        """Most differing elements of two linked sets of ``total`` elements together:
        percent * union <= 100 * shared."""
        return (100 - self.percent) * total // (100 + self.percent)

    def allowed(self, band: int) -> int:
        """Most differences of linked sets whose larger one is in ``band``."""
        self.grow_to(band)
        return int(self.differences(2 * self.ends[band]))

    def grow_to(self, band: int) -> None:
        while len(self.ends) <= band:
            self.ends.append((self.ends[-1] + 1) * 100 // self.percent)


def enumeration(k: int) -> tuple[int, int]:
    """(sub-parts, slack) for k differences: n1 parts of two sub-parts each, of
    which a signature leaves one out. Of ``sub-parts`` at least slack + 1 agree."""
    if k < 1:
        return 1, 0
    n1 = -(-int((k + 1) * SURPLUS) // 2)
    return 2 * n1, 2 * n1 - k - 1


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and the rows' offsets. Hashing
    takes many times a text's bytes, so it goes through the rows in small blocks."""
    parts = [_shingles(b.column("text"), n)
             for b in blocks([pa.RecordBatch.from_arrays([column], names=["text"])], limit=SMALL_BLOCK)]
    sizes = [np.diff(rows) for _, rows in parts]
    rows = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))]).astype(np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *(grams for grams, _ in parts)]), rows


def _shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of one block."""
    data, offsets = utf8(column)
    data = lower_ascii(data)
    starts, ends, rows = find_words(data, offsets)
    words = hash_spans(data, starts, ends)
    grams, at = hash_ngrams(words, rows, n)
    doc = np.searchsorted(rows, at, "right") - 1
    count = np.diff(rows)
    for d in np.flatnonzero((count > 0) & (count < n)):  # the whole sequence is one shingle
        whole = np.uint64(1)
        for w in words[rows[d]:rows[d + 1]]:
            whole = mix(np.array([whole ^ w], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
        grams, doc = np.append(grams, whole), np.append(doc, d)
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    first = np.ones(len(grams), bool)
    first[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[first], doc[first]
    return grams, np.searchsorted(doc, np.arange(len(rows)))


def signatures(grams: np.ndarray, rows: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of all rows, and the row of each."""
    sizes = np.diff(rows)
    bands = limits.band(np.maximum(sizes, 1))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    out, owner = [], []
    for side in (0, 1):
        tag = bands + side
        shape = {int(b): enumeration(limits.allowed(int(b))) for b in np.unique(tag)}
        parts = np.array([shape[int(b)][0] for b in tag], np.int64)
        slack = np.array([shape[int(b)][1] for b in tag], np.int64)
        salt = mix(tag.astype(np.uint64) + np.uint64(77))
        place = mix(grams ^ salt[doc])
        # the sub-part of each shingle; a kept sub-part's content is the sum of its hashes
        slot = (place % parts[doc].astype(np.uint64)).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(np.where(sizes > 0, parts, 0))])
        content = np.zeros(begin[-1], np.uint64)
        np.add.at(content, begin[doc] + slot, mix(place + np.uint64(0x51ED270B)))
        row = np.repeat(np.arange(len(sizes)), np.diff(begin))
        number = np.arange(begin[-1]) - begin[row]
        # drop the lightest sub-parts while fewer than those that must agree go
        weight = np.bincount(begin[doc] + slot, minlength=begin[-1])
        least = np.zeros(len(sizes), np.int64)
        for w in range(1, MOST_WEIGHT + 1):
            light = np.bincount(row[weight < w], minlength=len(sizes))
            least[light <= slack] = w
        strong = weight >= least[row]
        row, number, content = row[strong], number[strong], content[strong]
        out.append(mix(content ^ mix(salt[row] + number.astype(np.uint64))))
        owner.append(row)
    return np.concatenate(out), np.concatenate(owner)


def _keys(grams: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of each row's set."""
    total = np.zeros((2, len(grams) + 1), np.uint64)
    np.cumsum(mix(grams + np.uint64(0x1234567)), out=total[0, 1:])
    np.cumsum(mix(grams ^ np.uint64(0xABCDEF987654321)), out=total[1, 1:])
    n = np.diff(rows).astype(np.uint64)
    return tuple(mix(total[k, rows[1:]] - total[k, rows[:-1]] + n) for k in (0, 1))


def _batch(sig, sig2, doc, pivot, size) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in (sig, sig2, doc, pivot, size)], names=["sig", "sig2", "doc", "pivot", "size"])


def _least(sig: np.ndarray, sig2: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (sig, sig2, doc) and, in it, the least doc of each (sig, sig2)."""
    order = np.lexsort((doc, sig2, sig))
    s, s2, d = sig[order], sig2[order], doc[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (s2[1:] != s2[:-1])
    return order, d[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(d) else d


def sign(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Rows of SIGNED. size > 0: a set (sig, sig2: its hash, size: elements + 1);
    size 0: a PartEnum signature. pivot: the least doc of the block with it.
    Rows with a true ``copy`` (a column that may be missing) give their set alone."""

    def task(batches):
        limits = Limits(percent)
        for b in blocks(batches):
            doc = np.array(b.column("doc_id").to_numpy(zero_copy_only=False), np.int64)
            grams, rows = shingle_sets(b.column("text"), n)
            size = np.diff(rows)
            key, key2 = _keys(grams, rows)
            empty = size == 0
            key[empty], key2[empty] = mix(doc[empty].astype(np.uint64)), 0
            order, pivot = _least(signed(key), signed(key2), doc)
            yield _batch(signed(key)[order], signed(key2)[order], doc[order], pivot, size[order] + 1)
            # equal sets of a block sign once, by their least document
            once = np.zeros(len(doc), bool)
            once[order[pivot == doc[order]]] = True
            if "copy" in b.schema.names:  # the text's least document signs for it
                once &= ~b.column("copy").to_numpy(zero_copy_only=False).astype(bool)
            sig, row = signatures(grams, rows, limits)
            keep = once[row]
            sig, own = signed(sig[keep]), doc[row[keep]]
            zero = np.zeros(len(sig), np.int64)
            order, pivot = _least(sig, zero, own)
            sig, own = sig[order], own[order]
            for at in range(0, len(sig), 100_000):
                part = slice(at, at + 100_000)
                yield _batch(sig[part], zero[part], own[part], pivot[part], zero[part])

    return docs.mapInArrow(task, SIGNED)


def meet(rows: DataFrame) -> DataFrame:
    """Rows of SIGNED with the least doc over all blocks as pivot; signatures of
    a single document are dropped unless size says otherwise. Rows linked inside a
    block pass as they are. Spark sorts the partitions, spilling where it must, and
    a task reads them as a stream: it holds one batch and the last group's least doc."""
    own = F.col("doc") == F.col("pivot")
    # a block's least sets go by signature, the others anywhere
    key = F.when(own, F.col("sig")).otherwise(F.xxhash64("doc", "sig"))

    def task(batches):
        open_ = None  # signature and least doc of the last group, whether others met it, whether it is held back
        for b in batches:
            sig, sig2, doc, pivot, size = (c.to_numpy(zero_copy_only=False) for c in b.columns[:5])
            at = np.flatnonzero(doc == pivot)
            if len(at):
                s, s2, d = sig[at], sig2[at], doc[at]
                head = np.ones(len(at), bool)
                head[1:] = (s[1:] != s[:-1]) | (s2[1:] != s2[:-1])
                begin, group = np.flatnonzero(head), np.cumsum(head) - 1
                least, held, met = d[begin], size[at][begin] == 0, np.zeros(len(begin), bool)
                going = open_ is not None and open_[:2] == (s[0], s2[0])
                if going:
                    least[0], met[0], held[0] = open_[2:]
                met |= np.logical_or.reduceat(d != least[group], begin)
                if going and held[0] and met[0]:  # now somebody met it
                    yield _batch(s[:1], s2[:1], least[:1], least[:1], np.zeros(1, np.int64))
                pivot = pivot.copy()
                pivot[at] = least[group]
                open_ = s[-1], s2[-1], least[-1], met[-1], held[-1] and not met[-1]
                keep = np.ones(len(doc), bool)
                keep[at] = (size[at] != 0) | met[group]
                sig, sig2, doc, pivot, size = (c[keep] for c in (sig, sig2, doc, pivot, size))
            yield _batch(sig, sig2, doc, pivot, size)

    return rows.repartition(key).sortWithinPartitions("sig", "sig2", "doc").mapInArrow(task, SIGNED)


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The linked ones of candidate pairs (a, b), tested on their shingle sets."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")

    def task(batches):
        for b in blocks(batches, "text_a", 1 << 20):
            ga, ra = shingle_sets(b.column("text_a"), n)
            gb, rb = shingle_sets(b.column("text_b"), n)
            good = []
            for i in range(b.num_rows):
                x, y = ga[ra[i]:ra[i + 1]], gb[rb[i]:rb[i + 1]]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared) and shared > 0)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(task, "a long, b long")


def sketches(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc, size, sketch): the parity of the shingles in each of some buckets,
    so that two sketches differ in no more bits than the sets in elements."""

    def task(batches):
        limits = Limits(percent)
        for b in blocks(batches):
            grams, rows = shingle_sets(b.column("text"), n)
            size = np.diff(rows)
            bands = limits.band(np.maximum(size, 1))
            out = []
            for d in range(b.num_rows):
                # one width for every band that a partner may have
                bits = _sketch_bits(limits, int(bands[d]))
                out.append(np.packbits(np.bincount((mix(grams[rows[d]:rows[d + 1]]) % np.uint64(bits)).astype(np.int64),
                                                   minlength=bits).astype(np.uint8) & 1).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(out, pa.binary())],
                                             names=["doc", "size", "sketch"])

    return texts.select("doc_id", "text").mapInArrow(task, "doc long, size long, sketch binary")


def _sketch_bits(limits: Limits, band: int) -> int:
    """A power of two; neighbouring bands differ by one doubling at most."""
    return 64 << max(0, (SKETCH_BITS * limits.allowed(band) // 64)).bit_length()


def _bits(sketch: bytes, bits: int) -> np.ndarray:
    """A sketch folded to fewer buckets (hash modulo 2m folds to modulo m)."""
    out = np.frombuffer(sketch, np.uint8)
    while len(out) * 8 > bits:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


NEAR = "a long, b long, gap long"


def _close(group, limits, percent: int, best: bool):
    """(x, y, least difference) of the pairs of one block that may be linked;
    ``best``: the closest y of every x, and the closest x of every y."""
    side, doc, comp, size = (np.array([r[k] for r in group]) for k in (3, 4, 5, 6))
    bits = min(len(r[7]) for r in group) * 8
    sketch = np.stack([_bits(r[7], bits) for r in group]).view(np.uint64)
    rest = np.flatnonzero(side != 1)
    for xs in np.array_split(rest, len(rest) // 64 + 1):
        if not len(xs):
            continue
        x = xs[:, None]
        near = ((side == 1) | ((side == 2) & (side[x] == 2) & (doc > doc[x]))) & (comp != comp[x])
        near &= 100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x])
        ys = np.flatnonzero(near.any(axis=0))
        if not len(ys):
            continue
        near = near[:, ys]
        least = np.bitwise_count(sketch[x] ^ sketch[ys][None]).sum(axis=2, dtype=np.int64)
        near &= least <= limits.differences(size[ys] + size[x])
        if best:
            far = np.where(near, least, 1 << 40)
            i, y = np.arange(len(xs)), far.argmin(axis=1)
            some = far[i, y] < 1 << 40
            yield doc[xs[some]], doc[ys[y[some]]], far[i, y][some]
            j, k = np.arange(len(ys)), far.argmin(axis=0)
            some = far[k, j] < 1 << 40
            yield doc[ys[some]], doc[xs[k[some]]], far[k, j][some]
        else:
            i, j = np.nonzero(near)
            yield doc[xs[i]], doc[ys[j]], least[i, j]


def close_pairs(members: DataFrame, percent: int, best: bool = False, files: int = 1 << 20) -> DataFrame:
    """Pairs of one (sig, i, j) block in different components whose sketches and
    sizes allow a link (rows of NEAR). side 0 is compared with side 1, side 2 with
    itself and with side 1; members: lead (the signature's least document), sig, i,
    j, side, doc, comp, size, sketch.
    ``best``: for every document the closest of its pairs only."""
    # a group lies in one partition, sorted; partitions put behind one another keep that. Signatures with one
    # least document mostly have the same members: they go to one task, which names a pair once
    parts = members.repartition("lead", "i", "j").sortWithinPartitions("sig", "i", "j").coalesce(files)

    def task(batches):
        limits, group, found = Limits(percent), [], {}

        def take():
            for pairs in _close(group, limits, percent, best):
                for x, y, gap in zip(*(c.tolist() for c in pairs)):
                    if not best:
                        found[max(x, y), min(x, y)] = gap
                    elif x not in found or (gap, y) < found[x]:
                        found[x] = (gap, y)

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if group and r[:3] != group[0][:3]:
                    take()
                    group.clear()
                    if len(found) > 100_000:
                        yield _near_batch(found, best)
                        found.clear()
                group.append(r)
        if group:
            take()
        yield _near_batch(found, best)

    out = parts.select("sig", "i", "j", "side", "doc", "comp", "size", "sketch").mapInArrow(task, NEAR)
    if best:
        out = out.groupBy("a").agg(F.min(F.struct("gap", "b")).alias("m")).select("a", "m.b", "m.gap").coalesce(files)
    high, low = F.greatest("a", "b"), F.least("a", "b")
    return out.select(high.alias("a"), low.alias("b")).distinct().coalesce(files)


def _near_batch(found: dict, best: bool) -> pa.RecordBatch:
    rows = [(x, y, gap) for x, (gap, y) in found.items()] if best else [(x, y, gap) for (x, y), gap in found.items()]
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "gap"])


def _unresolved(members: DataFrame, comp: DataFrame) -> DataFrame:
    """(sig, doc, comp) of signatures (sig, doc) with members of several components;
    of signatures with equal members one."""
    members = written(members.select("sig", "doc").join(comp, "doc").select("sig", "doc", "comp"), "partenum-members")
    files = _files(members)
    own = lambda *c: F.bit_xor(F.xxhash64("doc", *c))
    mixed = members.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("n"),
                                       own().alias("h1"), own(F.lit(7)).alias("h2")).where("x != y").coalesce(files)
    # signatures with the same members hold the same pairs: one of them is enough
    mixed = mixed.groupBy("n", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig")
    return written(members.join(written(mixed.coalesce(files), "partenum-mixed"), "sig").coalesce(files), "partenum-unresolved")


def _folded(open_: DataFrame) -> DataFrame:
    """``open_`` with the signatures of one main component (their largest, of equals the
    least) as one signature that has all their members, where that makes fewer pairs. A family of
    near copies agrees on hundreds of signatures, with a few other members in each: all but
    the same pairs, which would be compared once a signature. No pair is lost."""
    files = _files(open_)

    def work(of: DataFrame, key: str) -> DataFrame:
        count = of.groupBy(key, "comp").agg(F.count(F.lit(1)).alias("n")).coalesce(files)
        per = count.groupBy(key).agg(F.max(F.struct("n", F.bitwise_not("comp").alias("not"))).alias("top"), F.sum("n").alias("all"))
        n, rest = F.col("top.n").cast("double"), (F.col("all") - F.col("top.n")).cast("double")
        return per.select(key, F.bitwise_not("top.not").alias("largest"), (rest * (2 * n + rest)).alias("work"))

    each = written(work(open_, "sig").withColumnRenamed("largest", "main").coalesce(files), "partenum-each")
    union = written(open_.join(each.select("sig", "main"), "sig").select("main", "doc", "comp").distinct().coalesce(files),
                    "partenum-families")
    apart = each.groupBy("main").agg(F.sum("work").alias("apart"), F.min("sig").alias("one"))
    mains = written(work(union, "main").join(apart, "main").select("main", "one", (F.col("work") <= F.col("apart")).alias("fold"))
                    .coalesce(files), "partenum-mains")
    fold = union.join(mains.where("fold"), "main").select(F.col("one").alias("sig"), "doc", "comp")
    stay = each.join(mains.where("not fold"), "main").select("sig")
    return written(fold.unionByName(open_.join(stay, "sig").select("sig", "doc", "comp")).coalesce(files), "partenum-folded")


def _files(rows: DataFrame) -> int:
    """Tasks for the steps over a written table: very many tasks on few rows cost more
    than the rows."""
    return rows.count() // ROWS_PER_FILE + 1


def _dealt(open_: DataFrame, sketch: DataFrame) -> DataFrame:
    """The members of unresolved signatures dealt to the blocks in which all pairs
    outside the largest component's own meet once."""
    files = _files(open_)
    count = open_.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least")).coalesce(files)
    per = count.groupBy("sig").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"),
                                   F.min("least").alias("lead"))
    per = written(per.select("sig", "lead", F.col("top.comp").alias("main"), F.col("top.n").alias("n_main"),
                             (F.col("all") - F.col("top.n")).alias("n_rest")).coalesce(files), "partenum-groups")
    m = open_.join(per, "sig")
    blocks_of = lambda c: (F.floor(F.col(c) / BLOCK) + 1).cast("long")
    at = lambda c: F.pmod(F.xxhash64("doc"), blocks_of(c)).cast("long")
    is_main = F.col("comp") == F.col("main")
    # main: one block, met by every block of the rest (i: rest block, j: -1 - main block)
    main = m.where(is_main).select("*", at("n_main").alias("j0")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), blocks_of("n_rest") - 1)).alias("i")).select(
        "lead", "sig", "i", (-1 - F.col("j0")).alias("j"), F.lit(1).alias("side"), "doc", "comp")
    rest = m.where(~is_main).withColumn("own", at("n_rest"))
    rest_main = rest.select("*", F.explode(F.sequence(F.lit(0).cast("long"), blocks_of("n_main") - 1)).alias("j0")).select(
        "lead", "sig", F.col("own").alias("i"), (-1 - F.col("j0")).alias("j"), F.lit(0).alias("side"), "doc", "comp")
    # rest against rest: block pairs i <= j; i = j holds its own pairs
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks_of("n_rest") - 1)).alias("o")
    rest_rest = rest.select("*", other).select(
        "lead", "sig", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"),
        F.when(F.col("own") == F.col("o"), 2).when(F.col("own") < F.col("o"), 0).otherwise(1).alias("side"),
        "doc", "comp")
    return written(main.unionByName(rest_main).unionByName(rest_rest), "partenum-dealt").join(sketch, "doc")


def _width(n: int) -> int:
    """Bits of a bitmap of n ids."""
    bits = 1 << 15
    while bits < min(FILTER_BITS * n, MOST_BITS):
        bits *= 2
    return bits


def _bitmap(at: DataFrame, name: str) -> DataFrame:
    """(bucket, name): the bits that the numbers ``at`` leave."""
    bucket, place = F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at")
    return F.broadcast(at.groupBy(bucket).agg(F.bitmap_construct_agg(place).alias(name)))


def _bit(name: str):
    """Whether the bitmap beside it holds ``at``."""
    place = F.bitmap_bit_position("at")
    byte = F.conv(F.hex(F.substring(name, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) > 0


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose doc_id is one of ``ids``. Each id leaves a bit, at its hash,
    in a bitmap that every task holds: few other rows go into the join that decides."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(_width(ids.count()))).alias("at")
    may = rows.select("*", at).select("*", F.bitmap_bucket_number("at").alias("bucket")).join(
        _bitmap(ids.select(at), "held"), "bucket").where(_bit("held"))
    return may.select(*rows.columns).join(ids, "doc_id")


def _copies(docs: DataFrame) -> DataFrame:
    """doc_id, text and copy: true only where a smaller doc_id holds the same text (128 bits of
    hash). Bitmaps of the copies and of the others, which every task holds, say so without a
    shuffle of texts; of the few copies at whose bit another row lies, copy is false."""
    hashes = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2")]
    rows = docs.select("doc_id", *hashes)
    least = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = written(least.where("least < most"), "partenum-repeated")  # texts of several documents
    n = docs.count()
    at = F.pmod(F.xxhash64("doc_id", "h1", "h2"), F.lit(_width(n))).alias("at")
    marks = written(rows.join(least, ["h1", "h2"], "left").select(
        at, F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).alias("copy")).distinct(), "partenum-marks")
    seen = docs.select("doc_id", "text", *hashes).select("doc_id", "text", at)
    seen = seen.select("*", F.bitmap_bucket_number("at").alias("bucket"))
    for name, which in (("again", "copy"), ("other", "not copy")):
        seen = seen.join(_bitmap(marks.where(which).select("at"), name), "bucket", "left")
    return seen.select("doc_id", "text", F.coalesce(_bit("again"), F.lit(False)).alias("again"),
                       F.coalesce(_bit("other"), F.lit(False)).alias("other")).select(
        "doc_id", "text", (F.col("again") & ~F.col("other")).alias("copy"))


def _whole(ids: DataFrame, comp: DataFrame) -> DataFrame:
    """(doc, comp) of all of ``ids``; a document without links is its own."""
    return ids.withColumnRenamed("doc_id", "doc").join(comp, "doc", "left").select(
        "doc", F.coalesce("component", "doc").alias("comp"))


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links between their members: only the graph between the
    components that the links join is solved, then every member is relabelled."""
    of = lambda side, out: comp.select(F.col("doc").alias(side), F.col("component").alias(out))
    joined = links.join(of("a", "ca"), "a", "left").join(of("b", "cb"), "b", "left")
    small = written(components(joined.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))),
                    "partenum-contracted")
    old = comp.join(small.select(F.col("node").alias("component"), F.col("component").alias("new")), "component", "left")
    alone = small.select(F.col("node").alias("doc"), "component").join(comp.select("doc"), "doc", "left_anti")
    return written(old.select("doc", F.coalesce("new", "component").alias("component")).unionByName(alone), "partenum-comp")


def join_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text):
    the connected components of all pairs with Jaccard >= percent / 100 on
    distinct ``n``-word shingles."""
    ship(docs.sparkSession)
    known = docs.where(F.col("doc_id").isNotNull())
    met = written(meet(sign(_copies(known), n, percent)), "partenum-met")
    sets, hits = met.where("size > 0"), met.where("size = 0")
    # equal sets: rows of a class point at its least document, over at most two steps
    same = sets.where("doc != pivot").select(F.col("doc").alias("a"), F.col("pivot").alias("b")).distinct()
    # a document all of whose sets an earlier one holds has that one's links
    copies = written(sets.groupBy("doc").agg(F.min(F.col("doc") != F.col("pivot")).alias("copy")).where("copy").select("doc"),
                     "partenum-copies")
    tried = hits.where("doc != pivot").groupBy("doc").agg(F.min("pivot").alias("x"), F.max("pivot").alias("y"))
    tried = tried.join(copies, "doc", "left_anti")
    tried = written(tried.select(F.col("doc").alias("a"), F.explode(F.array("x", "y")).alias("b")).distinct(),
                    "partenum-tried")
    meeting = hits.where("doc != pivot")
    ids = written(meeting.select(F.col("doc").alias("doc_id")).unionByName(meeting.select(F.col("pivot").alias("doc_id")))
                  .distinct(), "partenum-ids")
    texts = written(_among(known.select("doc_id", "text"), ids), "partenum-texts")
    links = written(verify(tried, texts, n, percent).unionByName(same), "partenum-links")
    comp = written(components(links).withColumnRenamed("node", "doc"), "partenum-comp")
    open_ = meeting.select("sig", "doc").unionByName(meeting.select("sig", F.col("pivot").alias("doc"))).distinct()
    first = ids.join(copies.withColumnRenamed("doc", "doc_id"), "doc_id", "left_anti")
    open_ = _unresolved(open_, _whole(first, comp))
    wanted = open_.select(F.col("doc").alias("doc_id")).distinct()
    sketch = written(sketches(texts.join(wanted, "doc_id"), n, percent), "partenum-sketches")
    while True:  # the closest pair of every open document, as long as any is a link
        folded = _folded(open_)
        dealt, files = _dealt(folded, sketch), _files(folded)
        near = written(close_pairs(dealt, percent, True, files).join(tried, ["a", "b"], "left_anti"), "partenum-near")
        more = written(verify(near, texts, n, percent), "partenum-links")
        tried = tried.unionByName(near)
        if more.isEmpty():
            break
        comp = _merged(comp, more)
        open_ = _unresolved(open_, _whole(first, comp))
    # every other pair of different components that may be a link
    near = written(close_pairs(dealt, percent, files=files).join(tried, ["a", "b"], "left_anti"), "partenum-near")
    comp = _merged(comp, verify(near, texts, n, percent)).withColumnRenamed("doc", "doc_id")
    size = sets.select(F.col("doc").alias("doc_id"), (F.col("size") - 1).alias("n_shingles"))
    out = size.join(comp, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    nameless = docs.where(F.col("doc_id").isNull()).select(F.lit(0).cast("long").alias("doc_id"), "text")
    nameless = sign(nameless, n, percent).where("size > 0").select(
        F.lit(None).cast("long").alias("doc_id"), (F.col("size") - 1).alias("n_shingles"),
        F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless)


def op4(spark, sf_dir: str) -> DataFrame:
    return join_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=90)


SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as words from documents),
s as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) end)
    as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
k as (select md5(string_agg(g, chr(10) order by g)) as k, doc_id from s group by doc_id),
c as (select doc_id, min(doc_id) over (partition by k) as rep from k),
r as (select s.doc_id, s.g, n.n from s join n using (doc_id) where s.doc_id in (select rep from c)),
f as (select g from r group by g having count(*) > 1),
p as (
  select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as shared
  from (select * from r where g in (select g from f)) a join (select * from r where g in (select g from f)) b
  on a.g = b.g and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by all having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e as (select a, b from p union all select b, a from p union all
      select doc_id, rep from c union all select rep, doc_id from c),
reach as (
  select doc_id as node, doc_id as got from c
  union select e.b, reach.got from reach join e on e.a = reach.node where reach.got < e.b),
m as (select node, min(got) as component from reach group by node)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, coalesce(m.component, d.doc_id) as component_id
from documents d left join n using (doc_id) left join m on m.node = d.doc_id
"""
