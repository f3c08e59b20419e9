"""Toxicity: a convolutional text classifier trained in numpy.

A word's vector is the sum of the hashed embeddings of the word and of its
3- and 5-byte beginnings (compounds share their stem). Filters of widths 1 to 3
run over the words of a text, a global maximum keeps each filter's strongest
place, a logistic layer adds them up. Decision thresholds are calibrated by
language, told from function words of the text itself, and the score is shifted
so that 0.5 is always the threshold.

The model is fitted on every text of every labelled id outside the held-out fold, of
any length. The labelled texts go to shards by their hash, about ``SHARD`` each. In an
epoch every shard trains from the same parameters in its own task, and the parameters
(with the state of their optimiser) are averaged by the shards' texts. Features and
thresholds come from counts. To the driver go FEATURES hashes, one sum of parameters
(about 0.8 MB) for each of the square root of the shards, and the counts of texts by
language and logit (in steps of 1 / GRID).

Defined results: null or empty text has no words and gets the model's score of
an empty text; rows with a null label or id do not train; equal texts train once, with the
label of the least id; without both labels or ten texts every score is the share of toxic labels (0 without any); an
empty table gives no rows; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.llm.common import (BLOCK_BYTES, NON_LETTERS, SMALL_BLOCK, HashTable, blocks, crc_bucket, find_words, hash_spans,
                                 lower_ascii, ship, signed, utf8, written)
from txnscore.llm.partenum import _bit, _bitmap, _width

FEATURES, MIN_DOCS = 4096, 3
#: Labelled texts of a shard, about, and bytes after which a shard goes on in another row.
SHARD, SHARD_BYTES = 4096, 1 << 22
#: Words whose filter responses are held at a time (a longer text is alone).
WORDS = 50_000
#: A text of more bytes is a long one to the tests; it trains like any other.
TEXT_BYTES = 1 << 16
#: Thresholds are sought between logits in steps of 1 / GRID, up to MOST_LOGIT either way.
GRID, MOST_LOGIT = 256, 32
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY = 5, 32, 0.01, 1e-4
STEMS = (3, 5)
#: A clean text lost counts so many times a toxic text missed.
CLEAN_WEIGHT = 4
FOLDS, HELD_OUT = 5, 0

# Function words that tell four languages apart.
FUNCTION_WORDS = {
    "en": "the of and to is that it for with are this be by from was have not".split(),
    "de": "der die und das den von mit ist im dem nicht eine auf sich auch".split(),
    "fr": "le les et des est que dans pour une du qui au par sur pas".split(),
    "es": "el los y las que por con para una del su lo como se".split(),
}
LANGUAGES = list(FUNCTION_WORDS)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and of its stems (words x 3) and the word offsets of the rows."""
    data, offsets = utf8(column)
    data = lower_ascii(data)
    starts, ends, rows = find_words(data, offsets, NON_LETTERS)
    spans = [hash_spans(data, starts, np.minimum(ends, starts + n)) for n in STEMS]
    return np.stack([hash_spans(data, starts, ends), *spans], axis=1), rows


def _function_table() -> HashTable:
    words = [(w, k + 1) for k, lang in enumerate(LANGUAGES) for w in FUNCTION_WORDS[lang]]
    hashes, _ = word_hashes(pa.array([w for w, _ in words]))
    return HashTable(hashes[:, 0], np.array([k for _, k in words]), 12)


def languages(hashes: np.ndarray, rows: np.ndarray, known: HashTable) -> np.ndarray:
    """Index of the language with the most function words, the last index if none."""
    code = known.find(hashes[:, 0])
    doc = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    n = np.zeros((len(rows) - 1, len(LANGUAGES) + 1), np.int64)
    np.add.at(n, (doc[code > 0], code[code > 0] - 1), 1)
    return np.where(n.any(axis=1), n.argmax(axis=1), len(LANGUAGES))


@dataclass
class Model:
    """Everything that scoring needs; its size is bounded by FEATURES."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    embed: np.ndarray = field(default_factory=lambda: np.zeros((1, DIM), np.float32))
    conv: list = field(default_factory=list)  # per width: (width, DIM, FILTERS)
    bias: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS, np.float32))
    out: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS + 1, np.float32))
    limits: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES) + 1))

    def table(self) -> HashTable:
        return HashTable(self.keys, np.arange(1, len(self.keys) + 1), 20)

    def responses(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter responses of every window that starts in ``x`` (words x DIM)."""
        out = []
        for w, weights in zip(WIDTHS, self.conv):
            n = len(x) - w + 1
            out.append(sum(x[k:k + n] @ weights[k] for k in range(w)) if n > 0 else np.zeros((0, FILTERS), np.float32))
        return out

    def pooled(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Global maximum of each filter per text, at least 0 (windows end with the text)."""
        top = np.zeros((len(rows) - 1, len(WIDTHS) * FILTERS), np.float32)
        for k, (w, r) in enumerate(zip(WIDTHS, self.responses(x))):
            some = np.flatnonzero(np.diff(rows) >= w)
            if len(some):
                cuts = np.stack([rows[some], rows[some + 1] - w + 1], axis=1).ravel()
                cuts = cuts[:-1] if cuts[-1] >= len(r) else cuts
                part = np.maximum.reduceat(r, cuts, axis=0)[::2]
                at = slice(k * FILTERS, (k + 1) * FILTERS)
                top[some, at] = np.maximum(part + self.bias[at], 0)
        return top

    def logits(self, hashes: np.ndarray, rows: np.ndarray, table: HashTable) -> np.ndarray:
        return self.lean([table.find(hashes[:, k]) for k in range(hashes.shape[1])], rows)

    def lean(self, ids, rows: np.ndarray) -> np.ndarray:
        """Logits of texts whose words have the features ``ids`` (hashes of a word x words)."""
        return self.pooled(self.words(ids), rows) @ self.out[:-1] + self.out[-1]

    def words(self, ids) -> np.ndarray:
        x = self.embed[ids[0]]
        for k in ids[1:]:
            x += self.embed[k]
        return x


class _Adam:
    def __init__(self, params):
        self.params, self.t = params, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, grads):
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            g = g + DECAY * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def _parts(texts: list[str]) -> list[tuple[int, int]]:
    """Ranges of texts of about BLOCK_BYTES letters, at least one text each."""
    size = np.cumsum([len(t) for t in texts])
    cuts = np.unique(np.searchsorted(size, np.arange(BLOCK_BYTES, size[-1] + BLOCK_BYTES, BLOCK_BYTES)) + 1)
    cuts = np.minimum(cuts, len(texts))
    return [(int(x), int(y)) for x, y in zip(np.append(0, cuts), np.append(cuts, len(texts))) if x < y]


def _hashed(texts: list[str]):
    """(first text, hashes, rows) part by part."""
    for x, y in _parts(texts):
        yield x, *word_hashes(pa.array(texts[x:y], pa.large_string()))


def _features(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The FEATURES hashes (of those in MIN_DOCS texts or more) whose presence
    tells most about the label, and how much: the z value of the difference of
    their shares in the two classes."""
    keys, owner = [], []
    for x, hashes, rows in _hashed(texts):
        k, d = _seen(hashes, rows)
        keys.append(k)
        owner.append((d + x).astype(np.int32))
    keys, n, found = _counted(np.concatenate(keys), labels[np.concatenate(owner)])
    some = n >= MIN_DOCS
    keys, n, found = keys[some], n[some], found[some]
    pos, neg = max(labels.sum(), 1), max((1 - labels).sum(), 1)
    share = (n + 1) / (pos + neg + 2)
    z = (found / pos - (n - found) / neg) / np.sqrt(share * (1 - share) * (1 / pos + 1 / neg))
    best = np.lexsort((keys, -np.abs(z)))[:FEATURES]
    return keys[best], z[best]


def _seen(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (hash, text) of texts, by hash."""
    doc = np.repeat(np.repeat(np.arange(len(rows) - 1), np.diff(rows)), hashes.shape[1])
    flat = hashes.ravel()
    order = np.lexsort((doc, flat))
    k, d = flat[order], doc[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return k[first], d[first]


def _counted(key: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, how often each stands, and the sum of its ``y``."""
    order = np.argsort(key, kind="stable")
    key, y = key[order], y[order].astype(float)
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[start], np.diff(np.append(start, len(key))), np.add.reduceat(y, start) if len(start) else np.zeros(0)


def _constant(share: float) -> Model:
    """Gives every text the score ``share``."""
    model = Model(conv=[np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS])
    model.out[-1] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    return model


def _begin(keys: np.ndarray, z: np.ndarray, rng) -> Model:
    """The network before training."""
    n, width = len(keys), len(WIDTHS) * FILTERS
    # Start from the evidence: one direction of the embedding carries z, which
    # every filter sees with a random weight; the other directions start small.
    model = Model(keys=keys, embed=rng.normal(0, 0.02, (n + 1, DIM)).astype(np.float32))
    model.embed[1:, 0] += np.clip(z / 10, -2, 2)
    model.embed[0] = 0
    model.conv = [rng.normal(0, 0.3 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    model.out = rng.normal(0, 0.1, width + 1).astype(np.float32)
    for k, w in enumerate(WIDTHS):
        model.conv[k][:, 0] = np.abs(model.conv[k][:, 0]) + 0.3
        model.out[k * FILTERS:(k + 1) * FILTERS] += 0.2
    model.out[-1] = -1
    return model


def fit(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Train on four fifths of the texts, calibrate the thresholds on the rest:
    what ``train`` does, on texts in memory as one shard."""
    share = float(labels.mean()) if len(labels) else 0.0
    if len(labels) < 10 or share in (0.0, 1.0):
        return _constant(share)
    rng = np.random.default_rng(seed)
    held = rng.random(len(texts)) < 0.2
    chosen = np.flatnonzero(~held)
    model = _begin(*_features([texts[d] for d in chosen], labels[chosen]), rng)
    table, known, parts, langs, ends = model.table(), _function_table(), [], [], [np.zeros(1, np.int64)]
    for _, hashes, rows in _hashed(texts):
        parts.append(table.find(hashes.ravel()).reshape(hashes.shape))
        langs.append(languages(hashes, rows, known))
        ends.append(rows[1:] + ends[-1][-1])
    ids, rows = np.concatenate(parts), np.concatenate(ends)
    adam = _Adam(_parameters(model))
    for _ in range(EPOCHS):
        _epoch(model, adam, ids, rows, labels, chosen, rng)
    model.limits = _calibrate(*_binned(model, ids, rows, labels, np.concatenate(langs), held))
    return model


def _parameters(model: Model) -> list[np.ndarray]:
    return [model.embed, *model.conv, model.bias, model.out]


def _epoch(model: Model, adam: _Adam, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, chosen: np.ndarray, rng) -> None:
    """One pass over the ``chosen`` texts, in batches."""
    for batch in np.array_split(rng.permutation(chosen), max(1, len(chosen) // BATCH)):
        grads = [np.zeros_like(p) for p in adam.params]
        for d in batch:
            _backward(model, ids[rows[d]:rows[d + 1]], float(labels[d]), grads, len(batch))
        grads[0][0] = 0
        adam.step(grads)
        model.embed[0] = 0


def _backward(model: Model, ids: np.ndarray, label: float, grads: list, size: int) -> None:
    """Add one text's gradient; a maximum passes it to its window alone."""
    x = model.words(ids.T)
    top, places = np.zeros(len(model.bias), np.float32), []
    for k, r in enumerate(model.responses(x)):
        at = r.argmax(axis=0) if len(r) else None
        places.append(at)
        if at is not None:
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            top[cols] = np.maximum(r[at, np.arange(FILTERS)] + model.bias[cols], 0)
    p = 1 / (1 + np.exp(-float(top @ model.out[:-1] + model.out[-1])))
    err = (p - label) / size
    grads[-1][:-1] += err * top
    grads[-1][-1] += err
    back = np.where(top > 0, err * model.out[:-1], 0).astype(np.float32)
    grads[-2] += back
    for k, (w, at) in enumerate(zip(WIDTHS, places)):
        if at is None:
            continue
        g = back[k * FILTERS:(k + 1) * FILTERS, None]  # 0 where a filter passes nothing
        for j in range(w):
            grads[1 + k][j] += (g * x[at + j]).T
            np.add.at(grads[0], ids[at + j], (g * model.conv[k][j].T)[:, None, :])


def _binned(model: Model, ids: np.ndarray, rows: np.ndarray, labels, langs, held) -> tuple:
    """(logit, language, held, texts, toxic texts) by logit in steps of 1 / GRID."""
    logits = model.lean(ids.T, rows)
    at = np.floor(np.clip(logits, -MOST_LOGIT, MOST_LOGIT) * GRID).astype(np.int64)
    key = ((at + MOST_LOGIT * GRID) * 2 + np.asarray(held, np.int64)) * 8 + np.asarray(langs, np.int64)
    return _unpacked(*_counted(key, np.asarray(labels)))


def _unpacked(key: np.ndarray, n: np.ndarray, found: np.ndarray) -> tuple:
    return (key // 16 - MOST_LOGIT * GRID + 0.5) / GRID, key % 8, key // 8 % 2 == 1, n, found


def _best_limit(x: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the best gap between the classes (recall, and specificity CLEAN_WEIGHT times);
    n texts, ``toxic`` of them toxic, have logit x."""
    x, at = np.unique(x, return_inverse=True)
    y, clean = np.bincount(at, toxic), np.bincount(at, n - toxic)
    cuts = np.concatenate([[x[0] - 2], (x[1:] + x[:-1]) / 2, [x[-1] + 2]])
    found = (y.sum() - np.concatenate([[0], np.cumsum(y)])) / max(y.sum(), 1)
    score = found + CLEAN_WEIGHT * np.concatenate([[0], np.cumsum(clean)]) / max(clean.sum(), 1)
    best = np.flatnonzero(score >= score.max() - 1e-12)
    return float(cuts[best[0]] + cuts[best[-1]]) / 2


def _calibrate(x, langs, held, n, toxic) -> np.ndarray:
    """A threshold per language from held-back texts; the common one where a
    language has fewer than 10 of either class."""
    both = 0 < toxic[held].sum() < n[held].sum()
    pick = held if both else np.ones_like(held)
    common = _best_limit(x[pick], n[pick], toxic[pick])
    out = np.full(len(LANGUAGES) + 1, common)
    for k in range(len(LANGUAGES)):
        own = pick & (langs == k)
        if min(toxic[own].sum(), (n - toxic)[own].sum()) >= 10:
            out[k] = _best_limit(x[own], n[own], toxic[own])
    return out


TEXTS = "shard int, part int, text binary, ends binary, label binary, held binary"
IDS = "shard int, part int, ids binary, ends binary, label binary, held binary, lang binary"


def _row(names: str, *values) -> pa.RecordBatch:
    """A batch of one row; arrays go as their bytes."""
    columns = [pa.array([v], pa.int32()) if isinstance(v, int) else pa.array([memoryview(v).cast("B") if len(v) else b""], pa.large_binary())
               for v in values]
    return pa.RecordBatch.from_arrays(columns, names=[n.split()[0] for n in names.split(", ")])


def _array(row: dict, name: str, kind) -> np.ndarray:
    return np.frombuffer(row[name], kind)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The distinct texts (128 bits of hash) of all labelled ids outside the held-out fold, written
    in rows of TEXTS: a shard, or up to SHARD_BYTES of it. A fifth of the texts, by hash, is held
    back. Labels are joined to hashes; only texts at whose bit a labelled one lies are shuffled,
    once, to where they meet their label."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                         & (crc_bucket("doc_id", FOLDS) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"))
    wanted = texts.select("doc_id", "h1", "h2").join(known, "doc_id").groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "toxic")).alias("least"))
    wanted = written(wanted.select("h1", "h2", "least.toxic"), "toxicity-labels")
    n = wanted.count()
    at = F.pmod(F.xxhash64("h1", "h2"), F.lit(_width(n))).alias("at")
    may = texts.select("text", "h1", "h2", at).select("*", F.bitmap_bucket_number("at").alias("bucket")).join(
        _bitmap(wanted.select(at), "held"), "bucket").where(_bit("held"))
    shard = F.pmod(F.xxhash64("h2", "h1"), F.lit(n // SHARD + 1)).cast("int").alias("shard")
    rows = wanted.select(shard, "h1", "h2", "toxic", F.lit(None).cast("string").alias("text")).unionByName(
        may.select(shard, "h1", "h2", F.lit(None).cast("int").alias("toxic"), "text"))

    def task(batches):
        shard, part, label, got, size = None, 0, None, [], 0  # label: of the next text, if it is one to take

        def take():
            text, label, held = zip(*got)
            return _row(TEXTS, shard, part, b"".join(text), np.cumsum([0, *map(len, text)]).astype(np.int64),
                        np.array(label, np.int8), np.array(held, np.int8))

        for whole in batches:
            for b in blocks([whole]):
                text = b.column("text").cast(pa.large_binary() if pa.types.is_large_string(b.column("text").type) else pa.binary())
                for s, h1, h2, y, t in zip(*(b.column(c).to_pylist() for c in ("shard", "h1", "h2", "toxic")), text.to_pylist()):
                    if got and (s != shard or size >= SHARD_BYTES):
                        yield take()
                        part, size = part + 1, 0
                        got.clear()
                    if s != shard:
                        shard, part = s, 0
                    if t is None:  # the label stands before its texts
                        label = h1, h2, y
                    elif label and label[:2] == (h1, h2):
                        got.append((t, label[2], h1 % 5 == 0))
                        size += len(t)
                        label = None
        if got:
            yield take()

    rows = rows.repartition("shard").sortWithinPartitions("shard", "h1", "h2", F.col("text").isNotNull())
    return written(rows.select("shard", "h1", "h2", "toxic", "text").mapInArrow(task, TEXTS), "toxicity-texts")


def _rows(batches):
    """Dictionaries, one after another."""
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def _text_blocks(row: dict):
    """(texts, labels, held) of a row of TEXTS, block by block."""
    ends = _array(row, "ends", np.int64)
    column = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(row["ends"]), pa.py_buffer(row["text"])])
    whole = pa.RecordBatch.from_arrays([column, pa.array(_array(row, "label", np.int8)), pa.array(_array(row, "held", np.int8))],
                                       names=["text", "label", "held"])
    for b in blocks([whole], limit=SMALL_BLOCK):
        yield b.column("text"), b.column("label").to_numpy(), b.column("held").to_numpy() > 0


def _best_features(texts: DataFrame, pos: int, neg: int) -> tuple[np.ndarray, np.ndarray]:
    """``_features`` of the texts that are not held back, from counts by hash."""

    def task(batches):
        for row in _rows(batches):
            for column, y, held in _text_blocks(row):
                k, d = _seen(*word_hashes(column))
                k, n, found = _counted(k[~held[d]], y[d[~held[d]]])
                yield pa.RecordBatch.from_arrays([pa.array(signed(k)), pa.array(n.astype(np.int64)), pa.array(found.astype(np.int64))],
                                                 names=["key", "n", "found"])

    pos, neg = float(max(pos, 1)), float(max(neg, 1))
    share = (F.col("n") + 1) / (pos + neg + 2)
    z = (F.col("found") / pos - (F.col("n") - F.col("found")) / neg) / F.sqrt(share * (1 - share) * (1 / pos + 1 / neg))
    count = texts.select("text", "ends", "label", "held").mapInArrow(task, "key long, n long, found long")
    count = count.groupBy("key").agg(F.sum("n").alias("n"), F.sum("found").alias("found")).where(F.col("n") >= MIN_DOCS)
    best = count.select("key", z.alias("z")).orderBy(F.abs("z").desc(), "key").limit(FEATURES).collect()
    return np.array([r["key"] for r in best], np.int64).view(np.uint64), np.array([r["z"] for r in best], float)


def _identified(texts: DataFrame, model: Model) -> DataFrame:
    """Written rows of IDS: the features of every word and the language of every text."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        table, known = shared.value.table(), _function_table()
        for row in _rows(batches):
            ids, langs, ends = [], [], [np.zeros(1, np.int64)]
            for column, _, _ in _text_blocks(row):
                hashes, at = word_hashes(column)
                ids.append(table.find(hashes.ravel()).astype(np.uint16))
                langs.append(languages(hashes, at, known).astype(np.int8))
                ends.append(at[1:] + ends[-1][-1])
            yield _row(IDS, row["shard"], row["part"], np.concatenate(ids), np.concatenate(ends),
                       _array(row, "label", np.int8), _array(row, "held", np.int8), np.concatenate(langs))

    return written(texts.mapInArrow(task, IDS), "toxicity-ids")


def _opened(row: dict) -> tuple[np.ndarray, ...]:
    """ids (words x hashes of a word), ends, labels, held and languages of a row of IDS."""
    return (_array(row, "ids", np.uint16).reshape(-1, 1 + len(STEMS)), _array(row, "ends", np.int64),
            *(_array(row, c, np.int8) for c in ("label", "held", "lang")))


def _averaged(ids: DataFrame, model: Model, state: np.ndarray, epoch: int, seed: int, groups: int) -> np.ndarray:
    """``state`` (parameters, then both moments) after a pass of every shard from it, averaged by texts."""
    shared = ids.sparkSession.sparkContext.broadcast((model, state))

    def task(batches):
        for row in _rows(batches):
            words, ends, labels, held, _ = _opened(row)
            chosen = np.flatnonzero(held == 0)
            if not len(chosen):
                continue
            own, adam = _restored(*shared.value)
            adam.t = epoch * max(1, len(chosen) // BATCH)
            _epoch(own, adam, words, ends, labels, chosen, np.random.default_rng([seed, epoch, row["shard"], row["part"]]))
            yield _row("shard, part, n, state", row["shard"], row["part"], len(chosen), _flat(adam))

    def total(batches):
        group, n, out = None, 0, None
        for row in _rows(batches):
            if row["g"] != group:
                if group is not None:
                    yield _row("n, state", n, out)
                group, n, out = row["g"], 0, np.zeros(len(state))
            n += row["n"]
            out += row["n"] * _array(row, "state", np.float32).astype(float)
        if group is not None:
            yield _row("n, state", n, out)

    passed = ids.mapInArrow(task, "shard int, part int, n int, state binary")
    passed = passed.select(F.pmod(F.xxhash64("shard"), F.lit(groups)).cast("int").alias("g"), "*").repartition("g")
    sums = passed.sortWithinPartitions("g", "shard", "part").mapInArrow(total, "n int, state binary").collect()
    sums = sorted((r["n"], bytes(r["state"])) for r in sums)
    n = sum(n for n, _ in sums)
    return (sum(np.frombuffer(b) for _, b in sums) / n).astype(np.float32) if n else state


def _flat(adam: _Adam) -> np.ndarray:
    return np.concatenate([a.ravel() for a in (*adam.params, *adam.m, *adam.v)]).astype(np.float32)


def _restored(model: Model, state: np.ndarray) -> tuple[Model, _Adam]:
    """A model of the shapes and keys of ``model`` with the parameters in ``state``, and its optimiser."""
    sizes = [p.shape for p in _parameters(model)] * 3
    parts = np.split(state, np.cumsum([int(np.prod(x)) for x in sizes])[:-1])
    parts = [p.reshape(x).copy() for p, x in zip(parts, sizes)]
    n = len(sizes) // 3
    embed, *conv, bias, out = parts[:n]
    own = Model(keys=model.keys, embed=embed, conv=conv, bias=bias, out=out)
    adam = _Adam(_parameters(own))
    adam.m, adam.v = parts[n:2 * n], parts[2 * n:]
    return own, adam


def _tallied(ids: DataFrame, model: Model) -> tuple:
    """``_binned`` of all texts."""
    shared = ids.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        for row in _rows(batches):
            words, ends, labels, held, langs = _opened(row)
            at = 0
            while at < len(ends) - 1:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + WORDS, "right")) - 1)
                e, at = ends[at:to + 1], to
                part = slice(to + 1 - len(e), to)
                x, lang, back, n, toxic = _binned(shared.value, words[e[0]:e[-1]], e - e[0], labels[part], langs[part], held[part])
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(lang), pa.array(back), pa.array(n.astype(np.int64)),
                                                  pa.array(toxic.astype(np.int64))], names=["x", "lang", "held", "n", "toxic"])

    out = ids.mapInArrow(task, "x double, lang long, held boolean, n long, toxic long")
    got = out.groupBy("x", "lang", "held").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).toArrow()
    return tuple(got.column(c).to_numpy() for c in ("x", "lang", "held", "n", "toxic"))


def train(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """Fit on all labelled rows outside the held-out fold (see the module)."""
    ship(docs.sparkSession)
    texts = _labelled(docs, labels)

    def count(batches):
        for row in _rows(batches):
            y, held = _array(row, "label", np.int8), _array(row, "held", np.int8)
            yield _row("n, toxic, train, bad", len(y), int(y.sum()), int((held == 0).sum()), int(y[held == 0].sum()))

    total = texts.select("label", "held").mapInArrow(count, "n int, toxic int, train int, bad int").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "toxic", "train", "bad")),
        F.count(F.lit(1)).alias("rows")).first()
    share = total["toxic"] / total["n"] if total["n"] else 0.0
    if total["n"] < 10 or share in (0.0, 1.0):
        return _constant(share)
    model = _begin(*_best_features(texts, total["bad"], total["train"] - total["bad"]), np.random.default_rng(seed))
    ids = _identified(texts, model)
    state, groups = _flat(_Adam(_parameters(model))), int(np.sqrt(total["rows"])) + 1
    for epoch in range(EPOCHS):
        state = _averaged(ids, model, state, epoch, seed, groups)
    model = _restored(model, state)[0]
    model.limits = _calibrate(*_tallied(ids, model))
    return model


def _scorer(model: Model):
    table, known = model.table(), _function_table()

    def run(column: pa.Array) -> np.ndarray:
        hashes, rows = word_hashes(column)
        lean = model.logits(hashes, rows, table) - model.limits[languages(hashes, rows, known)]
        return 1 / (1 + np.exp(-np.clip(lean.astype(float), -50, 50)))

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= 0.5) of every text."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def task(batches):
        run = _scorer(shared.value)
        for b in blocks(batches, limit=SMALL_BLOCK):
            s = run(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, score double, predicted int")


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def task(batches):
        run = _scorer(shared.value)
        for b in blocks(batches, limit=SMALL_BLOCK):
            yield b.filter(pa.array(run(b.column("text")) < 0.5))

    return docs.mapInArrow(task, docs.schema)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    return out.select("doc_id", (crc_bucket("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")
