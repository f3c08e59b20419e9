"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary gives the pieces. Each language has a probability for
every piece; a word's probability is the sum over all its segmentations into
pieces, which a forward pass computes letter by letter (pieces and words of any
length; long words in logarithms). A text's score is the product over its words,
every word of it.

The piece probabilities are fitted by expectation maximisation (forward and
backward passes) on word counts of a bounded sample: ``SAMPLE`` labelled texts,
chosen by the hash of their id, and besides the first ``LEAST`` of each language,
so every labelled language is learned whatever its share; one text of an id and
language, at most ``TYPES`` word types a language, words of more than
``WORD_LETTERS`` letters in parts (the cut is of the training sample only).
Passes run over many words at once, one trie step per vector operation.

Defined results: null text or text without a letter is ``und`` with score 0;
rows with a null language or id do not train; with no language learned every
text is ``und``; ties go to the first language in order; an empty table gives no
rows; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscore.llm.common import SMALL_BLOCK, HashTable, blocks, crc_bucket, mix, ship

SAMPLE, LEAST, TYPES, ROUNDS = 4000, 500, 20_000, 4
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Longer words are scored in logarithms, and train in parts of so many letters.
WORD_LETTERS = 32
#: Table entries (node x letter) up to which a trie is a plain table, and letters handled at a time.
DENSE, BATCH_LETTERS = 1 << 23, 400_000
#: Probability of a letter that no piece explains, and the smoothing of counts.
FLOOR, SMOOTH = 1e-8, 0.1
WORDS_KEPT = 200_000
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> list[str]:
    """Letter pieces of the vocabulary, lower case; ``_`` marks a word's start."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = set()
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i).lower()
        body = p.removeprefix("▁")
        if body and all(_WORD.fullmatch(c) for c in body):
            out.add("_" * (len(p) - len(body)) + body)
    return sorted(out)


class Trie:
    """Pieces over the letters ``alphabet``: a table node x letter -> node, or for
    large alphabets a hash table of the same steps."""

    def __init__(self, all_pieces: list[str], alphabet: str):
        self.code = {c: k + 1 for k, c in enumerate(alphabet)}  # 0: any other letter
        self.pieces = [p for p in all_pieces if all(c in self.code for c in p)]
        self.longest = max(map(len, self.pieces), default=0)
        self.width = len(alphabet) + 1
        # node 1 is the root, 0 is nowhere; piece 0: no piece ends here
        steps, self.piece_at = {}, [0, 0]
        for k, p in enumerate(self.pieces):
            node = 1
            for c in p:
                key = node * self.width + self.code[c]
                node = steps.get(key)
                if node is None:
                    node = steps[key] = len(self.piece_at)
                    self.piece_at.append(0)
            self.piece_at[node] = k + 1
        self.piece_at = np.array(self.piece_at, np.int32)
        keys = np.fromiter(steps, np.int64, len(steps))
        nodes = np.fromiter(steps.values(), np.int32, len(steps))
        self.table = self.sparse = None
        if len(self.piece_at) * self.width <= DENSE:
            self.table = np.zeros(len(self.piece_at) * self.width, np.int32)
            self.table[keys] = nodes
        else:
            self.sparse = HashTable(mix(keys.astype(np.uint64)), nodes, 16)

    def step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) * self.width + letter
        if self.table is not None:
            return self.table[key]
        # letter 0 is in no piece, and no step leaves node 0
        return self.sparse.find(mix(key.astype(np.uint64)))

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letter codes (words x longest, start mark first) and lengths."""
        size = np.array([len(w) + 1 for w in words])
        out = np.zeros((len(words), int(size.max(initial=1))), np.int32)
        flat = np.frombuffer("".join(["_" + w for w in words]).encode("utf-32-le"), np.uint32)
        keys = np.array(sorted(map(ord, self.code)), np.uint32)
        vals = np.array([self.code[chr(k)] for k in keys], np.int32)
        at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
        out[np.arange(out.shape[1]) < size[:, None]] = np.where(keys[at] == flat, vals[at], 0)
        return out, size

    def spans(self, codes: np.ndarray, size: np.ndarray):
        """For each start and length: (start, end, words, pieces) of pieces that fit."""
        for start in range(codes.shape[1]):
            rows = np.flatnonzero(size > start)
            node = np.ones(len(rows), np.int32)
            for end in range(start, min(codes.shape[1], start + self.longest)):
                node = self.step(node, codes[rows, end])
                live = (node > 0) & (size[rows] > end)
                rows, node = rows[live], node[live]
                if not len(rows):
                    break
                piece = self.piece_at[node]
                hit = piece > 0
                if hit.any():
                    yield start, end + 1, rows[hit], piece[hit]


@dataclass
class Model:
    languages: list[str]
    alphabet: str
    prob: np.ndarray  # piece (0: floor) x language
    path: str | None = None

    def trie(self) -> Trie:
        return Trie(pieces(self.path or vocabulary_path()), self.alphabet)


def forward(trie: Trie, prob: np.ndarray, codes: np.ndarray, size: np.ndarray):
    """Probability of every prefix of every word per language, summed over all
    segmentations; a letter outside every piece costs FLOOR."""
    a = np.zeros((codes.shape[1] + 1, len(codes), prob.shape[1]))
    a[0] = 1
    found, done = list(trie.spans(codes, size)), 0
    found.sort(key=lambda s: s[0])
    for start in range(codes.shape[1]):
        a[start + 1] += a[start] * FLOOR
        while done < len(found) and found[done][0] == start:
            _, end, rows, piece = found[done]
            a[end, rows] += a[start, rows] * prob[piece]
            done += 1
    return a, found


def log_forward(trie: Trie, prob: np.ndarray, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Log probability of every word per language, added up in logarithms: words of
    any length. Holds only the prefixes that a piece can still start from."""
    log_prob = np.log(np.maximum(prob, 1e-300))
    reach = max(trie.longest, 1) + 1
    a = np.full((reach, len(codes), prob.shape[1]), -np.inf)  # a ring of prefix ends
    a[0] = 0
    out = np.zeros((len(codes), prob.shape[1]))
    ending = np.argsort(size, kind="stable")
    done = 0
    spans = trie.spans(codes, size)
    found = next(spans, None)
    for start in range(codes.shape[1]):
        here = a[start % reach]
        after = a[(start + 1) % reach]
        np.logaddexp(after, here + np.log(FLOOR), out=after)
        while found is not None and found[0] == start:
            _, end, rows, piece = found
            a[end % reach, rows] = np.logaddexp(a[end % reach, rows], here[rows] + log_prob[piece])
            found = next(spans, None)
        here[:] = -np.inf  # free for the prefix that is ``reach`` further on
        while done < len(ending) and size[ending[done]] == start + 1:
            out[ending[done]] = after[ending[done]]
            done += 1
    return out


def log_words(trie: Trie, prob: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each word per language."""
    if not words:
        return np.zeros((0, prob.shape[1]), np.float32)
    out = np.zeros((len(words), prob.shape[1]), np.float32)
    length = np.array([len(w) for w in words])
    order = np.argsort(length, kind="stable")
    at = 0
    while at < len(order):
        # as many words as BATCH_LETTERS allows when all are as long as the longest of them
        room = np.arange(1, len(order) - at + 1) * (length[order[at:]] + 1) <= BATCH_LETTERS
        part = order[at:at + max(int(room.argmin()) if not room.all() else len(room), 1)]
        short = np.searchsorted(length[part], WORD_LETTERS, "right")
        part = part[:short] if short else part
        codes, size = trie.codes([words[i] for i in part])
        if short:
            a, _ = forward(trie, prob, codes, size)
            out[part] = np.log(np.maximum(a[size, np.arange(len(part))], 1e-300))
        else:
            out[part] = log_forward(trie, prob, codes, size)
        at += len(part)
    return out


def expected(trie: Trie, prob: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected piece counts of one language's words over all segmentations."""
    total = np.zeros(len(prob))
    for part in np.array_split(np.arange(len(words)), len(words) // 20_000 + 1):
        codes, size = trie.codes([words[i] for i in part])
        a, found = forward(trie, prob[:, None], codes, size)
        a = a[:, :, 0]
        b = np.zeros_like(a)
        b[size, np.arange(len(part))] = 1
        spans, at = found, len(found)
        for start in range(codes.shape[1] - 1, -1, -1):
            b[start] += b[start + 1] * FLOOR
            while at and spans[at - 1][0] == start:
                at -= 1
                _, end, rows, piece = spans[at]
                b[start, rows] += prob[piece] * b[end, rows]
        whole = np.maximum(a[size, np.arange(len(part))], 1e-300)
        for start, end, rows, piece in spans:
            share = a[start, rows] * prob[piece] * b[end, rows] / whole[rows] * counts[part[rows]]
            total += np.bincount(piece, share, len(prob))
    return total


def split_words(text: str) -> list[str]:
    """Lower-case letter runs."""
    return _WORD.findall(text.lower())


def in_parts(words: list[str]) -> list[str]:
    """Words longer than WORD_LETTERS in parts (for training, where every word is
    passed forwards and backwards in plain probabilities)."""
    if any(len(w) > WORD_LETTERS for w in words):
        return [w[k:k + WORD_LETTERS] for w in words for k in range(0, len(w), WORD_LETTERS)]
    return words


def fit(rows: list[tuple[str, str]], path: str | None = None) -> Model:
    """Piece probabilities per language from (language, text) rows."""
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        counts.setdefault(lang, Counter()).update(in_parts(split_words(text)))
    langs = sorted(k for k, c in counts.items() if c)
    letters = {ch for c in counts.values() for w in c for ch in w}
    model = Model(langs, "_" + "".join(sorted(letters)), np.zeros((1, len(langs))), path)
    if not langs:
        return model
    trie = model.trie()
    n = len(trie.pieces)
    model.prob = np.full((n + 1, len(langs)), 1 / (n + 1))
    for k, lang in enumerate(langs):
        top = counts[lang].most_common(TYPES)
        words, freq = [w for w, _ in top], np.array([c for _, c in top], float)
        for _ in range(ROUNDS):
            got = expected(trie, model.prob[:, k], words, freq) + SMOOTH
            got[0] = 0
            model.prob[:, k] = got / got.sum()
    return model


def train(docs: DataFrame, path: str | None = None) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
                       & (crc_bucket("doc_id", FOLDS) != HELD_OUT))
    ids = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    pairs = known.select("doc_id", "lang").distinct()
    # the hash is even, so this keeps about 4 * LEAST ids of a language for the ranking, however common it is
    at = F.xxhash64("doc_id")
    count = F.broadcast(pairs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    early = pairs.join(count, "lang").where(at / float(1 << 64) + 0.5 <= 4.0 * LEAST / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(at, "doc_id"))
    each = early.select("doc_id", "lang", rank.alias("rank")).where(F.col("rank") <= LEAST).drop("rank")
    chosen = pairs.join(F.broadcast(ids), "doc_id").unionByName(each).distinct()
    rows = known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows = sorted((r["doc_id"], r["lang"], r["text"]) for r in rows.collect())
    return fit([(lang, text) for _, lang, text in rows], path)


def _predictor(model: Model):
    """A function from texts to (languages, scores), with a bounded word cache."""
    trie = model.trie() if model.languages else None
    known: dict[str, int] = {}
    logs = np.zeros((0, len(model.languages)), np.float32)

    def run(texts: list[str | None]) -> tuple[list[str], list[float]]:
        nonlocal known, logs
        cut = [split_words(t) if t and trie else [] for t in texts]
        new = list({w for ws in cut for w in ws if w not in known})
        if len(known) + len(new) > WORDS_KEPT:  # start anew: only saved work is lost
            known, new, logs = {}, list({w for ws in cut for w in ws}), logs[:0]
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new))))
            logs = np.concatenate([logs, log_words(trie, model.prob, new)])
        best, conf = [], []
        for ws in cut:
            if not ws:
                best.append(UNKNOWN)
                conf.append(0.0)
                continue
            total = logs[np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))].sum(axis=0, dtype=np.float64)
            k = int(total.argmax())
            best.append(model.languages[k])
            conf.append(float(1 / np.exp(np.maximum(total - total[k], -700)).sum()))
        return best, conf

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (posterior of the predicted language)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def task(batches):
        run = _predictor(shared.value)
        for b in blocks(batches, limit=SMALL_BLOCK):
            best, conf = run(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(best, pa.string()), pa.array(conf, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more.

    A rule of its own: where the best language has less than ``least`` of the
    posterior, the text is taken to be in none of the learned ones. With ``least``
    0 only texts without letters go."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def task(batches):
        run = _predictor(shared.value)
        for b in blocks(batches, limit=SMALL_BLOCK):
            best, conf = run(b.column("text").to_pylist())
            yield b.filter(pa.array([k != UNKNOWN and c >= least for k, c in zip(best, conf)]))

    return docs.mapInArrow(task, docs.schema)


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = (crc_bucket("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return predict(docs, train(docs)).select("doc_id", held, "lang_pred", "score")
