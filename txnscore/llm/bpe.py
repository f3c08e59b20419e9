"""BPE encoding and decoding by prefix-sharing trie traversal.

A text falls into chunks at white space and a chunk into words (letters, one
digit, or other signs, as the vocabulary's pattern says). The distinct words of
a block of texts, sorted, are the trie of those words in depth-first order; a
stack holds the state of the current path. A node's state is the last token of
the encoding of its prefix: the suffix token that forms a valid pair with the
state in front of it (merging the two strings together gives these two tokens). So the encoding of a shared prefix is computed once,
and a word's ids are read by walking its states backwards. The last letter of a
word carries the end mark and is a symbol of its own.

The vocabulary file is a parameter (``path``), read where the task runs. A
task keeps up to ``CACHE`` encoded chunks and as many words, and a worker up to
``KEPT`` of both between tasks; they are only saved work.

Defined results: null or blank text has no tokens (decoded: empty); an empty
table gives no rows; repeated rows are encoded alike; control strings of the
vocabulary inside a text become their ids, as the library does; extra columns
are ignored; chunks of any length are encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from txnscore.llm.common import blocks, ship, uncollected

END = "</w>"
CACHE, CACHE_CHARS = 400_000, 64
#: Chunks and words that stay in a worker after a task; more of them go, as the worker's next task may be another stage's.
KEPT = 50_000
#: White space as the vocabulary's pattern sees it (str.split also takes \x1c-\x1f).
_WHITE = "[\t-\r \x85\xa0  -     　]+"
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = itertools.count(256)
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): k
                     for k, m in enumerate(spec["model"]["merges"])}
        self.made = {a + b: (k, a, b) for (a, b), k in self.rank.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.control = {t.upper(): i for t, i in self.special.items()}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.longest = max(len(t.removesuffix(END)) for t in self.ids)
        self.split_special = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")")
        self.letters = _byte_letters()
        self.word, self.white = regex.compile(_WORD), regex.compile(_WHITE)
        self.odd = regex.compile("[\x1c-\x1f]")
        self.pairs: dict[int, bool] = {}  # by both ids
        self.spines: tuple[dict, dict] = {}, {}
        self.library = None

    def spine(self, token: str, side: int) -> list[tuple[str, int, int]]:
        """The parts of ``token`` at its left (0) or right (1) edge, the whole first:
        (part, rank of the merge that made it, rank of the merge that used it)."""
        out = self.spines[side].get(token)
        if out is not None:
            return out
        out, used, part = [], 1 << 30, token
        while True:
            made = self.made.get(part)
            out.append((part, -1 if made is None else made[0], used))
            if made is None:
                self.spines[side][token] = out  # at most one of a token and side
                return out
            used, part = made[0], made[1 + side]

    def valid(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1 at a word's start): merging in
        rank order, then from the left, never joins parts across their border.

        Walks back through the merges that made the two tokens; a pair of parts
        that stood side by side joins if its rank is below that of the merge
        which used the left part and not above that which used the right one."""
        if len(self.pairs) > CACHE:
            self.pairs.clear()
        known = before < 0 or self._apart(self.tokens[before], self.tokens[token])
        self.pairs[before << 20 | token] = known
        return known

    def _apart(self, before: str, token: str) -> bool:
        left, right, rank = self.spine(before, 1), self.spine(token, 0), self.rank
        i = j = 0
        while True:
            (a, made_a, used_a), (b, made_b, used_b) = left[i], right[j]
            m = rank.get((a, b))
            if m is not None and m < used_a and m <= used_b:
                return False
            if made_b >= made_a and made_b >= 0:
                j += 1
            elif made_a >= 0:
                i += 1
            else:
                return True

    def _any_state(self, word: str, n: int, last: list[int]) -> tuple[int, int]:
        """(token, start) of the suffix token of ``word`` that fits the state before it;
        the last letter stands at n - 1 (an end mark may follow)."""
        for j in range(n - self.longest if n > self.longest else 0, n):
            token = self.ids.get(word[j:])
            if token is not None:
                ok = self.pairs.get(last[j] << 20 | token)
                if ok or ok is None and self.valid(last[j], token):
                    return token, j
        raise ValueError(f"no state for {word!r}")

    def encode_words(self, words) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words (byte letters), sharing the work of prefixes.

        The state of a prefix is its only suffix token that fits the state before
        it, so the order of trying is free: the last token with one letter more,
        or the letter alone, and only then every other start."""
        find, fits, valid, other = self.ids.get, self.pairs.get, self.valid, self._any_state
        out, path = {}, ""
        last, size = [-1], [0]  # of each prefix on the path: its last token and that one's length
        for word in sorted(words):
            n = len(word)
            same, top = 0, min(len(path), n - 1)
            while same < top and path[same] == word[same]:
                same += 1
            del last[same + 1:], size[same + 1:]
            for i in range(same + 1, n):
                j = i - 1 - size[-1]
                token = find(word[j:i])
                ok = token is not None and fits(last[j] << 20 | token)
                if not ok and (ok is not None or not valid(last[j], token)):
                    j = i - 1
                    token = find(word[j])
                    ok = fits(last[j] << 20 | token)
                    if not ok and (ok is not None or not valid(last[j], token)):
                        token, j = other(word[:i], i, last)
                last.append(token)
                size.append(i - j)
            path, marked = word[:-1], word + END
            j = n - 1 - size[-1]
            token = find(marked[j:])
            ok = token is not None and fits(last[j] << 20 | token)
            if not ok and (ok is not None or not valid(last[j], token)):
                token, j = other(marked, n, last)
            if not j:
                out[word] = (token,)
                continue
            found = [token]
            while j:
                found.append(last[j])
                j -= size[j]
            found.reverse()
            out[word] = tuple(found)
        return out

    def chunks(self, text: str) -> list[str]:
        """The normalised text cut at white space; control strings are chunks of
        their own, in capitals, which no normalised text has."""
        if any(t in text for t in self.special):
            parts = self.split_special.split(text)
            return [c for p in parts for c in ([p.upper()] if p in self.special else self._plain(p))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower() alone would look for a word's end
        text = text.lower()
        return [c for c in self.white.split(text) if c] if self.odd.search(text) else text.split()

    def words(self, chunk: str) -> list[str]:
        """The words of a chunk, in byte letters."""
        if chunk.isalpha():  # the common shapes: letters, and letters with one sign behind
            found = [chunk]
        elif chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            found = [chunk[:-1], chunk[-1]]
        else:
            found = self.word.findall(chunk)
        if chunk.isascii() and chunk.isprintable():
            return found
        letters = self.letters.__getitem__
        return ["".join(map(letters, w.encode("utf-8", "replace"))) for w in found]

    def packed(self, words) -> dict[str, bytes]:
        """Ids of distinct words (byte letters) as little-endian unsigned 32-bit numbers,
        by a library that merges bytes in rank order.

        It merges any two tokens that spell a third, this vocabulary only those that
        made it; so every pair of neighbours is held against ``valid``, and a word
        with one that is not goes through the trie."""
        words = list(words)
        if not words:
            return {}
        if self.library is None:
            self.library = _library(self)
        encoding, ids_of, last = self.library
        found = np.array(encoding.encode_ordinary("".join([w + _STOP for w in words])), np.int64)
        ends = np.flatnonzero(last[found]) + 1
        ids = ids_of[found]
        pair = np.append(ids[:-1] << 20 | ids[1:], -1)
        pair[ends - 1] = -1
        odd = [k for k in np.unique(pair).tolist() if k >= 0 and not (
            self.pairs[k] if k in self.pairs else self.valid(k >> 20, k & (1 << 20) - 1))]
        raw, at = ids.astype("<u4").tobytes(), (4 * ends).tolist()
        out = {w: raw[a:z] for w, a, z in zip(words, [0, *at], at)}
        if odd:
            wrong = np.unique(np.searchsorted(ends, np.flatnonzero(np.isin(pair, odd)), "right")).tolist()
            again = self.encode_words([words[k] for k in wrong])
            out.update({w: _as_bytes(self, i) for w, i in again.items()})
        return out

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids])


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


#: Stands behind every word in the library's input; no byte letter.
_STOP = "\0"


def _library(bpe: WordBpe):
    """(encoder, id of each of its tokens, which of them end a word): a byte merging
    library over byte letters, of which _STOP is the end mark. Letters of two bytes
    and a word's last letter with its end mark are put together before all else."""
    import tiktoken
    ranks = {bytes([k]): k for k in range(256)}
    for part in [*(c for c in bpe.letters if not c.isascii()), *(c + _STOP for c in bpe.letters), *sorted(bpe.made, key=bpe.made.get)]:
        ranks.setdefault(part.replace(END, _STOP).encode(), len(ranks))
    ids, last = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), bool)
    for token, k in bpe.ids.items():
        at = ranks.get(token.replace(END, _STOP).encode())
        if at is not None:
            ids[at], last[at] = k, token.endswith(END)
    return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}), ids, last


class Chunked:
    """Chunk encodings of a worker: ``encode`` gives the values of new words, ``join``
    puts the values of a chunk's words together."""

    def __init__(self, bpe: WordBpe, encode, join):
        self.bpe, self.encode, self.join = bpe, encode, join
        self.saved, self.words = {}, {}

    def _learn(self, chunks: set[str]) -> None:
        special, known = self.bpe.control, self.words
        if len(known) > CACHE:
            known.clear()
        parts = [(c, [special[c]] if c in special else self.bpe.words(c)) for c in chunks]
        new = {w for _, ws in parts for w in ws if w not in known}
        control = [w for w in new if not isinstance(w, str)]  # ids already
        known.update(self.encode(self.bpe, new.difference(control), control))
        saved, join = self.saved, self.join
        for c, ws in parts:
            saved[c] = known[ws[0]] if len(ws) == 1 else join([known[w] for w in ws])
        for w in new:  # long ones are not worth keeping
            if not isinstance(w, int) and len(w) > CACHE_CHARS:
                del known[w]

    def blocks(self, batches):
        """The blocks of a task's batches; large caches go with the task."""
        try:
            yield from blocks(batches)
        finally:
            if len(self.saved) + len(self.words) > KEPT:
                self.saved, self.words = {}, {}

    @uncollected()
    def block(self, texts) -> list[list]:
        """The values of the chunks of each text."""
        cut = [self.bpe.chunks(t) if t else [] for t in texts]
        flat = list(itertools.chain.from_iterable(cut))
        values = list(map(self.saved.get, flat))
        missing = [i for i, v in enumerate(values) if v is None]
        new = {flat[i] for i in missing}
        if len(self.saved) + len(new) > CACHE:  # only what this block has stays
            self.saved = {c: v for c, v in zip(flat, values) if v is not None}
        self._learn(new)
        for i in missing:
            values[i] = self.saved[flat[i]]
        for c in new:
            if len(c) > CACHE_CHARS:
                del self.saved[c]
        at = [0, *itertools.accumulate(map(len, cut))]
        return [values[a:z] for a, z in zip(at, at[1:])]


def _as_bytes(_, ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def as_text(_, ids) -> str:
    return " ".join(map(str, ids))


def as_decoded(bpe: WordBpe, ids) -> str:
    return bpe.decode(ids)


def ids_by_trie(bpe: WordBpe, words, control) -> dict:
    """New words' ids by the trie."""
    return bpe.encode_words(words) | {k: (k,) for k in control}


def texts_by_trie(bpe: WordBpe, words, control) -> dict:
    """(decimal ids, decoded text) of new words, ids by the trie."""
    return {w: (as_text(bpe, i), as_decoded(bpe, i)) for w, i in ids_by_trie(bpe, words, control).items()}


def bytes_by_library(bpe: WordBpe, words, control) -> dict:
    """New words' ids as bytes, by the library."""
    return bpe.packed(words) | {k: _as_bytes(bpe, (k,)) for k in control}


def _flat(parts):
    return tuple(itertools.chain.from_iterable(parts))


def _spaced(parts):
    return tuple(" ".join([p for p in side if p]) for side in zip(*parts))


@functools.lru_cache(maxsize=4)
def chunked(path: str, encode=bytes_by_library) -> Chunked:
    return Chunked(load(path), encode, {ids_by_trie: _flat, texts_by_trie: _spaced, bytes_by_library: b"".join}[encode])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)

    def task(batches):
        bpe = load(path or vocabulary_path())
        coder = chunked(path or vocabulary_path(), ids_by_trie)
        for b in coder.blocks(batches):
            rows = [list(_flat(values)) for values in coder.block(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(rows, pa.list_(pa.int32())), pa.array([bpe.decode(r) for r in rows])],
                names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, ids array<int>, decoded string")


def _hex(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's columns: token count and digests of ids and decoded text."""
    ship(docs.sparkSession)

    def task(batches):
        coder = chunked(path or vocabulary_path(), texts_by_trie)
        for b in coder.blocks(batches):
            joined, back = zip(*(_spaced(values) or ("", "") for values in coder.block(b.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([s.count(" ") + 1 if s else 0 for s in joined], pa.int64()),
                 pa.array([_hex(s) for s in joined], pa.string()), pa.array([_hex(s) for s in back], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
