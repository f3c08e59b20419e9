"""Operators on odd rows against plain versions: nulls, empty and very long texts,
ties, repeated rows, empty tables, clashing column names."""

import hashlib
import math
import os
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnscore.llm import bpe, fingerprint, langid, packing, partenum, quality, substring, toxicity
from txnscore.llm.common import HashTable, find_words, hash_spans, utf8, written

from . import brute


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_words_of_bytes_are_those_of_the_pattern():
    texts = ["", None, " a\tb\x0bc ", "é🙂 x\x1cy\xa0z w\n\n", "one"]
    data, offsets = utf8(pa.array(texts))
    s, e, rows = find_words(data, offsets)
    for k, t in enumerate(texts):
        got = [data[a:b].tobytes().decode() for a, b in zip(s[rows[k]:rows[k + 1]], e[rows[k]:rows[k + 1]])]
        assert got == brute.words(t)


def test_span_hashes_depend_on_the_bytes_alone():
    data = np.frombuffer(b"abcab abcab", np.uint8)
    h = hash_spans(data, np.array([0, 6, 0, 3]), np.array([5, 11, 2, 5]))
    assert h[0] == h[1] and h[2] == h[3] and h[0] != h[2]


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_components(odd_docs, n, percent):
    rows = rows_of(odd_docs)
    want = brute.components(rows, n, percent)
    got = partenum.join_components(odd_docs, n, percent).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    size = {d: len(brute.shingles(t, n)) for d, t in rows}
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["n_shingles"] == size[r["doc_id"]]


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_linked_sets_share_a_signature(percent):
    rng, limits = np.random.default_rng(5), partenum.Limits(percent)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        k = int(rng.integers(0, limits.differences(2 * n) + 1))
        drop, add = k // 2, k - k // 2
        b = np.concatenate([a[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)])
        shared = n - min(drop, n)
        if not len(b) or 100 * shared < percent * (n + len(b) - shared):
            continue
        grams = np.concatenate([np.sort(a), np.sort(b)])
        sig, row = partenum.signatures(grams, np.array([0, n, n + len(b)]), limits)
        assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())


def test_sketches_never_overstate(spark, odd_docs):
    import itertools
    docs = odd_docs.where("doc_id between 0 and 120").dropDuplicates(["doc_id"])
    sets = {d: brute.shingles(t, 3) for d, t in rows_of(docs)}
    sk = {r["doc"]: r["sketch"] for r in partenum.sketches(docs, 3, 90).collect()}
    for x, y in itertools.combinations(sorted(sets), 2):
        bits = 8 * min(len(sk[x]), len(sk[y]))
        least = int(np.bitwise_count(partenum._bits(sk[x], bits) ^ partenum._bits(sk[y], bits)).sum())
        assert least <= len(sets[x] ^ sets[y])


def test_every_pair_of_an_open_signature_meets_once(spark):
    members = [(1, d, 7 if d < 700 else d) for d in range(1300)]  # one large component, many small ones
    rows = spark.createDataFrame(members, "sig long, doc long, comp long")
    sketch = spark.createDataFrame([(d, 10, bytes(8)) for d in range(1300)], "doc long, size long, sketch binary")
    got = partenum.close_pairs(partenum._dealt(rows, sketch), 90).count()
    assert got == 700 * 600 + 600 * 599 // 2


def test_repeated_windows_go(odd_docs):
    rows = rows_of(odd_docs)
    gone = brute.removed(rows)
    want = Counter()
    for (d, t), g in zip(rows, gone):
        w = brute.words(t)
        left = " ".join(x for i, x in enumerate(w) if i not in g)
        want[(d, len(w), len(g), hashlib.sha256(left.encode()).hexdigest())] += 1
    out = substring.deduplicate(odd_docs).select("doc_id", "n_words", "n_removed", "kept_sha256", "kept").collect()
    assert Counter(tuple(r)[:4] for r in out) == want
    for r in out:  # the cut text holds the kept words
        assert hashlib.sha256(" ".join(brute.words(r["kept"])).encode()).hexdigest() == r["kept_sha256"]


def test_without_repeats_keeps_columns(odd_docs):
    out = substring.without_repeats(odd_docs)
    assert out.schema.simpleString() == odd_docs.schema.simpleString()
    for r in out.collect():
        assert r["row"] == 0 and r["at"] == 13 and (r["text"] is None or r["n_chars"] == len(r["text"]))


def test_automaton_statistics():
    rng = np.random.default_rng(2)
    for _ in range(60):
        passages = [[str(x) for x in rng.integers(0, 3, rng.integers(1, 25))] for _ in range(3)]
        text = [str(x) for x in rng.integers(0, 3, 40)]
        known = {tuple(p[i:j]) for p in passages for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
        want = [max([n for n in range(1, i + 2) if tuple(text[i + 1 - n:i + 1]) in known], default=0) for i in range(len(text))]
        assert substring.Automaton(passages).statistics(text) == want


def test_bpe_equals_the_library(odd_docs):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(bpe.vocabulary_path())
    extra = [(1000, "It's DON'T <|endoftext|>x<|startoftext|> <|ENDOFTEXT|> oftext|>"), (1001, "İΣς á ﬁ²Ⅷ\x1c\x1d\x85​　#!?...")]
    docs = odd_docs.select("doc_id", "text").unionByName(odd_docs.sparkSession.createDataFrame(extra, "doc_id long, text string"))
    want = Counter()
    for d, t in rows_of(docs):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[(d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in bpe.digest(docs).collect()) == want
    one = {r["doc_id"]: r for r in bpe.encode(docs).collect()}
    assert one[1000]["ids"] == lib.encode(extra[0][1], add_special_tokens=False).ids


def test_packing_holds_every_id_once(odd_docs):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(bpe.vocabulary_path())
    docs = odd_docs.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"])
    out = packing.pack(written(packing.pieces(docs), "test-pieces")).collect()
    ids = {d: lib.encode(t or "", add_special_tokens=False).ids + [packing.EOS] for d, t in rows_of(docs)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            own = ids[d][r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and len(own) == r["length"] > 0 and r["doc_tokens"] == len(ids[d])
            assert r["ids_crc32"] == zlib.crc32(np.asarray(own, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids[d])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
    assert len(by_sequence) <= sum(map(len, ids.values())) / packing.CAPACITY + 4
    kept = {r["start"]: r["ids"] for r in packing.pieces(docs.where("doc_id = 911"), keep_ids=True).collect()}
    assert [i for s in sorted(kept) for i in kept[s]] == ids[911]


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(4)
    for _ in range(20):
        h = Counter(32 * min(127, 1 + int(x)) for x in rng.lognormal(2.5, 1, 2000))
        found = packing.patterns(dict(h), 4096)
        got = Counter()
        for pattern, times in found:
            assert times > 0 and sum(n * c for n, c in pattern.items()) <= 4096
            got.update({n: c * times for n, c in pattern.items()})
        assert got == h
        assert sum(t for _, t in found) <= sum(n * c for n, c in h.items()) / 4096 * 1.01 + 3


def plain_phrases(text: str, level: int) -> list[bytes]:
    """The parse of one text, symbol by symbol."""
    def toss(left, own):
        d = left ^ own
        bit = (d & -d).bit_length() - 1 if d else 0
        return 2 * bit + (own >> bit & 1)

    def tossed(labels):
        return [toss(255 if i == 0 else labels[i - 1], x) for i, x in enumerate(labels)]

    raw = text.encode()
    parts = [raw[i:i + 1] for i in range(len(raw))]
    for k in range(level):
        runs = []
        for p in parts:  # a run of equal symbols is one
            if runs and runs[-1][0] == p:
                runs[-1][1] += 1
            else:
                runs.append([p, 1])
        if k == 0:
            labels = [p[0] for p, _ in runs]
        else:
            data = np.frombuffer(b"".join(p for p, _ in runs), np.uint8)
            ends = np.cumsum([len(p) for p, _ in runs])
            names = hash_spans(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
            labels = []
            for i, x in enumerate(names.tolist()):
                d = x ^ names.tolist()[i - 1] if i else (1 << 64) - 1
                bit = (d & -d).bit_length() - 1
                labels.append(2 * bit + (x >> bit & 1))
        for _ in range(3):
            labels = tossed(labels)
        n, out = len(labels), []
        for i, (p, times) in enumerate(runs):
            if i == 0 or 0 < i < n - 1 and labels[i] > labels[i - 1] and labels[i] > labels[i + 1]:
                out.append(b"")
            out[-1] += p * times
        parts = out
    return parts


def test_phrases_against_a_plain_parse():
    texts = ["", "a", "aaaa", "abab abab", "the cat and the dog and the cow " * 3, "éüß日本🙂" * 4, "xyz" * 50]
    names, rows = fingerprint.phrases(pa.array(texts))
    for k, t in enumerate(texts):
        want = plain_phrases(t, fingerprint.LEVEL) if t else []
        data = np.frombuffer(t.encode(), np.uint8)
        ends = np.cumsum([len(p) for p in want]).astype(np.int64)
        assert b"".join(want) == t.encode()
        assert names[rows[k]:rows[k + 1]].tolist() == hash_spans(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends).tolist() \
            if want else rows[k] == rows[k + 1]


def test_fingerprints_of_odd_rows(odd_docs):
    rows = sorted([((d is not None, d or 0), t or "", d) for d, t in rows_of(odd_docs)], key=lambda r: (-r[0][0], -r[0][1], r[1]))
    texts = [t for _, t, _ in rows]
    follow = texts[1:] + texts[:1]
    edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(texts, follow)]
    f, g = fingerprint.fingerprints(texts), fingerprint.fingerprints(edited)
    after = f[1:] + f[:1]
    want = Counter((r[2], len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, round(fingerprint.likeness(a, b), 9),
                    round(fingerprint.likeness(a, c), 9)) for r, t, e, a, b, c in zip(rows, texts, edited, f, g, after))
    got = Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 9), round(r[6], 9)) for r in fingerprint.fingerprint(odd_docs).collect())
    assert got == want


def test_likeness_bounds():
    a, b = fingerprint.fingerprints(["some words that are here " * 9, "other things altogether 123"])
    assert fingerprint.likeness(a, a) == 1 and 0 <= fingerprint.likeness(a, b) < 0.2
    assert fingerprint.likeness("", "") == 1 and fingerprint.likeness("", a) == 0


def test_quality_of_odd_rows(odd_docs):
    for r in quality.judge(odd_docs).where("doc_id >= 900").collect():
        t = dict(rows_of(odd_docs))[r["doc_id"]]
        w = brute.words(t)
        seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        repeat = {p for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for p in range(i, i + 5)}
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(repeat))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(repeat) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = [r for r in langid.op2(spark, "/root/testdata/sf0.01").collect()]
    assert len(got) == len(lang) and all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"] and lang[r["doc_id"]] and r["lang_pred"] != "und"]
    assert np.mean(held) > 0.93


def test_forward_sums_all_segmentations():
    trie = langid.Trie(["_a", "_ab", "b", "ba", "a", "_"], "_ab")
    prob = np.array([[0], [.1], [.2], [.3], [.15], [.05], [.2]])  # order of the pieces, after the floor

    def total(s):
        if not s:
            return 1.0
        out = langid.FLOOR * total(s[1:])
        return out + sum(prob[k + 1][0] * total(s[len(p):]) for k, p in enumerate(trie.pieces) if s.startswith(p))

    got = langid.log_words(trie, prob, ["a", "ab", "aba", "bab", "x"])
    assert np.allclose(np.exp(got[:, 0].astype(float)), [total("_" + w) for w in ["a", "ab", "aba", "bab", "x"]], rtol=1e-4)


def test_a_rare_language_is_learned(spark):
    """Three documents of 9,003, none of them among the first by hash."""
    docs = spark.range(9000).selectExpr("id as doc_id", "'the cat and the dog' as text", "'en' as lang").unionByName(
        spark.createDataFrame([(20001,), (20003,), (20008,)], "id long").selectExpr("id as doc_id", "'der hund und die katze' as text", "'de' as lang"))
    assert langid.train(docs).languages == ["de", "en"]


def test_language_of_odd_rows(odd_docs, no_docs):
    model = langid.fit([("en", "the cat and the dog"), ("de", "der hund und die katze")])
    got = {r["doc_id"]: r for r in langid.predict(odd_docs, model).collect()}
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[900]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.predict(no_docs, langid.train(no_docs)).count() == 0
    kept = langid.identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.where("doc_id in (900, 901, 902)").count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/check_s"
    if not os.path.isdir(sf):
        pytest.skip("no larger sample here")
    docs = spark.read.parquet(f"{sf}/documents.parquet/part-0000.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    test = [d for d in got if d in toxic and fold(d, 5) == 0]
    assert np.mean([got[d] == toxic[d] for d in test]) > 0.97


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7 * i, 1, i % 2) for i in range(40)] + [(None, 1, 1), (900, 1, None)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.train(odd_docs, labels)
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.score(no_docs, toxicity.train(no_docs, labels)).count() == 0
    nothing = toxicity.train(odd_docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(odd_docs, nothing).collect()} == {0}
    kept = toxicity.clean(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["predicted"] == 0 for r in got)


def test_empty_tables(no_docs):
    for out in (partenum.join_components(no_docs, 3, 90), substring.without_repeats(no_docs), bpe.digest(no_docs),
                packing.pack(written(packing.pieces(no_docs), "test-pieces")), fingerprint.fingerprint(no_docs),
                quality.judge(no_docs)):
        assert out.count() == 0


def test_nfc_matters():
    b = bpe.load(bpe.vocabulary_path())
    assert [b.words(c) for c in b.chunks(unicodedata.normalize("NFD", "É"))] == [["Ã©"]]


def test_one_id_with_very_many_texts_sends_one_to_the_fit(spark, monkeypatch):
    """The fit gets one text of an id, and none above the byte bound."""
    sent = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: sent.extend(texts))
    rows = [(7, f"text {k}") for k in range(1500)] + [(1, "good words"), (2, "x" * (toxicity.TEXT_BYTES + 1)), (3, None), (4, "bad")]
    labels = spark.createDataFrame([(7, 1), (1, 0), (2, 0), (3, 0), (4, 1)], "doc_id long, toxic int")
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), labels)
    assert len(sent) <= 4 and not [t for t in sent if len(t) > 100]


def test_convolution_against_a_plain_forward_pass():
    """Scores, and the gradient by differences, of a small network."""
    rng = np.random.default_rng(3)
    words = [f"word{k}" for k in range(30)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 12))) for _ in range(40)]
    labels = np.array([float("word3" in t.split()) for t in texts])
    model = toxicity.fit(texts, labels)
    hashes, rows = toxicity.word_hashes(pa.array(texts))
    table = model.table()
    got = model.logits(hashes, rows, table)
    ids = table.find(hashes)
    for k in range(len(texts)):
        x = model.embed[ids[rows[k]:rows[k + 1]]].sum(axis=1) if rows[k + 1] > rows[k] else np.zeros((0, toxicity.DIM))
        top = np.zeros(len(toxicity.WIDTHS) * toxicity.FILTERS)
        for i, w in enumerate(toxicity.WIDTHS):
            for at in range(len(x) - w + 1):
                r = sum(x[at + j] @ model.conv[i][j] for j in range(w))
                cols = slice(i * toxicity.FILTERS, (i + 1) * toxicity.FILTERS)
                top[cols] = np.maximum(top[cols], r + model.bias[cols])
        assert abs(float(top @ model.out[:-1] + model.out[-1]) - got[k]) < 1e-3


def test_held_out_toxicity_on_the_given_table(spark):
    out = {r.doc_id: r for r in toxicity.op1(spark, "/root/testdata/sf0.01").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if r.toxic is not None and out[r.doc_id].held_out]
    bad, good = ([out[r.doc_id].predicted for r in labels if r.toxic == y] for y in (1, 0))
    assert len(labels) > 20 and sum(good) <= 0.1 * len(good) and (not bad or sum(bad) >= 0.6 * len(bad))


def test_hash_table_keeps_keys_that_share_a_slot():
    keys = np.array([1, 1 + (1 << 12), 1 + (2 << 12), 4095, 4095 + (1 << 12), 1], np.uint64)
    t = HashTable(keys, np.array([1, 2, 3, 4, 5, 6], np.int32), 12)
    assert t.find(keys).tolist() == [1, 2, 3, 4, 5, 1] and t.find(np.array([0, 2, 1 + (3 << 12)], np.uint64)).tolist() == [0, 0, 0]


def plain_word(word, pieces, prob):
    """Log probability of a word, all segmentations summed one prefix at a time."""
    w, at = "_" + word, {p: prob[k + 1] for k, p in enumerate(pieces)}
    a = [0.0]
    for e in range(1, len(w) + 1):
        terms = [a[e - 1] + math.log(langid.FLOOR)] + [a[s] + math.log(at[w[s:e]]) for s in range(e) if w[s:e] in at]
        a.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
    return a[-1]


@pytest.mark.parametrize("letters,dense", [("abcdeü", 1 << 23), ("abcdeü", 0), ("".join(map(chr, range(0x4E00, 0x4E00 + 3000))), 0)])
def test_forward_pass_sums_every_segmentation(monkeypatch, letters, dense):
    """Words of any length, pieces of any length, small and large scripts."""
    monkeypatch.setattr(langid, "DENSE", dense)
    rng = random.Random(2)
    part = letters[:40]
    pieces = sorted({"_" * rng.randint(0, 1) + "".join(rng.choice(part) for _ in range(rng.choice([1, 2, 3, 9, 14]))) for _ in range(300)})
    trie = langid.Trie(pieces, "_" + "".join(sorted(letters)))
    prob = np.random.default_rng(1).random((len(trie.pieces) + 1, 2))
    prob[0] = 0
    prob /= prob.sum(axis=0)
    words = ["".join(rng.choice(part + "z") for _ in range(n)) for n in (1, 2, 8, 31, 32, 33, 60, 60, 250)] + [pieces[0].strip("_") * 5]
    for word, got in zip(words, langid.log_words(trie, prob, words)):
        for k in range(2):
            want = plain_word(word, trie.pieces, prob[:, k])
            assert abs(got[k] - want) < 1e-4 * abs(want)


def test_all_letters_of_a_large_script_are_learned():
    rng = random.Random(4)
    han = [chr(0x4E00 + k) for k in range(1500)]
    rows = [("zh", " ".join("".join(rng.choice(han) for _ in range(rng.randint(1, 50))) for _ in range(30))) for _ in range(60)]
    rows += [("ja", " ".join("".join(rng.choice(han[700:]) for _ in range(rng.randint(1, 50))) for _ in range(30))) for _ in range(60)]
    model = langid.fit(rows)
    assert len(model.alphabet) == 1501
    best, _ = langid._predictor(model)([rows[0][1], rows[-1][1], "x" * 100_000, "1"])
    assert best[:2] == ["zh", "ja"] and best[3] == langid.UNKNOWN


def test_substring_dedup_keeps_columns_that_need_quoting(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, text, 5, "x"), (2, "a " + text, 6, None)], ["doc_id", "text", "my col-1", "a.b"])
    out = substring.without_repeats(docs.withColumn("n_chars", F.length("text").cast("long")))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[2]["my col-1"] == 6 and rows[2]["a.b"] is None and rows[2]["text"].split() == ["a"] and rows[1]["text"] == text


def test_scorers_take_small_blocks(spark, monkeypatch):
    """Blocks of 2 MB made arrays of some hundred MB in each of an executor's workers."""
    from txnscore.llm import common, langid, toxicity
    seen = {}

    def noted(module):
        real = module.blocks

        def run(batches, text="text", limit=common.BLOCK_BYTES):
            seen[module.__name__] = limit
            return real(batches, text, limit)
        return run

    docs = spark.createDataFrame([(1, "the cat", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    tasks = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema, *a: tasks.append(task))
    for module, steps in ((toxicity, (toxicity.score, toxicity.clean)), (langid, (langid.predict, langid.identified))):
        monkeypatch.setattr(module, "blocks", noted(module))
        model = toxicity.Model() if module is toxicity else langid.Model([], "_", np.zeros((1, 0)))
        for step in steps:
            tasks.clear()
            seen.clear()
            step(docs, model)
            assert list(tasks[0](iter(()))) == []
            assert seen == {module.__name__: common.SMALL_BLOCK}


def test_near_duplicates_hash_small_blocks():
    """Hashing the shingles of a 2 MB block held arrays of some 80 MB in each of an executor's workers."""
    import tracemalloc

    from txnscore.llm import common, partenum
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    rows = [None, "", "one", *(" ".join(rng.choices(words, k=300)) for _ in range(960))]
    column = pa.array(rows, pa.string())
    common._POWERS.clear()
    tracemalloc.start()
    try:
        grams, at = partenum.shingle_sets(column, 5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6
    assert len(at) == len(rows) + 1 and at[0] == 0 and at[-1] == len(grams)
    for k in [0, 1, 2, 3, 500, 962]:  # as the text alone
        alone, ends = partenum.shingle_sets(column.slice(k, 1), 5)
        assert grams[at[k]:at[k + 1]].tolist() == alone.tolist() and ends.tolist() == [0, len(alone)]
    none, ends = partenum.shingle_sets(column.slice(0, 0), 5)
    assert len(none) == 0 and none.dtype == np.uint64 and ends.tolist() == [0]


def test_large_token_caches_go_with_the_task(monkeypatch):
    """A worker kept the encoded chunks of the packing stage while it ran other stages."""
    from txnscore.llm import bpe
    coder = bpe.Chunked(bpe.load(bpe.vocabulary_path()), bpe.bytes_by_library, b"".join)
    batch = pa.RecordBatch.from_arrays([pa.array([f"w{k} x{k}" for k in range(50)])], names=["text"])
    for most, stays in ((1000, True), (20, False)):
        monkeypatch.setattr(bpe, "KEPT", most)
        ids = [coder.block(b.column("text").to_pylist()) for b in coder.blocks([batch])]
        assert bool(coder.saved) is stays and bool(coder.words) is stays
        assert ids == [coder.block(batch.column("text").to_pylist())]


def test_arrow_batches_are_bounded_by_bytes(spark):
    """A batch was 10,000 rows of whatever length, in the JVM and in Python."""
    from txnscore.llm import common
    session = spark.newSession()
    common.ship(session)
    docs = session.range(0, 2000, 1, 1).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))

    def task(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    got = docs.mapInArrow(task, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 2000
    assert max(r["size"] for r in got) < 2 * common.ARROW_BYTES
    session.conf.set(common.ARROW_CONF, 1 << 20)  # a session's own figure stays
    common.ship(session)
    assert int(session.conf.get(common.ARROW_CONF)) == 1 << 20


def _judged(rng, n, bad, size):
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(n):
        text = [words[i] for i in rng.integers(0, 400, size)]
        if bad(k):
            text[::5] = ["vile"] * len(text[::5])
        rows.append((k, " ".join(text)))
    return rows


def test_all_labelled_texts_train(spark):
    """2,000 ids of a class, one text of an id and none above 64 KB trained before."""
    rows = [(k, f"text number {k}") for k in range(4500)] + [(7, "second text"), (8, "x" * 70_000), (9, None), (10, "text number 3"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, int(k == 3)) for k in range(4500)] + [(4, None), (5, 2)], "doc_id long, toxic int")
    want = {}
    for d, t in sorted((d, t or "") for d, t in rows if d is not None and d < 4500 and fold(d, 5) != 0):
        want.setdefault(t, int(d == 3))
    got = {}
    for row in toxicity._labelled(docs, labels).collect():
        ends = np.frombuffer(row["ends"], np.int64)
        for x, y, label in zip(ends, ends[1:], np.frombuffer(row["label"], np.int8)):
            assert row["text"][x:y].decode() not in got
            got[row["text"][x:y].decode()] = int(label)
    assert len(want) > 3000 and got == want


def test_long_texts_train(spark):
    """Toxic texts above 64 KB did not train: every text was called clean."""
    rng = np.random.default_rng(4)
    rows = [(d, t) for d, t in _judged(rng, 60, lambda k: k % 2, 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert sum(got[k] == k % 2 for k in range(60)) >= 57


def test_shards_average_to_a_model_that_holds(spark, monkeypatch):
    """Many shards, and the same model however the rows are dealt."""
    monkeypatch.setattr(toxicity, "SHARD", 150)
    rng = np.random.default_rng(5)
    rows = _judged(rng, 900, lambda k: k % 4 == 0, 60)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(900)], "doc_id long, toxic int")
    models = []
    for parts in (2, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        models.append(toxicity.train(docs, labels.repartition(parts)))
    for a, b in zip(toxicity._parameters(models[0]), toxicity._parameters(models[1])):
        assert np.array_equal(a, b)
    assert np.array_equal(models[0].limits, models[1].limits) and np.array_equal(models[0].keys, models[1].keys)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, models[0]).collect()}
    assert np.mean([got[k] == (k % 4 == 0) for k in range(900) if fold(k, 5) == 0]) > 0.97
