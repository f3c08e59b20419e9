"""Periodic runs, licence scans and tokenizer alignment against plain versions."""

import hashlib
import random
import re
import unicodedata
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnscore.llm import crosstoken as C
from txnscore.llm import license as L
from txnscore.llm import partenum
from txnscore.llm import periodic as P

from . import brute
from .conftest import texts

SF_SMALL = "/root/testdata/sf0.001"


def sha(s) -> str:
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


# periodic runs

def plain_runs(w, shortest=6, times=4):
    """Runs by testing every period at every place."""
    n, out = len(w), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(shortest, times * q):
                part = w[i:i + size]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def edited(doc, w):
    h = zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def plain_digest(doc, text, edit=edited):
    w = edit(doc, brute.words(text))
    runs = plain_runs(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words_with_repeats(seed):
    rng = random.Random(seed)
    for _ in range(150):
        docs = []
        for _ in range(3):
            k = rng.choice([1, 2, 3, 8])
            w = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
            a = rng.randint(0, len(w))
            w[a:a] = w[a:a + rng.randint(1, 6)] * rng.randint(0, 9)
            docs.append(w)
        rows = np.cumsum([0] + [len(d) for d in docs])
        found = P.block_runs(np.array(sum(docs, []), np.uint64), rows)
        for k, d in enumerate(docs):
            assert [tuple(map(int, r)) for r in zip(*found.get(k, ()))] == plain_runs(d)


def test_suffix_tree_orders_and_extensions():
    rng = random.Random(5)
    for _ in range(60):
        w = [rng.randrange(1, 4) for _ in range(rng.randint(1, 40))]
        t = P.SuffixTree([*w, 0], 4)
        order = sorted(range(len(w) + 1), key=lambda i: [*w, 0][i:])
        assert [t.ranks()[i] for i in order] == list(range(len(order)))
        down = sorted(range(len(w) + 1), key=lambda i: [-x if x else -9 for x in [*w, 0][i:]])
        assert [t.ranks_down(1)[i] for i in down] == list(range(len(down)))
        i, j = (np.array(x) for x in zip(*[(a, b) for a in range(len(w)) for b in range(len(w)) if a != b] or [(0, len(w))]))
        for a, b, n in zip(i, j, t.extension(i, j)):
            same = next((k for k in range(len(w) + 1) if [*w, 0][a + k:a + k + 1] != [*w, 0][b + k:b + k + 1]), 0)
            assert n == same


def test_a_run_over_a_whole_long_text():
    w = np.tile(np.arange(5000, dtype=np.uint64), 4)
    (run,) = zip(*P.block_runs(w, np.array([0, len(w)]))[0])
    assert tuple(map(int, run)) == (0, 20000, 5000)
    one = P.block_runs(np.ones(30000, np.uint64), np.array([0, 30000]))[0]
    assert [int(x[0]) for x in one] == [0, 30000, 1]


def test_run_digests_of_odd_documents(spark, odd_docs, no_docs):
    some = [r for r in odd_docs.select("doc_id", "text").collect() if len(brute.words(r[1])) < 2500]
    long = [r for r in odd_docs.select("doc_id", "text").collect() if len(brute.words(r[1])) >= 2500]
    assert long  # a very long text goes through as well, its plain version is too slow
    got = Counter(tuple(r) for r in P.digest(odd_docs, P.planted).collect())
    assert got >= Counter(plain_digest(*r) for r in some) and sum(got.values()) == odd_docs.count()
    raw = {r.doc_id: r for r in P.collapse(odd_docs).collect()}
    assert raw[909].collapsed == "the same words again" and [tuple(x) for x in raw[909].runs] == [(0, 120, 4)]
    assert raw[900].runs == [] and raw[900].collapsed == "" and raw[900].n_words == 0
    assert P.digest(no_docs).count() == 0 and P.collapse(no_docs).count() == 0


def test_run_query_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    small = [(r.doc_id, r.text) for r in docs if len(brute.words(r.text)) < 900]
    got = {r.doc_id: tuple(r) for r in P.op11(spark, SF_SMALL).collect()}
    assert len(got) == len(docs) and len(small) > 100
    for doc, text in small:
        assert got[doc] == plain_digest(doc, text)


# licence scan

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text))


def plain_matches(text, templates, percent):
    w, half = plain_words(text), L.BLOCK_WORDS // 2
    out = set()
    for k, s in enumerate(range(0, max(len(w) - half, 1), half) if w else ()):
        for t, (_, notice) in enumerate(templates):
            words = set(plain_words(notice))
            if 100 * len(words & set(w[s:s + L.BLOCK_WORDS])) >= percent * len(words):
                out.add((k, t))
    return out


def test_every_matching_block_is_found(spark):
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefghij") + rng.choice(["", "x", "é", "9"])
    rows = [(k, " ".join(word() for _ in range(rng.choice([0, 1, 5, 40, 64, 65, 97, 300])))) for k in range(120)]
    docs = spark.createDataFrame([*rows, (None, "a b c"), (500, None)], "doc_id long, text string").repartition(3)
    templates = [(f"t{k}", " ".join(word() for _ in range(rng.randint(1, 25)))) for k in range(30)]
    for percent in (40, 60, 80, 100):
        got = {(r.doc_id, r.block, r.template) for r in L.matches(docs, templates, percent).collect()}
        want = {(d, k, t) for d, text in [*rows, (None, "a b c")] for k, t in plain_matches(text, templates, percent)}
        assert got == want and got


def test_labels_of_odd_documents(spark, odd_docs, no_docs):
    more = [(70, "x\nReleased under the MIT License."), (71, "cc by cc-by CC  BY"), (72, "gnu general public"),
            (73, "Redistribution and use in source and binary forms with or without modification are permitted " * 9),
            (74, "mit"), (75, "mit license" * 2), (76, "licensed under the apache-license, version 2.0"), (None, "mit license")]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r.doc_id: tuple(r)[1:] for r in L.labelled(docs).collect()}
    assert got[70] == (6, 1, 4, 4, "mit", "mit,mit-notice", 1.0)
    assert got[71] == (6, 3, 0, 4, "cc-by", "cc-by", 1.0)
    assert got[72] == (3, 0, None, None, "", "", 0.0)
    assert got[73][1:] == (0, None, None, "", "bsd", 1.0)
    assert got[75] == (3, 0, None, None, "", "", 0.0) and got[74][1] == 0
    assert got[76] == (8, 1, 3, 3, "apache", "apache,apache-2.0", 1.0)
    assert got[None][1] == 1 and got[900] == (0, 0, None, None, "", "", 0.0)
    assert L.labelled(no_docs).count() == 0
    assert L.labelled(odd_docs).count() == odd_docs.count()


def test_template_words_are_bounded(spark, odd_docs):
    with pytest.raises(ValueError):
        L.matches(odd_docs, [("none", " ,. ")])


# alignment

@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(C.default_paths()[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=C.default_paths()[1]), C.load(*C.default_paths())


ODD = [None, "", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "\n  b", "x\n", "x\ny", "a\n b", "a \nb", "\n\n a", "Ünï cödé 🙂 日本語 ▁ x",
       "a▁b", "<|endoftext|> hi <s> </s> <unk> <0x41>", "\x00a b", "a b　c", "tab\t x", "it's we'll 'tis  don't",
       "1234 56 7", "é́", "a" * 3000, "ab " * 900, "\r\n \r\n", "İ ǅ ß", "퟿ ￿ \U0010ffff"]


def plain_alignment(libraries, text):
    """(A ids, B ids, groups, links) with the libraries on the whole text; None without tokens."""
    la, lb, pair = libraries
    if not text:
        return None
    a, b = la.encode(" " + text, add_special_tokens=False).ids, lb.encode(text)
    ends = []
    for ids, spelt in ((a, pair.bytes_a), (b, pair.bytes_b)):
        if b"".join(spelt[k] for k in ids) != (" " + text).encode():
            return None
        ends.append(np.cumsum([len(spelt[k]) for k in ids]).tolist())
    groups, links, i, j = [], [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        x, y = bisect_left(ends[0], e) + 1, bisect_left(ends[1], e) + 1
        groups.append((a[i:x], b[j:y]))
        links.append((a[x - 1], b[y - 1]))
        i, j = x, y
    return a, b, groups, links


def plain_statistics(libraries, rows):
    aligned = [(d, plain_alignment(libraries, t)) for d, t in rows]
    count = Counter(link for _, r in aligned if r for link in r[3])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = Counter()
    for d, r in aligned:
        if r is None:
            out[d, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in r[2])
        out[d, len(r[0]), len(r[1]), len(r[2]), len(r[3]), sum(count[k] == top[k[1]] for k in r[3]),
            sum(count[k] for k in r[3]), sha(text)] += 1
    return out


def test_merge_path_pieces_of_any_size():
    rng = np.random.default_rng(2)
    for _ in range(600):
        u = np.arange(1, int(rng.integers(2, 400)))
        a, b = u[rng.random(len(u)) < rng.random()], u[rng.random(len(u)) < rng.random()]
        piece = int(rng.integers(1, 40))
        i, j = C.diagonals(a, b, piece)
        assert np.all(np.diff(i + j)[:-1] == piece) and i[-1] == len(a) and j[-1] == len(b)
        x, y = C.shared_ends(a, b, piece)
        assert np.array_equal(a[x], np.intersect1d(a, b)) and np.array_equal(b[y], np.intersect1d(a, b))


def test_chunks_spell_as_whole_texts(libraries):
    pair, rng = libraries[2], random.Random(3)
    pool = list("ab \n\t '19.é▁ 　🙂日\x00<>|\r\x1c\x85 ")
    some = ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    al = C.Aligned(pair, some)
    for k, (text, listed) in enumerate(zip(some, al.listed())):
        r = plain_alignment(libraries, text)
        want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in r[2]) if r else ""
        assert listed == want and al.n_a[k] == (len(r[0]) if r else 0), text


def test_a_is_spelt_as_its_library_does_over_all_assigned_code_points(libraries):
    signs = [chr(k) for k in [*range(0xD800), *range(0xE000, 0x32000), *range(0xE0000, 0xE0200)]]
    some = [f" a{c}b {c}1{c} {c}'s  {c}\n{c}" for c in signs if unicodedata.category(c) not in ("Cn", "Co")]
    for at in range(0, len(some), 5000):
        for text, e in zip(some[at:at + 5000], libraries[0].encode_batch_fast(some[at:at + 5000], add_special_tokens=False)):
            assert libraries[2].a.encode_ordinary(text) == e.ids


@pytest.mark.parametrize("hot", [0, 7, 200_000])
def test_alignment_statistics_of_odd_documents(spark, libraries, odd_docs, no_docs, monkeypatch, hot):
    """With any number of pairs kept in the tasks the links are counted alike."""
    monkeypatch.setattr(C, "HOT", hot)
    monkeypatch.setattr(C, "HELD_PAIRS", 50)
    rows = [(k, t) for k, t in enumerate(ODD)] + [tuple(r) for r in odd_docs.select("doc_id", "text").collect()] + texts()[:9]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r) for r in C.statistics(docs).collect())
    assert got == plain_statistics(libraries, rows)
    assert C.statistics(odd_docs).count() == odd_docs.count() and C.statistics(no_docs).count() == 0


def test_alignment_query_equals_the_plain_version(spark, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert Counter(tuple(r) for r in C.op13(spark, SF_SMALL).collect()) == plain_statistics(libraries, docs)


def test_groups_are_real_id_lists(spark, libraries):
    rows = [(k, t) for k, t in enumerate(ODD)]
    for r in C.align(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        p = plain_alignment(libraries, ODD[r.doc_id])
        assert [(g.a, g.b) for g in r.groups] == (p[2] if p else [])


# signatures that meet

def test_groups_that_go_over_many_batches_meet_as_one(spark):
    """Sorted partitions read in batches of three rows: every group gets its least
    document, wherever its rows are cut."""
    from txnscore.llm import partenum
    rng = random.Random(8)
    rows = []
    for sig in range(12):
        docs = [rng.randrange(40) for _ in range(rng.choice([1, 1, 2, 7, 30]))]
        rows += [(sig, sig % 2, d, d, rng.choice([0, 0, 0, 5]) if sig % 3 else 0) for d in set(docs)]
    rows += [(sig, 0, 100 + k, 3, 0) for k, sig in enumerate((1, 2, 2))]  # linked inside a block
    least, members = {}, {}
    for s, s2, d, p, _ in rows:
        if d == p:
            least[s, s2] = min(d, least.get((s, s2), d))
            members.setdefault((s, s2), set()).add(d)
    want = {(s, s2, d, least[s, s2], n) if d == p else (s, s2, d, p, n) for s, s2, d, p, n in rows
            if d != p or n or len(members[s, s2]) > 1}
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame(rows, partenum.SIGNED).repartition(4)
        got = [tuple(r) for r in partenum.meet(df).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert set(got) == want and len(got) == len(want)


def test_texts_are_sorted_out_before_their_join(spark):
    """Texts without a partner went through the shuffle of the join that drops them."""
    rows = spark.range(-3000, 30000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = rows.unionByName(rows.where("doc_id % 3 = 0"))
    ids = rows.where("doc_id % 7 = 0").select("doc_id").distinct()
    got, whole = partenum._among(rows, ids), rows.join(ids, "doc_id")
    assert got.columns == rows.columns
    assert got.count() == whole.count() and got.exceptAll(whole).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan.lower()
    none = partenum._among(rows, ids.where("doc_id is null"))
    assert none.count() == 0


def _row_counts(monkeypatch, partenum):
    """Rows of every table that near duplicates write, by name."""
    counts, real = {}, partenum.written

    def noted(df, name):
        out = real(df, name)
        counts.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(partenum, "written", noted)
    return counts


def test_equal_texts_sign_once(spark, monkeypatch):
    """Every block that held a text signed for it: rows grew with copies times signatures."""
    rng = random.Random(5)
    text, other = (" ".join(str(rng.randrange(10**6)) for _ in range(300)) for _ in "ab")
    rows = [(k, text) for k in range(80)] + [(100, other), (100, text), (101, other), (102, other + " end"), (103, None), (104, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id")
    counts = _row_counts(monkeypatch, partenum)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in partenum.join_components(docs).collect()}
    assert got == {(k, 296): 0 for k in [*range(80), 100, 101]} | {(102, 297): 0, (103, 0): 103, (104, 0): 104}
    assert counts["partenum-met"][0] < 600


def test_pairs_of_a_family_are_compared_once(spark, monkeypatch):
    """Near copies and half copies share hundreds of signatures, each compared for itself."""
    rng = random.Random(6)
    base = [str(rng.randrange(10**6)) for _ in range(300)]
    rows = []
    for k in range(60):  # every fourth is too far from the others
        words, at = list(base), rng.randrange(260)
        words[at] = f"own{k}"
        if k % 4 == 0:
            words[at:at + 60] = [f"far{k}x{i}" for i in range(60)]
        rows.append((k, " ".join(words[:300])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    want = {d: c for d, c in brute.components(rows, 5, 80).items()}
    counts = _row_counts(monkeypatch, partenum)
    assert {r.doc_id: r.component_id for r in partenum.join_components(docs).collect()} == want
    assert 1 < len(set(want.values())) and max(counts["partenum-dealt"]) <= 4 * len(rows)
