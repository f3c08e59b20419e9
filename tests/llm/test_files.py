"""WARC archives, chat formatting and the pipeline."""

import hashlib
from collections import Counter

import pyarrow.fs as pafs
import pytest
import zstandard

import corpus_pipeline as P
from txnscore.llm import chat, langid, toxicity, warc
from txnscore.llm.common import written
from txnscore.session import scratch_path

from . import brute

SF_SMALL = "/root/testdata/sf0.001"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, last long, digest long")


@pytest.fixture(scope="module")
def odd_pages(spark):
    long, other = "<p>é🙂 again</p>" * 100, "<div>" + "z" * 3000
    rows = [(1, "http://a", long), (2, "http://b", long), (9, None, long), (9, "http://c", long), (3, "u", None), (4, "u", ""),
            (5, "u\r\nX: y", "short"), (6, "u", "short"), (None, "http://n", long), (-7, "u", other), (-8, "u", other),
            (10, "u", "WARC/1.1\r\n\r\nx" * 200), (11, "u", "q" * 3_000_000)]
    return pages(spark, [(*r, 0, 0) for r in rows])


def test_archives_round_trip(spark, odd_pages):
    folder = "file://" + scratch_path(spark, "warc-test")
    manifest = written(warc.write_archives(odd_pages, folder), "warc-test-manifest")
    got = warc.read_archives(manifest, folder).collect()
    rows = [(r["page_id"], r["html"] or "") for r in odd_pages.collect()]
    want = Counter()
    for p, h in rows:
        raw = h.encode()
        same = [q for q, g in rows if g == h and q is not None]
        again = p is not None and len(raw) >= 1000 and p < max(same)
        want[(p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", max(same) if again else None)] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4]) for r in got) == want
    assert sum(r["records"] for r in manifest.collect()) == len(rows)


def test_an_archive_begins_with_its_dictionary():
    records = [warc.record(i, "u", (f"<html><body>{i} " + "common text " * 40).encode(), "0", None) for i in range(200)]
    raw = warc.archive(records)
    assert int.from_bytes(raw[:4], "little") == warc.DICT_MAGIC and int.from_bytes(raw[4:8], "little") > 0
    assert list(warc.frames(raw)) == records
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(raw) < 0.7 * plain
    frame = raw[8 + int.from_bytes(raw[4:8], "little"):]  # needs the dictionary
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompressobj().decompress(frame)
    assert list(warc.frames(warc.archive(records[:2]))) == records[:2]


def test_a_damaged_payload_is_found(spark):
    folder = "file://" + scratch_path(spark, "warc-bad")
    bad = warc.record(1, "u", b"payload", "0" * 40, None)
    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(base)
    with store.open_output_stream(f"{base}/x.warc.zst") as f:
        f.write(warc.archive([bad]))
    manifest = spark.createDataFrame([(f"{base}/x.warc.zst", 1, 1)], warc.MANIFEST)
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(manifest, folder).collect()


def test_no_pages(spark, odd_pages):
    folder = "file://" + scratch_path(spark, "warc-none")
    manifest = written(warc.write_archives(odd_pages.limit(0), folder), "warc-none-manifest")
    assert manifest.count() == 0 and warc.read_archives(manifest, folder).count() == 0


def test_record_ids():
    assert [warc.page_of(warc.record_id(x)) for x in (0, 1, -1, 2**62, -2**63, None)] == [0, 1, -1, 2**62, -2**63, None]


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi & <|im_end|> &1; &amp;"), (1, 2, "assistant", "</s>[INST] ok"),
    (2, 0, "user", None), (2, 1, None, "no role"), (2, 2, "user", "x"), (3, 5, "assistant", "first"), (3, None, "user", "null turn"),
    (4, 0, "user", "tie b"), (4, 0, "user", "tie a"), (4, 0, "user", "tie a"), (None, 0, "user", "no conv"),
    (5, 0, "user", "[[INST]INST]<<s>s><|im_start|>user\n"), (5, 1, "assistant", "日本 &n; \n"), (6, 0, "odd\nrole&", "t" * 100_000)]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*t, 1, "x") for t in TURNS],
                                 "conv_id long, turn long, role string, text string, segments int, formatted string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(rows)).collect()}
    assert set(got) == {t[0] for t in TURNS}
    for conv, r in got.items():
        own = sorted([t for t in TURNS if t[0] == conv], key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(x["role"], x["text"]) for x in r["turns"]] == [(t[2] or "", t[3] or "") for t in own]
        assert r["loss_text"] == "".join(t[3] or "" for t in own if t[2] == "assistant")
        for c in chat.CONTROLS:
            assert r["formatted"].count(c) == (len(own) if c in (chat.OPEN, chat.CLOSE) else 0)
    assert {c: r["first_break"] for c, r in got.items()} == {1: -1, 2: 1, 3: 1 if got[3]["first_break"] == 1 else -1, 4: 1, None: -1, 5: -1, 6: 0}
    assert chat.digest(chat.read_back(chat.format_conversations(rows.limit(0)))).count() == 0


def test_the_state_machine(spark):
    cases = {"u": -1, "su": -1, "sua": -1, "uaua": -1, "a": 0, "s": -1, "ss": 1, "uu": 1, "suaa": 3, "us": 1}
    name = {"u": "user", "s": "system", "a": "assistant"}
    rows = [(k, i, name[c], "x") for k, case in enumerate(cases) for i, c in enumerate(case)]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r["first_break"] for r in got.collect()}
    assert [got[k] for k in range(len(cases))] == list(cases.values())


def test_stages_against_plain_versions(spark, odd_docs):
    """Each stage is judged on its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").unionByName(
        odd_docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id is not null"))
    docs = written(docs, "pipeline-in")
    seen = {}
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
        seen[name] = ([tuple(r) for r in docs.collect()], [tuple(r) for r in out.collect()], out)
        docs = out
    before, after, _ = seen["language_id"]
    assert set(after) <= set(before) and not [r for r in after if not any(c.isalpha() for c in r[1] or "")]
    before, after, _ = seen["near_duplicates"]
    # rows are judged, not ids: of each component of rows one with the least id stays, of blank rows one of an id and text
    comp, groups = brute.components([(k, r[1]) for k, r in enumerate(before)], 5, 80), {}
    for k, r in enumerate(before):
        groups.setdefault(comp[k] if brute.words(r[1]) else r[:2], []).append(r[0])
    assert Counter(r[0] for r in after) == Counter(min(g) for g in groups.values())
    before, after, _ = seen["substring_dedup"]
    want = Counter()
    for r, gone in zip(before, brute.removed([r[:2] for r in before])):
        w = brute.words(r[1])
        if len(gone) < len(w) or not w:
            want[(r[0], tuple(x for i, x in enumerate(w) if i not in gone))] += 1
    assert Counter((r[0], tuple(brute.words(r[1]))) for r in after) == want
    before, after, out = seen["packing"]
    assert set(out.select("doc_id").distinct().toPandas()["doc_id"]) == {r[0] for r in before}
    parts = Counter()
    for r in after:
        parts[r[0]] += r[2]
    whole = Counter()  # rows of one id count each, by their first piece
    for r in after:
        whole[r[0]] += r[4] if r[1] == 0 else 0
    assert parts == whole and sum(r[1] == 0 for r in after) == len(before)


def test_near_duplicates_judges_rows(spark):
    """One doc_id over unlike texts, one of them a near copy of a smaller id's."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, one), (5, one + " more"), (5, two), (5, two), (5, two + " end"), (5, three), (9, three), (None, one), (None, one),
            (7, None), (7, None), (7, ""), (7, " \t"), (8, None), (6, "few words"), (6, "Few words"), (6, "other")]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, node int").repartition(4)
    out = P.near_duplicates(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], (r["text"] or "").lower().removesuffix(" end") if r["text"] else r["text"]) for r in out.collect())
    assert got == Counter([(1, one), (5, two), (5, three), (None, one), (None, one), (7, None), (7, ""), (7, " \t"), (8, None),
                           (6, "few words"), (6, "other")])


def test_filters_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = toxicity.train(docs, labels)
    bad = {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    kept = {r["doc_id"] for r in P.toxicity_filter(spark, docs, SF_SMALL).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - bad
    known = {r["doc_id"] for r in langid.predict(docs, langid.train(docs)).where("score >= 0.3").collect()}
    assert {r["doc_id"] for r in P.language_id(spark, docs, SF_SMALL).collect()} == known


def test_run_equals_its_stages(spark):
    out = P.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0
