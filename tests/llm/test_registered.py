"""The registered queries, by name, against brute force over the smallest tables."""

import hashlib
import html
import re
import zlib

import pytest

from recordloom.llm import decontaminate as D, queries as Q

from .test_ngram_join import brute
from .test_text_operators import repeated

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def run(spark, sf, name):
    return Q.queries()[name](spark, sf).collect()


def test_op2(spark, sf, docs):
    want, _, _ = repeated(docs.items(), 10)
    got = {r.doc_id: r for r in run(spark, sf, "op2_line_dedup")}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        lines = text.split("\n")
        kept = "\n".join(x for k, x in enumerate(lines) if k not in want[i])
        assert (got[i].n_lines, got[i].n_removed, got[i].removed_lines) == (len(lines), len(want[i]), ",".join(map(str, sorted(want[i]))))
        assert (got[i].kept_chars, got[i].kept_sha256) == (len(kept), hashlib.sha256(kept.encode()).hexdigest())


def test_op4(spark, sf, docs):
    base = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
    got = {r.doc_id: r for r in run(spark, sf, "op4_licences")}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        w = WORDS.findall(text.translate(LOW))
        places = [(k, label) for p, label in base for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r, starts = got[i], [k for k, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))


def test_op5(spark, sf, docs):
    got = run(spark, sf, "op5_quality")
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_op6(spark, sf):
    rules = sorted(Q.RULES, key=lambda r: -len(r[1] + r[2]))
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r for r in run(spark, sf, "op6_url_filter")}
    assert got.keys() == pages.keys()
    for i, url in pages.items():
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else None
        host = re.split(r"[/?#]", rest)[0].translate(LOW) if rest is not None else ""
        path = re.split(r"[?#]", rest[len(host) :])[0] if rest is not None else ""
        hit = next(((v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, hit and hit[1])
        assert got[i].verdict == hit[0] if hit else got[i].verdict in ("allow", "block")


def test_op7(spark, sf, docs):
    ids = sorted(docs)
    got = {r.doc_id: r for r in run(spark, sf, "op7_fingerprint")}
    assert sorted(got) == ids
    prints = {}
    for i, j in zip(ids, ids[1:] + ids[:1]):
        x, y, r = docs[i], docs[j], got[i]
        half = len(x) // 2
        edited = x[: len(x) - half] + y[:half]
        assert (r.n_chars, r.edited_sha256) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        for text, fp in ((x, r.fingerprint), (edited, r.edited_fingerprint)):
            assert prints.setdefault(text, fp) == fp
        if x == y:
            assert r.near_next == 1


def test_op8(spark, sf, docs):
    want, sets = brute(sorted(docs.items()))
    got = {r.doc_id: r for r in run(spark, sf, "op8_ngram_join")}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets}


def test_op9(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r for r in run(spark, sf, "op9_main_text")}
    assert got.keys() == pages.keys()
    for i, p in pages.items():
        inside = re.search(r"<article>(.*)</article>", p.html or "", re.S)
        want = html.unescape(re.sub(r"<(?:/?b)>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inside[1]))) if inside else ""
        assert (got[i].url, got[i].text, got[i].n_chars) == (p.url, " ".join(want.split()), len(" ".join(want.split())))


def test_op10(spark, sf, docs):
    items = {r.item_id: WORDS.findall(r.text.translate(LOW)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for d, text in docs.items():
        w = WORDS.findall(text.translate(LOW))
        for i, q in items.items():
            if any(D.subsequence(q, w[max(0, a - len(q)) : a + 32 + len(q)]) >= 0.7 * len(q) for a in range(0, max(1, len(w)), 16)):
                want.add((d, i))
    got = {(r.doc_id, r.item_id): r for r in run(spark, sf, "op10_decontaminate")}
    assert {k for k, r in got.items() if r.kind == "copy"} == want
    assert all(0.5 <= r.overlap <= 1 and r.cosine >= 0.4 for r in got.values())
