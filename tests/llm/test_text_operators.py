"""Quality, licences, fingerprints, line dedup and decontamination on small fixtures."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from recordloom.llm import decontaminate as D, fingerprint as P, licences as L, line_dedup as N, quality as Q

from .conftest import ODD


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = Q.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]
    test = got[got.held_out]
    assert ((test.predicted == test.quality).mean()) > 0.9
    assert (got.predicted == (got.score >= 0.3)).all()


def test_quality_odd_rows(spark, docs_of):
    docs = docs_of(ODD * 2)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(ODD) * 2)], "doc_id long, quality int, toxic int")
    got = Q.classify(docs.withColumn("score", F.lit("x")), labels).collect()
    assert len(got) == len(ODD) * 2 and all(0 <= r.score <= 1 for r in got)
    empty = [r.score for r in got if r.doc_id in (0, 1)]
    assert empty[0] == empty[1]
    assert Q.classify(docs_of([]), labels).isEmpty()
    none = Q.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    batch = [f"good text {i}" for i in range(40)] + [f"BAD!! {i}!!" for i in range(40)]
    model = Q.fit(batch, [1] * 40 + [0] * 40)
    got = {r.doc_id: r.predicted for r in Q.score(docs_of(["good text 99", "BAD!! 99!!"]), model).collect()}
    assert got == {0: 1, 1: 0}


EXPRESSIONS = [
    ("MIT", True, True, ["mit"], []), ("MIT AND GPL-3.0-only", True, False, ["gpl-3.0-only", "mit"], []), ("MIT OR GPL-3.0-only", True, True, ["gpl-3.0-only", "mit"], []),
    ("GPL-2.0-only OR MIT AND GPL-3.0-only", True, False, ["gpl-2.0-only", "gpl-3.0-only", "mit"], []), ("(GPL-2.0-only OR MIT) and ISC */", True, True, ["gpl-2.0-only", "isc", "mit"], []),
    ("GPL-2.0-only WITH Classpath-exception-2.0", True, False, ["gpl-2.0-only with classpath-exception-2.0"], []), ("GPL-2.0 OR GPL-2.0 WITH LLVM-exception", True, False, ["gpl-2.0", "gpl-2.0 with llvm-exception"], []),
    ("GPL-2.0+", True, False, ["gpl-2.0+"], []), ("Apache-2.0+", True, True, ["apache-2.0+"], []), ("hello", True, False, [], ["hello"]), ("MIT OR hello", True, True, ["mit"], ["hello"]), ("MIT WITH hello", True, False, ["mit"], ["hello"]), ("LicenseRef-own", True, False, ["licenseref-own"], []),
    ("", False, False, [], []), ("MIT OR", False, False, [], []), ("(MIT", False, False, [], []), ("MIT ISC", False, False, [], []), (")", False, False, [], []),
]


@pytest.mark.parametrize("text, valid, allowed, names, unknown", EXPRESSIONS)
def test_licence_expressions(text, valid, allowed, names, unknown):
    assert L.evaluate(text) == (valid, allowed, names, unknown)


def test_licence_tags(spark, docs_of):
    t = ["a SPDX-License-Identifier: MIT\nb spdx license identifier MIT\nc SPDX-License-Identifier : hello OR ISC\r\nSPDX-License-Identifier:", "SPDX-License-Identifier: MIT SPDX-License-Identifier: ISC", None]
    got = {r.doc_id: r.expressions for r in L.scan(docs_of(t)).collect()}
    assert [(e.text, e.valid, e.licences, e.unknown) for e in got[0]] == [("MIT", True, ["mit"], []), ("hello OR ISC", True, ["isc"], ["hello"]), ("", False, [], [])]
    assert [e.valid for e in got[1]] == [False, True] and got[2] == []


def test_licence_scan(spark, docs_of):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rnd = random.Random(1)
    bits = ["CC", "BY", "by", "General", "public", "License", "All", "rights", "reserved", "é", "x9"]
    t = ODD + ["".join(rnd.choice(bits) + rnd.choice([" ", "-", ".\n", "  "]) for _ in range(40)) for _ in range(60)] + ["// SPDX-License-Identifier: MIT OR GPL-2.0-only\nx", "cc by cc by cc by"]
    got = {r.doc_id: r for r in L.scan(docs_of(t).withColumn("places", F.lit(1))).collect()}
    for i, text in enumerate(t):
        w = words.findall((text or "").translate(low))
        want = sorted((k, label) for p, label, _ in L.BASE for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        assert got[i].n_words == len(w)
        assert sorted((p.word, p.label) for p in got[i].places if p.base) == want
        assert 0 <= got[i].score < 1
    assert got[len(t) - 2].expressions[0].licences == ["gpl-2.0-only", "mit"]
    assert L.scan(docs_of([])).isEmpty()


def test_fingerprints(spark, docs_of):
    t = ["a b c d e f\nsecond line here", "second line here\na b c d e f", "", None, "x", *["p q r s t u v w x y z " * 5 + str(i) for i in range(9)], "dup", "dup"]
    df = docs_of(t, 5).withColumn("fingerprint", F.lit(1))
    rows = sorted(P.compare_edited(df).collect(), key=lambda r: r.doc_id)
    texts = [x or "" for x in t]
    for k, r in enumerate(rows):
        x, y = texts[k], texts[(k + 1) % len(texts)]
        h = len(x) // 2
        assert r.edited_sha256 == hashlib.sha256((x[: len(x) - h] + y[:h]).encode()).hexdigest()
        assert r.n_chars == len(x) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if x == y:
            assert r.near_next == 1 and r.fingerprint == rows[(k + 1) % len(rows)].fingerprint
    assert rows[0].fingerprint.split(":")[0] == rows[1].fingerprint.split(":")[0]  # order of paragraphs doesn't matter
    assert P.compare_edited(docs_of([])).isEmpty()
    many = docs_of([f"row {i}" for i in range(300)]).withColumn("doc_id", F.when(F.col("doc_id") < 290, F.floor(F.col("doc_id") / 2)))
    got = P.with_next(many, ["text"]).collect()
    order = sorted(((-1 if r.doc_id is None else r.doc_id, r.text) for r in many.collect()))
    assert {(r.text, r.next_text) for r in got} == {(a[1], b[1]) for a, b in zip(order, order[1:] + order[:1])}


def test_likeness_bears_an_insertion(spark, docs_of):
    rnd = random.Random(4)
    w = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    other = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    t = [" ".join(w), "new " + " ".join(w), " ".join(w[:200] + w[201:]), " ".join(w[:200] + other[:200]), " ".join(other), "\t\n" + " ".join(w) + "\n\x0c"]
    got = P.add_fingerprint(docs_of(t), "text", "fp").select("doc_id", "fp", P.centred(F.col("fp")).alias("z")).collect()
    fp = {r.doc_id: r for r in got}
    cos = lambda a, b: sum(x * y for x, y in zip(fp[a].z, fp[b].z)) / (sum(x * x for x in fp[a].z) * sum(x * x for x in fp[b].z)) ** 0.5
    assert cos(0, 1) > 0.97 and cos(0, 2) > 0.97 and abs(cos(0, 3) - 0.5) < 0.25 and abs(cos(0, 4)) < 0.27
    assert fp[5].fp == fp[0].fp and fp[0].fp.exact != fp[1].fp.exact  # blank paragraphs don't count
    lanes = spark.range(1).select(*[F.xxhash64(F.lit(100 + k), F.lit("p")).alias(f"h{k}") for k in range(8)]).first()
    chained = spark.range(1).select(F.xxhash64(F.lit("p"), F.lit(1)).alias("a"), F.xxhash64(F.lit("p"), F.lit(2)).alias("b")).first()
    assert len(set(lanes)) == 8 and not set(lanes) & set(chained)


def test_equal_rows_have_rows_of_their_own(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "a b"), (None, "x"), (None, None), (2, "")]
    got = P.compare_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 0), (0, 1), (1, 3), (1, 3), (1, 3), (2, 0)]
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([("a b\nc d", "c d", "a b")], "x string, y string, z string")
    for c in "xyz":
        df = P.add_fingerprint(df, c, f"f{c}")
    r = df.select(P.combine(F.col("fy"), F.col("fz")).alias("sum"), P.combine(F.col("fx"), F.col("fy"), -1).alias("rest"), "fx", "fz").first()
    assert r["sum"] == r.fx and r.rest == r.fz


WHITE = " \t\r\x0b\x0c"


def repeated(texts, least):
    """Lines of runs that stand earlier, by brute force; and for each place the longest such run."""
    seqs = {i: [(k, s.translate(str.maketrans(WHITE, " " * 5)).strip(" ")) for k, s in enumerate(x.split("\n"))] for i, x in texts}
    seqs = {i: [(k, s) for k, s in x if s] for i, x in seqs.items()}
    seen, gone, longest = {}, {i: set() for i in seqs}, {}
    for i in sorted(seqs):
        for a in range(len(seqs[i])):
            for b in range(a + 1, len(seqs[i]) + 1):
                run = tuple(s for _, s in seqs[i][a:b])
                if seen.setdefault(run, (i, a)) < (i, a):
                    longest[i, a] = b - a
                    if sum(len(s.split(" ")) - s.split(" ").count("") for s in run) >= least:
                        gone[i] |= {k for k, _ in seqs[i][a:b]}
    return gone, longest, seqs


def some_lines(n=100, seed=3):
    rnd = random.Random(seed)
    lines = ["a b c", "d e", "f", "g h i j k l m n o p q", "zz", "", " ", "\x0c", "\x0b\t", "\xa0", "a\x0cb"]
    long = [f"line {k} of a long run" for k in range(90)]
    t = ["\n".join(rnd.choice([*lines, f"u{rnd.random()} x"]) for _ in range(rnd.randint(0, 9))) for _ in range(n)]
    t += ["\n".join(["x1", *long, "y1"]), "\n".join(["x2", *long[3:80], "d e", "zz", "y2"]), "\n".join(long[:70]), "\n".join(long[:70]), "\n".join(["zz"] * 40), "\n".join(["zz"] * 25 + ["f"])]
    return t


@pytest.mark.parametrize("least", [1, 10])
def test_line_dedup(spark, docs_of, least):
    t = some_lines()
    want, _, _ = repeated(enumerate(t), least)
    got = {r.doc_id: r for r in N.line_dedup(docs_of(t).withColumn("n", F.lit(1)), least).collect()}
    assert {i: set(r.removed) for i, r in got.items()} == want
    assert all(r.kept_text == "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in want[i]) for i, r in got.items())


def test_maximal_runs(spark):
    t = some_lines(30, 5)
    _, longest, seqs = repeated(enumerate(t), 1)
    place = {(i, a): p for p, (i, a) in enumerate((i, a) for i in sorted(seqs) for a in range(len(seqs[i])))}
    names = {s: k for k, s in enumerate(sorted({s for x in seqs.values() for _, s in x}))}
    ends = {i: place[i, 0] + len(x) for i, x in seqs.items() if x}
    rows = [(place[i, a], names[s], ends[i]) for i, x in seqs.items() for a, (_, s) in enumerate(x)]
    with N.Stash(spark) as stash:
        runs = N.suffix_runs(spark.createDataFrame(rows, "pos long, rank long, end long"), stash).cache()
        assert {r.pos: r.n for r in runs.collect()} == {place[k]: n for k, n in longest.items()}
        want = {place[i, a]: n for (i, a), n in longest.items() if longest.get((i, a - 1), 0) - 1 < n}
        assert {r.pos: r.n for r in N.maximal_runs(runs).collect()} == want


def test_line_dedup_odd_rows(spark, docs_of):
    long = "one two three four five six seven eight nine ten"
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, long), (50, long), (50, long), (60, None), (70, f"x\n{long}\n{long}")]
    got = N.line_dedup(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, removed int")).collect()
    assert len(got) == len(rows)
    of = lambda i: [r.removed for r in got if r.doc_id == i]
    assert of(None) == [[]] and of(50) == [[0], [0]] and of(70) == [[1, 2]] and of(60) == [[]]
    assert N.line_dedup(docs_of([])).isEmpty()


def test_decontaminate(spark, docs_of):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [say(rnd.randint(15, 55)) for _ in range(20)]
    t, want = [], set()
    for i in range(300):
        w = say(rnd.randint(5, 400))
        if i % 5 == 0:
            k = i // 5 % 20
            item = list(items[k])
            if i % 10 == 0:  # reworded: every tenth word differs
                item[::10] = say(len(item[::10]))
            at = rnd.randint(0, len(w))
            w[at:at] = [x.upper() + "," if rnd.random() < 0.3 else x for x in item]
            want.add((i, k))
        t.append(" ".join(w))
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)] + [(90, None), (91, ""), (92, "tiny one")], "item_id long, text string")
    docs = docs_of(t + ODD)
    got = {(r.doc_id, r.item_id) for r in D.decontaminate(docs.withColumn("kind", F.lit(1)), bench).collect()}
    assert len(got & want) >= 0.9 * len(want) and not got - want
    assert D.decontaminate(docs_of([]), bench).isEmpty() and D.decontaminate(docs, bench.limit(0)).isEmpty()


def test_subsequence():
    def slow(a, b):
        best = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, best[j + 1] = best[j + 1], last + 1 if x == y else max(best[j + 1], best[j])
        return best[-1]

    rnd = random.Random(2)
    for _ in range(200):
        a, b = [rnd.randint(0, 6) for _ in range(rnd.randint(1, 30))], [rnd.randint(0, 6) for _ in range(rnd.randint(0, 40))]
        assert D.subsequence(a, b) == slow(a, b)


def test_decontamination_finds_what_reading_all_pairs_finds(spark, docs_of):
    """Copies, and rewordings of a tenth to a quarter of the words, at the default cosine, against the LCS of every pair."""
    sf = "/root/testdata/sf0.01"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").translate(low))
    rnd = random.Random(9)
    texts = [r.text for r in table(spark, sf, "documents").orderBy("doc_id").limit(400).collect()]
    items = {r.item_id: r.text for r in table(spark, sf, "benchmark").collect()}
    pool = [w for x in texts for w in words(x)]
    for k, (i, x) in enumerate(sorted(items.items()) * 3):
        w = words(x)
        for j in rnd.sample(range(len(w)), int(len(w) * (0, 0.1, 0.25)[k % 3])):
            w[j] = rnd.choice(pool)
        texts.append(" ".join(rnd.choices(pool, k=rnd.randint(5, 200)) + w + rnd.choices(pool, k=rnd.randint(5, 200))))
    want = set()
    for d, x in enumerate(texts):
        w = words(x)
        for i, item in items.items():
            q = words(item)
            known = set(q)
            if 2 <= len(q) and sum(v in known for v in w) >= 0.7 * len(q):
                for a in range(0, max(1, len(w)), 16):  # the windows that the operator may read
                    if D.subsequence(q, w[max(0, a - len(q)) : a + 32 + len(q)]) >= 0.7 * len(q):
                        want.add((d, i))
                        break
    got = {(r.doc_id, r.item_id): r.kind for r in D.decontaminate(docs_of(texts), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    copies = {k for k, kind in got.items() if kind == "copy"}
    assert len(want) >= 100 and copies <= want and len(copies) >= 0.95 * len(want)


def test_short_items_long_rows_and_null_ids(spark):
    rnd = random.Random(6)
    pool = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(2000)]
    item = " ".join(rnd.choices(pool, k=30))
    long = " ".join(rnd.choices(pool, k=150_000)) + " " + item + " " + " ".join(rnd.choices(pool, k=150_000))
    rows = [(1, long), (None, "x " + item), (2, "one Two, three"), (2, "two"), (3, "onetwo three"), (4, "two three one")]
    bench = spark.createDataFrame([(7, item), (7, "nothing like it in any text here"), (8, "one two"), (None, "three")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {(1, 7), (None, 7), (2, 8), (2, None), (3, None), (4, None)}
    assert abs(got[1, 7].first_word - 150_000) <= 32 and got[2, 8].first_word == 0 and got[2, None].first_word == 2


def test_words_in_pieces():
    import numpy as np

    from recordloom.llm import _words as W

    rnd = random.Random(2)
    text = "".join(rnd.choice("abé  \n") * rnd.randint(1, 3) for _ in range(5000)) + "q" * 3000 + " end"
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.array([0, 40, 40, len(data)])
    whole, first = W.words(data, at, W.table(W.SPACES))
    for limit in (7, 100, 1000):
        got, places = W.words(data, at, W.table(W.SPACES), limit=limit)
        assert (got == whole).all() and (places == first).all()
    starts, ends, _ = W.spans(data, at, W.table(W.SPACES))
    assert (W.hashes(data, starts, ends, piece=16) == W.hashes(data, starts, ends)).all()


def test_quality_long_rows_and_absent_documents(spark, docs_of, monkeypatch):
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(60)] + [(10**6 + i, 1, 0) for i in range(500)], "doc_id long, quality int, toxic int")
    docs = docs_of([("good clean words here " if i % 2 == 0 else "BAD!! WORDS!! ") * 5 for i in range(60)])
    model = Q.train(docs, labels, max_rows=40)  # labels without a document don't use up the bound
    data = ("good clean words here " * 4000).encode()
    import numpy as np

    flat, at = np.frombuffer(data, np.uint8), np.array([0, len(data)])
    whole = model.score(flat, at)
    monkeypatch.setattr(Q, "STRETCH", 5000)
    assert abs(model.score(flat, at) - whole).max() < 1e-3 and whole[0] > 0.5
    got = Q.score(docs.union(docs).withColumn("score", F.lit("x")), model, extra=("doc_id", "score")).collect()
    assert len(got) == 120 and all((r.score >= 0.3) == bool(r.predicted) for r in got)


def test_quality_features_stay_inside_words():
    import numpy as np

    def of(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return [b.tolist() for b, _ in Q._buckets(data, np.array([0, len(data)]))]

    words, pairs, three, four = of("éa bcd")
    assert (len(words), len(pairs)) == (2, 1) and len(three) == 3 and len(four) == 1  # "éa ", " bc", "bcd"; " bcd"
    assert of("aa aa")[1] == of("zq zq")[1] != of("aa zq")[1]
