"""The n-gram Jaccard join against brute force."""

import random
import re

import pytest

from recordloom.llm.ngram_join import Trie, apart, links, ngram_jaccard_join

from .conftest import ODD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}, sets


def texts(seed, n, common):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    passage = " ".join(rnd.choice(words) for _ in range(12))
    out = []
    for _ in range(n):
        if out and rnd.random() < 0.5:
            t = rnd.choice(out).split()
            for _ in range(rnd.randint(0, 3)):
                k = rnd.randrange(len(t) + 1)
                t[k : k + rnd.randint(0, 1)] = [rnd.choice(words)] * rnd.randint(0, 1)
            out.append(" ".join(t) or "a")
        else:
            out.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 70))) + (" " + passage if rnd.random() < common else ""))
    return out


@pytest.mark.parametrize("seed, block", [(1, 2000), (2, 3)])
def test_equals_brute_force(docs_of, seed, block):
    t = texts(seed, 150, 0.4)
    want, sets = brute(list(enumerate(t)))
    got = {r.doc_id: r for r in ngram_jaccard_join(docs_of(t), block=block).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets}


def test_odd_rows(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "same words here again and more"), (3, "same words here again and more"), (3, "other text for the same id and so on")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, component_id int")
    got = [tuple(r) for r in ngram_jaccard_join(df).select("doc_id", "n_shingles", "component_id").collect()]
    assert len(got) == len(rows)
    assert (0, 0, 0) in got and (1, 0, 1) in got and (None, 2, None) in got
    assert (8, 2, 3) in got and (9, 2, 3) in got and (3, 5, 3) in got
    assert ngram_jaccard_join(docs_of([])).isEmpty()


def test_an_id_with_many_texts_joins_them_all(spark):
    a, b, c, d = ("a b c d e f g", "h i j k l m n", "o p q r s t u", "v w x y z")
    rows = [(1, a), (2, b), (3, c), (5, a), (5, b), (5, c), (6, d), (7, d), (7, "only here and not there"), (8, "only here and not there")]
    got = {(r.doc_id, r.component_id) for r in ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (5, 1), (6, 6), (7, 6), (8, 6)}


def test_a_large_family_is_shipped_once(spark, docs_of):
    """One group of near copies over many blocks: the last round ships nothing, or each set about once for a few strays."""
    nodes = [(9, 1, 100 + i, 50) for i in range(1000)] + [(9, 5000 + i, 5000 + i, 50) for i in range(5)] + [(8, 7, 9000 + i, 50) for i in range(300)]
    got = apart(spark.createDataFrame(nodes, "family long, label long, node long, n long"), block=20).collect()
    assert {r.node for r in got} == {n[2] for n in nodes if n[0] == 9} and len(got) < 1000 * 3 + 5 * 120
    blocks = {}
    for r in got:
        blocks.setdefault(r.task, set()).add(r.node)
    strays = {n[2] for n in nodes if n[1] >= 5000}
    for s in strays:  # a stray meets every set of the other labels
        assert set().union(*(b for b in blocks.values() if s in b)) >= {n[2] for n in nodes if n[0] == 9}
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    t = [" ".join(w if j != i % 100 else f"x{i}" for j, w in enumerate(base)) for i in range(90)] + [" ".join(base[:60] + rnd.sample(base, 60)) for _ in range(20)]
    want, _ = brute(list(enumerate(t)))
    assert {r.doc_id: r.component_id for r in ngram_jaccard_join(docs_of(t), block=8).collect()} == want


def test_trie_finds_what_counting_finds():
    import numpy as np

    rnd = random.Random(5)
    rows = [np.array(sorted(rnd.sample(range(40), rnd.randint(1, 25)))) for _ in range(60)]
    t = Trie(rows)
    for x in rows:
        mask = np.zeros(40, np.int64)
        mask[x] = 1
        got = sorted(t.probe(mask, len(x), np.zeros(60, bool), 4, 5))
        assert got == [i for i, y in enumerate(rows) if 9 * len({*x.tolist()} & {*y.tolist()}) >= 4 * (len(x) + len(y))]
    assert links(np.arange(60), rows, 4, 5)
