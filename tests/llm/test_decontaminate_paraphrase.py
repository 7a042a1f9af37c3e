"""Paraphrases of items without a separate answer: one sentence, or a last sentence of one word; what the space is fitted on."""

import random

import numpy as np

from recordloom.llm import decontaminate as D


def test_items_without_an_answer(spark, docs_of):
    rnd = random.Random(11)
    common = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]
    say = lambda n: [rnd.choice(common) for _ in range(n)]
    items, t = [], []
    for k in range(8):
        item = [f"rare{k}x{i}" if i % 3 == 0 else w for i, w in enumerate(say(30))]
        items.append(" ".join(item) + ("." if k % 2 else ". Yes."))
        kept = [w for i, w in enumerate(item) if i % 3 == 0 or i < 14]  # 19 words, in order; no word stands for the others
        t.append(" ".join(say(rnd.randint(4, 60)) + kept + say(rnd.randint(4, 60))))
    t += [" ".join(say(rnd.randint(10, 400))) for _ in range(200)]  # common words alone prove nothing
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.decontaminate(docs_of(t), bench, cosine=0.1).collect()}  # of the reading: at the default cosine the search finds fewer of them
    assert set(got) == {(k, k) for k in range(8)}
    assert all(r.kind == "paraphrase" and 0.5 <= r.overlap < 0.7 for r in got.values())


def test_the_space_is_fitted_on_every_word_of_every_document(spark, docs_of, monkeypatch):
    rnd = random.Random(3)
    pool = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(500)]
    item = " ".join(rnd.choices(pool, k=40))
    lens = [rnd.randint(0, 12) for _ in range(4500)] + [9000, 32, 33, 64]  # more rows than a sample had, and more passages in a row
    seen, fit = [], D.fit
    monkeypatch.setattr(D, "fit", lambda rows, *a: seen.append([bytes(r.passages) for r in rows.collect()]) or fit(rows, *a))
    texts = [" ".join(rnd.choices(pool, k=n)) for n in lens] + [None, item]
    got = D.decontaminate(docs_of(texts), spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.kind) for r in got] == [(len(texts) - 1, "copy")]
    ids = np.frombuffer(b"".join(seen[0]), np.uint16)
    pieces = 32 + 32 + 32  # the item's own passages: words 0, 8 and the last 32
    assert abs(int((ids < 1 << D.BITS).sum()) - (sum(lens) + 40 + pieces)) <= 32


def test_product_is_the_matrix_product(spark):
    """A'A times a basis against dense numpy, with equal words in a passage, filling, weights and cells of many passages."""
    rng = np.random.default_rng(4)
    n = 700
    ids = np.minimum(rng.zipf(1.3, (n, 2 * D.BLOCK)) - 1, (1 << D.BITS) - 1).astype(np.uint16)
    ids[5, 3:] = ids[9] = 1 << D.BITS
    idf = np.where(rng.random(1 << D.BITS) < 0.9, rng.random(1 << D.BITS) + 0.1, 0.0)
    scales = (D._scales(ids, np.append(idf, 0.0)) * rng.integers(1, 4, n)).astype(np.float32)
    used = np.unique(ids[ids < 1 << D.BITS])
    a = np.zeros((n, len(used)))
    for k, row in enumerate(ids):
        w, c = np.unique(row[row < 1 << D.BITS], return_counts=True)
        a[k, np.searchsorted(used, w)] = c * idf[w]
    norm = (a**2).sum(axis=1)
    assert np.allclose(D._scales(ids, np.append(idf, 0.0)), 1 / np.where(norm > 0, norm, 1))
    cells = [(bytearray(ids[c : c + 300].tobytes()), bytearray(scales[c : c + 300].tobytes())) for c in range(0, n, 300)]
    rows = spark.createDataFrame(cells, "passages binary, scales binary")
    turn = np.eye(6)
    parts, gram, _ = D._product(rows, None, turn, idf, 1)
    basis = np.concatenate([np.frombuffer(x, np.float32).reshape(-1, 6) for x in D._start(6, 1, (idf > 0).astype(np.float32))])
    got = np.concatenate([np.frombuffer(x, np.float32).reshape(-1, 6) for x in parts])
    want = a.T @ (scales[:, None] * (a @ basis[used]))
    assert np.allclose(got[used], want, rtol=1e-4, atol=1e-4) and not got[np.setdiff1d(np.arange(1 << D.BITS), used)].any()
    assert np.allclose(gram, want.T @ want, rtol=1e-3, atol=1e-3)
