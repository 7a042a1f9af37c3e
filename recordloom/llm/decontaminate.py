"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into overlapping passages. A randomised SVD of the TF-IDF passages of
all documents, each pass a distributed sum, gives a latent space; every passage of every document is
folded into it and searched against the benchmark's passages by cosine. A
candidate is then read: the longest common subsequence of its words with a piece of
the item must cover the piece, or cover half of it and hold the item's answer. Where
there is no answer of some words, or it is most of the piece, the piece's rarest
words will do.

The driver passes on what the tasks have summed as bytes and itself only works on
matrices of the rank's size.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._store import Stash, tidy
from ._words import U64, lower_table, slices, table, utf8, words as _hashed

#: Vocabulary buckets (a power of two), latent dimensions, extra random ones, power passes.
BITS, RANK, EXTRA, PASSES = 15, 96, 16, 2
#: A passage is two neighbouring blocks of so many words.
BLOCK = 16
#: Items longer than this many words are searched in pieces of that length, half overlapping. (A machine word's bits.)
ITEM = 64
#: Items of fewer words have no passage to search for: they are looked up word for word.
SHORTEST = 5
#: An answer of fewer words proves nothing.
ANSWER = 3
#: Of a piece without a usable answer one in so many words (ANSWER at least), the rarest, stand for it.
RARE = 4
#: The benchmark's passages count in the space's fit as much as one passage of each document, and of so many documents at least.
OWN = 2000
#: Bands of buckets in which sums are added, and tasks that make them at least: beyond that as many as the session has cores.
BANDS, TASKS = 16, 8
#: Passages in one stored cell, and passages that are multiplied at once.
CELL, TOGETHER = 64, 1 << 15
#: Words whose passages are folded in at once.
AT_ONCE = 1 << 12
#: Words are runs of 0-9, a-z and non-ASCII after lower-casing A-Z.
OTHERS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the rows' first words."""
    lower = lower_table()
    return _hashed(data, at, table(OTHERS)[lower], lower)


def _buckets(words: np.ndarray) -> np.ndarray:
    return (words >> U64(64 - BITS)).astype(np.int64)


def blocks_of(first: np.ndarray) -> np.ndarray:
    """How many blocks each row's words fill."""
    return -(-np.diff(first) // BLOCK)


def _passages(words: np.ndarray, first: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums of the words' vectors, row, block) of every passage; a row of one block is one passage, an empty row none."""
    blocks = blocks_of(first)
    begin = np.cumsum(blocks) - blocks
    padded = np.full(int(blocks.sum()) * BLOCK, len(vectors) - 1, np.int64)  # the last vector is zero
    padded[np.arange(len(words)) + np.repeat(begin * BLOCK - first[:-1], np.diff(first))] = _buckets(words)
    sums = _row_sums(vectors, padded, BLOCK)
    row = np.repeat(np.arange(len(blocks)), blocks)
    place = np.arange(len(row)) - np.repeat(begin, blocks)
    follows = place + 1 < blocks[row]
    sums[:-1][follows[:-1]] += sums[1:][follows[:-1]]  # the right side is read before it is added to: numpy copies it
    keep = follows | (place == 0)
    return sums[keep], row[keep], place[keep]


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _common(masks: dict[int, int], size: int, text: list[int]) -> int:
    full = v = (1 << size) - 1
    for w in text:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def subsequence(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, a machine word at a time."""
    return _common(_masks(item), len(item), text)


def answer_of(text: str) -> str:
    """What follows the last ``answer:``, else the last sentence."""
    found = re.split(r"(?i)\banswer\s*:", text)
    if len(found) > 1:
        return found[-1]
    sentences = [s for s in re.split(r"[.!?\n]+", text) if re.search(r"\w", s)]
    return sentences[-1] if sentences else ""


class Items:
    """The benchmark's pieces: word hashes, answers, and the passages to search for; short items' words apart."""

    def __init__(self, rows: list[tuple[int, str, str | None]]):
        self.ids, self.words, self.answers, self.short = [], [], [], []
        texts: list[np.ndarray] = []
        for item_id, text, answer in rows:
            words = self._read(text or "")
            if 0 < len(words) < SHORTEST:
                self.short.append((item_id, words.tolist()))
                continue
            reply = self._read(answer if answer is not None else answer_of(text or "")).tolist()
            for a in range(0, max(1, len(words) - ITEM // 2), ITEM // 2):
                piece = words[a : a + ITEM]
                if len(piece):
                    self.ids.append(item_id)
                    self.words.append(piece.tolist())
                    self.answers.append([reply] if len(reply) >= ANSWER else [])
                    texts.append(piece)
        self.piece_of, self.passages = [], []
        for k, piece in enumerate(texts):
            for a in sorted({*range(0, max(1, len(piece) - 2 * BLOCK + 1), BLOCK // 2), max(0, len(piece) - 2 * BLOCK)}):
                self.piece_of.append(k)
                self.passages.append(piece[a : a + 2 * BLOCK])

    def add_rare(self, seen: np.ndarray) -> None:
        """Also takes the rarest words of a piece, in its order, for its answer if that is too short or more than half of the piece; words of no document can't be held."""
        for words, answers in zip(self.words, self.answers):
            if answers and 2 * len(answers[0]) <= len(words):
                continue
            often = seen[_buckets(np.array(words, U64))].tolist()
            places = {w: i for i, w in reversed([*enumerate(words)])}.values()  # first places
            rare = sorted(sorted((i for i in places if often[i]), key=lambda i: (often[i], i))[: max(ANSWER, len(words) // RARE)])
            if len(rare) >= ANSWER:
                answers.append([words[i] for i in rare])

    @staticmethod
    def _read(text: str) -> np.ndarray:
        return _words(*utf8(pa.array([text], pa.string())))[0]

    def rows(self) -> np.ndarray:
        """The passages' buckets, as the documents' are stored."""
        return _stored(np.concatenate(self.passages), np.concatenate(([0], np.cumsum([len(p) for p in self.passages]))))


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """How many documents have a word of each bucket, and last the number of documents: counted over all rows."""

    def run(batches):
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            data, at = utf8(batch.column(0))
            for a, b in slices(at, 1 << 19):
                words, first = _words(data[at[a] : at[b]], at[a : b + 1] - at[a])
                pairs = np.repeat(np.arange(b - a, dtype=np.uint64), np.diff(first)) << U64(BITS) | (words >> U64(64 - BITS))
                pairs = np.sort(pairs.astype(np.uint32) if (b - a) >> (32 - BITS) == 0 else pairs)
                once = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))] if len(pairs) else pairs
                total[:-1] += np.bincount((once & ((1 << BITS) - 1)).astype(np.int64), minlength=1 << BITS)
            total[-1] += len(batch)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros((1 << BITS) + 1)
    got = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most 2**BITS + 1 rows
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def _stored(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(passage, 2 * BLOCK) buckets, filled up with one beyond the last."""
    lens = np.diff(first)
    out = np.full((len(lens), 2 * BLOCK), 1 << BITS, np.uint16)
    out[np.repeat(np.arange(len(lens)), lens), np.arange(len(words)) - np.repeat(first[:-1], lens)] = _buckets(words)
    return out


def _scales(ids: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """One over the square of each stored passage's TF-IDF length; idf ends with a zero for the filling."""
    rows = np.sort(ids, axis=1)
    flat = rows.ravel()
    starts = np.flatnonzero(np.concatenate((np.ones((len(rows), 1), bool), rows[:, 1:] != rows[:, :-1]), axis=1))
    often = np.diff(np.append(starts, len(flat)))
    norm = np.bincount(starts // rows.shape[1], (often * idf[flat[starts]]) ** 2, minlength=len(rows))
    return 1.0 / np.where(norm > 0, norm, 1.0)


def stored_passages(texts: DataFrame, stash: Stash, idf: np.ndarray) -> DataFrame:
    """(passages binary, scales binary): every word of every text in one passage of two blocks; a text's last passage may be shorter."""
    scale = np.append(idf, 0.0)

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(0))
            for a, b in slices(at, 1 << 18):
                words, first = _words(data[at[a] : at[b]], at[a : b + 1] - at[a])
                count = -(-np.diff(first) // (2 * BLOCK))
                place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                bounds = np.append(np.repeat(first[:-1], count) + 2 * BLOCK * place, len(words))
                for f in range(0, len(bounds) - 1, 1 << 12):  # a long row a stretch at a time
                    own = bounds[f : f + (1 << 12) + 1]
                    ids = _stored(words[own[0] : own[-1]], own - own[0])
                    scales = _scales(ids, scale).astype(np.float32)
                    cells = [[x[c : c + CELL].tobytes() for c in range(0, len(x), CELL)] for x in (ids, scales)]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in cells], names=["passages", "scales"])

    return stash.save(texts.mapInArrow(run, "passages binary, scales binary"), "passages")


def _flat(column: pa.Array, kind: type) -> np.ndarray:
    """The numbers of all cells of a binary column (without nulls), one after another."""
    _, offsets, data = column.cast(pa.large_binary()).buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind) if data is not None else np.zeros(0, kind)


def _row_sums(rows: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
    """Sums of ``width`` rows at a time, in the order of ids."""
    out = np.empty((len(ids) // width, rows.shape[1]), np.float32)
    room = np.empty((min(AT_ONCE, len(ids)), rows.shape[1]), np.float32)
    for a in range(0, len(ids), AT_ONCE):  # few enough to stay in the cache
        part = ids[a : a + AT_ONCE]
        got = np.take(rows, part, axis=0, out=room[: len(part)], mode="clip").reshape(-1, width, rows.shape[1])
        np.add.reduce(got, axis=1, out=out[a // width : (a + len(part)) // width])
    return out


def _sums_by(flat: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, sums): for each bucket of the passages' the sum of z over its places. Eight rows of a bucket are added at a time until one is left, which is much faster than reduceat on rows."""
    order = np.argsort(flat, kind="stable")
    keys, ids, done = flat[order], order // (2 * BLOCK), []
    while True:
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(first, len(keys)))
        blocks = -(-size // 8)
        begin = np.cumsum(blocks) - blocks
        padded = np.full(int(blocks.sum()) * 8, len(z), np.int64)  # a row of zeros
        padded[np.arange(len(keys)) + np.repeat(begin * 8 - first, size)] = ids
        z = _row_sums(np.concatenate((z, np.zeros((1, z.shape[1]), z.dtype))), padded, 8)
        keys = np.repeat(keys[first], blocks)
        ready = np.repeat(blocks == 1, blocks)
        done.append((keys[ready], z[ready]))
        if ready.all():
            return tuple(np.concatenate(x) for x in zip(*done))
        keys, ids = keys[~ready], np.flatnonzero(~ready)


def _basis(parts: list[bytes], turn: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The bands' rows times a small matrix, scaled; one row of zeros more."""
    whole = np.concatenate([np.frombuffer(p, np.float32).reshape(-1, len(turn)) for p in parts])
    out = np.zeros((len(whole) + 1, turn.shape[1]), np.float32)
    np.matmul(whole, turn.astype(np.float32), out=out[:-1])
    out[:-1] *= scale[:, None].astype(np.float32)
    return out


def _start(wide: int, seed: int, known: np.ndarray) -> list[bytes]:
    rng = np.random.default_rng(seed)
    return [(rng.standard_normal((len(k), wide), np.float32) * k[:, None]).astype(np.float32).tobytes() for k in np.split(known, BANDS)]


def _product(passages: DataFrame, parts: list[bytes] | None, turn: np.ndarray, idf: np.ndarray, seed: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A'A times a basis, for A the normalised TF-IDF passages (weighted), in bands; its Gram matrix, and the one with ``parts``.

    The basis is ``parts`` times ``turn``; without parts it is random, made by a rule
    in every task. A task's sums are as large as the basis, so the passages are read
    by no more tasks than the session has cores.
    """
    context = passages.sparkSession.sparkContext
    shared = context.broadcast(parts)
    known = (idf > 0).astype(np.float32)
    wide = turn.shape[0]

    def run(batches):
        vectors = _basis(shared.value or _start(wide, seed, known), turn, idf)
        scale = np.append(idf, 0.0).astype(np.float32)
        out = np.zeros((len(vectors), vectors.shape[1]), np.float64)
        for batch in batches:
            whole, scales = _flat(batch.column(0), np.uint16), _flat(batch.column(1), np.float32)
            for a in range(0, len(scales), TOGETHER):
                flat = whole[a * 2 * BLOCK : (a + TOGETHER) * 2 * BLOCK]
                z = _row_sums(vectors, flat, 2 * BLOCK) * scales[a : a + TOGETHER, None]
                buckets, sums = _sums_by(flat, z)
                out[buckets] += sums
        out *= scale[:, None]
        bands = [p.astype(np.float32).tobytes() for p in np.split(out[:-1], BANDS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BANDS), pa.int32()), pa.array(bands, pa.binary())], names=["band", "part"])

    def add(group: pa.Table) -> pa.Table:
        k = group.column("band")[0].as_py()
        total = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in group.column("part").to_pylist()).reshape(-1, turn.shape[1])
        before = np.frombuffer((shared.value or _start(wide, seed, known))[k], np.float32).reshape(-1, wide).astype(np.float64)
        return pa.table({"band": pa.array([k], pa.int32()), "part": pa.array([total.astype(np.float32).tobytes()], pa.binary()), "gram": pa.array([(total.T @ total).tobytes()], pa.binary()), "cross": pa.array([(before.T @ total).tobytes()], pa.binary())})

    rows = passages.coalesce(max(TASKS, context.defaultParallelism)).mapInArrow(run, "band int, part binary").groupBy("band").applyInArrow(add, "band int, part binary, gram binary, cross binary").collect()  # BANDS rows
    shared.destroy()
    tidy(passages.sparkSession)  # the driver keeps no more than the last product
    rows.sort(key=lambda r: r.band)
    sums = [sum(np.frombuffer(r[c], np.float64) for r in rows) for c in ("gram", "cross")]
    return [r.part for r in rows], sums[0].reshape(turn.shape[1], -1), sums[1].reshape(wide, -1)


def fit(passages: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 1) -> tuple[list[bytes], np.ndarray]:
    """(bands, turn): the term vectors are the bands' rows times ``turn``, times idf; folding a passage in is the sum of its words' vectors.

    passages: (passages binary, scales binary). The bands stay as the tasks wrote them;
    orthogonal bases come from Gram matrices of the rank's size.
    """
    wide = min(rank + EXTRA, 1 << BITS)
    parts, turn = None, np.eye(wide)
    for _ in range(PASSES):
        parts, gram, _ = _product(passages, parts, turn, idf, seed)
        values, axes = np.linalg.eigh(gram)
        keep = values > 1e-10 * max(values.max(), 1e-30)
        turn = axes[:, keep] / np.sqrt(values[keep])  # the bands times this are orthogonal
        if not turn.shape[1]:
            return parts, turn
    _, _, cross = _product(passages, parts, turn, idf, seed)
    inner = turn.T @ cross
    values, axes = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-values)[:rank]
    order = order[values[order] > 1e-9 * max(values.max(), 1e-9)]
    return parts, turn @ (axes[:, order] / np.sqrt(values[order]))


class Reader:
    """Confirms candidates: exact bounds first, then the longest common subsequence."""

    def __init__(self, items: Items, copied: float, reworded: float, answered: float):
        self.sizes = np.array([len(w) for w in items.words])
        self.copied, self.reworded, self.answered = copied, reworded, answered
        self.known = np.unique(np.concatenate([np.array(w, U64) for w in (*items.words, *(a for answers in items.answers for a in answers))]))
        self.ids = np.full((len(items.words), ITEM), len(self.known), np.int64)  # beyond the last: no word
        for k, w in enumerate(items.words):
            self.ids[k, : len(w)] = np.searchsorted(self.known, np.array(w, U64))
        self.masks = [_masks(row[:n].tolist()) for row, n in zip(self.ids, self.sizes)]
        self.replies = [[(_masks(self.numbered(np.array(a, U64)).tolist()), len(a)) for a in answers] for answers in items.answers]

    def numbered(self, words: np.ndarray) -> np.ndarray:
        """Each word's number among the items' words, -1 for others."""
        at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        return np.where(self.known[at] == words, at, -1)

    def possible(self, numbers: np.ndarray, low: np.ndarray, high: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Which windows [low, high) hold enough of their piece's words, in any order: no subsequence is longer."""
        out = np.zeros(len(low), bool)
        upto = np.concatenate(([0], np.cumsum(numbers >= 0)))
        some = np.flatnonzero(upto[high] - upto[low] >= self.reworded * self.sizes[piece])  # of any item's words
        for a in range(0, len(some), 512):
            lo, hi, p = low[some[a : a + 512]], high[some[a : a + 512]], piece[some[a : a + 512]]
            n = hi - lo
            flat = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            seen = np.zeros((len(lo), len(self.known) + 2), bool)  # the last for other words
            seen[np.repeat(np.arange(len(lo)), n), numbers[flat]] = True
            seen[:, len(self.known)] = False
            seen[:, -1] = False
            held = np.take_along_axis(seen, self.ids[p], axis=1).sum(axis=1)
            out[some[a : a + 512]] = held >= self.reworded * self.sizes[p]
        return out

    def read(self, window: list[int], piece: int) -> tuple[str | None, float]:
        share = _common(self.masks[piece], int(self.sizes[piece]), window) / float(self.sizes[piece])
        if share >= self.copied:
            return "copy", share
        if share >= self.reworded and any(_common(masks, n, window) >= self.answered * n for masks, n in self.replies[piece]):
            return "paraphrase", share
        return None, share


def short_places(words: np.ndarray, first: np.ndarray, short: list[tuple[int, list[int]]]) -> list[tuple[int, int, int]]:
    """(row, item_id, place) of the first place of each short item's words in each row."""
    out = []
    for item_id, item in short:
        fits = np.ones(max(0, len(words) - len(item) + 1), bool)
        for k, w in enumerate(item):
            fits &= words[k : k + len(fits)] == U64(w)
        places = np.flatnonzero(fits)
        row = np.searchsorted(first, places, "right") - 1
        inside = places + len(item) <= first[row + 1]
        row, places = row[inside], places[inside]
        _, one = np.unique(row, return_index=True)
        out += [(int(r), item_id, int(p - first[r])) for r, p in zip(row[one], places[one])]
    return out


def candidates(words: np.ndarray, first: np.ndarray, vectors: np.ndarray, queries: np.ndarray, piece_of: np.ndarray, cosine: float) -> tuple[np.ndarray, ...]:
    """(row, block, piece, cosine) of every passage and piece that the search brings together, the best passages of a piece first."""
    sums, row, block = _passages(words, first, vectors)
    sums /= np.maximum(1e-9, np.sqrt(np.einsum("ij,ij->i", sums, sums)))[:, None]
    found = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.float32),)]
    for a in range(0, len(sums), 1024):
        near = sums[a : a + 1024] @ queries
        flat = np.flatnonzero(near >= cosine)
        if len(flat):
            i, q = flat // near.shape[1], flat % near.shape[1]
            piece, value = piece_of[q], near.ravel()[flat]
            order = np.lexsort((-value, piece, i))
            i, piece, value = i[order], piece[order], value[order]
            best = np.concatenate(([True], (i[1:] != i[:-1]) | (piece[1:] != piece[:-1])))
            found.append((row[a + i[best]], block[a + i[best]], piece[best], value[best]))
    r, k, p, v = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((k, -v, p, r))
    return r[order], k[order], p[order], v[order]


def search(docs: DataFrame, items: Items, parts: list[bytes], turn: np.ndarray, idf: np.ndarray, cosine: float, copied: float, reworded: float, answered: float) -> DataFrame:
    """doc_id, item_id, kind, cosine, overlap, first_word for every (document, item) that the reading confirms."""
    shared = docs.sparkSession.sparkContext.broadcast((parts, turn, idf))
    limits = (copied, reworded, answered)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("kind", pa.string()), ("cosine", pa.float64()), ("overlap", pa.float64()), ("first_word", pa.int64())])

    def run(batches):
        parts, turn, idf = shared.value
        vectors = queries = reader = None
        for batch in batches:
            if items.passages and vectors is None:
                vectors, piece_of, reader = _basis(parts, turn, idf), np.array(items.piece_of), Reader(items, *limits)
                queries = np.array([vectors[_buckets(p)].sum(axis=0) for p in items.passages], np.float32)
                queries = np.ascontiguousarray((queries / np.maximum(1e-9, np.linalg.norm(queries, axis=1, keepdims=True))).T)
            data, at = utf8(batch.column(1))
            keys = batch.column(0).to_pylist()
            found: dict[tuple, tuple] = {}
            for a, b in slices(at, 1 << 18):
                words, first = _words(data[at[a] : at[b]], at[a : b + 1] - at[a])
                for r, item, place in short_places(words, first, items.short):
                    found[a + r, item] = (keys[a + r], item, "copy", 1.0, 1.0, place)
                if not items.passages:
                    continue
                # a long row goes on in stretches; a stretch's windows may look beyond it
                step = 1 << 16
                parts_of = [(0, len(words), first, 0)] if len(words) <= 2 * step else [(f, g, np.array([0, g - f]), c) for c in range(len(first) - 1) for f, g in _steps(int(first[c]), int(first[c + 1]), step)]
                numbers = None
                for f, g, own, shift in parts_of:
                    r, k, piece, value = candidates(words[f:g], own, vectors, queries, piece_of, cosine)
                    if not len(r):
                        continue
                    if numbers is None:
                        numbers = reader.numbered(words)
                    start = f + own[r] + k * BLOCK  # of the passage
                    size = reader.sizes[piece]
                    low, high = np.maximum(first[r + shift], start - size), np.minimum(first[r + shift + 1], start + 2 * BLOCK + size)
                    for i in np.flatnonzero(reader.possible(numbers, low, high, piece)).tolist():
                        key = (a + int(r[i]) + shift, items.ids[piece[i]])
                        had = found.get(key)
                        if had and had[4] >= reader.copied:
                            continue
                        kind, share = reader.read(numbers[low[i] : high[i]].tolist(), int(piece[i]))
                        if kind and (had is None or share > had[4]):
                            found[key] = (keys[key[0]], key[1], kind, float(value[i]), share, int(start[i] - first[r[i] + shift]))
            if found:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, v)) for v in found.values()], schema=schema)

    return docs.mapInArrow(run, "doc_id long, item_id long, kind string, cosine double, overlap double, first_word long")


def _steps(first: int, last: int, step: int) -> list[tuple[int, int]]:
    """Stretches of a row's words that share one block with the next, so that every passage lies in one."""
    out, a = [], first
    while True:
        b = min(last, a + step)
        out.append((a, b))
        if b == last:
            return out
        a = b - BLOCK


def decontaminate(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.4, copied: float = 0.7, reworded: float = 0.5, answered: float = 0.8) -> DataFrame:
    """One row per document and benchmark item that it contains: doc_id, item_id, kind (copy or paraphrase), cosine, overlap, first_word.

    The benchmark (item_id, text, and answer if it has that column) is the query set
    and is held by every task, so its size must be bounded; every passage of every
    document is searched. An item longer than ITEM words counts as contained when one
    of its pieces is; overlap is that piece's. Items of fewer than SHORTEST words are
    found word for word (a copy). Null and empty texts match nothing. Rows of one
    item_id are one item with several texts; a null item_id is an item. first_word
    is where the matching passage starts. Rows with equal doc_id (null too) give one
    row for each item, the one with the greatest overlap, then cosine, then the
    smallest first_word. Other columns are ignored. Empty tables give none.
    """
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), (F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")).alias("answer"))
    items = Items([tuple(r) for r in asked.distinct().orderBy("item_id", "text", "answer").collect()])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = texts.sparkSession
    empty = spark.createDataFrame([], "doc_id long, item_id long, kind string, cosine double, overlap double, first_word long")
    if not items.passages and not items.short:
        return empty
    parts, turn, idf = [], np.zeros((0, 0)), np.zeros(0)
    if items.passages:
        seen = document_frequencies(texts.select("text"))
        tidy(spark)
        items.add_rare(seen[:-1])
        idf = np.log((1 + seen[-1]) / (1 + seen[:-1]))
        known = np.unique(np.concatenate([_buckets(np.array(w, U64)) for w in items.words]))
        idf[(seen[:-1] == 0)] = 0.0
        if not idf[known].any():
            idf = np.where(seen[:-1] > 0, 1.0, 0.0)  # a table of one text has no rare words
        with Stash(spark) as stash:
            own = items.rows()
            scales = (max(OWN, seen[-1]) / len(own)) * _scales(own, np.append(idf, 0.0))  # the benchmark's passages too, so that the space keeps what tells items apart
            rows = stored_passages(texts.select("text"), stash, idf)
            rows = rows.union(spark.createDataFrame([(bytearray(own.tobytes()), bytearray(scales.astype(np.float32).tobytes()))], "passages binary, scales binary"))
            parts, turn = fit(rows, idf)
        if not turn.shape[1]:
            items.passages = []
    hits = search(texts, items, parts, turn, idf, cosine, copied, reworded, answered)
    best = F.max_by(F.struct("kind", "cosine", "overlap", "first_word"), F.struct("overlap", "cosine", -F.col("first_word")))
    return hits.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
