"""Quality classifier: averaged subword embeddings with a softmax output, fitted by numpy SGD.

A text's features are its words, pairs of neighbouring words and the character
n-grams inside its words (with their ends marked), hashed into a fixed number of
buckets. A pair of equal words is one feature whichever word it is: n-grams of
words never seen before can't tell by themselves that a text repeats them. Each bucket has a learned vector. A document is the mean of its
feature vectors, and two softmax weights give the probability of label 1. Once
fitted, the two layers are folded into one number per bucket, so scoring is a
gather and a mean over each whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ._store import Stash, first_by_hash
from ._words import SPACES, U64, odd, slices, stretches, table, utf8, words as _hashed

#: Buckets (a power of two), vector width, character n-gram lengths.
BITS, DIM, NGRAMS = 17, 16, (3, 4)
#: The fit uses at most so many labelled rows, the first by a hash of doc_id.
MAX_ROWS = 4000
#: Rows of more bytes are read in stretches that end between words.
STRETCH = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id's text is a multiple of five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def _characters(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One number per UTF-8 character (white space is a space), and the rows' places in them."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    out = data[lead].astype(np.uint32)
    out[~table(SPACES)[data[lead]]] = 32
    wide = np.flatnonzero(out >= 0xC0)
    for k in (1, 2, 3):
        wide = wide[lead[wide] + k < len(data)]
        rest = data[lead[wide] + k]
        wide, rest = wide[(rest & 0xC0) == 0x80], rest[(rest & 0xC0) == 0x80]
        out[wide] |= rest.astype(np.uint32) << np.uint32(8 * k)
    return out, np.searchsorted(lead, at)


def _buckets(data: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, n + 1 row places) of each kind of feature."""
    shift = U64(64 - BITS)
    words, first = _hashed(data, at, table(SPACES))
    out = [((words >> shift).astype(np.int64), first)]
    inner = np.ones(max(0, len(words) - 1), bool)
    cuts = first[1:-1]
    inner[cuts[(cuts > 0) & (cuts < len(words))] - 1] = False  # pairs don't cross rows
    pairs = np.where(words[:-1] == words[1:], U64(1), words[:-1] * odd(1, 3)[0] + words[1:])[inner] * odd(1, 5)[0]
    kept = np.concatenate(([0], np.cumsum(inner))) if len(inner) else np.zeros(1, np.int64)
    out.append(((pairs >> shift).astype(np.int64), kept[np.minimum(first, len(kept) - 1)]))
    letters, at = _characters(data, at)
    gaps = np.concatenate(([0], np.cumsum(letters == 32)))
    ends = np.repeat(at[1:], np.diff(at))  # of each character's row
    for n in NGRAMS:
        size = len(letters) - n + 1
        if size <= 0:
            out.append((np.zeros(0, np.int64), np.zeros(len(at), np.int64)))
            continue
        by = (odd(n, seed=20 + n) >> U64(32)).astype(np.uint32) | np.uint32(1)
        x = np.zeros(size, np.uint32)
        for k in range(n):
            x += letters[k : k + size] * by[k]
        x *= np.uint32(2654435769)
        inside = (gaps[n - 1 : n - 1 + size] == gaps[1 : 1 + size]) & (np.arange(n, n + size) <= ends[:size])  # only its ends may be spaces
        count = np.concatenate(([0], np.cumsum(inside)))
        out.append(((x[inside] >> np.uint32(32 - BITS)).astype(np.int64), count[np.minimum(at, size)]))
    return out


@dataclass
class Model:
    """weight: a number for each bucket; bias: the score's logit for a text without features."""

    weight: np.ndarray
    bias: float

    def _sums(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, count = np.zeros(len(at) - 1), np.zeros(len(at) - 1)
        for buckets, first in _buckets(data, at):
            total += np.diff(np.concatenate(([0.0], np.cumsum(self.weight[buckets], dtype=np.float64)))[first])
            count += np.diff(first)
        return total, count

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        if len(data) <= STRETCH:
            total, count = self._sums(data, at)
        else:
            rows = [[self._sums(data[a + c : a + d], np.array([0, d - c])) for c, d in stretches(data[a:b], table(SPACES), STRETCH)] for a, b in zip(at[:-1], at[1:])]
            total, count = (np.array([sum(float(x[k][0]) for x in row) for row in rows]) for k in (0, 1))
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def _features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and their shares."""
    data, _ = utf8(pa.array([text], pa.string()))
    counts = np.zeros(1 << BITS, np.int64)
    for a, b in stretches(data, table(SPACES), STRETCH):
        for buckets, _ in _buckets(data[a:b], np.array([0, b - a])):
            counts += np.bincount(buckets, minlength=1 << BITS)
    own = np.flatnonzero(counts)
    return own.astype(np.int32), (counts[own] / max(1, counts.sum())).astype(np.float32)


def fit(texts: list[str | None], labels: list[int], epochs: int = 5, rate: float = 20.0, seed: int = 1) -> Model:
    """Stochastic gradient descent on softmax cross-entropy, one text a step. No rows of one of the labels: a constant score."""
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1 << BITS, np.float32), 4.0 * (float(y.mean()) * 2 - 1) if len(y) else 0.0)
    ids, share, at = [], [], [0]
    for text in texts:
        own, part = _features(text)
        ids.append(own)
        share.append(part)
        at.append(at[-1] + len(own))
    ids, share = np.concatenate(ids), np.concatenate(share)  # two arrays for all rows: the driver's memory is given back as a whole
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.log(np.bincount(y, minlength=2) / len(y)).astype(np.float32)
    steps, step = epochs * len(y), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            lr = rate * (1 - step / steps)
            step += 1
            mine, part = ids[at[i] : at[i + 1]], share[at[i] : at[i + 1]]
            rows = np.take(vectors, mine, axis=0)
            mean = part @ rows
            logit = mean @ out + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= 0.05 * lr * np.outer(mean, p)
            bias -= 0.001 * lr * p
            rows -= (lr * part)[:, None] * back
            vectors[mine] = rows  # the buckets of a text are distinct
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fits on a bounded sample of the labelled rows whose document is there, chosen by id before any text is read.

    One task counts each text's features as it comes and fits; only the folded
    model comes back. Rows of one doc_id in docs or labels are learned from as many
    times as they pair, within max_rows.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where("quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        texts, marks = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
        model = fit(texts, marks)
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.astype(np.float32).tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], names=["weight", "bias"])

    with Stash(docs.sparkSession) as stash:
        known = stash.save(marked.join(texts.select("doc_id"), "doc_id", "left_semi"), "known")
        chosen = stash.save(first_by_hash(known, ["doc_id", "quality"], max_rows), "chosen")
        rows = texts.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", F.xxhash64("text")).limit(max_rows)
        got = rows.select("text", "quality").coalesce(1).mapInArrow(run, "weight binary, bias double").collect()
    return Model(np.frombuffer(got[0].weight, np.float32), got[0].bias) if got else Model(np.zeros(1 << BITS, np.float32), 0.0)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns named in ``extra``, score and predicted (1 from the threshold on), one row per input row.

    Null texts count as empty; empty texts get the bias's score. Null ids stay null.
    Equal texts have equal scores. Columns of docs named score or predicted are
    replaced. An empty table gives none.
    """
    extra = tuple(c for c in extra if c not in ("score", "predicted"))
    shown = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(F.col(c) for c in extra if c not in ("doc_id", "text"))]
    table_in = docs.select(shown)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_in.schema if f.name != "text" or "text" in extra)

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(1))
            found = [model.score(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in slices(at)]
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text" or "text" in extra]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(np.concatenate(found) if found else np.zeros(0))], names=[*(batch.schema.names[i] for i in keep), "score"])

    return table_in.mapInArrow(run, f"{schema}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs; labels of held-out rows are never learned from."""
    out = score(docs, train(docs, labels), threshold)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
