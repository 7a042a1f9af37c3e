"""Exact n-gram Jaccard self-join: prefix-tree traversal inside families that share rare n-grams.

1. Every document becomes its set of hashed word n-grams. Documents with equal
   sets form a class; only one representative per class goes on, so thousands of
   exact copies cost one row.
2. n-grams have one global order. Two sets within the threshold share at least k
   of their first ``n - least overlap + k`` n-grams. An index of those prefixes
   tells how many of them occur in a single class; a representative with too
   few shared ones can have no partner and leaves.
3. The rest's n-grams are ordered by how many classes have them, the rarest first.
   The plain prefix principle (one shared n-gram) links documents into families;
   passages that many documents share come last and hardly ever link.
4. A family is walked in one task when it is small, else in blocks of bounded
   size. Its sets are stored in a compressed trie; a probe adds up the
   overlap along shared paths, prunes subtrees by the lengths that can still
   reach the threshold, and skips subtrees whose sets are linked to it already.
   Every pair that is skipped is connected through other verified links, so the
   components are exact and a group of n near copies costs about n verifications.
5. A family of several blocks is linked inside its blocks first, then its parts'
   leaders among themselves, and then only blocks of what is still apart meet, in
   pairs. So near copies, however many, are shipped once and not once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._graph import components
from ._store import Stash, cut, pieces
from ._words import SPACES, U64, lower_table, mix, slices, table, utf8, windows, words

#: Sets, and n-grams, of one block in a walk; they bound a task's memory.
BLOCK, GRAMS = 2000, 1_500_000
#: Prefixes are longer than the plain principle asks by a set's size over this.
SLACK = 10
#: Longest stretch of one trie edge, so that pruning comes in time.
EDGE = 64


def least(n, num: int = 4, den: int = 5):
    """The smallest overlap, and partner, of a set of n."""
    return -(-n * num // den)


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    data, offsets = utf8(column)
    is_word, lower = table(SPACES), lower_table()
    for a, b in slices(offsets):
        at = offsets[a : b + 1] - offsets[a]
        part = data[offsets[a] : offsets[b]]
        for grams in windows(*words(part, at, is_word, lower), width):
            grams = np.sort(grams.view(np.int64))
            yield grams[np.concatenate(([True], grams[1:] != grams[:-1]))] if len(grams) else grams


def _lists(rows: list[np.ndarray]) -> pa.Array:
    lens = np.fromiter(map(len, rows), np.int64, len(rows))
    at = np.concatenate(([0], np.cumsum(lens))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def _index_length(n: int, num: int, den: int) -> int:
    return min(n, n - least(n, num, den) + 1 + n // SLACK)


def signatures(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (a 128-bit sum of the set's hashes), head (the index prefix)."""

    def run(batches):
        for batch in batches:
            n, s1, s2, heads = [], [], [], []

            def out(ids):
                return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), _lists(heads)], names=["doc_id", "n", "s1", "s2", "head"])

            ids, done = batch.column(0), 0
            for grams in _sets(batch.column(1), width):
                n.append(len(grams))
                u = grams.view(U64)
                s1.append(int(mix(u + U64(11)).sum().view(np.int64)))
                s2.append(int(mix(u ^ U64(0x5851F42D4C957F2D)).sum().view(np.int64)))
                heads.append(grams[: _index_length(len(grams), num, den)])
                if len(n) == 2000:
                    yield out(ids[done : done + 2000])
                    done, n, s1, s2, heads = done + 2000, [], [], [], []
            if n:
                yield out(ids[done:])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n long, s1 long, s2 long, head array<long>")


class Trie:
    """A compressed prefix tree of integer sequences, walked level by level."""

    def __init__(self, rows: list[np.ndarray]):
        order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">u4").tobytes())
        parent, start, stop, depth, leaf_of = [0], [0], [0], [0], np.zeros(len(rows), np.int64)
        text: list[np.ndarray] = []
        filled = 0
        stack = [0]  # nodes of the current path, depth = tokens up to and including the node
        last = np.zeros(0, np.int64)
        for i in order:
            row = rows[i]
            m = min(len(row), len(last))
            differs = np.flatnonzero(row[:m] != last[:m])
            common = int(differs[0]) if len(differs) else m
            while depth[stack[-1]] > common:
                top = stack.pop()
                if depth[stack[-1]] < common:  # split the edge of top
                    cut_at = start[top] + common - depth[stack[-1]]
                    node = len(parent)
                    parent.append(stack[-1])
                    start.append(start[top])
                    stop.append(cut_at)
                    depth.append(common)
                    parent[top], start[top] = node, cut_at
                    stack.append(node)
            for a in range(common, len(row), EDGE):
                b = min(a + EDGE, len(row))
                parent.append(stack[-1])
                start.append(filled + a - common)
                stop.append(filled + b - common)
                depth.append(b)
                stack.append(len(parent) - 1)
            text.append(row[common:])
            filled += len(row) - common
            leaf_of[i] = stack[-1]
            last = row
        self.tokens = np.concatenate(text) if text else np.zeros(0, np.int64)
        self.parent, self.depth = np.array(parent), np.array(depth)
        self.start, self.length = np.array(start), np.array(stop) - np.array(start)
        count = len(parent)
        kids = np.argsort(self.parent[1:], kind="stable") + 1
        self.kids = kids
        self.kid_at = np.searchsorted(self.parent[kids], np.arange(count + 1))
        self.leaf_of = leaf_of
        self.sets_at: dict[int, list[int]] = {}
        big, small, live = np.zeros(count, np.int64), np.full(count, 1 << 60), np.zeros(count, np.int64)
        for i, node in enumerate(leaf_of):
            self.sets_at.setdefault(int(node), []).append(i)
            size, at = len(rows[i]), int(node)
            while True:
                big[at], small[at], live[at] = max(big[at], size), min(small[at], size), live[at] + 1
                if not at:
                    break
                at = parent[at]
        self.big, self.small, self.live = big, small, live
        self.sizes = [len(r) for r in rows]

    def take(self, i: int) -> None:
        at = int(self.leaf_of[i])
        while True:
            self.live[at] -= 1
            if not at:
                return
            at = int(self.parent[at])

    def probe(self, mask: np.ndarray, size: int, taken: np.ndarray, num: int, den: int) -> list[int]:
        """Sets not yet taken whose Jaccard similarity with the masked set is num/den or more."""
        nodes, got, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(nodes):
            n_kids = self.kid_at[nodes + 1] - self.kid_at[nodes]
            total = int(n_kids.sum())
            if not total:
                break
            firsts = np.cumsum(n_kids) - n_kids
            kids = self.kids[np.arange(total) - np.repeat(firsts, n_kids) + np.repeat(self.kid_at[nodes], n_kids)]
            base = np.repeat(got, n_kids)
            # lengths alone: a partner has at least num/den of this size, and at most den/num of it
            keep = (self.live[kids] > 0) & (self.big[kids] * den >= size * num) & (size * den >= self.small[kids] * num)
            kids, base = kids[keep], base[keep]
            if not len(kids):
                break
            lens = self.length[kids]
            ends = np.cumsum(lens)
            place = np.arange(int(ends[-1])) - np.repeat(ends - lens, lens) + np.repeat(self.start[kids], lens)
            got = base + np.add.reduceat(mask[self.tokens[place]], ends - lens)
            # missing tokens of the path are lost for good: overlap <= length - missing, and (num + den) * overlap >= num * (both lengths)
            missing, most = self.depth[kids] - got, self.big[kids]
            keep = (num + den) * (most - missing) >= num * (size + most)
            kids, got = kids[keep], got[keep]
            for node, overlap in zip(kids.tolist(), got.tolist()):
                for i in self.sets_at.get(node, ()):
                    if not taken[i] and (num + den) * overlap >= num * (size + self.sizes[i]):
                        found.append(i)
            nodes = kids
        return found


def links(ids: np.ndarray, rows: list[np.ndarray], num: int = 4, den: int = 5, parts: list[int] | None = None) -> list[tuple[int, int]]:
    """Pairs (member, first member) that connect exactly the sets which similarities connect; sets of one part are known to be connected."""
    flat = np.concatenate(rows)
    known, dense, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(known))  # what many share comes first: long common paths
    at = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    ordered = [np.sort(rank[dense[a:b]]) for a, b in zip(at[:-1], at[1:])]
    trie, mask = Trie(ordered), np.zeros(len(known), np.int64)
    taken, out = np.zeros(len(rows), bool), []
    mates: dict[int, list[int]] = {}
    for i, part in enumerate(parts or ()):
        mates.setdefault(part, []).append(i)
    for i in range(len(rows)):
        if taken[i]:
            continue
        todo, members = [], []

        def meet(x: int) -> None:
            for y in mates.pop(parts[x], ()) if parts else (x,):  # all sets of a part at once
                if not taken[y]:
                    taken[y] = True
                    trie.take(y)
                    todo.append(y)
                    members.append(y)

        meet(i)
        while todo:
            x = todo.pop()
            if not trie.live[0]:
                break
            mask[ordered[x]] = 1
            for y in trie.probe(mask, len(ordered[x]), taken, num, den):
                meet(y)
            mask[ordered[x]] = 0
        out += [(int(ids[y]), int(ids[i])) for y in members if y != i]
    return out


def _walk(width: int, num: int, den: int):
    """(task, doc_id, part, text) sorted by task -> links (a, b)."""

    def run(batches):
        task, ids, parts, rows = None, [], [], []

        def flush():
            return links(np.array(ids), rows, num, den, parts) if len(ids) > 1 else []

        def out(found):
            return pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=["a", "b"], dtype="int64"), preserve_index=False)

        for batch in batches:
            found = []
            for t, i, part, grams in zip(*(batch.column(k).to_pylist() for k in range(3)), _sets(batch.column(3), width)):
                if t != task:
                    found += flush()
                    task, ids, parts, rows = t, [], [], []
                ids.append(i)
                parts.append(part)
                rows.append(grams)
            if found:
                yield out(found)
        if found := flush():
            yield out(found)

    return run


def _blocks(size: str, weight: str, block: int, grams_in_block: int) -> Column:
    return F.greatest(F.ceil(F.col(size) / block), F.ceil(F.col(weight) / grams_in_block), F.lit(1)).cast("int")


def apart(nodes: DataFrame, block: int = BLOCK, grams_in_block: int = GRAMS) -> DataFrame:
    """(family, label, node, n) -> (node, label, task): what has to meet once sets of one label are known to be connected.

    A label that fills half a block has blocks of its own, the others share blocks.
    Blocks of a family meet in pairs, but no two of one label; a family of one
    label has no task.
    """
    labels = nodes.groupBy("family", "label").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
    labels = labels.withColumn("several", F.count("*").over(Window.partitionBy("family")) > 1).where("several")
    labels = labels.withColumn("own", (2 * F.col("size") >= block) | (2 * F.col("weight") >= grams_in_block)).withColumn("blocks", _blocks("size", "weight", block, grams_in_block))
    shared = labels.where("NOT own").groupBy("family").agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).select("family", (2 * _blocks("size", "weight", block, grams_in_block)).alias("mixed"))
    labels = labels.join(shared, "family", "left").select("family", "label", "own", "blocks", "mixed")
    mine = F.when(F.col("own"), F.concat_ws(".", "label", F.pmod(F.xxhash64("node"), F.col("blocks")))).otherwise(F.concat(F.lit("-"), F.pmod(F.xxhash64("label"), F.col("mixed"))))
    placed = nodes.join(labels, ["family", "label"]).select("family", "node", "label", mine.alias("mine"), F.when(F.col("own"), F.col("label")).alias("pure"))
    ids = placed.select("family", "mine", "pure").distinct()
    other = ids.select("family", F.col("mine").alias("other"), F.col("pure").alias("pure2"))
    pairs = ids.join(other, "family").where("NOT (pure <=> pure2 AND pure IS NOT NULL) AND (mine != other OR pure IS NULL)")
    pairs = pairs.select("family", "mine", F.concat_ws("/", "family", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"))
    return placed.join(pairs, ["family", "mine"]).select("node", "label", "task")


def ngram_jaccard_join(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5, block: int = BLOCK, grams_in_block: int = GRAMS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, representative (smallest doc_id with the same set), component_id.

    Words are what ASCII white space leaves after lower-casing A-Z; similar means
    ``den * overlap >= num * union``. Null and empty texts have an empty set and
    link with nothing; a text of fewer than ``width`` words is one n-gram. Rows
    with one doc_id are one node and join all that any of their texts links to. A null doc_id names no node: its row comes back
    with its size and null ids, and links nothing. Other columns are ignored. An
    empty table gives an empty result. ``block`` and ``grams_in_block``
    bound a task's memory; no value changes a result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    need = f"((n * {num} + {den - 1}) DIV {den})"  # least overlap, and least partner, of a set of n
    head_size = f"least(n, n - {need} + 1 + n DIV {SLACK})"
    in_both = f"(1 + {need} DIV {SLACK})"  # n-grams that two partners' heads share at least

    with Stash(spark) as stash:
        heads = stash.save(signatures(docs, width, num, den), "heads")
        named = heads.where("doc_id IS NOT NULL AND n > 0")
        ids = stash.save(named.select("doc_id", "n", "s1", "s2"), "ids")
        empty = cut(heads.where("doc_id IS NULL OR n = 0").select("doc_id", "n"))
        reps = stash.save(ids.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n")), "reps")

        # the prefix index: how many n-grams of each prefix stand in one row only
        alone = (
            named.select("doc_id", "s1", F.explode("head").alias("gram"))
            .groupBy("gram").agg(F.count("*").alias("c"), F.min("doc_id").alias("doc_id"), F.min("s1").alias("s1"))
            .where("c = 1").groupBy("doc_id", "s1").agg(F.count("*").alias("alone"))
        )
        kept = stash.save(
            reps.select(F.col("rep").alias("doc_id"), "s1", "s2", "n").join(alone, ["doc_id", "s1"], "left")
            .where(f"{head_size} - coalesce(alone, 0) >= {in_both}").select("doc_id", "s1", "s2", "n").distinct(),
            "kept",
        )
        stash.drop("heads")
        texts = stash.save(docs.join(kept.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"), "texts")

        def run(batches):
            for batch in batches:
                keys = batch.column(0)
                for k in range(0, len(keys), 500):
                    yield pa.RecordBatch.from_arrays([keys[k : k + 500], _lists(list(_sets(batch.column(1)[k : k + 500], width)))], names=["doc_id", "grams"])

        def sets(t: DataFrame) -> DataFrame:
            return t.mapInArrow(run, "doc_id long, grams array<long>").where("size(grams) > 0").withColumn("n", F.size("grams").cast("long"))

        # the same test among those left, now between classes
        grams = sets(texts).selectExpr("doc_id", "n", f"explode(slice(grams, 1, CAST({head_size} AS INT))) AS gram")
        often = grams.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
        near = stash.save(grams.join(often, "gram").groupBy("doc_id", "n").agg(F.count("*").alias("c")).where(f"c >= {in_both}").select("doc_id").distinct(), "near")
        # the rest's n-grams in their final order, the rarest first: a set's first n - need + 1 are its prefix
        grams = sets(texts.join(near.hint("merge"), "doc_id", "left_semi")).select("doc_id", "n", F.explode("grams").alias("gram"))
        often = grams.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1")
        offered = (
            grams.join(often, "gram").groupBy("doc_id", "n").agg(F.collect_list(F.struct("c", "gram")).alias("g"))
            .selectExpr("doc_id", "n", f"n - {need} + 1 - (n - size(g)) AS room", "g").where("room > 0")
            .selectExpr("doc_id", "n", "explode(transform(slice(sort_array(g), 1, CAST(room AS INT)), x -> x.gram)) AS gram")
        )
        offered = stash.save(offered, "offered")
        leaders = offered.groupBy("gram").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("top")).where("b < top").select("gram", "b")
        family = components(offered.join(leaders, "gram").select(F.col("doc_id").alias("a"), "b").distinct())

        def walked(tasks: DataFrame, name: str) -> DataFrame:
            """Links among the sets of each task; tasks: (task, doc_id, part)."""
            rows = tasks.join(texts, "doc_id").select("task", "doc_id", "part", "text")
            return stash.save(rows.repartition(pieces(spark, 2), "task").sortWithinPartitions("task", "doc_id").mapInArrow(_walk(width, num, den), "a long, b long"), name)

        weight = offered.groupBy(F.col("doc_id").alias("node")).agg(F.max("n").alias("n"))
        family = stash.save(family.join(weight, "node").select("node", F.col("component").alias("family"), "n"), "family")
        sizes = family.groupBy("family").agg(F.count("*").alias("size"), F.sum("n").alias("weight")).withColumn("blocks", _blocks("size", "weight", block, grams_in_block))
        placed = family.join(sizes, "family").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")))
        found = walked(placed.select(F.concat_ws(".", "family", "mine").alias("task"), F.col("node").alias("doc_id"), F.col("node").alias("part")), "inside")
        large = stash.save(placed.where("blocks > 1").select("family", "node", "n"), "large")
        if not large.isEmpty():

            def labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
                """A task links each set to the first of its part, so its links are labels already."""
                to = links.where("a != b").select(F.col("a").alias("label"), F.col("b").alias("__b")).distinct()
                return nodes.join(to, "label", "left").withColumn("label", F.coalesce("__b", "label")).drop("__b")

            labels = stash.save(labelled(large.withColumn("label", F.col("node")), found), "labels")
            leaders = labels.where("label = node").withColumn("size", F.count("*").over(Window.partitionBy("family")))
            task = F.concat_ws(".", "family", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / block).cast("int")))
            more = walked(leaders.select(task.alias("task"), F.col("node").alias("doc_id"), F.col("node").alias("part")), "leaders")
            rest = apart(stash.save(labelled(labels, more), "parts"), block, grams_in_block)
            found = found.union(more).union(walked(rest.select("task", F.col("node").alias("doc_id"), F.col("label").alias("part")), "across"))
        # a doc_id with several sets joins all their classes
        several = ids.select("doc_id", "s1", "s2").distinct().groupBy("doc_id").count().where("count > 1").select("doc_id")
        again = ids.select("doc_id", "s1", "s2").join(several, "doc_id").join(reps.select("s1", "s2", "rep"), ["s1", "s2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        joined = components(found.union(again))
        classes = reps.join(joined, reps.rep == joined.node, "left").select("s1", "s2", F.col("rep").alias("representative"), F.coalesce("component", "rep").alias("component_id"))
        return cut(
            ids.join(classes, ["s1", "s2"]).select("doc_id", F.col("n").alias("n_shingles"), "representative", "component_id")
            .union(empty.select("doc_id", "n", "doc_id", "doc_id"))
        )
