"""Queries against brute force over all rows of their tables."""

import duckdb
import pytest

from recordloom import queries as Q
from recordloom.operators import closure


def read(sf, sql):
    con = duckdb.connect()
    for t in ("part", "lineitem", "customer", "supplier", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.execute(sql).fetchall()


def test_prose_predicates_every_part(spark, sf):
    said = [" group-by-stage", " voxel-by-voxel", " a vs b", " change in x", " x > y over time"]
    words = ("versus", " vs ", " vs. ", "greater than", "less than", "difference between", "change in", "change from", "pre-post", "pre/post", "prepost", " x > y ")
    want = {k: any(w in (name + said[k % 5]).lower() for w in words) for k, name in read(sf, "SELECT p_partkey, p_name FROM part")}
    assert {r.p_partkey: r.comparison for r in Q.queries()["prose_predicates"](spark, sf).collect()} == want


def test_allowlist_partition_every_line(spark):
    sf = "/root/testdata/sf0.01"  # order keys beyond 2000
    want = {(o, n, p, "allowed" if n == 2 or (n == 3 and flag == "R") else "reported") for o, n, p, flag in read(sf, "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem")}
    assert {tuple(r) for r in Q.queries()["allowlist_partition"](spark, sf).collect()} == want


def test_positional_diff_every_customer(spark, sf):
    sides = [{}, {}]
    for side, (table, c) in zip(sides, (("supplier", "s"), ("customer", "c"))):
        key = {"s": "s_suppkey", "c": "c_custkey"}[c]
        for nation, k in read(sf, f"SELECT {c}_nationkey, {key} FROM {table} ORDER BY {key}"):
            side[nation, sum(n == nation for n, _ in side) + 1] = k
    want = {(*at, sides[0].get(at), sides[1].get(at), sides[0].get(at) == sides[1].get(at)) for at in sides[0].keys() | sides[1].keys()}
    assert {(r.nation, r.pos, r.left, r.right, r.same) for r in Q.queries()["positional_diff"](spark, sf).collect()} == want


def test_span_nearest_every_document(spark, sf):
    want = {}
    for doc_id, text in read(sf, "SELECT doc_id, text FROM documents"):
        at = [i for i in range(len(text or "")) if text.startswith(" the", i)]
        if at:
            want[doc_id] = min(at, key=lambda i: (abs(i - len(text) // 2), i))
    assert {r.doc_id: r.start_char for r in Q.queries()["span_nearest"](spark, sf).collect()} == want


def test_reachable_beyond_64_hops(spark):
    edges = spark.range(70).selectExpr("id AS src", "id + 1 AS dst")
    assert sorted(r.node for r in closure.reachable(edges, spark.range(1).selectExpr("id AS node")).collect()) == list(range(71))


def test_identity_diff_every_nation(spark, sf):
    a, b = ({k for (k,) in read(sf, f"SELECT {c} FROM {t}")} for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey")))
    want = {(k, "common" if k in a & b else "missing" if k in a else "extra") for k in a | b}
    assert {tuple(r) for r in Q.queries()["identity_diff"](spark, sf).collect()} == want
