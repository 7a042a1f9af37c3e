"""Record assembly, repair and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators import catalogue as C, records as R
from ..sources import readers, sinks
from ._register import Family, Tables

FAMILY = Family()
query = FAMILY.query

LINES = "(SELECT DISTINCT l_orderkey, l_linenumber, min(l_returnflag) OVER w AS flag, min(l_linestatus) OVER w AS status FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber))"


def _cents(c):
    return F.round(F.col(c) * 100).cast("long")


@query("SELECT user_id, event_type, arg_max(CAST(round(value * 100) AS BIGINT), event_id) AS value, count(*) - 1 AS collisions FROM events GROUP BY 1, 2")
def merge_last_wins(t: Tables) -> DataFrame:
    return R.merge_last(t.events.withColumn("value", _cents("value")), ["user_id", "event_type"], "value", "event_id")


@query("SELECT l_orderkey, string_agg(l_linenumber || '-' || l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS parts FROM lineitem GROUP BY 1")
def ordered_concat(t: Tables) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    g = t.lineitem.groupBy("l_orderkey").agg(parts.alias("p"))
    return g.select("l_orderkey", F.array_join(F.transform("p", lambda x: F.concat_ws("-", x["l_linenumber"], x["l_partkey"])), ",").alias("parts"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'press' WHEN 'view' THEN 'look' ELSE event_type END AS target_id, event_type IN ('click', 'view') AS rewritten FROM events")
def alias_rewrite(t: Tables) -> DataFrame:
    a = t.spark.createDataFrame([("click", "press"), ("view", "look")], "alias string, target string")
    return R.apply_aliases(t.events.select("event_id", F.col("event_type").alias("target_id")), a).select("event_id", "target_id", "rewritten")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN CASE o_orderstatus WHEN 'F' THEN 'extracted' ELSE 'not_reported' END ELSE 'extracted' END AS status, CASE WHEN o_orderstatus IN ('F', 'O') THEN CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END ELSE CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE o_orderstatus END END AS value, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'reported' END AS source, o_orderstatus NOT IN ('F', 'O') AS repaired FROM orders")
def wrapper_repair(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "extracted").when(F.col("o_orderstatus") == "O", "not_reported").otherwise(F.col("o_orderstatus"))
    value = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", R.repair_wrapper(status, value, F.lit(None).cast("string")).alias("w")).select("o_orderkey", "w.*")


@query("SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 = 0 THEN 'given' END, 'class ' || p_type) AS kind, p_partkey % 3 <> 0 AS derived FROM part WHERE p_type IS NOT NULL")
def enum_lookup_derive(t: Tables) -> DataFrame:
    lookup = t.part.select("p_type", F.concat(F.lit("class "), "p_type").alias("found")).distinct()
    p = t.part.select("p_partkey", "p_type", F.when(F.col("p_partkey") % 3 == 0, "given").alias("kind"))
    return R.fill_from_lookup(p, lookup, "p_type", "kind").select("p_partkey", "kind", "derived")


@query("""WITH l AS (SELECT l_orderkey, min(l_returnflag) AS lo, max(l_returnflag) AS hi FROM lineitem GROUP BY 1) SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN 'X' END, CASE WHEN lo = hi THEN lo END) AS flag, o_orderkey % 5 <> 0 AND coalesce(lo = hi, FALSE) AS filled FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def single_space_fill(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "X").alias("flag"))
    return R.fill_if_single(o, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("flag")), "o_orderkey", "flag").select("o_orderkey", "flag", "filled")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '[' || (props->>'$.k') || ']' WHEN event_id % 3 = 1 THEN '[' || (props->>'$.k') || ']' ELSE NULL END AS k FROM events")
def shape_repair(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    raw = F.when(F.col("event_id") % 3 == 0, k).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), k, F.lit("]")))
    return t.events.select("event_id", R.listify(raw).alias("k"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_ids(t: Tables) -> DataFrame:
    return R.duplicate_ids(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events WHERE CAST(props->>'$.k' AS BIGINT) NOT IN (SELECT n_nationkey FROM nation)")
def dangling_refs(t: Tables) -> DataFrame:
    e = t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return R.dangling(e, "k", t.nation.withColumn("n_nationkey", F.col("n_nationkey").cast("long")), "n_nationkey").select("event_id", "k")


FIELDS = "(SELECT d.doc_id, d.source, CASE WHEN d.doc_id % 4 = 0 THEN 'not_reported' ELSE 'extracted' END AS status, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))"
EVIDENCE = "CASE WHEN status <> 'extracted' THEN 'not_applicable' WHEN quality IS NOT NULL THEN 'present' ELSE 'not_found' END"


def _fields(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "source", "lang", F.when(F.col("doc_id") % 4 == 0, "not_reported").otherwise("extracted").alias("status"), F.col("lang").alias("value"))
    return R.merge_evidence(d, t.labels, ["doc_id"])


@query(f"SELECT source, count(*) AS fields, count(*) FILTER (status = 'extracted') AS extracted, count(*) FILTER ({EVIDENCE} = 'present') AS present, count(*) FILTER ({EVIDENCE} = 'not_found') AS not_found, count(*) FILTER ({EVIDENCE} = 'not_applicable') AS not_applicable FROM {FIELDS} GROUP BY source")
def build_report(t: Tables) -> DataFrame:
    return R.build_report(_fields(t), ["source"])


@query(f"SELECT source, count(*) FILTER ({EVIDENCE} = 'not_found') AS not_found, count(*) FILTER (status = 'extracted') AS extracted, count(*) FILTER ({EVIDENCE} = 'not_found') / greatest(count(*) FILTER (status = 'extracted'), 1) > 0.10 AS failed FROM {FIELDS} GROUP BY source")
def threshold_gate(t: Tables) -> DataFrame:
    return R.gate(R.build_report(_fields(t), ["source"]), "not_found", "extracted").select("source", "not_found", "extracted", "failed")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST((row_number() OVER (PARTITION BY l_suppkey ORDER BY (l_orderkey, l_linenumber, l_partkey)) - 1) // 50 AS BIGINT) AS batch FROM lineitem")
def batch_50(t: Tables) -> DataFrame:
    """Each supplier's lines, fifty to a batch."""
    rows = t.lineitem.withColumn("place", F.struct("l_orderkey", "l_linenumber", "l_partkey"))
    return R.batches(rows, ["l_suppkey"], "place").select("l_orderkey", "l_linenumber", "l_partkey", "batch")


@query("SELECT event_id, 'k' AS path, 'BIGINT' AS kind, props->>'$.k' AS value FROM events UNION ALL SELECT event_id, 'l', 'ARRAY', NULL FROM events UNION ALL SELECT event_id, 'l[0].t', 'STRING', event_type FROM events UNION ALL SELECT event_id, 'l[0]', 'OBJECT', NULL FROM events")
def json_paths(t: Tables) -> DataFrame:
    text = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(', "l": [{"t": "'), "event_type", F.lit('"}]}'))
    r = t.events.select(F.col("event_id").alias("id"), F.parse_json(text).alias("record"))
    p = R.flatten(r)
    return p.select(F.col("id").alias("event_id"), "path", "kind", F.expr("CASE WHEN kind NOT IN ('OBJECT', 'ARRAY') THEN variant_get(value, '$', 'string') END").alias("value"))


@query(f"SELECT doc_id, {EVIDENCE} AS evidence, CASE WHEN status = 'extracted' THEN d.lang END AS value FROM {FIELDS} f JOIN documents d USING (doc_id)")
def evidence_merge(t: Tables) -> DataFrame:
    return _fields(t).select("doc_id", "evidence", "value")


@query("""WITH m AS (SELECT source, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CAST(doc_id AS VARCHAR)) AS k FROM m)
SELECT source, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY k) FILTER (k <= 8) AS first FROM r GROUP BY source""")
def postconditions(t: Tables) -> DataFrame:
    d = t.documents.select("source", "doc_id")
    return R.missing_after(d, d.join(t.labels, "doc_id", "left_semi"), ["source"], "doc_id")


@query("SELECT l_orderkey, count(DISTINCT l_linestatus) >= 1 AND count(DISTINCT l_linenumber) >= 2 AND count(*) FILTER (l_returnflag <> 'R') = 0 AS mismatch FROM lineitem GROUP BY 1")
def design_mismatch(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey").agg(F.countDistinct("l_linenumber").alias("o"), F.count_if(F.col("l_returnflag") != "R").alias("c"))
    return R.design_mismatch(g, F.col("o"), F.col("c")).select("l_orderkey", "mismatch")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey, min(n) AS n, string_agg(o_orderkey, ', ' ORDER BY k) FILTER (k <= 3) || CASE WHEN min(n) > 3 THEN ' and ' || (min(n) - 3) || ' more' ELSE '' END AS head FROM r GROUP BY 1""")
def digest_topk(t: Tables) -> DataFrame:
    return R.digest(t.orders, ["o_custkey"], ["o_orderkey"], F.col("o_orderkey").cast("string"))


@query("""WITH r AS (SELECT l_orderkey, l_suppkey % 3 AS tb, l_linenumber * 1000000 + l_partkey AS pos, l_returnflag, l_linestatus FROM lineitem), g AS (SELECT l_orderkey, tb, min(pos) AS p, count(*) AS n, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS spaces, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS kinds FROM r GROUP BY 1, 2)
SELECT l_orderkey AS study_id, tb AS table_id, n, spaces, kinds, row_number() OVER (PARTITION BY l_orderkey ORDER BY p, tb) AS "index" FROM g""")
def stage_block(t: Tables) -> DataFrame:
    p = t.lineitem.select(F.col("l_orderkey").alias("study_id"), (F.col("l_suppkey") % 3).alias("table_id"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("pos"), F.col("l_returnflag").alias("space"), F.col("l_linestatus").alias("kind"))
    return R.table_block(p)


@query("SELECT user_id, coalesce(max(status) FILTER (event_type = 'view'), '-') AS \"view\", coalesce(max(status) FILTER (event_type = 'click'), '-') AS click, coalesce(max(status) FILTER (event_type = 'purchase'), '-') AS purchase FROM (SELECT *, CASE WHEN value > 50 THEN 'ok' ELSE 'failed' END AS status FROM events) GROUP BY user_id")
def verdict_pivot(t: Tables) -> DataFrame:
    e = t.events.withColumn("status", F.when(F.col("value") > 50, "ok").otherwise("failed"))
    return R.verdicts(e, "user_id", "event_type", "status", ["view", "click", "purchase"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 2 OR (l_linenumber = 3 AND l_returnflag = 'R') THEN 'allowed' ELSE 'reported' END AS side FROM lineitem")
def allowlist_partition(t: Tables) -> DataFrame:
    f = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("lines["), "l_partkey", F.lit("].n"), "l_linenumber").alias("path"), F.concat(F.lit("flag "), "l_returnflag").alias("message"))
    a = t.spark.createDataFrame([("lines[0].n2", None), ("lines.n3", "flag R"), (None, None)], "path string, message string")
    left, gone = R.partition_allowed(f, a)
    cols = ["l_orderkey", "l_linenumber", "l_partkey"]
    return left.select(*cols, F.lit("reported").alias("side")).union(gone.select(*cols, F.lit("allowed")))


@query("""SELECT doc_id, coalesce(CASE WHEN quality IS NOT NULL THEN 'label ' || quality END, CASE WHEN doc_id IN (SELECT item_id FROM benchmark) THEN 'item' END, 'no source') AS found, CASE WHEN quality IS NOT NULL THEN 'labels' WHEN doc_id IN (SELECT item_id FROM benchmark) THEN 'benchmark' ELSE 'warning' END AS source FROM documents LEFT JOIN labels USING (doc_id)""")
def fallback_source(t: Tables) -> DataFrame:
    a = t.labels.select("doc_id", F.concat(F.lit("label "), "quality").alias("found"))
    b = t.benchmark.select(F.col("item_id").alias("doc_id"), F.lit("item").alias("found"))
    good, bad = readers.first_of(t.documents, "doc_id", [("labels", a), ("benchmark", b)], "found")
    return good.select("doc_id", "found", "source").union(bad.select("doc_id", "warning", F.lit("warning")))


@query("""WITH o AS (SELECT o_orderkey AS path, o_orderstatus AS h FROM orders WHERE o_orderkey % 10 <> 0), p AS (SELECT o_orderkey AS path, CASE WHEN o_orderkey % 7 = 0 THEN 'old' ELSE o_orderstatus END AS h FROM orders WHERE o_orderkey % 9 <> 0)
SELECT coalesce(o.path, p.path) AS path, CASE WHEN p.path IS NULL THEN 'new' WHEN o.path IS NULL THEN 'orphan' WHEN o.h <> p.h THEN 'stale' ELSE 'current' END AS state FROM o FULL JOIN p ON o.path = p.path""")
def output_diff(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_orderkey").alias("path"), F.col("o_orderstatus").alias("hash"))
    present = o.where("path % 9 <> 0").withColumn("hash", F.when(F.col("path") % 7 == 0, "old").otherwise(F.col("hash")))
    return sinks.output_states(o.where("path % 10 <> 0"), present)


@query("""WITH a AS (SELECT s_nationkey AS k, s_suppkey AS v, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS pos FROM supplier), b AS (SELECT c_nationkey AS k, c_custkey AS v, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos FROM customer)
SELECT coalesce(a.k, b.k) AS nation, CAST(coalesce(a.pos, b.pos) AS INT) AS pos, a.v AS "left", b.v AS "right", a.v IS NOT DISTINCT FROM b.v AS same FROM a FULL JOIN b ON a.k = b.k AND a.pos = b.pos""")
def positional_diff(t: Tables) -> DataFrame:
    a = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("pos"), F.col("s_suppkey").alias("name"))
    b = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("pos"), F.col("c_custkey").alias("name"))
    return R.diff_report(a, b, "nation", "name")
