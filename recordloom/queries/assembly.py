"""Queries of record assembly, schema walks and reports that need more than one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import catalogue as C, checks as V, records as R, sections, spans, views as D
from ._register import Family, Tables
from .catalogue import TOY_SQL, _toy, _values
from .text import EXACT, MARKDOWN, _markdown, _pairs

FAMILY = Family()
query = FAMILY.query

#: class, attr, ord, range, multivalued, inlined of a catalogue with lists on two levels. (fixed values)
OWNED = [
    ("Study", "groups", 1, "Group", True, True), ("Study", "design", 2, "Design", False, True), ("Study", "title", 3, "string", False, False), ("Study", "other", 4, "Design", False, False),
    ("Design", "arms", 1, "Arm", True, True), ("Design", "groups", 2, "Group", True, True), ("Design", "note", 3, "string", False, False), ("Part", "more", 1, "string", True, False),
]


@query(f"""WITH a(class, attr, ord, range, multivalued, inlined) AS (VALUES {_values(OWNED)}), f AS (SELECT attr AS key, attr AS path, -1 AS i, ord AS j FROM a WHERE class = 'Study' AND multivalued
UNION ALL SELECT b.attr, a.attr || '.' || b.attr, a.ord, b.ord FROM a JOIN a b ON b.class = a.range WHERE a.class = 'Study' AND NOT a.multivalued AND a.inlined AND b.multivalued)
SELECT key, arg_min(path, (i, j)) AS path FROM f GROUP BY key""")
def entity_lists(t: Tables) -> DataFrame:
    a = t.spark.createDataFrame(OWNED, "class string, attr string, ord int, range string, multivalued boolean, inlined boolean")
    c = a.select("class", F.lit(None).cast("string").alias("parent"), (F.col("class") == "Study").alias("tree_root")).distinct()
    return C.entity_lists(c, a, C.tree_root(c))


#: class, rule, slot; enum, member. (fixed values)
RULES = [("Patients", "one", "count"), ("Patients", "one", "nothing"), ("Arm", "two", "name"), ("Arm", "three", "count"), ("Arm", "three", "arm")]
MEMBERS = [("GroupKind", "patients"), ("GroupKind", "unstated"), ("Code", "a")]


@query(f"""WITH RECURSIVE {TOY_SQL}, r(class, rule, slot) AS (VALUES {_values(RULES)}), m(enum, member) AS (VALUES {_values(MEMBERS)})
SELECT class AS element, rule, string_agg(slot, ', ' ORDER BY slot) AS problem FROM r WHERE (class, slot) NOT IN (SELECT (cls, attr) FROM full_a) GROUP BY 1, 2 UNION ALL SELECT enum, NULL, 'unstated' FROM m WHERE member = 'unstated'""")
def rule_slots(t: Tables) -> DataFrame:
    c, a, _ = _toy(t)
    bad = C.unknown_rule_slots(t.spark.createDataFrame(RULES, "class string, rule string, slot string"), c, a)
    out = C.unstated_members(t.spark.createDataFrame(MEMBERS, "enum string, member string"))
    return bad.select(F.col("class").alias("element"), "rule", F.col("slots").alias("problem")).union(out.select("enum", F.lit(None).cast("string"), F.lit("unstated")))


@query(f"""WITH RECURSIVE {TOY_SQL} SELECT 'own' AS walk, class AS a, attr AS b FROM a WHERE class = 'Group' UNION ALL SELECT 'is_a', class, ancestor FROM anc UNION ALL SELECT 'below', 'Group', class FROM anc WHERE ancestor = 'Group' AND depth > 0
UNION ALL SELECT 'designator', cls, attr FROM full_a WHERE designator UNION ALL SELECT 'references', cls, string_agg(attr, ',' ORDER BY attr) FROM full_a WHERE NOT identifier AND NOT inlined AND range IN (SELECT class FROM c) GROUP BY cls""")
def schema_walks(t: Tables) -> DataFrame:
    c, a, e = _toy(t)
    row = lambda df, walk, x, y: df.select(F.lit(walk).alias("walk"), x.alias("a"), y.alias("b"))
    out = row(C.own_attributes(a, "Group"), "own", F.col("class"), F.col("attr"))
    out = out.union(row(C.resolves_to(c), "is_a", F.col("class"), F.col("ancestor"))).union(row(C.subclasses(c, "Group"), "below", F.lit("Group"), F.col("class")))
    out = out.union(row(C.type_designator(c, a), "designator", F.col("class"), F.col("attr")))
    return out.union(row(C.reference_slots(C.classify_slots(c, a, e)), "references", F.col("class"), F.col("slots")))


@query(f"""WITH e AS ({EXACT}), q AS (SELECT doc_id, item_id, item_id % 2 AS set_no, start_char, end_char, item_id % 3 <> 0 AS found FROM e),
s AS (SELECT doc_id, set_no, string_agg(start_char || '-' || end_char, ',' ORDER BY item_id) FILTER (found) AS spans, count(*) AS n, count(*) FILTER (found) AS r FROM q GROUP BY 1, 2),
b AS (SELECT doc_id, sum(n) AS quotes, sum(r) AS resolved, string_agg(spans, ';' ORDER BY set_no) AS sets FROM s GROUP BY 1),
f AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'not_reported' ELSE 'extracted' END AS status, CASE WHEN doc_id % 5 = 0 THEN 'not_applicable' ELSE 'not_found' END AS evidence FROM documents)
SELECT doc_id, CAST(coalesce(quotes, 0) AS BIGINT) AS quotes, CAST(coalesce(resolved, 0) AS BIGINT) AS resolved, sets,
CASE WHEN resolved > 0 THEN 'present' WHEN quotes IS NOT NULL AND status = 'extracted' THEN 'not_found' WHEN quotes IS NOT NULL THEN 'not_applicable' WHEN status = 'extracted' THEN 'not_found' ELSE evidence END AS evidence,
status = 'extracted' AND CASE WHEN quotes IS NOT NULL THEN resolved = 0 ELSE evidence = 'not_applicable' END AS downgraded FROM f LEFT JOIN b USING (doc_id)""")
def evidence_walk(t: Tables) -> DataFrame:
    """Each document a field, each item in it a quote, a third of them spoilt."""
    p = _pairs(t).drop("start_char", "end_char").withColumn("quote", F.when(F.col("item_id") % 3 == 0, F.concat("quote", F.lit("☃"))).otherwise(F.col("quote")))
    quotes = spans.resolve(p).select("doc_id", (F.col("item_id") % 2).alias("set_no"), F.col("item_id").alias("quote_no"), "start_char", "end_char")
    fields = t.documents.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "not_reported").otherwise("extracted").alias("status"), F.when(F.col("doc_id") % 5 == 0, "not_applicable").otherwise("not_found").alias("evidence"))
    out = R.walk_quotes(fields, quotes, ["doc_id"])
    sets = F.array_join(F.transform("sets", lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws("-", x["start_char"], x["end_char"])), ",")), ";")
    return out.select("doc_id", "quotes", "resolved", F.nullif(sets, F.lit("")).alias("sets"), "evidence", "downgraded")


@query(f"WITH e AS ({EXACT}) SELECT lang, count(*) AS spans FROM e JOIN documents USING (doc_id) GROUP BY lang")
def integrity_gate(t: Tables) -> DataFrame:
    """Spans by language, all of them verified; one that isn't true would fail the query."""
    return spans.require_true(_pairs(t), "text", "start_char", "end_char", "quote").groupBy("lang").agg(F.count("*").alias("spans"))


@query(f"WITH e AS ({EXACT}) SELECT item_id, count(*) FILTER (doc_id % 2 = 0) AS found, count(*) FILTER (doc_id % 2 = 1) AS failed FROM e GROUP BY item_id")
def resolve_partition(t: Tables) -> DataFrame:
    p = _pairs(t).drop("start_char", "end_char").withColumn("quote", F.when(F.col("doc_id") % 2 == 1, F.concat("quote", F.lit("☃"))).otherwise(F.col("quote")))
    found, failed = spans.resolve_all(spans.resolve(p))
    both = found.select("item_id", F.lit(True).alias("ok")).union(failed.select("item_id", F.lit(False)))
    return both.groupBy("item_id").agg(F.count_if("ok").alias("found"), F.count_if(~F.col("ok")).alias("failed"))


@query("""WITH r AS (SELECT user_id AS id, unnest(CASE WHEN user_id % 3 = 0 THEN ['arms', 'study.design.arms', 'tables'] WHEN user_id % 3 = 1 THEN ['arms', 'study.design.timepoints'] ELSE ['timepoints', 'study.design.timepoints'] END) AS path FROM (SELECT DISTINCT user_id FROM events))
SELECT id, path, path IN ('arms', 'timepoints') AND EXISTS (SELECT 1 FROM r x WHERE x.id = r.id AND x.path = 'study.design.' || r.path) AS dropped FROM r""")
def payload_nested_wins(t: Tables) -> DataFrame:
    lists = F.when(F.col("user_id") % 3 == 0, F.array(*map(F.lit, ("arms", "study.design.arms", "tables")))).when(F.col("user_id") % 3 == 1, F.array(*map(F.lit, ("arms", "study.design.timepoints")))).otherwise(F.array(*map(F.lit, ("timepoints", "study.design.timepoints"))))
    return R.nested_wins(t.events.select("user_id").distinct().select(F.col("user_id").alias("id"), F.explode(lists).alias("path")))


@query("""WITH a AS (SELECT o_custkey AS id, o_orderkey // 2 AS local_id, o_orderstatus AS kind, o_orderpriority AS label, CASE WHEN o_orderstatus <> 'F' THEN 'x' END AS effect FROM orders),
d AS (SELECT DISTINCT o_custkey AS id, o_orderkey // 2 AS local_id, 'declared' AS kind, 'd' AS label FROM orders WHERE o_orderkey % 6 = 0)
SELECT id, local_id, kind, label, 'analysis' AS list FROM a WHERE effect IS NOT NULL UNION ALL SELECT id, local_id, kind, label, 'required' FROM d
UNION ALL SELECT id, local_id, kind, min(label), 'required' FROM a WHERE effect IS NULL AND (id, local_id) NOT IN (SELECT (id, local_id) FROM d) GROUP BY id, local_id, kind""")
def required_entities(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("id"), F.floor(F.col("o_orderkey") / 2).alias("local_id"), F.col("o_orderstatus").alias("kind"), F.col("o_orderpriority").alias("label"), "o_orderkey")
    a = o.withColumn("effect", F.when(F.col("kind") != "F", "x"))
    d = o.where("o_orderkey % 6 = 0").select("id", "local_id", F.lit("declared").alias("kind"), F.lit("d").alias("label")).distinct()
    kept, required = R.required_entities(a, d, "effect")
    cols = ["id", "local_id", "kind", "label"]
    return kept.select(*cols, F.lit("analysis").alias("list")).union(required.select(*cols, F.lit("required")))


@query("SELECT CAST(r_regionkey AS BIGINT) AS region_id, CAST(3 AS BIGINT) AS before, CAST(0 AS BIGINT) AS after FROM region")
def leftover_placeholders(t: Tables) -> DataFrame:
    n = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("l"))
    r = t.region.join(n, F.col("n_regionkey") == F.col("r_regionkey")).withColumn("text", F.concat("r_name", F.lit(": [placeholder-2] and [placeholder-99] end [placeholder-1]")))
    r = r.withColumn("filled", spans.place_tables("text", "l"))
    return r.select(F.col("r_regionkey").cast("long").alias("region_id"), spans.leftover("text").alias("before"), spans.leftover("filled").alias("after"))


@query(f"WITH {MARKDOWN}, f AS (SELECT doc_id, arg_min(start_char, ordinal) AS s, arg_min(end_char, ordinal) AS e FROM sec WHERE title = 'T1' GROUP BY doc_id) SELECT conv_id AS doc_id, substr(text, CAST(s AS BIGINT) + 1, CAST(e - s AS BIGINT)) AS text FROM md LEFT JOIN f ON doc_id = conv_id")
def section_slice(t: Tables) -> DataFrame:
    return sections.slice_section(_markdown(t), "T1", missing="null")


@query("""WITH a AS (SELECT DISTINCT l_orderkey AS analysis_id, l_suppkey % 7 AS "group" FROM lineitem), c AS (SELECT s_suppkey % 7 AS "group", count(*) AS acquired FROM supplier WHERE s_suppkey % 7 <> 3 GROUP BY 1)
SELECT analysis_id, "group", CAST(analysis_id % 5 AS BIGINT) AS n, acquired, CASE WHEN acquired IS NULL THEN 0 ELSE greatest(acquired - analysis_id % 5, 0) END AS dropped FROM a LEFT JOIN c USING ("group")""")
def who_was_in_it(t: Tables) -> DataFrame:
    n = (F.col("l_orderkey") % 5).cast("long")
    a = t.lineitem.groupBy(F.col("l_orderkey").alias("analysis_id")).agg(F.collect_set(F.struct((F.col("l_suppkey") % 7).alias("group"), n.alias("n"))).alias("groups"))
    c = t.supplier.where("s_suppkey % 7 <> 3").groupBy((F.col("s_suppkey") % 7).alias("group")).agg(F.count("*").alias("acquired"))
    return D.members(a, c, "analysis_id")


@query("""WITH a AS (SELECT o_custkey AS k, o_orderpriority AS name, o_orderkey % 4 + 1 AS p FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey AS k, o_orderpriority AS name, o_orderkey % 4 + 2 AS p FROM orders WHERE o_orderstatus <> 'F'),
u AS (SELECT k, name, count(*) FILTER (s = 0) AS n0, count(*) FILTER (s = 1) AS n1, sum(p) FILTER (s = 0) AS p0, sum(p) FILTER (s = 1) AS p1 FROM (SELECT *, 0 AS s FROM a UNION ALL SELECT *, 1 FROM b) GROUP BY 1, 2)
SELECT k AS study, CAST(sum(n0) AS BIGINT) AS n_left, CAST(sum(n1) AS BIGINT) AS n_right, CAST(coalesce(sum(p0), 0) AS BIGINT) AS points_left, CAST(coalesce(sum(p1), 0) AS BIGINT) AS points_right,
coalesce(string_agg(name, ', ' ORDER BY name) FILTER (n1 = 0), '') AS only_left, coalesce(string_agg(name, ', ' ORDER BY name) FILTER (n0 = 0), '') AS only_right FROM u GROUP BY 1""")
def diff_summary(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("study"), F.col("o_orderpriority").alias("name"), (F.col("o_orderkey") % 4).cast("long").alias("points"), "o_orderstatus")
    left, right = o.where("o_orderstatus = 'F'").withColumn("points", F.col("points") + 1), o.where("o_orderstatus != 'F'").withColumn("points", F.col("points") + 2)
    return R.diff_summary(left, right, "study", "name", "points")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders)
SELECT o_custkey, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY k) FILTER (k <= 4) AS head, greatest(count(*) - 4, 0) AS rest FROM r GROUP BY 1""")
def first_points(t: Tables) -> DataFrame:
    return R.first_points(t.orders, ["o_custkey"], ["o_orderkey"], F.col("o_orderkey").cast("string"), 4)


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'list_expected' WHEN 1 THEN 'ok' WHEN 2 THEN 'single_expected' WHEN 3 THEN 'identifier_not_text' WHEN 4 THEN 'reference_not_text' ELSE 'ok' END AS code FROM events""")
def slot_shape(t: Tables) -> DataFrame:
    k = F.col("event_id") % 6
    text = F.when(k == 0, F.lit('"a"')).when(k.isin(1, 2), F.lit('["a"]')).when(k == 3, F.lit('""')).when(k == 4, F.lit("7")).otherwise(F.lit('"b"'))
    slot = F.when(k.isin(0, 1, 2), "evidence").when(k == 3, "identifier").otherwise("reference")
    e = t.events.withColumn("v", F.parse_json(text)).withColumn("kind", F.expr("CASE WHEN schema_of_variant(v) LIKE 'ARRAY%' THEN 'ARRAY' ELSE schema_of_variant(v) END"))
    return e.select("event_id", V.slot_shape(F.col("kind"), slot, k < 2, F.expr("try_variant_get(v, '$', 'string')")).alias("code"))
