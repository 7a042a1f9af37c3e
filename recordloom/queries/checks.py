"""Validation and derived-view queries over the study encoding of the order tables.

An analysis is an order, a cell one of its lines, a term the return flag (R is
continuous), a level the line status, the direction the line number modulo four,
and a model the order's priority, each taking the one before as its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..operators import checks as V, records as R, views as D
from ..plans import rules as P
from ._register import Family, Tables

FAMILY = Family()
query = FAMILY.query

CELLS = """cells AS (SELECT l_orderkey AS analysis_id, l_linenumber AS pos, min(l_returnflag) AS term_id, min(l_linestatus) AS level, CASE l_linenumber % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'undirected' ELSE 'held' END AS direction FROM lineitem GROUP BY 1, 2)"""
#: model, term, name: what each priority's stage declares. (fixed values)
TERMS = [("1", "A", "Alpha"), ("2", "N", "New"), ("3", "R", "Rate"), ("4", "A", "alpha "), ("4", "X", "product")]
LEVELS = [("A", "F"), ("N", "O"), ("N", "F"), ("N", "Z")]
SCOPE = f"""t(model_id, term_id, name) AS (VALUES {", ".join(str(x) for x in TERMS)}), m AS (SELECT DISTINCT left(o_orderpriority, 1) AS model_id FROM orders),
reach AS (SELECT model_id AS root, model_id AS node, 0 AS depth FROM m UNION ALL SELECT root, CAST(CAST(node AS INT) - 1 AS VARCHAR), depth + 1 FROM reach WHERE CAST(node AS INT) > 1),
scope AS (SELECT root, term_id, owner, depth, name FROM (SELECT root, term_id, node AS owner, depth, name, row_number() OVER (PARTITION BY root, term_id ORDER BY depth) AS k FROM reach JOIN t ON model_id = node) WHERE k = 1),
levels(term_id, level) AS (VALUES {", ".join(str(x) for x in LEVELS)})"""


def _cells(t: Tables) -> DataFrame:
    k = F.col("pos") % 4
    c = t.lineitem.groupBy(F.col("l_orderkey").alias("analysis_id"), F.col("l_linenumber").alias("pos")).agg(F.min("l_returnflag").alias("term_id"), F.min("l_linestatus").alias("level"))
    return c.withColumn("direction", F.when(k == 0, "positive").when(k == 1, "negative").when(k == 2, "undirected").otherwise("held"))


def _models(t: Tables):
    m = t.orders.select(F.left("o_orderpriority", F.lit(1)).alias("model_id")).distinct()
    inputs = m.where("model_id > '1'").select("model_id", (F.col("model_id").cast("int") - 1).cast("string").alias("input_id"))
    terms = t.spark.createDataFrame(TERMS, "model_id string, term_id string, name string")
    return m, inputs, terms, t.spark.createDataFrame(LEVELS, "term_id string, level string")


def _scope(t: Tables) -> DataFrame:
    m, inputs, terms, _ = _models(t)
    return V.terms_in_scope(inputs, m, terms, [])


def _model_cells(t: Tables) -> DataFrame:
    return _cells(t).join(t.orders.select(F.col("o_orderkey").alias("analysis_id"), F.left("o_orderpriority", F.lit(1)).alias("model_id")), "analysis_id")


@query("SELECT event_id, 'j' AS key, 'missing' AS code FROM events UNION ALL SELECT event_id, 'k', 'undeclared' FROM events WHERE event_id % 2 = 0")
def undeclared_missing(t: Tables) -> DataFrame:
    props = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.lit('{"z": 1}'))
    keys = t.events.select("event_id", F.explode(F.json_object_keys(props)).alias("key"))
    return V.undeclared_and_missing(keys, t.spark.createDataFrame([("z",), ("j",)], "key string"), t.spark.createDataFrame([("j",)], "key string"), "event_id")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS study_id, o_orderpriority AS path, 'error' AS severity, 'rule:status' AS code, 'breaks status' AS message FROM orders WHERE o_orderstatus = 'F' AND NOT (left(o_orderpriority, 1) IN ('1', '2') OR o_orderkey % 2 = 0) UNION ALL SELECT NULL, NULL, 'error', 'rule:odd', 'unsupported keyword pattern'")
def rule_implication(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_orderkey").alias("study_id"), F.col("o_orderpriority").alias("path"), F.col("o_orderstatus").alias("status"), F.left("o_orderpriority", F.lit(1)).alias("urgency"), F.when(F.col("o_orderkey") % 2 == 0, 1).alias("even"))
    rule = {"preconditions": {"slot_conditions": {"status": {"equals_string": "F"}}}, "postconditions": {"any_of": [{"slot_conditions": {"urgency": {"any_of": [{"equals_string": "1"}, {"equals_string": "2"}]}}}, {"slot_conditions": {"even": {"value_presence": "PRESENT"}}}]}}
    return P.check_rules(o, [("status", rule), ("odd", {"preconditions": {"slot_conditions": {"status": {"pattern": "x"}}}})])


@query("WITH v AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'unstated' ELSE event_type END AS value, event_id % 2 = 0 AS closed FROM events) SELECT event_id, value, CASE WHEN value = 'unstated' THEN 'unstated' WHEN value IN ('view', 'click') THEN 'ok' ELSE 'off_vocabulary' END AS code, CASE WHEN value = 'unstated' THEN 'error' WHEN value IN ('view', 'click') THEN 'none' WHEN closed THEN 'error' ELSE 'warning' END AS severity FROM v")
def vocabulary_check(t: Tables) -> DataFrame:
    v = t.events.select("event_id", F.when(F.col("event_id") % 11 == 0, "unstated").otherwise(F.col("event_type")).alias("value"))
    return V.vocabulary(v, t.spark.createDataFrame([("view",), ("click",)], "term string"), F.col("event_id") % 2 == 0)


@query("SELECT event_type AS field, event_type AS value, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1")
def off_vocabulary_tally(t: Tables) -> DataFrame:
    v = V.vocabulary(t.events.select(F.col("event_type").alias("field"), F.col("event_type").alias("value")), t.spark.createDataFrame([("view",), ("click",)], "term string"), F.lit(False))
    return V.off_vocabulary_tally(v, "field")


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN CASE WHEN CAST(props->>'$.k' AS INT) < 50 THEN 'below_minimum' ELSE 'ok' END ELSE 'wrong_type' END AS code FROM events")
def type_check(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    j = F.when(F.col("event_id") % 4 == 0, k).when(F.col("event_id") % 4 == 1, F.lit("true")).when(F.col("event_id") % 4 == 2, F.lit('"a"')).otherwise(F.lit("1.5"))
    e = t.events.withColumn("v", F.parse_json(j)).withColumn("kind", F.schema_of_variant("v"))
    return e.select("event_id", V.scalar(F.col("kind"), F.lit("integer"), F.expr("variant_get(v, '$', 'string')"), F.lit(50)).alias("code"))


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'bad_status' WHEN 1 THEN 'value_not_reported' WHEN 2 THEN 'value_missing' WHEN 3 THEN 'evidence_missing' WHEN 4 THEN 'present_without_sets' ELSE 'ok' END AS code FROM documents")
def status_invariants(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 6
    status = F.when(k == 0, "claimed").when(k == 1, "not_reported").otherwise("extracted")
    code = V.wrapper_invariants(status, F.when(k != 2, F.col("lang")), F.lit("reported"), F.when(k == 3, "not_applicable").otherwise("present"), F.when(k == 4, 0).otherwise(1))
    return t.documents.select("doc_id", code.alias("code"))


@query(f"WITH RECURSIVE {SCOPE} SELECT root, term_id, owner, CAST(depth AS BIGINT) AS depth FROM scope")
def terms_in_scope(t: Tables) -> DataFrame:
    return _scope(t).select("root", "term_id", "owner", "depth")


@query(f"WITH RECURSIVE {SCOPE} SELECT root, lower(trim(name)) AS key, count(DISTINCT node) AS owners FROM reach JOIN t ON model_id = node GROUP BY 1, 2 HAVING count(DISTINCT node) > 1")
def same_name_on_chain(t: Tables) -> DataFrame:
    m, inputs, terms, _ = _models(t)
    scope = V.closure(inputs.select(F.col("model_id").alias("src"), F.col("input_id").alias("dst")), m.select(F.col("model_id").alias("node")))
    return V.same_name_on_chain(scope.join(terms.withColumnRenamed("model_id", "node"), "node").withColumnRenamed("node", "owner"), [])


@query(f"""WITH RECURSIVE {CELLS}, {SCOPE} SELECT analysis_id, pos, CASE WHEN s.term_id IS NULL AND c.term_id IN (SELECT term_id FROM t) THEN 'elsewhere' WHEN s.term_id IS NULL THEN 'nowhere' WHEN c.term_id NOT IN (SELECT term_id FROM levels) THEN 'no_levels' WHEN NOT EXISTS (SELECT 1 FROM levels l WHERE l.term_id = c.term_id AND l.level = c.level) THEN 'undeclared_level' ELSE 'ok' END AS code
FROM cells c JOIN orders ON o_orderkey = analysis_id LEFT JOIN scope s ON s.root = left(o_orderpriority, 1) AND s.term_id = c.term_id""")
def cell_resolution(t: Tables) -> DataFrame:
    _, _, terms, levels = _models(t)
    return V.resolve_cells(_model_cells(t), _scope(t), terms, levels, []).select("analysis_id", "pos", "code")


@query(f"""WITH {CELLS}, per AS (SELECT analysis_id, term_id, bool_or(direction = 'positive') AND bool_or(direction = 'negative') AS x, bool_or(direction = 'held') AS h FROM cells GROUP BY 1, 2), a AS (SELECT analysis_id, count(*) FILTER (x) AS n, bool_or(h) AS h FROM per GROUP BY 1)
SELECT o_orderkey AS analysis_id FROM orders LEFT JOIN a ON analysis_id = o_orderkey WHERE o_orderkey % 3 = 0 AND NOT coalesce(h, FALSE) AND coalesce(n, 0) < 2""")
def crossing_lint(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("analysis_id"), F.when(F.col("o_orderkey") % 3 == 0, "group-by-stage effect").otherwise("voxel-by-voxel map").alias("name"))
    return V.crossing_unrecorded(a, _cells(t).withColumn("is_product", F.lit(False)), ["analysis_id"], "name").select("analysis_id")


@query(f"""WITH {CELLS}, s AS (SELECT analysis_id, string_agg(term_id || ':' || level || ':' || direction, '|' ORDER BY term_id || ':' || level || ':' || direction) AS signature FROM cells GROUP BY 1)
SELECT o_custkey % 5 AS study, left(o_orderpriority, 1) AS model, signature, count(*) AS n FROM orders JOIN s ON analysis_id = o_orderkey GROUP BY 1, 2, 3 HAVING bool_or(o_orderkey % 2 = 0) AND NOT bool_and(o_orderkey % 2 = 0)""")
def duplicate_estimand(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("analysis_id"), (F.col("o_custkey") % 5).alias("study"), F.left("o_orderpriority", F.lit(1)).alias("model"), F.when(F.col("o_orderkey") % 2 == 0, "an interaction").otherwise("a main effect").alias("name"))
    return V.same_estimand(a, _cells(t), "study", "analysis_id", "model", T.names_a_crossing("name"))


@query(f"""WITH RECURSIVE {CELLS}, {SCOPE} SELECT analysis_id, term_id, 'held_without_level' AS code FROM cells WHERE direction = 'held' AND pos % 8 = 7 GROUP BY 1, 2
UNION ALL SELECT analysis_id, term_id, 'all_held' FROM cells c WHERE direction = 'held' AND pos % 8 <> 7 GROUP BY 1, 2 HAVING count(DISTINCT level) = (SELECT count(DISTINCT level) FROM levels l WHERE l.term_id = c.term_id)""")
def unsigned_lint(t: Tables) -> DataFrame:
    c = _cells(t).withColumn("level", F.when(F.col("pos") % 8 != 7, F.col("level")))
    return V.held_cells(c, _models(t)[3], ["analysis_id"])


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 AND l.doc_id IS NOT NULL THEN 'contradiction' ELSE 'silent' END AS code, CASE WHEN doc_id % 5 = 0 AND l.doc_id IS NOT NULL THEN 'error' ELSE 'warning' END AS severity FROM documents LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) WHERE (doc_id % 5 = 0) = (l.doc_id IS NOT NULL)""".replace("l.doc_id IS NOT NULL", "doc_id IN (SELECT doc_id FROM labels)").replace(" LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)", ""))
def purpose_lint(t: Tables) -> DataFrame:
    return V.table_purpose(t.documents.select("doc_id"), t.labels, "doc_id", F.col("doc_id") % 5 == 0).select("doc_id", "code", "severity")


@query("""SELECT d.lang AS study, d.doc_id AS analysis_id, a.arm FROM documents d JOIN (VALUES ('en', 'that'), ('de', 'nicht'), ('fr', 'pour')) a(lang, arm) ON a.lang = d.lang WHERE contains(' ' || regexp_replace(lower(d.text), '[^\\p{L}\\p{N}]+', ' ', 'g') || ' ', ' ' || arm || ' ') AND d.doc_id NOT IN (SELECT doc_id FROM labels)""")
def arm_reachability(t: Tables) -> DataFrame:
    arms = t.spark.createDataFrame([("en", "That"), ("de", " nicht"), ("fr", "pour"), ("es", "de")], "study string, name string")
    d = t.documents.select(F.col("lang").alias("study"), F.col("doc_id").alias("analysis_id"), "text")
    return V.arm_mentions(d, arms, d.join(t.labels, F.col("analysis_id") == F.col("doc_id"), "left_semi"), "study", "text", "name")


@query("""SELECT p_partkey, 'comparison' AS code FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 'no_source_definition' FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 3 <> 0 UNION ALL SELECT p_partkey, 'no_assessment' FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 3 <> 0 AND p_partkey % 4 = 0""")
def change_lint(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    p = t.part.select("p_partkey", F.when(k % 3 == 0, "old versus new").when(k % 5 == 0, "percent change of x").otherwise("age").alias("name"), F.lit(None).cast("string").alias("source_definition"), F.when(k % 4 != 0, "scale").alias("assessment"))
    c = p.where(V.comparison_term("name", k % 2 == 0, F.lit(False))).select("p_partkey", F.lit("comparison").alias("code"))
    return c.union(V.derived_terms(p, "name", F.lit(True)).select("p_partkey", "code"))


@query("""WITH a AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 3 <> 0)
SELECT o_custkey, min(n) AS n, string_agg(o_orderkey, ', ' ORDER BY k) FILTER (k <= 3) || CASE WHEN min(n) > 3 THEN ' and ' || (min(n) - 3) || ' more' ELSE '' END AS head FROM a GROUP BY 1""")
def change_without_occasion(t: Tables) -> DataFrame:
    a = t.orders.select("o_custkey", F.col("o_orderkey").alias("analysis_id"), F.when(F.col("o_orderkey") % 2 == 0, "change over time").otherwise("baseline").alias("name"))
    studies = a.select("o_custkey").distinct()
    points = studies.select("o_custkey", F.explode(F.array(F.lit("pre"), F.lit("post"))).alias("timepoint"))
    return V.change_without_occasion(a, "o_custkey", points, studies.where("o_custkey % 3 = 0"), "name")


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS target, 'no_nation' AS code FROM events WHERE CAST(props->>'$.k' AS BIGINT) NOT IN (SELECT n_nationkey FROM nation) UNION ALL SELECT event_id, user_id, 'no_customer' FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)")
def reference_checks(t: Tables) -> DataFrame:
    e = t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("target"))
    u = t.events.select("event_id", F.col("user_id").alias("target"))
    a = V.references(e, "target", t.nation.select(F.col("n_nationkey").cast("long").alias("k")), "k", "no_nation")
    return a.unionByName(V.references(u, "target", t.customer.select(F.col("c_custkey").alias("k")), "k", "no_customer")).select("event_id", "target", "code")


@query(f"""WITH RECURSIVE {CELLS}, {SCOPE}, c(term_id, component_id) AS (VALUES ('X', 'A'), ('X', 'Q'), ('R', 'N')), r AS (SELECT root, s.term_id, component_id FROM scope s JOIN c USING (term_id))
SELECT DISTINCT root, term_id, 'component_out_of_scope' AS code FROM r WHERE NOT EXISTS (SELECT 1 FROM scope s WHERE s.root = r.root AND s.term_id = component_id) UNION ALL SELECT DISTINCT root, term_id, 'never_celled' FROM r WHERE term_id NOT IN (SELECT term_id FROM cells)""")
def component_scope(t: Tables) -> DataFrame:
    parts = t.spark.createDataFrame([("X", "A"), ("X", "Q"), ("R", "N")], "term_id string, component_id string")
    scope = _scope(t)
    return V.product_columns(scope.select("root", "term_id").join(parts, "term_id"), scope, _cells(t), [])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n, TRUE AS extension FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_key_ext(t: Tables) -> DataFrame:
    return V.unique_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""SELECT p_partkey, p_size > 40 AS above, (p_partkey % 2 = 0) AND (p_partkey % 3 = 0) AS both_spaces, (p_partkey % 4 = 0) AND (p_partkey % 3 = 0) AS healthy_ill, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 5 = 0 THEN 'level_required' WHEN p_partkey % 2 = 1 AND p_partkey % 5 <> 0 THEN 'level_forbidden' ELSE 'ok' END AS level_code FROM part""")
def extension_checks(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    said = lambda c: F.when(c, "given")
    kind = F.when(k % 2 == 0, "categorical").otherwise("continuous")
    return t.part.select("p_partkey", V.above_maximum(F.col("p_size"), F.lit(40)).alias("above"), V.exclusive(said(k % 2 == 0), said(k % 3 == 0)).alias("both_spaces"), V.healthy_with_condition(k % 4 == 0, said(k % 3 == 0)).alias("healthy_ill"), V.level_by_kind(kind, said(k % 5 != 0)).alias("level_code"))


@query("""WITH f AS (SELECT event_type AS study_id, 'error' AS severity, CAST(event_id AS VARCHAR) AS path, 'too small' AS message FROM events WHERE value < 5 UNION ALL SELECT event_type, 'warning', CAST(event_id AS VARCHAR), 'even' FROM events WHERE event_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY study_id ORDER BY severity, path) AS k, count(*) OVER (PARTITION BY study_id) AS n FROM f)
SELECT study_id, min(n) AS n, string_agg(severity || ' ' || path || ': ' || message, ', ' ORDER BY k) FILTER (k <= 5) || CASE WHEN min(n) > 5 THEN ' and ' || (min(n) - 5) || ' more' ELSE '' END AS head FROM r GROUP BY 1""")
def findings_union(t: Tables) -> DataFrame:
    e = t.events.withColumnRenamed("event_type", "study_id").withColumn("path", F.col("event_id").cast("string"))
    found = P.run_checks([lambda: P.findings(e, "small", "too small", F.col("value") < 5), lambda: P.findings(e, "even", "even", F.col("event_id") % 100 == 0, "warning")])
    return P.render(found)


KIND = f"""{CELLS}, per AS (SELECT analysis_id, term_id, bool_or(direction IN ('positive', 'negative')) AS s, bool_and(direction = 'undirected') AS f, bool_or(direction = 'positive') AND bool_or(direction = 'negative') AS x FROM cells GROUP BY 1, 2),
a AS (SELECT analysis_id, bool_or(term_id = 'R') AS r, count(*) FILTER (x) AS x, bool_or(s) AS s, bool_and(f) AS f FROM per GROUP BY 1)"""


@query(f"WITH {KIND} SELECT analysis_id, CASE WHEN r THEN CASE analysis_id % 3 WHEN 0 THEN 'parametric_modulation' WHEN 1 THEN 'cross_subject_regression' END WHEN x >= 2 THEN 'interaction' WHEN x = 1 THEN 'contrast' WHEN s THEN 'simple_effect' WHEN f THEN 'omnibus' END AS kind FROM a")
def effect_kind(t: Tables) -> DataFrame:
    c = _cells(t).withColumn("term_type", F.when(F.col("term_id") == "R", "continuous").otherwise("categorical")).withColumn("in_scope", F.lit(True)).withColumn("is_product", F.lit(False))
    k = F.col("analysis_id") % 3
    return D.effect_kind(c.withColumn("variation", F.when(k == 0, "within_subject").when(k == 1, "mixed")), ["analysis_id"])


@query(f"""WITH RECURSIVE {CELLS}, {SCOPE}, p AS (SELECT o_orderkey AS analysis_id, s.term_id, o_orderkey % 4 AS k FROM orders JOIN scope s ON s.root = left(o_orderpriority, 1))
SELECT analysis_id, term_id FROM p WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.analysis_id = p.analysis_id AND c.term_id = p.term_id) AND NOT (term_id = 'X' AND EXISTS (SELECT 1 FROM cells c WHERE c.analysis_id = p.analysis_id AND c.term_id = 'A') AND EXISTS (SELECT 1 FROM cells c WHERE c.analysis_id = p.analysis_id AND c.term_id = 'N')) AND NOT (k IN (0, 1) AND term_id = 'N')""")
def adjustment_set(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 4
    a = t.orders.select(F.col("o_orderkey").alias("analysis_id"), F.left("o_orderpriority", F.lit(1)).alias("model_id"), F.lit("N").alias("mediator_id"), F.when(k == 0, "indirect").when(k == 1, "total").when(k == 2, "direct").alias("path"))
    parts = t.spark.createDataFrame([("X", "A"), ("X", "N")], "term_id string, component_id string")
    return D.adjustment_set(a, _scope(t), _cells(t), parts, [])


@query(f"WITH RECURSIVE {CELLS}, {SCOPE} SELECT DISTINCT analysis_id, l.term_id, l.level FROM cells c JOIN levels l USING (term_id) WHERE NOT EXISTS (SELECT 1 FROM cells d WHERE d.analysis_id = c.analysis_id AND d.term_id = l.term_id AND d.level = l.level)")
def weighted_out(t: Tables) -> DataFrame:
    return D.weighted_out(_cells(t), _models(t)[3], ["analysis_id"])


@query(f"WITH {CELLS}, e(term_id, level, slot) AS (VALUES ('A', 'F', 'groups'), ('N', 'O', 'timepoints'), ('N', 'F', 'groups'), ('R', 'F', 'arms')) SELECT analysis_id, string_agg(DISTINCT slot, ',' ORDER BY slot) AS axis FROM cells JOIN e USING (term_id, level) GROUP BY 1")
def compared_axis(t: Tables) -> DataFrame:
    e = t.spark.createDataFrame([("A", "F", "groups"), ("N", "O", "timepoints"), ("N", "F", "groups"), ("R", "F", "arms")], "term_id string, level string, slot string")
    return D.compared_axis(_cells(t), e, ["analysis_id"])


@query("SELECT o_orderkey, sha256(concat_ws(chr(31), CAST(o_custkey AS VARCHAR), 'Order', '', o_orderpriority, CAST(o_orderkey AS VARCHAR))) AS id, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS value FROM orders")
def mapper_ids(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "extracted").otherwise("not_reported")
    return t.orders.select("o_orderkey", D.deterministic_id(F.col("o_custkey"), F.lit("Order"), F.lit(None), F.col("o_orderpriority"), F.col("o_orderkey")).alias("id"), D.unwrap(status, F.col("o_orderpriority")).alias("value"))


@query("SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN 'urgent' WHEN '2' THEN 'high' ELSE o_orderpriority END AS normalized FROM orders")
def free_text_normalize(t: Tables) -> DataFrame:
    p = t.orders.select("o_orderpriority").distinct().where("left(o_orderpriority, 1) IN ('1', '2')")
    table = p.select(F.upper("o_orderpriority").alias("raw"), F.when(F.left("o_orderpriority", F.lit(1)) == "1", "urgent").otherwise("high").alias("normal"))
    return D.normalize_free_text(t.orders.select("o_orderkey", F.concat("o_orderpriority", F.lit(" ")).alias("f")), table, "f").select("o_orderkey", F.trim("normalized").alias("normalized"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 OR doc_id % 5 = 0 THEN 'drop' WHEN doc_id % 4 = 1 THEN 'unknown' ELSE 'keep' END AS verdict FROM documents")
def paper_gate(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    types = F.when(k % 4 == 0, F.array(F.lit("Review"), F.lit("Meta-Analysis"))).when(k % 4 != 1, F.array(F.lit("Journal Article")))
    return t.documents.select("doc_id", D.paper_gate(types, F.when(k % 5 == 0, "A META-ANALYSIS of x").otherwise("x")).alias("verdict"))


@query("SELECT source, count(*) AS n, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM (SELECT source, 'not_reported' AS code FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT source, 'toxic' FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) GROUP BY source")
def review_routing(t: Tables) -> DataFrame:
    a = t.documents.join(t.labels, "doc_id", "left_anti").select("source", F.lit("not_reported").alias("code"))
    return D.review_routing(a.union(t.documents.join(t.labels.where("toxic = 1"), "doc_id").select("source", F.lit("toxic"))), "source")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'MNI' END, CASE WHEN o_orderkey % 3 = 0 THEN 'TAL' END) AS space FROM orders")
def coordinate_space(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", D.coordinate_space(F.when(F.col("o_orderkey") % 2 == 0, "MNI"), F.when(F.col("o_orderkey") % 3 == 0, "TAL")).alias("space"))
