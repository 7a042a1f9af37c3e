"""Schema-as-data queries: closures, projections and two-way checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import catalogue as C, closure as G
from ._register import Family, Tables

FAMILY = Family()
query = FAMILY.query

TREE = """tree AS (SELECT 'r' || r_regionkey AS class, CAST(NULL AS VARCHAR) AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
anc AS (SELECT class, class AS ancestor, 0 AS depth FROM tree UNION ALL SELECT a.class, t.parent, a.depth + 1 FROM anc a JOIN tree t ON t.class = a.ancestor WHERE t.parent IS NOT NULL)"""


def _tree(t: Tables) -> DataFrame:
    r = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("class"), F.lit(None).cast("string").alias("parent"))
    n = t.nation.select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"))
    return r.union(n).union(t.supplier.select(F.concat(F.lit("s"), "s_suppkey"), F.concat(F.lit("n"), "s_nationkey")))


@query(f"WITH RECURSIVE {TREE} SELECT class, ancestor, CAST(depth AS BIGINT) AS depth FROM anc")
def ancestry_closure(t: Tables) -> DataFrame:
    return C.ancestry(_tree(t))


@query(f"""WITH RECURSIVE {TREE}, att AS (SELECT class, 'kind' AS attr, 'region' AS val FROM tree WHERE parent IS NULL UNION ALL SELECT class, 'kind', 'supplier' FROM tree WHERE class LIKE 's%' AND right(class, 1) = '3' UNION ALL SELECT class, 'zone', class FROM tree WHERE class LIKE 'n%')
SELECT class, attr, val AS range, declared_in FROM (SELECT a.class, attr, val, ancestor AS declared_in, row_number() OVER (PARTITION BY a.class, attr ORDER BY depth) AS k FROM anc a JOIN att ON att.class = ancestor) WHERE k = 1""")
def attribute_override(t: Tables) -> DataFrame:
    tree = _tree(t)
    kinds = tree.where("parent IS NULL").select("class", F.lit("kind").alias("attr"), F.lit("region").alias("range"))
    kinds = kinds.union(tree.where("class LIKE 's%' AND right(class, 1) = '3'").select("class", F.lit("kind"), F.lit("supplier"))).union(tree.where("class LIKE 'n%'").select("class", F.lit("zone"), "class"))
    return C.attributes_for(tree, kinds).select("class", "attr", "range", "declared_in")


NEXT = "SELECT CAST(n_nationkey AS BIGINT) AS src, CAST((7 * n_nationkey + 3) % 25 AS BIGINT) AS dst FROM nation"


def _next(t: Tables) -> DataFrame:
    return t.nation.selectExpr("CAST(n_nationkey AS BIGINT) AS src", "CAST((7 * n_nationkey + 3) % 25 AS BIGINT) AS dst")


@query(f"WITH RECURSIVE e AS ({NEXT}), w AS (SELECT CAST(0 AS BIGINT) AS node UNION SELECT dst FROM w JOIN e ON src = node) SELECT node FROM w")
def reachability(t: Tables) -> DataFrame:
    return G.closure(_next(t), _next(t).where("src = 0").selectExpr("src AS node")).select("node")


@query(f"""WITH RECURSIVE e AS ({NEXT}), w AS (SELECT src AS root, src AS node, [CAST(src AS VARCHAR)] AS path, FALSE AS cyc FROM e UNION ALL SELECT root, dst, list_append(path, CAST(dst AS VARCHAR)), list_contains(path, CAST(dst AS VARCHAR)) FROM w JOIN e ON src = node WHERE NOT cyc)
SELECT root, array_to_string(path, ' > ') AS path FROM w WHERE cyc""")
def cycle_detect(t: Tables) -> DataFrame:
    return G.cycles(_next(t), _next(t).selectExpr("src AS node"))


@query("""SELECT coalesce(a.k, b.k) AS nation, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' ELSE 'common' END AS side
FROM (SELECT c_nationkey AS k FROM customer UNION SELECT -1) a FULL JOIN (SELECT s_nationkey AS k FROM supplier UNION SELECT -2) b ON a.k = b.k""")
def identity_diff(t: Tables) -> DataFrame:
    """All nations of customers against all of suppliers, with a key of its own on either side."""
    a, b = t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))
    a, b = (x.union(t.spark.range(1).select(F.lit(k).cast(x.schema[0].dataType))) for x, k in ((a, -1), (b, -2)))
    return C.two_way(a, b, "nation")


@query("""SELECT d.doc_id, CASE WHEN (d.lang = 'en') AND (l.quality = 1) THEN 'both' WHEN (d.lang = 'en') OR coalesce(l.quality = 1, FALSE) THEN 'one' ELSE 'neither' END AS marks FROM documents d LEFT JOIN labels l USING (doc_id)""")
def exactly_one_mark(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return C.exactly_one(d, "doc_id", F.col("lang") == "en", F.coalesce(F.col("quality") == 1, F.lit(False)))


@query("SELECT p_size AS size, count(*) AS n, p_size IN (1, 2, 3, 5, 7, 11, 13) AS valid FROM part GROUP BY p_size")
def domain_inventory(t: Tables) -> DataFrame:
    return C.inventory(t.part.select(F.col("p_size").alias("size")), "size", [1, 2, 3, 5, 7, 11, 13])


@query("""SELECT CAST(event_id AS BIGINT) AS event_id, CASE WHEN (event_id % 2 = 0) <> (o.o_orderstatus = 'O') THEN 'openness' WHEN NOT (event_type IN ('view', 'click', 'purchase')) THEN 'enum' WHEN (event_id % 3 = 0) <> (o_orderkey % 3 = 0) THEN 'cardinality' ELSE 'ok' END AS verdict FROM events JOIN orders o ON o_orderkey = event_id""")
def closed_open_parity(t: Tables) -> DataFrame:
    j = t.events.join(t.orders, F.col("o_orderkey") == F.col("event_id"))
    j = j.select("event_id", (F.col("event_id") % 2 == 0).alias("source_open"), (F.col("o_orderstatus") == "O").alias("target_open"), F.col("event_type").isin("view", "click", "purchase").alias("enum_reached"), (F.col("event_id") % 3 == 0).alias("source_many"), (F.col("o_orderkey") % 3 == 0).alias("target_many"))
    return j.select("event_id", C.vocabulary_parity(j).alias("verdict"))


#: A toy catalogue: class, attr, ord, range, multivalued, inlined, identifier, designator, required, subset, minimum. (fixed values)
TOY = [
    ("Study", "id", 1, "string", False, False, True, False, True, "deterministic", None), ("Study", "title", 2, "string", False, False, False, False, True, "mvp", None),
    ("Study", "groups", 3, "Group", True, True, False, False, False, "mvp", None), ("Group", "local", 1, "string", False, False, True, False, True, "", None),
    ("Group", "count", 2, "integer", False, False, False, False, False, "mvp", 0), ("Group", "kind", 3, "GroupKind", False, False, False, False, True, "", None),
    ("Group", "arm", 4, "Arm", False, False, False, False, False, "", None), ("Arm", "name", 1, "string", False, False, False, False, True, "", None),
    ("Patients", "diagnoses", 1, "string", True, False, False, False, False, "mvp", None), ("Patients", "type", 2, "string", False, False, False, True, True, "", None),
    ("Orphan", "codes", 1, "Code", True, False, False, False, False, "", None),
]
TOY_CLASSES = [("Study", None, True), ("Group", None, False), ("Patients", "Group", False), ("Arm", None, False), ("Orphan", None, False)]
TOY_ENUMS = [("GroupKind",), ("Code",), ("Unused",)]


def _toy(t: Tables):
    cols = "class string, attr string, ord int, range string, multivalued boolean, inlined boolean, identifier boolean, designator boolean, required boolean, subset string, minimum int"
    a = t.spark.createDataFrame(TOY, cols).withColumn("subsets", F.array("subset")).withColumn("any_of", F.array().cast("array<string>"))
    return t.spark.createDataFrame(TOY_CLASSES, "class string, parent string, tree_root boolean"), a, t.spark.createDataFrame(TOY_ENUMS, "enum string")


def _values(rows) -> str:
    lit = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'"
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


TOY_SQL = f"""a(class, attr, ord, range, multivalued, inlined, identifier, designator, required, subset, minimum) AS (VALUES {_values(TOY)}),
c(class, parent, tree_root) AS (VALUES {_values(TOY_CLASSES)}), e(enum) AS (VALUES {_values(TOY_ENUMS)}),
anc AS (SELECT class, class AS ancestor, 0 AS depth FROM c UNION ALL SELECT anc.class, c.parent, depth + 1 FROM anc JOIN c ON c.class = ancestor WHERE c.parent IS NOT NULL),
full_a AS (SELECT * FROM (SELECT anc.class AS cls, a.*, row_number() OVER (PARTITION BY anc.class, attr ORDER BY depth) AS k FROM anc JOIN a ON a.class = ancestor) WHERE k = 1)"""


@query(f"""WITH RECURSIVE {TOY_SQL} SELECT cls AS class, attr, CASE WHEN identifier THEN 'identifier' WHEN range LIKE 'Extracted%' THEN 'evidence' WHEN range IN (SELECT class FROM c) AND inlined THEN 'nested' WHEN range IN (SELECT class FROM c) THEN 'reference' ELSE 'native' END AS kind FROM full_a""")
def slot_classify(t: Tables) -> DataFrame:
    return C.classify_slots(*_toy(t)).select("class", "attr", "kind")


@query(f"""WITH RECURSIVE {TOY_SQL}, w AS (SELECT *, CASE WHEN identifier OR designator THEN 'string' WHEN range IN (SELECT enum FROM e) THEN 'Extracted' || range || CASE WHEN multivalued THEN 'List' ELSE '' END WHEN range IN ('string', 'integer') THEN CASE range WHEN 'string' THEN 'ExtractedString' ELSE 'ExtractedInteger' END || CASE WHEN multivalued THEN 'List' ELSE '' END ELSE range END AS r FROM a WHERE subset <> 'deterministic')
SELECT class, CASE WHEN identifier THEN 'local_id' ELSE attr END AS attr, r AS result, 'slot' AS kind FROM w UNION ALL SELECT class, attr, CAST(minimum AS VARCHAR), 'dropped minimum' FROM w WHERE minimum IS NOT NULL""")
def schema_projection(t: Tables) -> DataFrame:
    _, a, e = _toy(t)
    kept, lost = C.project(a, e)
    return kept.select("class", "attr", F.col("range").alias("result"), F.lit("slot").alias("kind")).union(lost.select("class", "attr", "value", F.concat(F.lit("dropped "), "dropped")))


@query(f"""WITH RECURSIVE {TOY_SQL}, ed AS (SELECT class AS s, range AS d FROM a WHERE (subset = 'mvp' OR identifier OR designator) AND range IN (SELECT class FROM c) UNION SELECT parent, class FROM c WHERE parent IS NOT NULL UNION SELECT class, parent FROM c WHERE parent IS NOT NULL),
w AS (SELECT class FROM c WHERE tree_root UNION SELECT d FROM w JOIN ed ON s = class)
SELECT class, CAST(NULL AS VARCHAR) AS attr, 'survives' AS finding FROM w UNION ALL SELECT class, attr, 'required lost' FROM a WHERE class IN (SELECT class FROM w) AND required AND NOT (subset = 'mvp' OR identifier OR designator) UNION ALL SELECT enum, NULL, 'unreferenced' FROM e WHERE enum NOT IN (SELECT range FROM a)""")
def subset_prune(t: Tables) -> DataFrame:
    c, a, e = _toy(t)
    alive, lost = C.prune(c, a, "mvp", C.tree_root(c))
    none = F.lit(None).cast("string").alias("attr")
    return alive.select("class", none, F.lit("survives").alias("finding")).union(lost.select("class", "attr", F.lit("required lost"))).union(C.unreferenced(e, a).select("enum", none, F.lit("unreferenced")))


@query(f"""WITH RECURSIVE {TOY_SQL}, r(id, declared, named) AS (VALUES (1, 'Group', 'Patients'), (2, 'Group', 'Arm'), (3, 'Group', 'Nothing'), (4, 'Arm', NULL))
SELECT id, declared, CASE WHEN named IS NULL OR EXISTS (SELECT 1 FROM anc WHERE anc.class = named AND ancestor = declared) THEN 'ok' WHEN named NOT IN (SELECT class FROM c) THEN 'unknown' ELSE 'not_a_subclass' END AS code,
CASE WHEN EXISTS (SELECT 1 FROM anc WHERE anc.class = named AND ancestor = declared) THEN named ELSE declared END AS class FROM r""")
def designator_lint(t: Tables) -> DataFrame:
    c, _, _ = _toy(t)
    r = t.spark.createDataFrame([(1, "Group", "Patients"), (2, "Group", "Arm"), (3, "Group", "Nothing"), (4, "Arm", None)], "id int, declared string, named string")
    r = C.designated_type(r, c).join(F.broadcast(c.select(F.col("class").alias("named"), F.lit(True).alias("known"))), "named", "left")
    ok = F.col("named").isNull() | (F.col("class") == F.col("named"))
    return r.select("id", "declared", F.when(ok, "ok").when(F.col("known").isNull(), "unknown").otherwise("not_a_subclass").alias("code"), "class")
