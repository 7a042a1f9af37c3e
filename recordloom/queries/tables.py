"""Grid queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as T
from ..operators import tables as G
from ..sources import readers
from ._register import Family, Tables

FAMILY = Family()
query = FAMILY.query


@query("""WITH n AS (SELECT conv_id, turn, role, CASE WHEN role = lag(role) OVER w THEN 0 ELSE 1 END AS f FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT conv_id, role, sum(f) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM n) SELECT conv_id, CAST(run AS BIGINT) AS run, min(role) AS text, count(*) AS span FROM r GROUP BY conv_id, run""")
def header_rle(t: Tables) -> DataFrame:
    return G.runs(t.conversations, ["conv_id"], "turn", "role")


def _grid(t: Tables) -> DataFrame:
    """A table for each region: a header, then for each nation a data, a section or an empty row."""
    n = t.nation.withColumn("kind", F.col("n_nationkey") % 4)
    cells = F.when(F.col("kind") == 0, F.array("n_name", F.col("n_nationkey").cast("string"), F.lit("Unnamed: 3"))).when(F.col("kind") == 1, F.array("n_name")).when(F.col("kind") == 2, F.array("n_name", "n_name")).otherwise(F.array(F.lit(" ")))
    body = n.select(F.col("n_regionkey").alias("table_id"), (F.col("n_nationkey") + 1).alias("row"), cells.alias("cells"))
    head = t.region.select(F.col("r_regionkey").alias("table_id"), F.lit(0).alias("row"), F.array(F.lit("Name"), F.lit("Key")).alias("cells"))
    return head.union(body).withColumn("n_header", F.lit(1))


@query("""SELECT n_regionkey AS table_id, n_nationkey + 1 AS "row", CASE WHEN n_nationkey % 4 = 0 THEN 'data' WHEN n_nationkey % 4 = 2 OR NOT regexp_matches(n_name, '[0-9]') THEN 'section' ELSE 'data' END AS row_type, CASE WHEN n_nationkey % 4 = 2 OR (n_nationkey % 4 = 1 AND NOT regexp_matches(n_name, '[0-9]')) THEN n_name END AS section_text,
n_name || '|' || CASE n_nationkey % 4 WHEN 0 THEN CAST(n_nationkey AS VARCHAR) WHEN 2 THEN n_name ELSE '' END || '|' AS padded FROM nation WHERE n_nationkey % 4 <> 3 AND n_regionkey IN (SELECT n_regionkey FROM nation WHERE n_nationkey % 4 = 0)
UNION ALL SELECT n_regionkey, n_nationkey + 1, CASE WHEN n_nationkey % 4 = 2 OR NOT regexp_matches(n_name, '[0-9]') THEN 'section' ELSE 'data' END, CASE WHEN n_nationkey % 4 = 2 OR NOT regexp_matches(n_name, '[0-9]') THEN n_name END, n_name || '|' || CASE n_nationkey % 4 WHEN 2 THEN n_name ELSE '' END FROM nation WHERE n_nationkey % 4 <> 3 AND n_regionkey NOT IN (SELECT n_regionkey FROM nation WHERE n_nationkey % 4 = 0)
UNION ALL SELECT r_regionkey, 0, 'header', NULL, 'Name|Key' || CASE WHEN r_regionkey IN (SELECT n_regionkey FROM nation WHERE n_nationkey % 4 = 0) THEN '|' ELSE '' END FROM region""")
def row_classify(t: Tables) -> DataFrame:
    r = G.classify_rows(_grid(t))
    return r.select("table_id", "row", "row_type", "section_text", F.array_join("cells", "|").alias("padded"))


@query("""SELECT p_partkey, CAST(p_partkey % 90 AS DOUBLE) * CASE WHEN p_partkey % 2 = 0 THEN -1 ELSE 1 END AS x, CAST(p_size AS DOUBLE) AS y, CAST(-(p_partkey % 7) AS DOUBLE) AS z FROM part""")
def number_normalize_triple(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    sign = F.when(k % 2 == 0, "− ").otherwise("")
    cell = F.concat(F.lit("("), sign, (k % 90).cast("string"), F.when(k % 3 == 0, ", ").otherwise(" "), F.col("p_size").cast("string"), F.when(k % 3 == 0, " ; ").otherwise("  "), F.lit("–"), (k % 7).cast("string"), F.lit(")"))
    p = t.part.select("p_partkey", T.triple(cell).alias("t"))
    return p.select("p_partkey", F.get("t", F.lit(0)).alias("x"), F.get("t", F.lit(1)).alias("y"), F.get("t", F.lit(2)).alias("z"))


@query("""SELECT p_brand, count(*) AS n, count(*) FILTER (p_size % 2 = 0) AS n_ok, 2 * count(*) FILTER (p_size % 2 = 0) >= count(*) AS confirmed FROM part GROUP BY p_brand""")
def axis_majority(t: Tables) -> DataFrame:
    p = t.part.withColumn("cell", F.when(F.col("p_size") % 2 == 0, F.concat_ws(", ", F.lit("1"), F.lit("-2"), "p_size")).otherwise(F.col("p_name")))
    return G.majority(p, "p_brand", T.triple("cell").isNotNull())


@query("""WITH w AS (SELECT r_regionkey, r_name, n_nationkey, n_name, greatest(max(length(n_name)) OVER (PARTITION BY r_regionkey), 4) AS a, greatest(max(length(CAST(n_nationkey AS VARCHAR))) OVER (PARTITION BY r_regionkey), 3) AS b FROM region JOIN nation ON n_regionkey = r_regionkey)
SELECT r_regionkey AS table_id, min(r_name) || chr(10) || chr(10) || '| ' || rpad('Name', CAST(min(a) AS INT), ' ') || ' | ' || rpad('Key', CAST(min(b) AS INT), ' ') || ' |' || chr(10) || '|' || repeat('-', CAST(min(a) + 2 AS INT)) || '|' || repeat('-', CAST(min(b) + 2 AS INT)) || '|' || chr(10) || string_agg('| ' || rpad(n_name, CAST(a AS INT), ' ') || ' | ' || rpad(CAST(n_nationkey AS VARCHAR), CAST(b AS INT), ' ') || ' |', chr(10) ORDER BY n_nationkey) AS text FROM w GROUP BY r_regionkey""")
def markdown_pad(t: Tables) -> DataFrame:
    body = t.nation.select(F.col("n_regionkey").alias("table_id"), (F.col("n_nationkey") + 1).alias("row"), F.array("n_name", F.col("n_nationkey").cast("string")).alias("cells"))
    head = t.region.select(F.col("r_regionkey").alias("table_id"), F.lit(0).alias("row"), F.array(F.lit("Name"), F.lit("Key")).alias("cells"))
    rows = G.classify_rows(head.union(body).withColumn("n_header", F.lit(1)))
    return G.markdown(rows, t.region.select(F.col("r_regionkey").alias("table_id"), F.col("r_name").alias("label"), F.lit("").alias("caption"), F.lit("").alias("footer")))


@query("""SELECT o_orderkey, 'tbl' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS local_id, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderpriority END AS label FROM orders""")
def manifest_ids(t: Tables) -> DataFrame:
    line = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    m = t.orders.select("o_orderkey", line.alias("line"), F.col("o_orderkey").cast("string").alias("table_id"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("label"))
    return G.manifest_ids(m).select("o_orderkey", "local_id", "label")


#: table, header rows, data row, expected columns. (fixed values: shapes of coordinate headers)
SHAPES = [
    ("plain", [["Region", "x", "y", "z", "Z"]], ["a", "1", "-2", "3", "4.5"], "1,2,3"), ("stat first", [["Region", "Z", "x", "y", "z"]], ["a", "4.5", "1", "2", "3"], "2,3,4"),
    ("paren", [["Region", "Tal(x)", "Tal(y)", "Tal(z)"]], ["a", "1", "2", "3"], "1,2,3"), ("dedup", [["Region", "MNI (x,y,z)", "MNI (x,y,z).1", "MNI (x,y,z).2"]], ["a", "1", "2", "3"], "1,2,3"),
    ("two rows", [["Region", "Peak Coordinate", "Peak Coordinate", "Peak Coordinate", "Z"], ["", "x", "y", "z", ""]], ["a", "1", "2", "3", "4"], "1,2,3"),
    ("misplaced", [["Region", "Voxels", "Hem", "Peak coordinates", "Peak coordinates", "Peak coordinates"], ["X", "Y", "Z", "", "", ""]], ["a", "b", "c", "1", "2", "3"], "3,4,5"),
    ("one column", [["Region", "MNI (x, y, z)"]], ["a", "- 52,- 42,56"], "cell 1"), ("unsupported", [["x", "y", "z"]], ["a", "b", "c"], "none"),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{e}')" for n, _, _, e in SHAPES) + ") v(table_id, axes)")
def axis_columns(t: Tables) -> DataFrame:
    rows = [(n, i, cells, len(h)) for n, h, d, _ in SHAPES for i, cells in enumerate([*h, d])]
    r = G.classify_rows(t.spark.createDataFrame(rows, "table_id string, row int, cells array<string>, n_header int"))
    names = r.select("table_id").distinct()
    out = names.join(G.axis_columns(r), "table_id", "left").join(G.axis_cell(r), "table_id", "left")
    axes = F.when(F.col("x").isNotNull(), F.concat_ws(",", "x", "y", "z")).when(F.col("col").isNotNull(), F.concat(F.lit("cell "), "col")).otherwise("none")
    return out.select("table_id", axes.alias("axes"))


@query("""SELECT a.page_id, regexp_extract(regexp_replace(a.url, '[?#].*$', ''), '([^/]+)/?$', 1) AS basename, (SELECT min(b.page_id) FROM pages b WHERE regexp_extract(regexp_replace(b.url, '[?#].*$', ''), '([^/]+)/?$', 1) = regexp_extract(regexp_replace(a.url, '[?#].*$', ''), '([^/]+)/?$', 1)) AS first_page FROM pages a""")
def basename_join(t: Tables) -> DataFrame:
    base = readers.basename(F.regexp_replace("url", r"[?#].*$", ""))
    p = t.pages.select("page_id", base.alias("basename"))
    return p.join(p.groupBy("basename").agg(F.min("page_id").alias("first_page")), "basename")


@query("""SELECT p_brand AS table_id, count(*) FILTER (p_size > 45) AS coordinate_count FROM part GROUP BY p_brand""")
def coordinate_count(t: Tables) -> DataFrame:
    tables = t.part.select(F.col("p_brand").alias("table_id")).distinct()
    points = t.part.where("p_size > 45").groupBy(F.col("p_brand").alias("table_id")).agg(F.count("*").alias("n"))
    return tables.join(points, "table_id", "left").select("table_id", F.coalesce("n", F.lit(0)).alias("coordinate_count"))
