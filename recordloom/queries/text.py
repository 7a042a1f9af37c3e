"""Text, span and section queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..operators import sections, spans
from ._register import Family, Tables

FAMILY = Family()
query = FAMILY.query

EXACT = """SELECT doc_id, item_id, CAST(strpos(d.text, b.text) - 1 AS BIGINT) AS start_char, CAST(strpos(d.text, b.text) - 1 + length(b.text) AS BIGINT) AS end_char
FROM documents d, benchmark b WHERE strpos(d.text, b.text) > 0"""


def _items(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", F.col("text").alias("quote"))


def _pairs(t: Tables) -> DataFrame:
    """Documents with the items they hold: doc_id, text, item_id, quote."""
    hits = spans.find_exact(t.documents.select("doc_id", "text"), _items(t))
    return hits.join(t.documents.select("doc_id", "text", "lang"), "doc_id").join(_items(t), "item_id")


@query(EXACT)
def span_exact(t: Tables) -> DataFrame:
    return spans.find_exact(t.documents.select("doc_id", "text"), _items(t))


@query("""SELECT doc_id, length(n) AS n_chars_norm, sha256(n) AS sha, n = replace(replace(n, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS stable
FROM (SELECT doc_id, replace(replace(text || chr(13) || chr(10) || 'x' || chr(13), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS n FROM documents)""")
def text_normalize_hash(t: Tables) -> DataFrame:
    d = t.documents.withColumn("n", T.normalize(F.concat("text", F.lit("\r\nx\r"))))
    return d.select("doc_id", F.length("n").cast("long").alias("n_chars_norm"), T.text_hash("n").alias("sha"), (F.col("n") == T.normalize("n")).alias("stable"))


@query("""SELECT doc_id, length(raw) AS before, length(raw) AS after, replace(replace(replace(raw, chr(8217), ''''), chr(8212), '-'), chr(160), ' ') <> raw AS changed
FROM (SELECT doc_id, replace(replace(text, 'e ', 'e' || chr(160)), 'a ', chr(8217) || chr(8212)) AS raw FROM documents)""")
def fold_length_invariant(t: Tables) -> DataFrame:
    d = t.documents.withColumn("raw", F.replace(F.replace("text", F.lit("e "), F.lit("e ")), F.lit("a "), F.lit("’—")))
    d = d.withColumn("f", T.fold("raw"))
    return d.select("doc_id", F.length("raw").cast("long").alias("before"), F.length("f").cast("long").alias("after"), (F.col("f") != F.col("raw")).alias("changed"))


@query("""WITH p AS (SELECT lower(trim(regexp_replace(p_type, '\\s+', ' ', 'g'))) AS k, count(*) AS parts FROM part GROUP BY 1),
c AS (SELECT DISTINCT lower(trim(regexp_replace('  ' || p_type || ' ', '\\s+', ' ', 'g'))) AS k, p_brand FROM part), u AS (SELECT k, min(p_brand) AS brand, count(*) AS n FROM c GROUP BY k)
SELECT p.k AS label, parts, n AS brands, CASE WHEN n = 1 THEN brand END AS only_brand FROM p JOIN u ON p.k = u.k""")
def fold_label_join(t: Tables) -> DataFrame:
    p = t.part.groupBy(T.fold_label("p_type").alias("label")).agg(F.count("*").alias("parts"))
    c = t.part.select(T.fold_label(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("label"), "p_brand").distinct()
    u = c.groupBy("label").agg(F.count("*").alias("brands"), F.min("p_brand").alias("b"))
    return p.join(u, "label").select("label", "parts", "brands", F.when(F.col("brands") == 1, F.col("b")).alias("only_brand"))


MARKDOWN = """md AS (SELECT conv_id, string_agg(CASE role WHEN 'system' THEN '#' WHEN 'user' THEN '##' ELSE '###' END || ' T' || turn || chr(10) || replace(text, '#', ''), chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id),
ln AS (SELECT conv_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos, length(text) AS n FROM md),
lp AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ln),
h AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS ordinal, length(regexp_extract(line, '^(#+) ', 1)) - 1 AS level, regexp_extract(line, '^#+ +(.*)$', 1) AS title, CAST(s AS BIGINT) AS start_char, n FROM lp WHERE regexp_matches(line, '^#+ ')),
sec AS (SELECT a.conv_id AS doc_id, a.ordinal, a.title, a.level, a.start_char, coalesce((SELECT min(b.start_char) FROM h b WHERE b.conv_id = a.conv_id AND b.ordinal > a.ordinal AND b.level <= a.level), a.n) AS end_char,
  (SELECT max_by(b.title, b.ordinal) FROM h b WHERE b.conv_id = a.conv_id AND b.ordinal < a.ordinal AND b.level < a.level) AS parent_section FROM h a)"""


def _markdown(t: Tables) -> DataFrame:
    mark = F.when(F.col("role") == "system", "#").when(F.col("role") == "user", "##").otherwise("###")
    part = F.concat(mark, F.lit(" T"), F.col("turn").cast("string"), F.lit("\n"), F.replace("text", F.lit("#"), F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct("turn", part.alias("p"))))
    return t.conversations.groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(parts["p"], "\n").alias("text"))


@query(f"WITH {MARKDOWN} SELECT doc_id, ordinal, title, CAST(level AS BIGINT) AS level, start_char, CAST(end_char AS BIGINT) AS end_char, parent_section FROM sec")
def section_index(t: Tables) -> DataFrame:
    return sections.build_sections(_markdown(t))


@query(f"""WITH {MARKDOWN}, o AS (SELECT doc_id, end_char - 1 AS off FROM sec), c AS (SELECT o.doc_id, o.off, s.level, s.ordinal, s.title, max(s.level) OVER (PARTITION BY o.doc_id, o.off) AS deep FROM (SELECT DISTINCT * FROM o) o JOIN sec s ON s.doc_id = o.doc_id AND s.start_char <= o.off AND o.off < s.end_char)
SELECT doc_id, CAST(off AS BIGINT) AS "offset", string_agg(title, ' > ' ORDER BY level, ordinal) AS path FROM c WHERE level < deep OR ordinal = (SELECT min(d.ordinal) FROM c d WHERE d.doc_id = c.doc_id AND d.off = c.off AND d.level = c.deep) GROUP BY doc_id, off""")
def section_path(t: Tables) -> DataFrame:
    s = sections.build_sections(_markdown(t))
    return sections.section_path(s, s.select("doc_id", (F.col("end_char") - 1).alias("offset")).distinct())


@query("""WITH p AS (SELECT doc_id, length(text) // 2 AS mid, unnest(string_split(text, ' the')) AS part, unnest(range(len(string_split(text, ' the')))) AS k, len(string_split(text, ' the')) AS m FROM documents),
o AS (SELECT doc_id, mid, k, m, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY k) + 4 * k AS s FROM p)
SELECT doc_id, CAST(arg_min(s, (abs(s - mid), s)) AS BIGINT) AS start_char FROM o WHERE k < m - 1 GROUP BY doc_id""")
def span_nearest(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "text", F.lit(" the").alias("quote"), F.floor(F.length("text") / 2).alias("mid"))
    return spans.resolve(d, near="mid").where("exact").select("doc_id", "start_char")


@query("""SELECT doc_id, item_id, CAST(strpos(d.text, b.text) - 1 AS BIGINT) AS start_char, CAST(strpos(d.text, b.text) - 1 + length(b.text) AS BIGINT) AS end_char, strpos(b.text, ' ') = 0 AS "exact"
FROM documents d, benchmark b WHERE strpos(d.text, b.text) > 0""")
def span_tolerant(t: Tables) -> DataFrame:
    quotes = t.benchmark.select("item_id", F.replace("text", F.lit(" "), F.lit("  ")).alias("quote"))
    return spans.find_tolerant(t.documents.select("doc_id", "text"), quotes)


@query(f"""WITH e AS ({EXACT}), v AS (SELECT e.doc_id, e.item_id, start_char + (item_id % 3) * CASE WHEN item_id % 3 = 2 THEN 1000000 ELSE 1 END AS s, end_char + (item_id % 3) AS e, d.text, b.text AS span FROM e JOIN documents d USING (doc_id) JOIN benchmark b USING (item_id))
SELECT doc_id, item_id, CASE WHEN s < 0 OR s >= e OR e > length(text) THEN 'out_of_range' WHEN substr(text, CAST(s AS BIGINT) + 1, CAST(e - s AS BIGINT)) <> span THEN 'text_differs' ELSE 'ok' END AS status FROM v""")
def span_verify(t: Tables) -> DataFrame:
    p = _pairs(t)
    shift = F.col("item_id") % 3
    p = p.withColumn("s", F.col("start_char") + shift * F.when(shift == 2, 1000000).otherwise(1)).withColumn("e", F.col("end_char") + shift)
    return p.select("doc_id", "item_id", spans.verify("text", "s", "e", "quote").alias("status"))


@query(f"""WITH e AS ({EXACT}) SELECT lang, count(*) FILTER (item_id % 3 = 0) AS exact_n, count(*) FILTER (item_id % 3 = 1 AND strpos(b.text, ' ') > 0) AS tolerant_n, count(*) FILTER (NOT (item_id % 3 = 0 OR (item_id % 3 = 1 AND strpos(b.text, ' ') > 0))) AS unresolved_n
FROM e JOIN documents d USING (doc_id) JOIN benchmark b USING (item_id) GROUP BY lang""")
def resolve_report(t: Tables) -> DataFrame:
    p = _pairs(t).drop("start_char", "end_char")
    k = F.col("item_id") % 3
    p = p.withColumn("quote", F.when(k == 0, F.col("quote")).when(k == 1, F.when(F.contains("quote", F.lit(" ")), F.replace("quote", F.lit(" "), F.lit("  "))).otherwise("~")).otherwise(F.concat("quote", F.lit("☃"))))
    r = spans.resolve(p)
    return r.groupBy("lang").agg(F.count_if("exact").alias("exact_n"), F.count_if(~F.col("exact")).alias("tolerant_n"), F.count_if(F.col("exact").isNull()).alias("unresolved_n"))


@query("""WITH n AS (SELECT r_regionkey, r_name, list(n_name ORDER BY n_nationkey) AS l FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2)
SELECT CAST(r_regionkey AS BIGINT) AS region_id, r_name || ': ' || l[2] || ' and  end ' || l[1] || chr(10) || chr(10) || '## Tables' || chr(10) || chr(10) || array_to_string(l[3:], chr(10) || chr(10)) AS filled, CAST(len(l) - 2 AS BIGINT) AS floated FROM n""")
def placeholder_insert(t: Tables) -> DataFrame:
    n = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("l"))
    r = t.region.join(n, F.col("n_regionkey") == F.col("r_regionkey")).withColumn("l", F.col("l.n_name"))
    r = r.withColumn("text", F.concat("r_name", F.lit(": [placeholder-2] and [placeholder-99] end [placeholder-1]")))
    return r.select(F.col("r_regionkey").cast("long").alias("region_id"), spans.place_tables("text", "l").alias("filled"), (F.size("l") - 2).cast("long").alias("floated"))


#: The words that the counterpart looks for, written out once more. (fixed values)
SAID = {
    "crossing": ("interaction", "moderat", "×"),
    "comparison": ("versus", " vs ", " vs. ", "greater than", "less than", "difference between", "change in", "change from", "pre-post", "pre/post", "prepost"),
    "change": ("change", "longitudinal", "over time", "follow-up", "followup", "pre > post", "post > pre", "pre-post", "following treatment", "after treatment"),
    "derivation": ("change in", "change from", "change over", "percent change", "percentage change", "percent reduction", "difference between", "difference in", "improvement in", "delta "),
}


def _says(kind: str) -> str:
    return " OR ".join(f"contains(x, '{w}')" for w in SAID[kind])


@query(rf"""SELECT p_partkey, {_says("crossing")} OR regexp_extract(x, '([a-z]+)-by-([a-z]+)', 1) <> regexp_extract(x, '([a-z]+)-by-([a-z]+)', 2) AS crossing, {_says("comparison")} OR regexp_matches(x, '[a-z0-9)\]]\s*[<>]\s*[a-z0-9(\[]') AS comparison,
{_says("change")} AS change, {_says("derivation")} AS derivation
FROM (SELECT p_partkey, lower(p_name || CASE p_partkey % 5 WHEN 0 THEN ' group-by-stage' WHEN 1 THEN ' voxel-by-voxel' WHEN 2 THEN ' a vs b' WHEN 3 THEN ' change in x' ELSE ' x > y over time' END) AS x FROM part)""")
def prose_predicates(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 5
    said = F.when(k == 0, " group-by-stage").when(k == 1, " voxel-by-voxel").when(k == 2, " a vs b").when(k == 3, " change in x").otherwise(" x > y over time")
    p = t.part.withColumn("x", F.concat("p_name", said))
    return p.select("p_partkey", T.names_a_crossing("x").alias("crossing"), T.names_a_comparison("x").alias("comparison"), T.names_a_change("x").alias("change"), T.names_a_derivation("x").alias("derivation"))


@query("""SELECT doc_id, substr(trim(regexp_replace(text, '[ \\n\\t]+', ' ', 'g')), 1, 110) AS short, length(trim(regexp_replace(text, '[ \\n\\t]+', ' ', 'g'))) AS squeezed, trim(regexp_replace(text, '[ \\n\\t]+', ' ', 'g')) AS unfenced FROM documents""")
def squeeze_truncate(t: Tables) -> DataFrame:
    d = t.documents
    fenced = T.strip_fence(F.concat(F.lit("```json\n"), T.squeeze("text"), F.lit("\n```")))
    return d.select("doc_id", T.truncate("text", 110).alias("short"), F.length(T.squeeze("text")).cast("long").alias("squeezed"), fenced.alias("unfenced"))


@query("""WITH d AS (SELECT text, min(doc_id) AS first_id FROM documents GROUP BY text) SELECT e.doc_id, first_id, length(e.text) > 0 AS equal, length(e.text) AS difference_at FROM documents e JOIN d ON e.text = d.text WHERE doc_id > first_id""")
def text_equivalence(t: Tables) -> DataFrame:
    """Copies against their first: equal, and where they would part if one letter followed."""
    first = t.documents.groupBy(T.text_hash("text").alias("h")).agg(F.min("doc_id").alias("first_id"))
    d = t.documents.withColumn("h", T.text_hash("text")).join(first, "h").where("doc_id > first_id")
    d = d.join(t.documents.select(F.col("doc_id").alias("first_id"), F.col("text").alias("other")), "first_id").withColumn("longer", F.concat("other", F.lit("!")))
    return d.select("doc_id", "first_id", spans.first_difference("text", "other").isNull().alias("equal"), spans.first_difference("text", "longer").alias("difference_at"))


@query("""SELECT doc_id, sha256(text) = sha256(CASE WHEN doc_id % 7 = 0 THEN text || ' ' ELSE text END) AS matches, CASE WHEN doc_id % 7 = 0 THEN 'hash_mismatch' ELSE 'ok' END AS code FROM documents""")
def hash_match(t: Tables) -> DataFrame:
    d = t.documents.withColumn("declared", T.text_hash(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))))
    d = d.withColumn("matches", T.text_hash("text") == F.col("declared"))
    return d.select("doc_id", "matches", F.when(F.col("matches"), "ok").otherwise("hash_mismatch").alias("code"))


@query(f"""WITH e AS ({EXACT}) SELECT doc_id, count(*) AS quotes, count(*) FILTER (item_id % 2 = 0) AS resolved, CASE WHEN count(*) FILTER (item_id % 2 = 0) > 0 THEN 'present' ELSE 'not_found' END AS status,
string_agg(CASE WHEN item_id % 2 = 0 THEN start_char || '-' || end_char END, ',' ORDER BY item_id) AS spans FROM e GROUP BY doc_id""")
def quote_walk(t: Tables) -> DataFrame:
    """Quotes of a document resolved and gathered again in order; without any left the evidence is not found."""
    p = _pairs(t).drop("start_char", "end_char").withColumn("quote", F.when(F.col("item_id") % 2 == 0, F.col("quote")).otherwise(F.concat("quote", F.lit("☃"))))
    r = spans.resolve(p)
    found = F.array_sort(F.collect_list(F.when(F.col("start_char").isNotNull(), F.struct("item_id", F.concat_ws("-", "start_char", "end_char").alias("s")))))
    r = r.groupBy("doc_id").agg(F.count("*").alias("quotes"), F.count("start_char").alias("resolved"), found.alias("f"))
    return r.select("doc_id", "quotes", "resolved", F.when(F.col("resolved") > 0, "present").otherwise("not_found").alias("status"), F.nullif(F.array_join("f.s", ","), F.lit("")).alias("spans"))
