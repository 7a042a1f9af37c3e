"""Records: payloads merged, repaired, linked and reported, over VARIANT and path rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import fold_label
from ..session import cut

#: The two legal statuses of a wrapped fact. (fixed values)
STATUSES = ("extracted", "not_reported")


def merge_last(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """keys, value of the last row, collisions (rows that were overwritten)."""
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value), (F.count("*") - 1).alias("collisions"))


def merge_payloads(payloads: DataFrame, entity_lists: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Payload files of a study (study_id, rank, file, payload VARIANT) merged: attributes, entities, findings.

    Attributes of the ``study`` object: the last file wins, and overwriting is
    reported. Entity lists are joined in file order; empty ones are ignored. Unknown
    keys are reported and dropped.
    """
    rows = payloads.where("payload IS NOT NULL").selectExpr("study_id", "rank", "file", "payload")
    spark = payloads.sparkSession
    top = spark.sql("SELECT p.study_id, p.rank, p.file, x.key, x.value FROM {p} p, LATERAL variant_explode(p.payload) x", p=rows)
    study = spark.sql("SELECT s.study_id, s.rank, s.file, x.key, x.value FROM {s} s, LATERAL variant_explode(s.value) x", s=top.where("key = 'study'"))
    text = study.withColumn("value", F.expr("to_json(value)"))
    merged = merge_last(text, ["study_id", "key"], "value", "rank")
    lists = top.where(F.col("key").isin(*entity_lists))
    items = spark.sql("SELECT l.study_id, l.rank, l.key, x.pos, x.value FROM {l} l, LATERAL variant_explode(l.value) x", l=lists)
    pos = F.row_number().over(Window.partitionBy("study_id", "key").orderBy("rank", "pos")) - 1
    entities = items.select("study_id", F.col("key").alias("list"), pos.alias("pos"), F.expr("to_json(value)").alias("entity"))
    known = [*entity_lists, "study", "cross_reference_notes"]
    unknown = top.where(~F.col("key").isin(*known)).select("study_id", F.col("key").alias("path"), F.lit("unknown_key").alias("code"))
    clash = merged.where("collisions > 0").select("study_id", F.concat(F.lit("study."), "key").alias("path"), F.lit("overwritten").alias("code"))
    return merged.select("study_id", "key", "value"), entities, unknown.union(clash)


def flatten(records: DataFrame) -> DataFrame:
    """(id, record VARIANT) -> id, path, kind, value: every node, ``a.b[0].c`` paths; kind is Spark's name of the type. One round a level, until none is left."""
    spark = records.sparkSession
    shape = "CASE WHEN schema_of_variant(value) LIKE 'OBJECT%' THEN 'OBJECT' WHEN schema_of_variant(value) LIKE 'ARRAY%' THEN 'ARRAY' ELSE schema_of_variant(value) END"
    level, out = records.selectExpr("id", "'' AS path", "record AS value").selectExpr("*", f"{shape} AS kind"), None
    while True:
        step = "SELECT n.id, CASE WHEN x.key IS NULL THEN concat(n.path, '[', x.pos, ']') WHEN n.path = '' THEN x.key ELSE concat(n.path, '.', x.key) END AS path, x.value FROM {n} n, LATERAL variant_explode(n.value) x"
        level = cut(spark.sql(step, n=level.where("kind IN ('OBJECT', 'ARRAY')")).selectExpr("*", f"{shape} AS kind").select("id", "path", "kind", "value"))
        if out is not None and level.isEmpty():
            return out
        out = level if out is None else out.union(level)


def wrappers(records: DataFrame) -> DataFrame:
    """id, path, status, value, source of every wrapped fact (an object with a status), not looking inside."""
    w = flatten(records).where("kind = 'OBJECT' AND is_variant_null(variant_get(value, '$.extraction_status')) IS NOT NULL").where("variant_get(value, '$.extraction_status') IS NOT NULL")
    return w.selectExpr("id", "path", "variant_get(value, '$.extraction_status', 'string') AS status", "variant_get(value, '$.value') AS value", "try_variant_get(value, '$.value_source', 'string') AS source")


def apply_aliases(edges: DataFrame, aliases: DataFrame, target: str = "target_id") -> DataFrame:
    """References renamed by (alias, target) pairs; adds rewritten."""
    a = aliases.select(F.col("alias").alias(target), F.col("target").alias("__to"))
    return edges.join(a, target, "left").withColumn("rewritten", F.col("__to").isNotNull()).withColumn(target, F.coalesce("__to", target)).drop("__to")


def repair_wrapper(status: Column, value: Column, source: Column) -> Column:
    """struct(status, value, source, repaired): an illegal status is a value in the wrong place."""
    bad = ~F.coalesce(status.isin(*STATUSES), F.lit(False))
    empty = F.coalesce(value, F.lit("")) == ""
    return F.struct(F.when(bad, "extracted").otherwise(status).alias("status"), F.when(bad & empty, status).otherwise(value).alias("value"), F.when(bad, F.coalesce(source, F.lit("reported"))).otherwise(source).alias("source"), bad.alias("repaired"))


def fill_from_lookup(rows: DataFrame, lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Empty values taken from (key, found); adds derived."""
    out = rows.join(lookup, key, "left").withColumn("derived", F.col(value).isNull() & F.col("found").isNotNull())
    return out.withColumn(value, F.coalesce(value, "found")).drop("found")


def fill_if_single(rows: DataFrame, links: DataFrame, key: str, value: str) -> DataFrame:
    """A missing value is the linked rows' value where they have exactly one; adds filled."""
    one = links.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi")).where("__lo = __hi").drop("__hi")
    out = rows.join(one, key, "left").withColumn("filled", F.col(value).isNull() & F.col("__lo").isNotNull())
    return out.withColumn(value, F.coalesce(value, "__lo")).drop("__lo")


def listify(json_text: Column) -> Column:
    """A single value in a place for a list becomes a list; null stays."""
    v = F.trim(json_text)
    return F.when(v.isNull() | (v == "null") | F.startswith(v, F.lit("[")), v).otherwise(F.concat(F.lit("["), v, F.lit("]")))


def align_levels(cells: DataFrame, levels: DataFrame, by: list[str]) -> DataFrame:
    """A cell's level that isn't declared becomes the only declared one that folds equal; adds aligned."""
    declared = levels.select(*by, F.col("level").alias("__l")).distinct()
    exact = cells.join(declared.withColumn("__is", F.lit(True)).withColumnRenamed("__l", "level"), [*by, "level"], "left")
    folded = declared.withColumn("__k", fold_label("__l")).groupBy(*by, "__k").agg(F.min("__l").alias("__l"), F.count("*").alias("__n")).where("__n = 1").drop("__n")
    out = exact.withColumn("__k", fold_label("level")).join(folded, [*by, "__k"], "left")
    moved = F.col("__is").isNull() & F.col("__l").isNotNull()
    return out.withColumn("aligned", moved).withColumn("level", F.when(moved, F.col("__l")).otherwise(F.col("level"))).drop("__is", "__l", "__k")


def duplicate_ids(ids: DataFrame, keys: list[str]) -> DataFrame:
    return ids.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def dangling(edges: DataFrame, target: str, entities: DataFrame, key: str) -> DataFrame:
    """References to nothing."""
    return edges.where(F.col(target).isNotNull()).join(entities.select(F.col(key).alias(target)).distinct(), target, "left_anti")


def merge_evidence(fields: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Evidence status of each field: not_applicable unless extracted, else present or not_found; a dropped value is null."""
    hit = found.select(*keys).distinct().withColumn("__hit", F.lit(True))
    out = fields.join(hit, keys, "left")
    status = F.when(F.col("status") != "extracted", "not_applicable").when(F.col("__hit"), "present").otherwise("not_found")
    return out.withColumn("evidence", status).withColumn("value", F.when(F.col("status") == "extracted", F.col("value"))).drop("__hit")


def walk_quotes(fields: DataFrame, quotes: DataFrame, keys: list[str]) -> DataFrame:
    """Fields (keys, status, evidence) with their quotes (keys, set_no, quote_no, start_char, end_char; nulls: not found) -> adds quotes, resolved, sets, downgraded.

    Failed quotes go, and sets without any. With a set left the evidence is present;
    else it is not_found for an extracted field (downgraded) and not_applicable for
    others. A field without any quote keeps its evidence, but an extracted one can't
    be not_applicable. ``sets`` is an array of arrays of spans, in order.
    """
    hit = F.col("start_char").isNotNull()
    one = quotes.groupBy(*keys, "set_no").agg(F.count("*").alias("n"), F.count_if(hit).alias("r"), F.array_sort(F.collect_list(F.when(hit, F.struct("quote_no", "start_char", "end_char")))).alias("q"))
    spans = F.transform("q", lambda x: F.struct(x["start_char"].alias("start_char"), x["end_char"].alias("end_char")))
    sets = F.array_sort(F.collect_list(F.when(F.col("r") > 0, F.struct("set_no", spans.alias("spans")))))
    by = one.groupBy(*keys).agg(F.sum("n").alias("quotes"), F.sum("r").alias("resolved"), sets.alias("sets"))
    out = fields.join(by.withColumn("sets", F.col("sets.spans")), keys, "left")
    tried, extracted = F.col("quotes").isNotNull(), F.col("status") == "extracted"
    evidence = (
        F.when(F.col("resolved") > 0, "present").when(tried & extracted, "not_found").when(tried, "not_applicable")
        .when(extracted & (F.col("evidence") == "not_applicable"), "not_found").otherwise(F.col("evidence"))
    )
    lost = F.coalesce(extracted & F.when(tried, F.col("resolved") == 0).otherwise(F.col("evidence") == "not_applicable"), F.lit(False))
    out = out.withColumn("downgraded", lost).withColumn("evidence", evidence)
    return out.withColumn("quotes", F.coalesce("quotes", F.lit(0).cast("long"))).withColumn("resolved", F.coalesce("resolved", F.lit(0).cast("long")))


def batches(rows: DataFrame, group: list[str], order: str, size: int = 50) -> DataFrame:
    """Adds batch: rows numbered in order, ``size`` to a batch."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1) / size))


#: Lists that a payload may wrongly keep under ``study``, and those whose nested form wins over the top one. (fixed values)
NESTED_WINS = ("arms", "timepoints")


def normalize_keys(rows: DataFrame, lists: list[str], allowed: list[str]) -> DataFrame:
    """(id, path) one level of keys -> adds new_path: lists come out of ``study``, strays go into it, keys beyond the pass's list go (null)."""
    key = F.regexp_replace("path", r"^study\.", "")
    inside = F.startswith("path", F.lit("study."))
    moved = F.when(inside & key.isin(*lists), key).when(~inside & ~key.isin(*lists) & (key != "study"), F.concat(F.lit("study."), key)).otherwise(F.col("path"))
    out = rows.withColumn("new_path", moved)
    return out.withColumn("new_path", F.when(F.regexp_replace("new_path", r"^study\.", "").isin(*allowed, "study"), F.col("new_path")))


def nested_wins(rows: DataFrame, part: str = "study.design", lists: tuple[str, ...] = NESTED_WINS) -> DataFrame:
    """(id, path) -> adds dropped: a top-level list goes where the same payload has it inside ``part`` too."""
    inside = rows.where(F.col("path").isin(*[f"{part}.{x}" for x in lists])).select("id", F.substring_index("path", ".", -1).alias("path"), F.lit(True).alias("__in")).distinct()
    return rows.join(inside, ["id", "path"], "left").withColumn("dropped", F.coalesce("__in", F.lit(False))).drop("__in")


def required_entities(analyses: DataFrame, declared: DataFrame, effect: str) -> tuple[DataFrame, DataFrame]:
    """(id, local_id, kind, label, effect) and (id, local_id, kind, label) -> analyses with an effect; declared entities with those that the others declare.

    An analysis without an effect is a declaration in the wrong list. A local_id that
    is declared already stays as it is; of several new ones the smallest row counts.
    """
    columns = ["id", "local_id", "kind", "label"]
    moved = analyses.where(F.col(effect).isNull()).select(*columns)
    new = moved.join(declared.select("id", "local_id"), ["id", "local_id"], "left_anti")
    new = new.groupBy("id", "local_id").agg(F.min(F.struct("kind", "label")).alias("x")).select("id", "local_id", "x.kind", "x.label")
    return analyses.where(F.col(effect).isNotNull()), declared.select(*columns).union(new.select(*columns))


def missing_after(declared: DataFrame, present: DataFrame, group: list[str], key: str, most: int = 8) -> DataFrame:
    """group, n, first: declared ids that aren't there; the first few in order, joined."""
    gone = declared.join(present.select(*group, key).distinct(), [*group, key], "left_anti").select(*group, key).distinct()
    return gone.groupBy(*group).agg(F.count("*").alias("n"), F.array_join(F.slice(F.array_sort(F.collect_set(F.col(key).cast("string"))), 1, most), ",").alias("first"))


def design_mismatch(studies: DataFrame, occasions: Column, categorical: Column) -> DataFrame:
    """Adds mismatch: two or more arms and timepoints, but no categorical term."""
    return studies.withColumn("mismatch", (occasions >= 2) & (categorical == 0))


def digest(rows: DataFrame, group: list[str], order: list[str], label: Column, most: int = 3) -> DataFrame:
    """group, n, head: the first labels in order, then ``and N more``."""
    k = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    r = rows.withColumn("__label", label).withColumn("__k", k)
    g = r.groupBy(*group).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("__k") <= most, F.struct("__k", "__label")))).alias("h"))
    more = F.when(F.col("n") > most, F.concat(F.lit(" and "), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise("")
    return g.select(*group, "n", F.concat(F.array_join(F.col("h.__label"), ", "), more).alias("head"))


def table_block(points: DataFrame) -> DataFrame:
    """(study_id, pos, table_id, space, kind) -> per table in first-seen order (tables first seen at one place: by table_id): index from 1, n, spaces and kinds (sorted, joined)."""
    t = points.groupBy("study_id", "table_id").agg(F.min("pos").alias("p"), F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("space")), ",").alias("spaces"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))
    return t.withColumn("index", F.row_number().over(Window.partitionBy("study_id").orderBy(F.asc_nulls_last("p"), F.asc_nulls_last("table_id")))).drop("p")


def first_points(points: DataFrame, group: list[str], order: list[str], label: Column, most: int = 40) -> DataFrame:
    """group, n, head, rest: the labels of the first points in order, one a line, and how many more there are."""
    k = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    g = points.withColumn("__label", label).withColumn("__k", k).groupBy(*group)
    g = g.agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("__k") <= most, F.struct("__k", "__label")))).alias("h"))
    return g.select(*group, "n", F.array_join("h.__label", "\n").alias("head"), F.greatest(F.col("n") - most, F.lit(0).cast("long")).alias("rest"))


def index_free(path) -> Column:
    return F.regexp_replace(path, r"\[\d+\]", "")


def partition_allowed(findings: DataFrame, allowed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Findings left and suppressed by (path, message) entries: a given path must match without indexes, a given message must be contained; an empty entry matches nothing.

    Entries with a path are an equi-join; only those of a message alone are compared
    with each finding, so their number should stay small.
    """
    entries = allowed.select(F.coalesce("path", F.lit("")).alias("__p"), F.coalesce("message", F.lit("")).alias("__m"))
    said = F.contains(F.coalesce("message", F.lit("")), F.col("__m"))
    placed = (index_free("path") == F.col("__q")) & said
    with_path = entries.where("__p != ''").withColumn("__q", index_free("__p")).drop("__p")
    alone = entries.where("__p = '' AND __m != ''").drop("__p")
    rest = findings.join(with_path, placed, "left_anti")
    gone = findings.join(with_path, placed, "left_semi").unionByName(rest.join(alone, said, "left_semi"))
    return rest.join(alone, said, "left_anti"), gone


def build_report(fields: DataFrame, by: list[str]) -> DataFrame:
    """Counts of statuses and evidence."""
    return fields.groupBy(*by).agg(
        F.count("*").alias("fields"), F.count_if(F.col("status") == "extracted").alias("extracted"), F.count_if(F.col("evidence") == "present").alias("present"),
        F.count_if(F.col("evidence") == "not_found").alias("not_found"), F.count_if(F.col("evidence") == "not_applicable").alias("not_applicable"),
    )


def gate(counts: DataFrame, part: str, whole: str, most: float = 0.10) -> DataFrame:
    """Adds failed: part / whole (at least 1) beyond the threshold."""
    return counts.withColumn("failed", F.col(part) / F.greatest(F.col(whole), F.lit(1)) > most)


def verdicts(rows: DataFrame, key: str, stage: str, status: str, stages: list[str]) -> DataFrame:
    """key by stage; a stage that never ran is ``-``."""
    return rows.groupBy(key).pivot(stage, stages).agg(F.max(status)).na.fill("-", stages)


def diff_report(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """Both sides by position within a key: pos, left, right, same."""
    w = Window.partitionBy(key).orderBy("pos")
    l = a.select(key, F.row_number().over(w).alias("pos"), F.col(name).alias("left"))
    r = b.select(key, F.row_number().over(w).alias("pos"), F.col(name).alias("right"))
    return l.join(r, [key, "pos"], "full_outer").withColumn("same", F.col("left").eqNullSafe(F.col("right")))


def diff_summary(a: DataFrame, b: DataFrame, key: str, name: str, points: str) -> DataFrame:
    """Both sides of a key in figures: n_left, n_right, points_left, points_right, only_left, only_right (names, sorted and joined; empty if none)."""
    both = a.select(key, name, points, F.lit(0).alias("__s")).union(b.select(key, name, points, F.lit(1)))
    per = both.groupBy(key, name).agg(*[F.count_if(F.col("__s") == k).alias(f"n{k}") for k in (0, 1)], *[F.sum(F.when(F.col("__s") == k, F.col(points))).alias(f"p{k}") for k in (0, 1)])
    only = lambda k: F.array_join(F.array_sort(F.collect_list(F.when(F.col(f"n{1 - k}") == 0, F.col(name)))), ", ")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per.groupBy(key).agg(total("n0").alias("n_left"), total("n1").alias("n_right"), total("p0").alias("points_left"), total("p1").alias("points_right"), only(0).alias("only_left"), only(1).alias("only_right"))
