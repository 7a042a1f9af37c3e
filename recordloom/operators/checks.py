"""Checks: structure, references, and consistency of models, terms, cells and prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import fold_label, names_a_change, names_a_comparison, names_a_crossing, names_a_derivation
from .closure import closure, cycles


def undeclared_and_missing(keys: DataFrame, declared: DataFrame, required: DataFrame, owner: str) -> DataFrame:
    """(owner, key) against (key) -> owner, key, code: undeclared, or missing for an owner without a required key."""
    extra = keys.join(declared.select("key"), "key", "left_anti").select(owner, "key", F.lit("undeclared").alias("code"))
    wanted = required.agg(F.collect_set("key").alias("__wanted"))  # one row: a class's required keys
    have = keys.groupBy(owner).agg(F.collect_set("key").alias("__have")).join(wanted)
    return extra.union(have.select(owner, F.explode(F.array_except("__wanted", "__have")).alias("key"), F.lit("missing")))


def shape(kind: Column, multivalued: Column) -> Column:
    """ok, or how a node's type (of flatten) disagrees with list or single."""
    return F.when(multivalued & (kind != "ARRAY"), "list_expected").when(~multivalued & (kind == "ARRAY"), "single_expected").otherwise("ok")


def slot_shape(kind: Column, slot: Column, multivalued: Column, value: Column) -> Column:
    """ok, or how a node (its type, of flatten, and its text) doesn't fit its slot: list-ness first, then identifiers and references, which are texts."""
    single = slot.isin("evidence", "nested")
    return (
        F.when(multivalued & (kind != "ARRAY"), "list_expected").when(~multivalued & single & (kind == "ARRAY"), "single_expected")
        .when(~multivalued & (slot == "identifier") & ((kind != "STRING") | (F.coalesce(value, F.lit("")) == "")), "identifier_not_text")
        .when(~multivalued & (slot == "reference") & (kind != "STRING"), "reference_not_text").otherwise("ok")
    )


def scalar(kind: Column, declared: Column, value: Column, minimum: Column | None = None) -> Column:
    """ok, wrong_type or below_minimum; a truth value is no integer, an integer is a float."""
    integer = (kind == "BIGINT") | (F.startswith(kind, F.lit("DECIMAL")) & F.endswith(kind, F.lit(",0)")))
    number = integer | F.startswith(kind, F.lit("DECIMAL")) | (kind == "DOUBLE")
    fits = F.when(declared == "integer", integer).when(declared == "float", number).when(declared == "boolean", kind == "BOOLEAN").otherwise(kind == "STRING")
    out = F.when(~fits, "wrong_type")
    if minimum is not None:
        out = out.when(value.try_cast("double") < minimum, "below_minimum")
    return out.otherwise("ok")


def vocabulary(values: DataFrame, terms: DataFrame, closed: Column) -> DataFrame:
    """(value) -> adds code: ok, unstated, off_vocabulary with severity error (closed) or warning (open)."""
    known = terms.select(F.col("term").alias("value"), F.lit(True).alias("__known"))
    out = values.join(known, "value", "left")
    out = out.withColumn("code", F.when(F.col("value") == "unstated", "unstated").when(F.col("__known"), "ok").otherwise("off_vocabulary"))
    return out.withColumn("severity", F.when(F.col("code") == "unstated", "error").when(F.col("code") == "ok", "none").when(closed, "error").otherwise("warning")).drop("__known")


def off_vocabulary_tally(checked: DataFrame, field: str) -> DataFrame:
    return checked.where("code = 'off_vocabulary'").groupBy(field, "value").agg(F.count("*").alias("n"))


def wrapper_invariants(status: Column, value: Column, source: Column, evidence: Column, n_sets: Column) -> Column:
    """The first rule that a wrapped fact breaks, else ok."""
    return (
        F.when(status.isNull() | ~status.isin("extracted", "not_reported"), "bad_status")
        .when(source.isNotNull() & ~source.isin("reported", "generated"), "bad_source")
        .when(evidence.isNull(), "no_evidence")
        .when((status == "not_reported") & value.isNotNull(), "value_not_reported")
        .when((status == "extracted") & value.isNull(), "value_missing")
        .when((status == "not_reported") & (evidence != "not_applicable"), "evidence_not_applicable")
        .when((status == "extracted") & (evidence == "not_applicable"), "evidence_missing")
        .when((evidence == "present") & (n_sets < 1), "present_without_sets")
        .when((evidence != "present") & (n_sets > 0), "sets_without_present")
        .otherwise("ok")
    )


def terms_in_scope(model_inputs: DataFrame, models: DataFrame, terms: DataFrame, group: list[str]) -> DataFrame:
    """(group, model_id), (group, model_id, input_id), (group, model_id, term_id, ...) -> group, root, term_id, owner, depth and the term's columns.

    A model sees its own terms and, through its inputs, those of the stages before;
    of one term id the nearest stage's counts. Cycles end the walk.
    """
    edges = model_inputs.select(*group, F.col("model_id").alias("src"), F.col("input_id").alias("dst"))
    reach = closure(edges, models.select(*group, F.col("model_id").alias("node")), group)
    seen = reach.join(terms.withColumnRenamed("model_id", "node"), [*group, "node"])
    nearest = F.row_number().over(Window.partitionBy(*group, "root", "term_id").orderBy("depth", "node"))
    return seen.withColumn("__k", nearest).where("__k = 1").drop("__k").withColumnRenamed("node", "owner")


def stage_cycles(model_inputs: DataFrame, models: DataFrame, group: list[str]) -> DataFrame:
    edges = model_inputs.select(*group, F.col("model_id").alias("src"), F.col("input_id").alias("dst"))
    return cycles(edges, models.select(*group, F.col("model_id").alias("node")), group)


def same_name_on_chain(scope: DataFrame, group: list[str], name: str = "name") -> DataFrame:
    """group, root, key, owners: folded term names that two stages of a chain both have."""
    out = scope.withColumn("key", fold_label(name)).groupBy(*group, "root", "key").agg(F.countDistinct("owner").alias("owners"))
    return out.where("owners > 1")


def resolve_cells(cells: DataFrame, scope: DataFrame, terms: DataFrame, levels: DataFrame, group: list[str]) -> DataFrame:
    """Adds code to (group, model_id, term_id, level) cells: ok, elsewhere, nowhere, no_levels or undeclared_level."""
    in_scope = scope.select(*group, F.col("root").alias("model_id"), "term_id", F.lit(True).alias("__in")).distinct()
    anywhere = terms.select(*group, "term_id", F.lit(True).alias("__any")).distinct()
    has = levels.select(*group, "term_id", F.lit(True).alias("__has")).distinct()
    is_level = levels.select(*group, "term_id", "level", F.lit(True).alias("__is")).distinct()
    out = cells.join(in_scope, [*group, "model_id", "term_id"], "left").join(anywhere, [*group, "term_id"], "left").join(has, [*group, "term_id"], "left").join(is_level, [*group, "term_id", "level"], "left")
    code = (
        F.when(F.col("__in").isNull() & F.col("__any").isNotNull(), "elsewhere").when(F.col("__in").isNull(), "nowhere")
        .when(F.col("level").isNotNull() & F.col("__has").isNull(), "no_levels").when(F.col("level").isNotNull() & F.col("__is").isNull(), "undeclared_level").otherwise("ok")
    )
    return out.withColumn("code", code).drop("__in", "__any", "__has", "__is")


def table_purpose(tables: DataFrame, refs: DataFrame, key: str, marked: Column) -> DataFrame:
    """Tables marked as no analysis that analyses use (contradiction), and unmarked ones that none uses (silent)."""
    used = refs.select(key).distinct().withColumn("__used", F.lit(True))
    out = tables.withColumn("__marked", marked).join(used, key, "left")
    code = F.when(F.col("__marked") & F.col("__used"), "contradiction").when(~F.col("__marked") & F.col("__used").isNull(), "silent")
    return out.withColumn("code", code).where("code IS NOT NULL").withColumn("severity", F.when(F.col("code") == "contradiction", "error").otherwise("warning")).drop("__marked", "__used")


def references(edges: DataFrame, target: str, entities: DataFrame, key: str, code: str) -> DataFrame:
    """Edges whose target is no entity, with the code."""
    return edges.where(F.col(target).isNotNull()).join(entities.select(F.col(key).alias(target)).distinct(), target, "left_anti").withColumn("code", F.lit(code))


def crossings(cells: DataFrame, group: list[str]) -> DataFrame:
    """group, n_crossed, has_product, has_held: per analysis, from (group, term_id, level, direction, is_product)."""
    per = cells.groupBy(*group, "term_id").agg(
        F.bool_or(F.col("direction") == "positive").alias("p"), F.bool_or(F.col("direction") == "negative").alias("n"), F.bool_or("is_product").alias("x"), F.bool_or(F.col("direction") == "held").alias("h")
    )
    return per.groupBy(*group).agg(F.count_if(F.col("p") & F.col("n")).alias("n_crossed"), F.bool_or("x").alias("has_product"), F.bool_or("h").alias("has_held"))


def crossing_unrecorded(analyses: DataFrame, cells: DataFrame, group: list[str], *prose_columns: str) -> DataFrame:
    """Analyses whose prose names a crossing that the cells don't have."""
    c = analyses.join(crossings(cells, group), group, "left")
    return c.where(names_a_crossing(*prose_columns) & ~F.coalesce("has_product", F.lit(False)) & ~F.coalesce("has_held", F.lit(False)) & (F.coalesce("n_crossed", F.lit(0)) < 2))


def same_estimand(analyses: DataFrame, cells: DataFrame, study: str, analysis: str, model: str, crossing: Column) -> DataFrame:
    """study, model, signature, n: analyses of one model with equal cells whose prose disagrees on crossing."""
    sign = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col("term_id"), F.coalesce("level", F.lit("")), "direction"))), "|").alias("signature")
    s = cells.groupBy(analysis).agg(sign)
    a = analyses.withColumn("__x", crossing).join(s, analysis)
    return a.groupBy(study, model, "signature").agg(F.count("*").alias("n"), F.bool_or("__x").alias("a"), F.bool_and("__x").alias("b")).where("a AND NOT b").drop("a", "b")


def held_cells(cells: DataFrame, levels: DataFrame, group: list[str]) -> DataFrame:
    """group, term_id, code: held_without_level, or all_held where every declared level is held."""
    held = cells.where("direction = 'held'")
    bare = held.where("level IS NULL").select(*group, "term_id", F.lit("held_without_level").alias("code")).distinct()
    n_levels = levels.groupBy("term_id").agg(F.countDistinct("level").alias("__n"))
    every = held.groupBy(*group, "term_id").agg(F.countDistinct("level").alias("__h")).join(n_levels, "term_id").where("__h = __n")
    return bare.union(every.select(*group, "term_id", F.lit("all_held")))


def product_columns(components: DataFrame, scope: DataFrame, cells: DataFrame, group: list[str]) -> DataFrame:
    """(group, root, term_id, component_id) -> group, root, term_id, code: component_out_of_scope or never_celled."""
    seen = scope.select(*group, "root", F.col("term_id").alias("component_id")).distinct()
    out = components.join(seen, [*group, "root", "component_id"], "left_anti").select(*group, "root", "term_id", F.lit("component_out_of_scope").alias("code")).distinct()
    unused = components.select(*group, "root", "term_id").distinct().join(cells.select(*group, "term_id").distinct(), [*group, "term_id"], "left_anti")
    return out.union(unused.select(*group, "root", "term_id", F.lit("never_celled")))


def comparison_term(name: str, continuous: Column, excluded: Column) -> Column:
    """A continuous term that is named as a comparison."""
    return continuous & ~excluded & names_a_comparison(name)


def change_without_occasion(analyses: DataFrame, study: str, timepoints: DataFrame, referenced: DataFrame, *prose_columns: str) -> DataFrame:
    """Studies with two or more timepoints, none used, where analyses claim change: study, n, first (three ids)."""
    many = timepoints.groupBy(study).agg(F.count("*").alias("__n")).where("__n >= 2").join(referenced.select(study).distinct(), study, "left_anti")
    claims = analyses.where(names_a_change(*prose_columns)).join(many, study)
    from .records import digest

    return digest(claims, [study], ["analysis_id"], F.col("analysis_id").cast("string"), 3)


def arm_mentions(analyses: DataFrame, arms: DataFrame, reached: DataFrame, study: str, text: str, name: str) -> DataFrame:
    """Analyses that name an arm (a word of three or more letters) while no way leads to any arm."""
    a = arms.where(F.length(F.trim(name)) >= 3).select(study, F.lower(F.trim(name)).alias("__name")).distinct()
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    hit = analyses.join(a, study).where(F.contains(words, F.concat(F.lit(" "), F.regexp_replace("__name", r"[^\p{L}\p{N}]+", " "), F.lit(" "))))
    return hit.join(reached.select(study, "analysis_id").distinct(), [study, "analysis_id"], "left_anti").select(study, "analysis_id", F.col("__name").alias("arm"))


def derived_terms(terms: DataFrame, name: str, has_assessments: Column) -> DataFrame:
    """Terms named as derived: without a source definition, or without an assessment though the study has some."""
    t = terms.where(names_a_derivation(name))
    a = t.where("source_definition IS NULL").withColumn("code", F.lit("no_source_definition"))
    return a.union(t.where(F.col("assessment").isNull() & has_assessments).withColumn("code", F.lit("no_assessment")))


def unique_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Documented, unchecked elsewhere: keys that stand more than once (extension)."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").withColumn("extension", F.lit(True))


def exclusive(a: Column, b: Column) -> Column:
    """Both given, where only one may be (extension: coordinate space of table and analysis)."""
    return a.isNotNull() & b.isNotNull()


def healthy_with_condition(is_healthy: Column, condition: Column) -> Column:
    return F.coalesce(is_healthy, F.lit(False)) & condition.isNotNull()


def above_maximum(value: Column, maximum: Column) -> Column:
    return F.coalesce(value > maximum, F.lit(False))


def level_by_kind(kind: Column, level: Column) -> Column:
    """ok, level_required (categorical) or level_forbidden (continuous)."""
    return F.when((kind == "categorical") & level.isNull(), "level_required").when((kind == "continuous") & level.isNotNull(), "level_forbidden").otherwise("ok")
