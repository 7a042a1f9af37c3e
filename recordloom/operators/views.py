"""Derived views: what was compared, how, adjusted for what, and where it is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def effect_kind(cells: DataFrame, group: list[str]) -> DataFrame:
    """(group, term_id, level, direction, term_type, variation, is_product, in_scope) -> group, kind (or null).

    The first that holds: a signed product cell is an interaction, an undirected one
    an omnibus test, one of unknown direction an interaction; a continuous term is
    a modulation (within subjects) or a regression (between, mixed); two crossed terms are an
    interaction, one a contrast; any sign a simple effect; undirected alone an
    omnibus test; terms compared at unknown direction as crossed ones.
    """
    d = F.col("direction")
    signed, undirected, unknown = d.isin("positive", "negative"), d == "undirected", F.coalesce(d == "not_reported", F.lit(True))
    per = cells.groupBy(*group, "term_id").agg(
        F.count("*").alias("n"), F.coalesce(F.bool_and("in_scope"), F.lit(False)).alias("scoped"), F.coalesce(F.bool_or("is_product"), F.lit(False)).alias("product"),
        F.first("term_type", True).alias("type"), F.first("variation", True).alias("variation"),
        F.bool_or(signed).alias("signed"), F.bool_and(undirected).alias("flat"), F.bool_or(unknown).alias("unknown"),
        F.bool_or(d == "positive").alias("p"), F.bool_or(d == "negative").alias("m"), F.countDistinct("level").alias("levels"),
    )
    slope = (F.col("type") == "continuous") & ~F.col("product")
    agg = per.groupBy(*group).agg(
        F.bool_and("scoped").alias("scoped"), F.bool_or(F.col("product") & F.col("signed")).alias("p_signed"), F.bool_or(F.col("product") & F.col("unknown")).alias("p_unknown"), F.bool_or("product").alias("product"),
        F.bool_or(slope).alias("slope"), F.min(F.when(slope, F.coalesce("variation", F.lit("~")))).alias("variation"), F.count_if(F.col("p") & F.col("m")).alias("crossed"),
        F.bool_or("signed").alias("signed"), F.bool_and("flat").alias("flat"), F.count_if((F.col("levels") >= 2) & F.col("unknown")).alias("compared"),
    )
    kind = (
        F.when(~F.col("scoped"), None).when(F.col("p_signed"), "interaction").when(F.col("product") & ~F.col("p_unknown"), "omnibus").when(F.col("p_unknown"), "interaction")
        .when(F.col("slope"), F.when(F.col("variation") == "within_subject", "parametric_modulation").when(F.col("variation").isin("between_subject", "mixed"), "cross_subject_regression"))
        .when(F.col("crossed") >= 2, "interaction").when(F.col("crossed") == 1, "contrast").when(F.col("signed"), "simple_effect").when(F.col("flat"), "omnibus")
        .when(F.col("compared") >= 2, "interaction").when(F.col("compared") == 1, "contrast")
    )
    return agg.select(*group, kind.alias("kind"))


def adjustment_set(analyses: DataFrame, scope: DataFrame, cells: DataFrame, components: DataFrame, group: list[str]) -> DataFrame:
    """(group, analysis_id, model_id, mediator_id, path) -> group, analysis_id, term_id: what the analysis was adjusted for.

    The terms in the model's scope without those that have cells, without products of
    which every component has cells, and without the mediator of an indirect or
    total path.
    """
    s = analyses.join(scope.select(*group, F.col("root").alias("model_id"), "term_id").distinct(), [*group, "model_id"])
    celled = cells.select(*group, "analysis_id", "term_id").distinct()
    left = s.join(celled, [*group, "analysis_id", "term_id"], "left_anti")
    parts = left.join(components, [*group, "term_id"]).join(celled.withColumnRenamed("term_id", "component_id").withColumn("__c", F.lit(True)), [*group, "analysis_id", "component_id"], "left")
    whole = parts.groupBy(*group, "analysis_id", "term_id").agg(F.bool_and(F.coalesce("__c", F.lit(False))).alias("__all")).where("__all").drop("__all")
    left = left.join(whole, [*group, "analysis_id", "term_id"], "left_anti")
    mediator = F.coalesce(F.col("path").isin("indirect", "total") & (F.col("term_id") == F.col("mediator_id")), F.lit(False))
    return left.where(~mediator).select(*group, "analysis_id", "term_id")


def weighted_out(cells: DataFrame, levels: DataFrame, group: list[str]) -> DataFrame:
    """group, term_id, level: declared levels of celled terms that no cell uses."""
    terms = cells.select(*group, "term_id").distinct()
    return terms.join(levels, "term_id").join(cells.select(*group, "term_id", "level").distinct(), [*group, "term_id", "level"], "left_anti").select(*group, "term_id", "level")


def compared_axis(cells: DataFrame, level_entities: DataFrame, group: list[str]) -> DataFrame:
    """group, axis: which kinds of entities the cells' levels stand for, sorted and joined."""
    j = cells.join(level_entities, ["term_id", "level"])
    return j.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_set("slot")), ",").alias("axis"))


def members(analyses: DataFrame, acquired: DataFrame, analysis: str) -> DataFrame:
    """(analysis, groups array<struct(group, n)>) and (group, acquired) -> analysis, group, n, acquired, dropped: who was in it, and how many of a cohort were left out."""
    each = analyses.select(analysis, F.explode("groups").alias("g")).select(analysis, "g.group", "g.n")
    return each.join(acquired, "group", "left").select(analysis, "group", "n", "acquired", F.greatest(F.col("acquired") - F.col("n"), F.lit(0)).alias("dropped"))


def deterministic_id(*parts: Column) -> Column:
    """A stable id of study, class, table, label and position; null parts are empty."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def unwrap(status: Column, value: Column) -> Column:
    return F.when(status == "extracted", value)


def normalize_free_text(rows: DataFrame, table: DataFrame, field: str) -> DataFrame:
    """A field's values by (raw, normal), compared folded; unmatched values stay. Adds normalized."""
    t = table.select(F.lower(F.trim("raw")).alias("__k"), "normal")
    out = rows.withColumn("__k", F.lower(F.trim(F.col(field)))).join(t, "__k", "left")
    return out.withColumn("normalized", F.coalesce("normal", field)).drop("__k", "normal")


def coordinate_space(table_space: Column, analysis_space: Column) -> Column:
    """The table's, else the analysis's."""
    return F.coalesce(table_space, analysis_space)


def paper_gate(types: Column, title: Column) -> Column:
    """keep, drop, or unknown for records that aren't indexed."""
    marked = F.coalesce(F.exists(types, lambda t: F.lower(t) == "meta-analysis"), F.lit(False))
    return F.when(marked | F.contains(F.lower(F.coalesce(title, F.lit(""))), F.lit("meta-analysis")), "drop").when(types.isNull(), "unknown").otherwise("keep")


def review_routing(found: DataFrame, by: str) -> DataFrame:
    """by, n, codes: how many findings, and which, send something to review."""
    return found.groupBy(by).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("code")), ",").alias("codes"))
