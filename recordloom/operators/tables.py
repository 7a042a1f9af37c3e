"""Result tables: ragged grids to typed rows, coordinate columns and markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import GAP, clean_cell, dedup_base, is_number, markdown_cell, triple

# What header cells say.
COORDISH = r"(?i)^[xyz]$|coordinate|mni|talairach"
AXIS = r"(?i)^\(?\s*{}\s*\)?$"
PAREN_AXIS = r"(?i)\(\s*{}\s*\)\s*$"
AXIS_TRIPLE = r"(?i)[(\[]?\s*x\s*[,;/]\s*y\s*[,;/]\s*z\s*[)\]]?"


def runs(cells: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """Runs of equal neighbours: keys, run (from 1), text, span."""
    w = Window.partitionBy(*keys).orderBy(order)
    new = F.when(F.col(text).eqNullSafe(F.lag(text).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    marked = cells.withColumn("__new", new).withColumn("run", F.sum("__new").over(w).cast("long"))
    return marked.groupBy(*keys, "run").agg(F.first(text).alias("text"), F.count("*").alias("span"))


def classify_rows(rows: DataFrame, n_header: str = "n_header") -> DataFrame:
    """(table_id, row, cells array, n_header) -> padded cells, row_type (header, section, data) and section_text.

    Empty rows go. A section is one text in two or more filled cells, or a single
    filled cell without a digit.
    """
    w = Window.partitionBy("table_id")
    out = rows.withColumn("cells", F.transform("cells", clean_cell)).withColumn("width", F.max(F.size("cells")).over(w))
    out = out.withColumn("cells", F.concat("cells", F.array_repeat(F.lit(""), F.col("width") - F.size("cells"))))
    filled = F.filter("cells", lambda c: c != "")
    section = ((F.size(F.array_distinct(filled)) == 1) & (F.size(filled) >= 2)) | ((F.size(filled) == 1) & ~F.rlike(F.get(filled, F.lit(0)), F.lit(r"\d")))
    kind = F.when(F.col("row") < F.col(n_header), "header").when(section, "section").otherwise("data")
    out = out.withColumn("row_type", kind).where((F.col("row_type") == "header") | (F.size(filled) > 0))
    return out.withColumn("section_text", F.when(F.col("row_type") == "section", F.get(filled, F.lit(0))))


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.select("table_id", "row", "row_type", F.posexplode("cells").alias("col", "text"))


def coord_cols(rows: DataFrame) -> DataFrame:
    """table_id, col of header cells that speak of coordinates."""
    return cells_of(rows.where("row_type = 'header'")).where(F.rlike("text", F.lit(COORDISH))).select("table_id", "col").distinct()


def axis_columns(rows: DataFrame) -> DataFrame:
    """table_id, x, y, z: the columns of the three axes, for tables that name them.

    Candidates: a lone axis letter, then a letter in parentheses, each from one
    header row that names all three, the lowest row first; in a row a consecutive
    triple comes before the leftmost letters. Last, three neighbours under one
    coordinate label. A candidate holds if some data row is numeric in all three
    columns, or the table has no data row.
    """
    head = cells_of(rows.where("row_type = 'header'"))
    found = None
    for rank, pattern in enumerate((AXIS, PAREN_AXIS)):
        named = {a: head.where(F.rlike("text", F.lit(pattern.format(a)))).select("table_id", "row", F.col("col").alias(a)) for a in "xyz"}
        every = named["x"].join(named["y"], ["table_id", "row"]).join(named["z"], ["table_id", "row"])
        near = every.where("y = x + 1 AND z = x + 2").select("table_id", "row", "x", "y", "z", F.lit(0).alias("far"))
        left = every.groupBy("table_id", "row").agg(F.min("x").alias("x"), F.min("y").alias("y"), F.min("z").alias("z")).withColumn("far", F.lit(1))
        both = near.unionByName(left).withColumn("rank", F.lit(rank))
        found = both if found is None else found.unionByName(both)
    base = head.withColumn("base", dedup_base("text"))
    w = Window.partitionBy("table_id", "row").orderBy("col")
    label = F.rlike("base", F.lit(AXIS_TRIPLE)) | F.rlike("base", F.lit(COORDISH))
    three = base.withColumn("same", (F.lead("base", 1).over(w) == F.col("base")) & (F.lead("base", 2).over(w) == F.col("base"))).where(F.col("same") & label & (F.col("base") != ""))
    three = three.select("table_id", "row", F.col("col").alias("x"), (F.col("col") + 1).alias("y"), (F.col("col") + 2).alias("z"), F.lit(0).alias("far"), F.lit(2).alias("rank"))
    found = found.unionByName(three)
    data = rows.where("row_type = 'data'").select("table_id", F.transform("cells", is_number).alias("numeric"))
    told = found.join(data, "table_id", "left")
    all_three = F.get("numeric", F.col("x")) & F.get("numeric", F.col("y")) & F.get("numeric", F.col("z"))
    held = told.groupBy("table_id", "row", "x", "y", "z", "far", "rank").agg(F.coalesce(F.bool_or(all_three), F.lit(False)).alias("ok"), F.count("numeric").alias("n")).where("ok OR n = 0")
    best = F.row_number().over(Window.partitionBy("table_id").orderBy("rank", F.desc("row"), "far", "x"))
    return held.withColumn("k", best).where("k = 1").select("table_id", "x", "y", "z")


def axis_cell(rows: DataFrame) -> DataFrame:
    """table_id, col: the column headed by all three axes whose filled cells are triples by half or more."""
    head = cells_of(rows.where("row_type = 'header'")).where(F.rlike("text", F.lit(AXIS_TRIPLE))).select("table_id", "row", "col")
    data = cells_of(rows.where("row_type = 'data'")).where("text != ''").groupBy("table_id", "col").agg((F.avg(triple("text").isNotNull().cast("int")) >= 0.5).alias("ok")).where("ok")
    best = F.row_number().over(Window.partitionBy("table_id").orderBy(F.desc("row"), "col"))
    return head.join(data, ["table_id", "col"]).withColumn("k", best).where("k = 1").select("table_id", "col")


def majority(values: DataFrame, key: str, ok: Column) -> DataFrame:
    """key, n, share of ok, confirmed from a half on."""
    return values.groupBy(key).agg(F.count("*").alias("n"), F.count_if(ok).alias("n_ok")).withColumn("confirmed", 2 * F.col("n_ok") >= F.col("n"))


def markdown(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows of classify_rows and (table_id, label, caption, footer) -> table_id, text: a padded pipe table.

    Header levels are joined per column unless the column has the word already;
    section rows don't widen columns.
    """
    c = cells_of(rows).withColumn("text", markdown_cell("text"))
    head = c.where("row_type = 'header'").groupBy("table_id", "col").agg(F.array_sort(F.collect_list(F.struct("row", "text"))).alias("levels"))
    joined = F.aggregate("levels", F.lit(""), lambda acc, x: F.when((x["text"] == "") | F.contains(acc, x["text"]), acc).otherwise(F.trim(F.concat(acc, F.lit(" "), x["text"]))))
    head = head.select("table_id", F.lit(-1).alias("row"), F.lit("header").alias("row_type"), "col", joined.alias("text")).withColumn("text", F.when(F.col("text") == "", " ").otherwise(F.col("text")))
    section = rows.where("row_type = 'section'").select("table_id", "row", "row_type", F.posexplode(F.transform("cells", lambda x, i: F.when(i == 0, F.lit(1)).otherwise(0))).alias("col", "first"), "section_text")
    section = section.select("table_id", "row", "row_type", "col", F.when(F.col("first") == 1, markdown_cell("section_text")).otherwise("").alias("text"))
    body = head.unionByName(c.where("row_type = 'data'")).unionByName(section)
    widths = body.where("row_type != 'section'").groupBy("table_id", "col").agg(F.max(F.length("text")).alias("w"))
    body = body.join(widths, ["table_id", "col"])
    padded = F.concat("text", F.repeat(F.lit(" "), F.greatest(F.col("w") - F.length("text"), F.lit(0))))
    lines = body.groupBy("table_id", "row").agg(F.array_sort(F.collect_list(F.struct("col", padded.alias("t")))).alias("c"))
    lines = lines.select("table_id", F.col("row").cast("double").alias("row"), F.concat(F.lit("| "), F.array_join("c.t", " | "), F.lit(" |")).alias("line"))
    rule = widths.groupBy("table_id").agg(F.array_sort(F.collect_list(F.struct("col", F.repeat(F.lit("-"), F.col("w") + 2).alias("t")))).alias("c"))
    rule = rule.select("table_id", F.lit(-0.5).alias("row"), F.concat(F.lit("|"), F.array_join("c.t", "|"), F.lit("|")).alias("line"))
    text = lines.unionByName(rule).groupBy("table_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("row", "line")))["line"], "\n").alias("body"))
    title = F.concat_ws(" — ", F.nullif("label", F.lit("")), F.nullif("caption", F.lit("")))
    return text.join(heads, "table_id").select("table_id", F.concat_ws("\n\n", F.nullif(title, F.lit("")), "body", F.nullif(markdown_cell("footer"), F.lit(""))).alias("text"))


def manifest_ids(manifest: DataFrame) -> DataFrame:
    """(line from 1, table_id, label) -> adds local_id ``tbl{line}`` and a label that falls back on the id."""
    return manifest.withColumn("local_id", F.concat(F.lit("tbl"), F.col("line").cast("string"))).withColumn("label", F.coalesce(F.nullif("label", F.lit("")), "table_id"))
