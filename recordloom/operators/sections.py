"""Sections: headings of a text as nested half-open intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import squeeze

#: One heading line: marks, blanks, title. (fixed values)
HEADING = r"(?d)^(#+)[ \t]+(.*?)[ \t]*$"


def headings(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, ordinal (from 1, all headings), level, title, start_char, n_chars."""
    lines = docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.split("text", "\n").alias("lines"))
    at = lines.select("doc_id", "n_chars", F.posexplode("lines").alias("pos", "line"))
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    at = at.withColumn("start_char", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)).cast("long"))
    at = at.where(F.rlike("line", F.lit(HEADING)))
    numbered = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")).cast("long")
    return at.select("doc_id", numbered.alias("ordinal"), (F.length(F.regexp_extract("line", HEADING, 1)) - 1).cast("long").alias("level"), squeeze(F.regexp_extract("line", HEADING, 2)).alias("title"), "start_char", "n_chars")


def build_sections(docs: DataFrame) -> DataFrame:
    """doc_id, ordinal, title, level, parent_section, start_char, end_char.

    A section ends at the next heading of its level or higher, else with the text.
    Headings without a title make no section but end others. The parent is the
    latest earlier section of a lower level. Both come from one fold over a
    document's headings with a stack of rising levels.
    """
    h = headings(docs)
    own = F.array_sort(F.collect_list(F.struct("ordinal", "level", "title", "start_char")))
    h = h.groupBy("doc_id").agg(F.first("n_chars").alias("n_chars"), own.alias("h"))

    def fold(rows: Column, value: Column, inclusive: bool) -> Column:
        """For each row the value of the last row before it with a lower (or equal) level; rows without a value are passed by."""
        kind = "array<struct<level:bigint,value:string>>"

        def step(acc: Column, x: Column) -> Column:
            lower = F.filter(acc["stack"], lambda y: (y["level"] <= x["level"]) if inclusive else (y["level"] < x["level"]))
            kept = F.filter(acc["stack"], lambda y: y["level"] < x["level"])
            mine = value(x)
            stack = F.when(mine.isNull(), acc["stack"]).otherwise(F.concat(kept, F.array(F.struct(x["level"].alias("level"), mine.alias("value")))))
            return F.struct(stack.alias("stack"), F.concat(acc["out"], F.array(F.get(lower, F.size(lower) - 1)["value"])).alias("out"))

        start = F.struct(F.array().cast(kind).alias("stack"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(rows, start, step, lambda acc: acc["out"])

    ends = F.reverse(fold(F.reverse("h"), lambda x: x["start_char"].cast("string"), True))
    parents = fold(F.col("h"), lambda x: F.nullif(x["title"], F.lit("")), False)
    s = h.select("doc_id", "n_chars", F.explode(F.arrays_zip("h", ends.alias("next"), parents.alias("parent"))).alias("x"))
    s = s.select("doc_id", "x.h.ordinal", "x.h.title", "x.h.level", F.col("x.parent").alias("parent_section"), "x.h.start_char", F.coalesce(F.col("x.next").cast("long"), "n_chars").alias("end_char"))
    return s.where("title != ''").select("doc_id", "ordinal", "title", "level", "start_char", "end_char", "parent_section")


def section_path(sections: DataFrame, offsets: DataFrame) -> DataFrame:
    """(doc_id, offset) -> doc_id, offset, path: the titles around an offset, outermost first, or null."""
    at = offsets.alias("o").join(sections.alias("s"), (F.col("o.doc_id") == F.col("s.doc_id")) & (F.col("s.start_char") <= F.col("o.offset")) & (F.col("o.offset") < F.col("s.end_char")), "left")
    deepest = F.max("s.level").over(Window.partitionBy("o.doc_id", "o.offset"))
    at = at.select("o.doc_id", "o.offset", "s.level", "s.ordinal", "s.title", deepest.alias("deep"))
    first = F.min(F.when(F.col("level") == F.col("deep"), F.col("ordinal"))).over(Window.partitionBy("doc_id", "offset"))
    at = at.withColumn("chosen", first).where("level IS NULL OR level < deep OR ordinal = chosen")
    trail = F.array_sort(F.collect_list(F.when(F.col("title").isNotNull(), F.struct("level", "ordinal", "title"))))
    return at.groupBy("doc_id", "offset").agg(trail.alias("t")).select("doc_id", "offset", F.nullif(F.array_join("t.title", " > "), F.lit("")).alias("path"))


def slice_section(docs: DataFrame, title: str, missing: str = "error") -> DataFrame:
    """doc_id, text of the first section with that title.

    A document without one fails the query (``missing="error"``), or comes back with
    a null text (``missing="null"``).
    """
    s = build_sections(docs).where(F.col("title") == title)
    s = s.groupBy("doc_id").agg(F.min_by(F.struct("start_char", "end_char"), "ordinal").alias("s"))
    part = F.substring(F.col("text"), F.col("s.start_char").cast("int") + 1, (F.col("s.end_char") - F.col("s.start_char")).cast("int"))
    if missing == "error":
        part = F.when(F.col("s").isNull(), F.raise_error(F.concat(F.lit(f"no heading '{title}' in document "), F.col("doc_id").cast("string"))).cast("string")).otherwise(part)
    return docs.join(s, "doc_id", "left").select("doc_id", part.alias("text"))
