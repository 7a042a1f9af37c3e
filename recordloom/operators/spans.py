"""Quotes and spans: where a quote stands in a document, and whether a span is true."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fold
from ..session import spread

#: Quotes without a whole inner word are sent to the tasks in blocks of so many characters.
BLOCK_CHARS = 4_000_000
#: Words that identify a quote: the second to the fifth.
WIDTH = 4
#: White space that folding leaves, each one for one; a space separates words.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\u00a0"


def nearest_start(text: str, quote: str, near: str) -> Column:
    """Start of the non-overlapping occurrence of a literal that is nearest to a place (the first of equals), else null: one running sum."""
    parts = F.split(F.col(text), F.concat(F.lit(r"\Q"), F.replace(F.col(quote), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")), -1)
    size, at = F.length(quote), F.col(near).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("best"))

    def step(acc: Column, part: Column) -> Column:
        here = acc["at"] + F.length(part)
        better = acc["best"].isNull() | (F.abs(here - at) < F.abs(acc["best"] - at))
        return F.struct((here + size).alias("at"), F.when(better, here).otherwise(acc["best"]).alias("best"))

    return F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), start, step, lambda acc: acc["best"])


def tolerant_pattern(quote: Column) -> Column:
    """Tokens of the folded quote with any white space between them."""
    tokens = F.filter(F.split(fold(quote), r"(?U)\s+"), lambda t: t != "")
    quoted = F.transform(tokens, lambda t: F.concat(F.lit(r"\Q"), F.replace(t, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
    return F.concat(F.lit("(?U)"), F.array_join(quoted, r"\s+"))


def words_of(text: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), lambda t: t != "")


def find_exact(docs: DataFrame, quotes: DataFrame) -> DataFrame:
    """(doc_id, text) and (item_id, quote) -> doc_id, item_id, start_char, end_char of each quote's first place."""
    pairs = by_anchor(docs, quotes.where("quote IS NOT NULL AND trim(quote) != ''"), lambda c: c).where(F.contains("text", "quote"))
    found = pairs.withColumn("start_char", F.expr("locate(quote, text)").cast("long") - 1)
    return found.select("doc_id", "item_id", "start_char", (F.col("start_char") + F.length("quote")).alias("end_char"))


def by_anchor(docs: DataFrame, quotes: DataFrame, form) -> DataFrame:
    """Pairs of documents and quotes that may match once formed: those that share the quote's anchor.

    Inner words of a quote are whole words of any text that holds it. Six words or
    more: words 2 to 5, hashed to one number; three to five: the longest inner word.
    The documents' word runs become rows of numbers in generated code and meet the
    anchors in an equi-join, whose side Spark broadcasts when it is small. Shorter
    quotes have no whole word; they are searched for directly, in blocks of bounded
    size. Equal hashes of other words only bring a pair too many.
    """
    q = quotes.withColumn("t", words_of(form(F.col("quote"))))
    long, middle, short = q.where(F.size("t") >= WIDTH + 2), q.where(F.size("t").between(3, WIDTH + 1)), q.where("size(t) < 3").drop("t")
    counts = q.agg(F.count_if(F.size("t").between(3, WIDTH + 1)).alias("middle"), F.coalesce(F.sum(F.when(F.size("t") < 3, F.length("quote"))), F.lit(0)).alias("chars")).first()
    inner = F.array_sort(F.transform(F.slice(F.col("t"), F.lit(2), F.size("t") - 2), lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t"))))
    d = spread(docs.select("doc_id", "text")).select("doc_id", words_of(form(F.col("text"))).alias("t"))

    def met(width: int, anchors: DataFrame) -> DataFrame:
        runs = d.where(F.size("t") >= width).select("doc_id", "t", F.explode(F.sequence(F.lit(1), F.size("t") - (width - 1))).alias("k"))
        return runs.select("doc_id", F.xxhash64(F.slice("t", F.col("k"), F.lit(width))).alias("gram")).join(anchors, "gram").drop("gram").distinct()

    hits = met(WIDTH, long.withColumn("gram", F.xxhash64(F.slice("t", 2, WIDTH))).drop("t"))
    if counts["middle"]:
        hits = hits.unionByName(met(1, middle.withColumn("gram", F.xxhash64(F.array(inner[0]["t"]))).drop("t")))
    pairs = docs.join(hits, "doc_id")
    blocks = -(-counts["chars"] // BLOCK_CHARS)
    for k in range(blocks):
        part = short.where(F.pmod(F.xxhash64("quote"), F.lit(blocks)) == k)
        first = F.regexp_extract(form(F.col("quote")), r"(?U)^\s*(\S+)", 1)
        pairs = pairs.unionByName(spread(docs).join(F.broadcast(part), F.contains(form(F.col("text")), first)).select(*pairs.columns))
    return pairs


def resolve(pairs: DataFrame, near: str | None = None) -> DataFrame:
    """Adds start_char, end_char, span, exact to (text, quote) rows; nulls where the quote can't be found.

    A literal occurrence wins: the first, or the one nearest to ``near`` (the first
    of equals). Else folded texts are matched token by token with any white space
    between; the span is always the document's own text.
    """
    best = nearest_start("text", "quote", near) if near else F.expr("locate(quote, text)").cast("long") - 1
    out = pairs.withColumn("__at", F.when(F.contains("text", "quote") & (F.trim("quote") != ""), best))
    miss = F.col("__at").isNull()
    out = out.withColumn("__folded", F.when(miss, fold("text"))).withColumn("__hit", F.when(miss & (F.trim("quote") != ""), F.call_function("regexp_extract", F.col("__folded"), tolerant_pattern(F.col("quote")), F.lit(0))))
    loose = F.when(F.length("__hit") > 0, F.expr("locate(__hit, __folded) - 1"))
    out = out.withColumn("start_char", F.when(miss, loose).otherwise(F.col("__at")).cast("long"))
    out = out.withColumn("end_char", F.col("start_char") + F.when(miss, F.length("__hit")).otherwise(F.length("quote")))
    out = out.withColumn("span", F.substring(F.col("text"), F.col("start_char").cast("int") + 1, (F.col("end_char") - F.col("start_char")).cast("int")))
    return out.withColumn("exact", F.when(F.col("start_char").isNotNull(), ~miss)).drop("__at", "__folded", "__hit")


def find_tolerant(docs: DataFrame, quotes: DataFrame) -> DataFrame:
    """doc_id, item_id, start_char, end_char of quotes up to folding and white space, by anchors."""
    return resolve(by_anchor(docs, quotes, fold)).where("start_char IS NOT NULL").select("doc_id", "item_id", "start_char", "end_char", "exact")


def verify(text: str, start: str, end: str, span: str) -> Column:
    """ok, or the first thing wrong with a span."""
    return (
        F.when(F.col(start).isNull() | F.col(end).isNull(), "not_integer")
        .when((F.col(start) < 0) | (F.col(start) >= F.col(end)) | (F.col(end) > F.length(text)), "out_of_range")
        .when(F.substring(F.col(text), F.col(start).cast("int") + 1, (F.col(end) - F.col(start)).cast("int")) != F.col(span), "text_differs")
        .otherwise("ok")
    )


def require_true(rows: DataFrame, text: str, start: str, end: str, span: str) -> DataFrame:
    """The rows, if every span is true; the first one that isn't fails the query."""
    status = verify(text, start, end, span)
    return rows.where(F.when(status != "ok", F.raise_error(F.concat(F.lit("span "), status)).cast("boolean")).otherwise(True))


def leftover(text: str) -> Column:
    """How many placeholders a text still has; after placing the tables there must be none."""
    return F.regexp_count(F.col(text), F.lit(r"\[placeholder-")).cast("long")


def resolve_all(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Found and failed rows."""
    return resolved.where("start_char IS NOT NULL"), resolved.where("start_char IS NULL")


def first_difference(a: str, b: str) -> Column:
    """Index of the first differing character, null for equal texts."""
    return F.when(F.col(a) == F.col(b), F.lit(None)).otherwise(
        F.coalesce(
            F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False)).cast("long") - 1, F.least(F.length(a), F.length(b)).cast("long")
        )
    )


def place_tables(text: str, tables: str) -> Column:
    """Text with ``[placeholder-N]`` replaced by table N (an array, from 1); unknown numbers go, unplaced tables follow under a heading."""
    body, all_ = F.col(text), F.col(tables)
    parts = F.split(body, r"\[placeholder-\d+\]", -1)
    marks = F.regexp_extract_all(body, F.lit(r"\[placeholder-(\d+)\]"), F.lit(1))
    filled = F.concat(F.transform(marks, lambda m: F.coalesce(F.get(all_, m.cast("int") - 1), F.lit(""))), F.array(F.lit("")))
    placed = F.array_join(F.zip_with(parts, filled, lambda p, t: F.concat(p, F.coalesce(t, F.lit("")))), "")
    rest = F.filter(all_, lambda t, i: ~F.array_contains(marks, (i + 1).cast("string")))
    return F.when(F.size(rest) > 0, F.concat(placed, F.lit("\n\n## Tables\n\n"), F.array_join(rest, "\n\n"))).otherwise(placed)
