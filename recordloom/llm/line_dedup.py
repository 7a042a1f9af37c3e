"""Line dedup: repeated line runs from a suffix array over line-ID sequences.

Lines that stand only once split a document into islands; islands of too few words
can't hold a run and go, and of equal islands only the first goes on (the others
are copies as a whole). Over the rest, each doubling round sorts the distinct pairs
(rank of 2**t lines, rank of the next 2**t lines) and numbers those that occur
again: suffixes of equal rank are an interval of the suffix array whose common
prefix is 2**(t+1) lines or more. Pairs that occur once have found their place and
leave, so the rounds shrink to what is repeated, and they go on until no rank does.

Then the intervals are narrowed from the longest prefix down. A suffix is in the
interval of (f, n) when its first n lines stand first at place f, before its own;
it goes on to n + 2**t lines if the rank of the next 2**t lines occurs earlier inside
that interval. What comes out is, for each place, the longest run from there that
stands earlier: the depth of the deepest LCP interval in which it isn't the first.
Runs that are no part of the run one line before are the maximal ones; their lines go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._store import Stash, cut, hot_join, most as _most

#: What separates words and is trimmed from lines: ASCII white space. NBSP and the like are letters.
WHITE = "\t\r\x0b\x0c"


def _doc_key(df: DataFrame) -> Column:
    return F.xxhash64(F.lit(17), F.col("doc_id"), F.col("text"))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, key, j, line, words, h1, h2: the lines that have words; line counts all lines from 0, j those with words."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("key", _doc_key(base))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.cast("long").alias("line"), F.trim(F.translate(x, WHITE, " " * len(WHITE))).alias("s")))
    rows = base.select("doc_id", "key", F.posexplode(F.filter(lines, lambda x: x["s"] != "")).alias("j", "x"))
    return rows.select("doc_id", "key", F.col("j").cast("long").alias("j"), "x.line", F.regexp_count("x.s", F.lit("[^ ]+")).cast("long").alias("words"), F.xxhash64("x.s").alias("h1"), F.xxhash64(F.lit(1), "x.s").alias("h2"))


def suffix_runs(active: DataFrame, stash: Stash) -> DataFrame:
    """(pos, rank, end) -> (pos, first, n, end): the longest run from each place that also starts at an earlier place.

    pos numbers the lines, consecutively inside an island; rank names a line; end is
    one past the island's last line and names the island. Places without such a run
    are left out; ``first`` is the earliest place of the run.
    """
    levels, width = [active.select("pos", "rank", "end")], 1
    while True:
        level = levels[-1]
        ahead = level.select((F.col("pos") - width).alias("pos"), F.col("rank").alias("rb"), F.col("end").alias("end2"))
        pairs = stash.save(level.withColumnRenamed("rank", "ra").join(ahead, "pos").where("end = end2").select("pos", "ra", "rb", "end"), f"pairs{width}")
        classes = pairs.groupBy("ra", "rb").agg(F.count("*").alias("c")).where("c > 1").orderBy("ra", "rb").withColumn("rank", F.monotonically_increasing_id())
        classes = stash.save(classes, f"classes{width}")
        most = _most(classes)
        if not most[0]:
            break
        levels.append(stash.save(hot_join(pairs, classes, ["ra", "rb"], most).select("pos", "rank", "end"), f"level{2 * width}"))
        stash.drop(f"pairs{width}")
        width *= 2
    found = None  # pos, end; the interval: first and the end of its island, n
    none = F.lit(None).cast("long")
    while levels:
        level = levels.pop()
        # places without a run so far: is the one of this width here a copy?
        fresh = level if found is None else level.join(found.select("pos"), "pos", "left_anti")
        tried = fresh.select("pos", "end", F.lit(-1).cast("long").alias("first"), none.alias("first_end"), F.lit(0).cast("long").alias("n"), "rank", F.lit(False).alias("seen"))
        if found is not None:  # the first of an interval is asked too, but has its own run elsewhere
            firsts = found.select(F.col("first").alias("pos"), F.col("first_end").alias("end"), "first", "first_end", "n", F.lit(True).alias("seen")).distinct()
            longer = found.withColumn("seen", F.lit(False)).unionByName(firsts).withColumn("at", F.col("pos") + F.col("n"))
            ahead = level.select(F.col("pos").alias("at"), "rank", F.col("end").alias("end2"))
            longer = longer.join(ahead, "at").where("end = end2")
            tried = tried.unionByName(longer.drop("at", "end2"))
        tried = stash.save(tried, f"tried{width}")
        groups = tried.groupBy("first", "n", "rank").agg(F.min("pos").alias("earliest"), F.min_by("end", "pos").alias("earliest_end"), F.count("*").alias("c"))
        groups = stash.save(groups.where("c > 1"), f"groups{width}")
        now = hot_join(tried.where("NOT seen"), groups, ["first", "n", "rank"]).where("pos > earliest")
        now = stash.save(now.select("pos", "end", F.col("earliest").alias("first"), F.col("earliest_end").alias("first_end"), (F.col("n") + width).alias("n")), f"now{width}")
        found = now if found is None else found.join(now.select("pos"), "pos", "left_anti").unionByName(now)
        if width > 1 and len(levels) % 3 == 0:
            found = stash.save(found, f"found{width}")
        stash.drop(f"tried{width}")
        stash.drop(f"groups{width}")
        width //= 2
    return found.select("pos", "first", "n", "end")


def maximal_runs(runs: DataFrame) -> DataFrame:
    """Of (pos, first, n, end) those that aren't the rest of a run one line before."""
    before = runs.select((F.col("pos") + 1).alias("pos"), (F.col("n") - 1).alias("left"), F.col("end").alias("end0"))
    return runs.join(before, "pos", "left").where("end0 IS NULL OR end0 != end OR left < n").select("pos", "first", "n", "end")


def repeated_lines(docs: DataFrame, min_words: int = 10) -> DataFrame:
    """(doc_id, key, line): the lines, numbered from 0, that belong to a later copy of a repeated run.

    Order is ascending doc_id (null first), then a hash of the text, then the line.
    """
    with Stash(docs.sparkSession) as stash:
        rows = stash.save(lines_of(docs), "rows")
        # a whole row that stands again is the same document, so it is counted once
        twice = rows.where("j = 0").groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key")
        if not twice.isEmpty():
            same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.key") == F.col("b.key"))
            again = rows.alias("a").join(twice.alias("b"), same, "left_semi").distinct()
            rows = stash.save(rows.alias("a").join(twice.alias("b"), same, "left_anti").union(again), "single")

        # lines that stand again, and places: one number for each, ascending, consecutive inside a document
        classes = rows.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").orderBy("h1", "h2").withColumn("rank", F.monotonically_increasing_id())
        active = hot_join(rows, stash.save(classes, "classes"), ["h1", "h2"]).select("doc_id", "key", "j", "line", "words", "rank")
        active = active.repartitionByRange("doc_id", "key").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "key", "j")
        active = stash.save(active.withColumn("pos", F.monotonically_increasing_id()), "active")

        # islands of enough words; pos - j is the same all over an island of a document
        island = Window.partitionBy("doc_id", "key", "shift")
        placed = active.select("doc_id", "key", (F.col("pos") - F.col("j")).alias("shift"), "pos", "rank", "words")
        placed = placed.select("pos", "rank", "words", F.min("pos").over(island).alias("begin"), (F.max("pos").over(island) + 1).alias("end"), F.sum("words").over(island).alias("all"))
        placed = stash.save(placed.where(F.col("all") >= min_words).drop("all"), "placed")
        mark = lambda k: F.bit_xor(F.xxhash64(F.lit(k), "rank", F.col("pos") - F.col("begin")))
        signed = stash.save(placed.groupBy("begin", "end").agg(mark(1).alias("s1"), mark(2).alias("s2")).withColumn("n", F.col("end") - F.col("begin")), "signed")
        equal = stash.save(signed.groupBy("n", "s1", "s2").agg(F.min("begin").alias("earliest"), F.count("*").alias("c")).where("c > 1"), "equal")
        copies = stash.save(hot_join(signed, equal, ["n", "s1", "s2"]).where("begin > earliest").select("begin", "n"), "copies")
        kept = placed.join(copies.select("begin"), "begin", "left_anti")

        runs = maximal_runs(suffix_runs(stash.save(kept.select("pos", "rank", "end"), "kept"), stash))
        # words of a run: sums up to its last line less those before its first
        upto = Window.partitionBy("end").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        sums = stash.save(kept.select("pos", "words", F.sum("words").over(upto).alias("sum")), "sums")
        runs = runs.withColumn("last", F.col("pos") + F.col("n") - 1).join(sums.select(F.col("pos").alias("last"), "sum"), "last")
        runs = runs.join(sums.select("pos", (F.col("sum") - F.col("words")).alias("before")), "pos").where(F.col("sum") - F.col("before") >= min_words)
        # maximal runs of an island end in the order in which they begin: each adds the lines behind the one before
        done = F.lag("last").over(Window.partitionBy("end").orderBy("pos"))
        new = runs.select(F.greatest(F.col("pos"), F.coalesce(done + 1, F.col("pos"))).alias("a"), F.col("last").alias("b")).where("a <= b")
        gone = new.union(copies.selectExpr("begin", "begin + n - 1")).select(F.explode(F.sequence("a", "b")).alias("pos"))
        return cut(gone.join(active, "pos").select("doc_id", "key", "line"))


def line_dedup(docs: DataFrame, min_words: int = 10) -> DataFrame:
    """Every row of docs with n_lines, removed (numbers of the lines that go, ascending) and kept_text.

    Repeated means: a run of consecutive lines, trimmed, equal to another run that
    starts at an earlier place and has at least ``min_words`` words in all. Blank
    lines neither count nor break runs, and stay. Null texts are empty and keep a
    null text; rows that agree in doc_id and text are one document and get the same
    result. Columns of docs stay as they are, whatever their names (those named
    here are replaced).
    """
    gone = repeated_lines(docs, min_words).groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("line")).alias("removed"))
    left = docs.drop("n_lines", "removed", "kept_text")
    source = left.withColumn("__id", F.col("doc_id").cast("long"))
    source = source.withColumn("__key", F.xxhash64(F.lit(17), F.col("__id"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    gone = gone.select(F.col("doc_id").alias("__gid"), F.col("key").alias("__gkey"), "removed")
    out = source.join(gone, F.col("__id").eqNullSafe(F.col("__gid")) & (F.col("__key") == F.col("__gkey")), "left").drop("__id", "__key", "__gid", "__gkey")
    out = out.withColumn("removed", F.coalesce("removed", F.array().cast("array<bigint>"))).withColumn("__lines", F.split(F.col("text").cast("string"), "\n"))
    out = out.withColumn("n_lines", F.coalesce(F.size("__lines"), F.lit(1)).cast("long"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0).cast("long"), F.col("n_lines") - 1), F.col("removed")), lambda i: F.col("__lines")[i.cast("int")])
    kept = F.when(F.size("removed") > 0, F.array_join(kept, "\n")).otherwise(F.col("text").cast("string"))
    return out.withColumn("kept_text", kept).drop("__lines")
