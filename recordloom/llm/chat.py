"""Chat formatting: reply trees to root-to-leaf conversations with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._store import cut

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """No control string is left: a ``<`` with k backslashes and ``|`` gets one backslash more. Null: empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """As ``escape``, and line ends become ``\\n``, so that a role ends at its line."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return unescape(F.array_join(parts, "\\"))


def chains(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows by turn as reply-tree nodes (tree, node, parent, score, role, text): each turn answers the one before it.

    Rows of one turn are ordered by role, then text; null turns come first.
    """
    w = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    node = F.row_number().over(w).cast("long")
    out = turns.select(F.col(conv).cast("long").alias("tree"), node.alias("node"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return out.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up) for every node on the way from each leaf up to its root (up = 0 at the leaf).

    Self-joins double the reach each round: with J the ancestor 2**k steps up and P
    the nodes within 2**k steps of a leaf, the next P adds J of P's nodes and the
    next J is J of J. The depth costs its logarithm in rounds. Nodes below a
    missing parent hang on no root and those on a cycle have no leaf or root: their
    leaves give no path.
    """
    n = cut(nodes.select("tree", "node", "parent").distinct())
    inner = n.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    same = lambda a, b: F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree")) & (F.col(f"{a}.node") == F.col(f"{b}.node"))
    leaves = n.alias("a").join(inner.alias("b"), same("a", "b"), "left_anti")
    reach = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    jump = n.where("parent IS NOT NULL").select("tree", "node", F.col("parent").alias("to"))
    step, most = 1, n.count()
    while step <= most:
        more = reach.alias("a").join(jump.alias("b"), same("a", "b")).select("a.tree", "a.leaf", F.col("b.to").alias("node"), (F.col("a.up") + step).alias("up"))
        reach = cut(reach.union(more))
        on = F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.to") == F.col("b.node"))
        jump = cut(jump.alias("a").join(jump.alias("b"), on).select("a.tree", "a.node", "b.to"))
        step *= 2
        if jump.isEmpty():
            break
    roots = n.where("parent IS NULL")
    whole = reach.alias("a").join(roots.alias("b"), same("a", "b"), "left_semi").select("tree", "leaf").distinct()
    return reach.alias("a").join(whole.alias("b"), F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.leaf") == F.col("b.leaf")), "left_semi")


def format_trees(nodes: DataFrame, best: int | None = 1, learn: str = "assistant") -> DataFrame:
    """One conversation per chosen path: tree, leaf, rank, score, n_turns, formatted, loss_spans.

    ``nodes`` has tree, node, parent (null: a root), score, role, text. A branch's
    score is the sum of its nodes' scores (null: 0); the ``best`` branches of each
    tree stay (None: all), ties go to the smaller leaf. A turn is written as
    ``<|im_start|>role`` LF ``text<|im_end|>`` LF with texts and roles escaped
    reversibly. loss_spans has, for each turn of the role ``learn`` in order, the
    start and length of its escaped text in the formatted string, in code points
    (start, chars) and in UTF-8 bytes (byte_start, bytes). Null texts are empty,
    repeated node ids of a tree keep their smallest row, an empty table gives none.
    """
    nodes = nodes.select("tree", "node", "parent", "score", "role", "text")
    order = Window.partitionBy("tree", "node").orderBy(F.col("parent").asc_nulls_first(), "role", "text", "score")
    nodes = cut(nodes.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k"))
    on_path = paths(nodes).alias("p").join(nodes.alias("n"), F.col("p.tree").eqNullSafe(F.col("n.tree")) & (F.col("p.node") == F.col("n.node"))).select("p.tree", "p.leaf", "p.up", "n.score", "n.role", "n.text")
    key = ["tree", "leaf"]
    if best is not None:
        on_path = cut(on_path)
        ranked = on_path.groupBy(key).agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("total"))
        chosen = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "leaf"))).where(F.col("rank") <= best)
        on_path = on_path.alias("a").join(chosen.alias("b"), F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.leaf") == F.col("b.leaf"))).select("a.*", "b.total", "b.rank")
    else:
        on_path = on_path.withColumn("total", F.lit(None).cast("double")).withColumn("rank", F.lit(None).cast("int"))
    lead = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = on_path.withColumn("lead", lead).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("piece", F.concat("lead", "body", F.lit(END + "\n")))
    before = Window.partitionBy(*key).orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    for name, size in (("start", F.length), ("byte_start", F.octet_length)):
        rows = rows.withColumn(name, F.coalesce(F.sum(size("piece").cast("long")).over(before), F.lit(0)) + size("lead"))
    span = F.when(F.col("role") == learn, F.struct("start", F.length("body").cast("long").alias("chars"), "byte_start", F.octet_length("body").cast("long").alias("bytes")))
    out = rows.groupBy(*key).agg(
        F.first("rank").alias("rank"), F.first("total").alias("score"), F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("pos"), "piece"))).alias("pieces"), F.array_sort(F.collect_list(span)).alias("loss_spans"),
    )
    return out.select(*key, "rank", "score", "n_turns", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss_spans")


def read_back(formatted: Column) -> Column:
    """array<struct(role, text)> of a formatted conversation, unescaped."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(p):
        at = F.instr(p, "\n")
        return F.struct(
            unescape_role(F.substring(p, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"), unescape(F.substring(p, at + 1, F.length(p))).alias("text")
        )

    return F.transform(pieces, turn)


def masked(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, one after the other."""
    raw = formatted.cast("binary")
    parts = F.transform(spans, lambda s: unescape(F.substring(raw, (s["byte_start"] + 1).cast("int"), s["bytes"].cast("int")).cast("string")))
    return F.array_join(parts, "")
