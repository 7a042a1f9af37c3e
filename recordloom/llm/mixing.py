"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, lang, source). A budget in tokens flows down the tree by the
children's weights, no child getting more than it can give (its tokens times the
epochs allowed). What a child can't give goes to its siblings by their weights;
only what all of them together can't give goes past their parent. Each leaf then
gives whole epochs and, from one more, a prefix of its documents in seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._store import Stash, cut

LEVELS = ("domain", "lang", "source")
#: Hex digits of a document's order hash that make a bin, and rows of one bin that are ordered without splitting it again.
DIGITS, ORDERED = 2, 5000


def n_tokens(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("double")


def budgets(leaves: DataFrame, target: Column, weights: dict[str, dict[str, int]], epochs: int) -> DataFrame:
    """(domain, lang, source, tokens) -> the same with budget (tokens to take); target is an expression over ``total``.

    Names without a weight weigh 1; a weight of 0 gives nothing. Null names are
    names of their own.
    """
    at = [c for c in LEVELS]
    nodes = leaves.select(*at, "tokens", (F.col("tokens") * epochs).cast("double").alias("can"))
    for level in LEVELS:
        nodes = nodes.withColumn(f"w_{level}", _weight(level, weights))
    # what a subtree can give excludes what its weights forbid
    forbidden = F.least(*[F.col(f"w_{x}") for x in LEVELS]) <= 0
    nodes = nodes.withColumn("can", F.when(forbidden, 0.0).otherwise(F.col("can")))
    total = nodes.agg(F.sum("tokens").alias("total"), F.sum("can").alias("top"))
    frame = total.select(F.least(F.coalesce("top", F.lit(0.0)), target.cast("double")).alias("budget"))
    parents: list[str] = []
    for level in LEVELS:
        keys = [*parents, level]
        units = nodes.groupBy(*keys).agg(F.sum("can").alias("can"), F.max(f"w_{level}").alias("w")).where("w > 0 AND can > 0")
        if parents:
            same = [F.col(f"u.{p}").eqNullSafe(F.col(f"f.{p}")) for p in parents]
            units = units.alias("u").join(frame.alias("f"), same).select(*[F.col(f"u.{k}") for k in keys], "can", "w", "budget")
        else:
            units = units.crossJoin(frame)  # one row: the whole budget
        # fill in order of can / w: all that can't take their share are full, the rest share what is left by weight
        w = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
        order = w.orderBy(F.col("can") / F.col("w"), F.col(level).asc_nulls_first())
        units = units.withColumn("given", F.sum("can").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        units = units.withColumn("open", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        units = units.withColumn("fair", (F.col("budget") - F.coalesce("given", F.lit(0.0))) / F.col("open"))
        units = units.withColumn("full", F.col("can") <= F.col("fair") * F.col("w"))
        rate = F.min(F.when(~F.col("full"), F.struct((F.col("can") / F.col("w")).alias("x"), F.col(level), F.col("fair").alias("fair")))).over(w)
        units = units.withColumn("rate", rate["fair"])
        frame = units.select(*keys, F.when(F.col("full"), F.col("can")).otherwise(F.col("rate") * F.col("w")).alias("budget"))
        parents = keys
    same = [F.col(f"n.{p}").eqNullSafe(F.col(f"f.{p}")) for p in LEVELS]
    return nodes.alias("n").join(frame.alias("f"), same, "left").select(*[F.col(f"n.{k}") for k in LEVELS], "tokens", F.floor(F.coalesce("budget", F.lit(0.0)) + 1e-6).cast("long").alias("budget"))


def _same(a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.{p}").eqNullSafe(F.col(f"{b}.{p}")) for p in LEVELS]


def _ordered(df: DataFrame, seed: int) -> DataFrame:
    return df.withColumn("__order", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))


def ends(ids: DataFrame, plan: DataFrame, stash: Stash, seed: int, ordered: int = ORDERED) -> DataFrame:
    """LEVELS, prefix, last, ties, same: for each leaf with a partial epoch, the (order, doc_id, tokens) of the last document it reaches, and how many of how many equal ones.

    Token sums by the order's first digits find the bin in which the budget ends;
    that bin alone is split by more digits, until no leaf's has more than
    ``ordered`` rows. Only those are ordered.
    """
    part = plan.where("rest > 0").select(*LEVELS, "whole", "rest")
    rows = _ordered(ids.alias("d").join(part.alias("p"), _same("d", "p")).select("d.*", "whole", "rest"), seed)
    found = part.select(*LEVELS, F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"))
    digits = 0
    while True:
        inside = rows.alias("d").join(found.alias("f"), _same("d", "f")).select("d.*", "prefix", "before").where(F.col("__order").startswith(F.col("prefix")))
        digits += DIGITS
        sums = inside.groupBy(*LEVELS, F.substring("__order", 1, digits).alias("bin"), "rest", "before").agg(F.sum("tokens").alias("t"), F.count("*").alias("c"))
        upto = F.sum("t").over(Window.partitionBy(*LEVELS).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        over = sums.withColumn("upto", F.col("before") + upto).where(F.col("upto") > F.col("rest"))
        found = stash.save(over.groupBy(*LEVELS).agg(F.min(F.struct("bin", (F.col("upto") - F.col("t")).alias("before"), "c")).alias("m")).select(*LEVELS, F.col("m.bin").alias("prefix"), "m.before", "m.c"), f"ends{digits}")
        most = found.agg(F.max("c")).first()[0]
        if not most or most <= ordered or digits >= 32:
            break
        found = found.drop("c")
    inside = rows.alias("d").join(found.drop("c").alias("f"), _same("d", "f")).select("d.*", "prefix", "before").where(F.col("__order").startswith(F.col("prefix")))
    running = Window.partitionBy(*LEVELS).orderBy("__order", F.col("doc_id").asc_nulls_first(), "tokens").rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("__sum", F.col("before") + F.sum("tokens").over(running)).withColumn("__in", 2 * F.col("__sum") - F.col("tokens") <= 2 * F.col("rest"))
    equal = reached.groupBy(*LEVELS, F.struct("__order", "doc_id", "tokens").alias("last")).agg(F.sum(F.col("__in").cast("long")).alias("ties"), F.count("*").alias("same")).where("ties > 0")
    taken = equal.groupBy(*LEVELS).agg(F.max(F.struct("last", "ties", "same")).alias("m")).select(*LEVELS, "m.*")
    # a leaf whose bin gives nothing ends with the bin's beginning
    return found.select(*LEVELS, "prefix").alias("f").join(taken.alias("t"), _same("f", "t"), "left").select("f.*", "last", "ties", "same")


def mix(docs: DataFrame, weights: dict[str, dict[str, int]], target: Column, epochs: int = 2, seed: int = 1) -> DataFrame:
    """One row for each copy of a document in the mixture: its columns, tokens and epoch (from 0).

    docs needs doc_id, domain, lang, source and text; null names are names of their
    own, null texts have no tokens, columns named tokens and epoch are replaced. A leaf's last, partial epoch
    takes documents in the order of md5(seed:epoch:doc_id) (ties: doc_id, null
    first, then tokens; of rows equal in these any) as
    long as at least half of a document fits into what is left of the budget.
    Documents without tokens cost nothing and come with any epoch that reaches them.
    Ids and token counts are saved once; where each leaf's last epoch ends is found
    from sums, so a source with a third of all rows is never ordered in one task.
    An empty table gives none.
    """
    docs = docs.drop("tokens", "epoch").withColumn("tokens", n_tokens(F.col("text")))
    with Stash(docs.sparkSession) as stash:
        ids = stash.save(docs.select("doc_id", *LEVELS, "tokens"), "ids")
        leaves = ids.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
        plan = budgets(leaves, target, weights, epochs).where("tokens > 0 AND budget > 0")
        plan = stash.save(plan.select(*LEVELS, F.expr("budget DIV tokens").alias("whole"), F.expr("budget % tokens").alias("rest")), "plan")
        plan = cut(plan.alias("p").join(ends(ids, plan, stash, seed).alias("e"), _same("p", "e"), "left").select("p.*", "prefix", "last", "ties", "same"))

    rows = _ordered(docs.alias("d").join(plan.alias("p"), _same("d", "p")).select("d.*", "whole", "rest", "prefix", "last", "ties", "same"), seed)
    here = F.struct("__order", "doc_id", "tokens")
    at_last = F.coalesce(here == F.col("last"), F.lit(False))
    reached = F.when(F.col("last").isNull(), F.col("__order") < F.col("prefix")).otherwise((here < F.col("last")) | (at_last & (F.col("ties") == F.col("same"))))
    partial = F.when((F.col("rest") > 0) & reached, F.array("whole")).otherwise(F.array().cast("array<bigint>"))
    whole = F.when(F.col("whole") > 0, F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).otherwise(F.array().cast("array<bigint>"))
    out = rows.withColumn("epoch", F.explode(F.concat(whole, partial))).select(*docs.columns, "epoch")
    if plan.where("ties < same").isEmpty():
        return out
    # rows that agree in all that orders them, of which some fit
    some = rows.where(at_last & (F.col("ties") < F.col("same"))).withColumn("__k", F.row_number().over(Window.partitionBy(*LEVELS).orderBy("__order"))).where("__k <= ties")
    return out.unionByName(some.withColumn("epoch", F.col("whole")).select(*docs.columns, "epoch"))
