"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs.

A paragraph's vector has two parts. The identity part is EXACT lanes of 32 bits
from independently seeded hashes of the whole paragraph; lanes add modulo 2**32, so
the sum depends on the multiset of paragraphs alone and a paragraph is inserted or
deleted by adding or subtracting its vector. The likeness part counts, for each of
2 * PAIRS hash bits, the paragraph's shingles of GROUP words that have the bit set;
it adds the same way, and the cosine of two centred sums estimates that of the
shingle counts, with a standard error of (1 - cosine**2) / sqrt(2 * PAIRS). A word
put in or taken out touches GROUP shingles only.

xxhash64 isn't cryptographic: equality is safe against chance (EXACT * 32 bits), not
against attack.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._store import pieces

#: 32-bit lanes that decide equality; longs that hold two 32-bit likeness lanes each.
EXACT, PAIRS = 16, 64
#: Words of a shingle.
GROUP = 5
LANE = 0xFFFFFFFF
SMALLEST = -(1 << 63)
#: What separates words, beside spaces and line ends.
WHITE = "\t\r\x0b\x0c"


def paragraphs(text: Column) -> Column:
    """Lines that aren't blank."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: F.length(F.trim(F.translate(p, WHITE, " " * len(WHITE)))) > 0)


def summed(rows: DataFrame, keys: list[str], text: str, name: str = "fp") -> DataFrame:
    """keys, ``rows`` (how many have them) and ``name``, struct(exact array<long>, n long, like array<long>): the fingerprint of each key's text.

    Rows with equal keys must have equal texts. Null texts are empty. Paragraphs and
    shingles become rows and are summed at once, in generated code; nothing is
    shuffled if the input is partitioned by some of the keys.
    """
    own = rows.select(*keys, paragraphs(F.col(text)).alias("__ps"))
    own = own.select(*keys, F.posexplode(F.when(F.size("__ps") > 0, F.col("__ps")).otherwise(F.array(F.lit(None).cast("string")))).alias("__at", "__p"))
    own = own.withColumn("__words", F.split(F.trim(F.translate("__p", WHITE, " " * len(WHITE))), " +"))
    own = own.withColumn("__i", F.explode(F.sequence(F.lit(1), F.greatest(F.size("__words") - (GROUP - 1), F.lit(1)))))
    shingle = F.slice("__words", F.col("__i"), F.lit(GROUP))
    said = F.col("__p").isNotNull()
    own = own.select(*keys, "__at", "__i", "__p", said.alias("__said"), *[F.when(said, F.xxhash64(F.lit(k), shingle)).otherwise(F.lit(0).cast("long")).alias(f"__h{k}") for k in (0, 1)])
    whole = [F.when(F.col("__said") & (F.col("__i") == 1), F.xxhash64(F.lit(100 + k), "__p")).otherwise(F.lit(0).cast("long")).alias(f"__w{k}") for k in range(EXACT // 2)]
    own = own.select(*keys, ((F.col("__at") == 0) & (F.col("__i") == 1)).cast("long").alias("__first"), F.col("__said").cast("long").alias("__n"), "__h0", "__h1", *whole)
    two = F.lit((1 << 32) + 1)
    sums = [F.sum("__first").alias("__c"), F.sum("__n").alias("__n")]
    for k in range(EXACT // 2):
        sums += [F.sum(F.col(f"__w{k}").bitwiseAND(F.lit(LANE))).alias(f"__e{2 * k}"), F.sum(F.shiftrightunsigned(f"__w{k}", 32)).alias(f"__e{2 * k + 1}")]
    half = PAIRS // 2
    sums += [F.sum(F.shiftrightunsigned(f"__h{k}", s).bitwiseAND(two)).alias(f"__l{k * half + s}") for k in (0, 1) for s in range(half)]
    out = own.groupBy(*keys).agg(*sums)
    share = lambda c: F.expr(f"{c} DIV __c")  # noqa: E731  rows that agree in all keys
    exact = F.array(*[share(f"__e{k}").bitwiseAND(F.lit(LANE)) for k in range(EXACT)])
    return out.select(*keys, F.col("__c").alias("rows"), F.struct(exact.alias("exact"), share("__n").alias("n"), F.array(*[share(f"__l{k}") for k in range(PAIRS)]).alias("like")).alias(name))


def add_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the column ``name``: struct(exact, n, like). Equal texts are summed up once, after a partial aggregation."""
    keys = [f"__{name}_{k}" for k in (1, 2)]
    keyed = df.drop(name).withColumns({k: F.xxhash64(F.lit(i), F.coalesce(F.col(text), F.lit(""))) for i, k in enumerate(keys)})
    return keyed.join(summed(keyed, keys, text, name).drop("rows"), keys).drop(*keys)


def render(fp: Column) -> Column:
    """The fingerprint as text: identity lanes, number of groups, likeness lanes."""
    return F.concat(
        F.array_join(F.transform(fp["exact"], lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""), F.lit(":"), F.lower(F.hex(fp["n"])), F.lit(":"),
        F.array_join(F.transform(fp["like"], lambda x: F.lower(F.hex(x))), "."),
    )


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of the multiset union (sign 1), or of a without b's paragraphs (sign -1)."""
    lane = F.zip_with(a["exact"], b["exact"], lambda x, y: F.pmod(x + sign * y, F.lit(LANE + 1)))
    return F.struct(lane.alias("exact"), (a["n"] + sign * b["n"]).alias("n"), F.zip_with(a["like"], b["like"], lambda x, y: x + sign * y).alias("like"))


def centred(fp: Column) -> Column:
    """The likeness lanes as sums of plus and minus one."""
    return F.flatten(F.transform(fp["like"], lambda x: F.array(2 * x.bitwiseAND(F.lit(LANE)) - fp["n"], 2 * F.shiftrightunsigned(x, 32) - fp["n"])))


def likeness(a: Column, b: Column, za: Column, zb: Column) -> Column:
    """0 to 1 from two fingerprints and their centred lanes: 1 when equal, else the cosine, at least 0; 0 when just one is empty."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: (p * q).cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    norm = F.sqrt(dot(za, za) * dot(zb, zb))
    return F.when(a["exact"] == b["exact"], 1.0).when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(za, zb) / norm))).otherwise(0.0)


def with_next(docs: DataFrame, columns: list[str], prefix: str = "next_", places: bool = False) -> DataFrame:
    """Each row of (doc_id, columns) with the columns of the next row by doc_id; the first follows the last.

    With ``places`` also __r (the range), __k (the place in it) and __guest, and the
    guests' rows too.

    Null ids stand first; rows with one id are ordered by their text. Rows are
    dealt into ranges of ids whose bounds are ids themselves; the row at a bound
    also stands, as a guest, at the end of the range before, so no range needs to
    look into another; __r is the range, by which the result is partitioned.
    """
    spark = docs.sparkSession
    key = docs.withColumn("__id", F.coalesce(F.col("doc_id"), F.lit(SMALLEST)))
    n = pieces(spark, 4)
    got = key.agg(F.min("__id").alias("low"), F.percentile_approx("__id", [i / n for i in range(1, n)] or [0.5], 100 * n).alias("bounds")).first()
    low = got["low"] if got["low"] is not None else 0
    bounds = sorted({b for b in got["bounds"] or [] if b > low})
    step = max(1, int(len(bounds) ** 0.5))
    fixed = lambda xs: F.from_json(F.lit(json.dumps(xs)), "array<long>")
    coarse = F.size(F.filter(fixed(bounds[step - 1 :: step]), lambda b: b <= F.col("__id")))
    key = key.withColumn("__coarse", coarse * step)
    key = key.withColumn("__range", F.col("__coarse") + F.size(F.filter(F.slice(fixed(bounds), F.col("__coarse") + 1, F.lit(step)), lambda b: b <= F.col("__id"))))
    first_of = F.when(F.col("__range") > 0, F.get(fixed(bounds), F.col("__range") - 1))
    own = F.struct(F.col("__range").cast("int").alias("r"), F.lit(0).alias("g"))
    guests = F.when(F.col("__id") == F.lit(low), F.array(own, F.struct(F.lit(len(bounds)).alias("r"), F.lit(2).alias("g"))))
    guests = guests.when(F.col("__id") == first_of, F.array(own, F.struct((F.col("__range") - 1).cast("int").alias("r"), F.lit(1).alias("g")))).otherwise(F.array(own))
    dealt = key.withColumn("__place", F.explode(guests))
    dealt = dealt.withColumn("__r", F.col("__place")["r"]).withColumn("__g", F.col("__place")["g"])
    w = Window.partitionBy("__r").orderBy(F.col("__g") == 2, "__id", "text", "__g")
    for c in columns:
        dealt = dealt.withColumn(prefix + c, F.lead(c).over(w))
    if places:
        return dealt.select("__r", F.row_number().over(w).alias("__k"), (F.col("__g") > 0).alias("__guest"), "doc_id", *columns, *[prefix + c for c in columns])
    return dealt.where("__g = 0").select("doc_id", *columns, *[prefix + c for c in columns])


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces the last floor(n_chars / 2) code points by as many
    first ones of the next document (all it has, if fewer), in ascending doc_id;
    after the last comes the first. Null texts are empty; a single row is its own
    next. Null ids come first; rows with equal ids follow the order of their texts. Every row gives one
    row, also equal ones; an empty table gives none; other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = with_next(base, ["text"], places=True).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = both.withColumn("edited", F.when(~F.col("__guest"), edited))
    # a place in a range is one row; the range stays among the keys, so that sums are made where the rows are
    keys = ["__r", "__k", "__guest", "doc_id", "n_chars", "__sha"]
    each = both.select(*keys[:-1], F.unhex(F.sha2("edited", 256)).alias("__sha"), F.posexplode(F.array("text", "edited")).alias("__which", "__one"))
    rows = summed(each, [*keys, "__which"], "__one").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__which", "fp"))).alias("__fps"))
    rows = rows.withColumn("fp", F.col("__fps")[0]["fp"]).withColumn("efp", F.col("__fps")[1]["fp"])
    rows = rows.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("__r").orderBy("__k"))).where("NOT __guest")
    for name in ("fp", "efp", "next_fp"):
        rows = rows.withColumn(f"z_{name}", centred(F.col(name)))
    return rows.select(
        "doc_id", "n_chars", F.lower(F.hex("__sha")).alias("edited_sha256"), render(F.col("fp")).alias("fingerprint"), render(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp"), F.col("z_fp"), F.col("z_efp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp"), F.col("z_fp"), F.col("z_next_fp")).alias("near_next"),
    )
