"""The schema as data: classes, attributes, inheritance, projection and its checks.

classes(class, parent, is_abstract, tree_root), attributes(class, attr, ord, range,
any_of array, multivalued, inlined, identifier, designator, required, subsets array).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .closure import closure

#: How a wrapped fact of one value, or of a list, is named; an enum's wrapper takes the enum's name. (fixed values)
WRAPPERS = {"string": "ExtractedString", "integer": "ExtractedInteger", "float": "ExtractedFloat", "boolean": "ExtractedBoolean"}


def ancestry(classes: DataFrame) -> DataFrame:
    """class, ancestor, depth: each class with itself (0) and all it inherits from."""
    edges = classes.where("parent IS NOT NULL").select(F.col("class").alias("src"), F.col("parent").alias("dst"))
    return closure(edges, classes.select(F.col("class").alias("node"))).select(F.col("root").alias("class"), F.col("node").alias("ancestor"), "depth")


def own_attributes(attributes: DataFrame, name: str) -> DataFrame:
    return attributes.where(F.col("class") == name)


def attribute_ranges(attributes: DataFrame) -> DataFrame:
    """class, attr, pos, range: the declared range, then its alternatives."""
    both = F.concat(F.array(F.col("range")), F.coalesce("any_of", F.array().cast("array<string>")))
    return attributes.select("class", "attr", F.posexplode(F.filter(both, lambda r: r.isNotNull())).alias("pos", "range"))


def is_selected(subset: str) -> Column:
    return F.array_contains("subsets", subset) | F.col("identifier") | F.col("designator")


def attributes_for(classes: DataFrame, attributes: DataFrame) -> DataFrame:
    """Each class's attributes with the inherited ones; the nearest declaration wins. Adds declared_in."""
    a = ancestry(classes).join(attributes.withColumnRenamed("class", "ancestor"), "ancestor")
    nearest = F.row_number().over(Window.partitionBy("class", "attr").orderBy("depth"))
    return a.withColumn("__k", nearest).where("__k = 1").drop("__k", "depth").withColumnRenamed("ancestor", "declared_in")


def subclasses(classes: DataFrame, name: str) -> DataFrame:
    """Strict descendants."""
    return ancestry(classes).where((F.col("ancestor") == name) & (F.col("depth") > 0)).select("class")


def resolves_to(classes: DataFrame) -> DataFrame:
    """(class, ancestor) pairs for which class is an ancestor or itself."""
    return ancestry(classes).select("class", "ancestor")


def type_designator(classes: DataFrame, attributes: DataFrame) -> DataFrame:
    return attributes_for(classes, attributes).where("designator").select("class", "attr")


def designated_type(records: DataFrame, classes: DataFrame) -> DataFrame:
    """(declared, named) -> adds class: the named one when it is the declared one or below it, else the declared."""
    a = ancestry(classes).select(F.col("class").alias("__c"), F.col("ancestor").alias("__a"))
    return records.join(a, (F.col("named") == F.col("__c")) & (F.col("declared") == F.col("__a")), "left").withColumn("class", F.coalesce("__c", "declared")).drop("__c", "__a")


def classify_slots(classes: DataFrame, attributes: DataFrame, enums: DataFrame) -> DataFrame:
    """Every class's attributes with kind: identifier, evidence, nested, reference or native."""
    a = attributes_for(classes, attributes)
    names = classes.select(F.col("class").alias("range"), F.lit(True).alias("is_class"))
    a = a.join(names, "range", "left").join(enums.select(F.col("enum").alias("range"), F.lit(True).alias("is_enum")), "range", "left")
    kind = (
        F.when(F.col("identifier"), "identifier").when(F.startswith("range", F.lit("Extracted")), "evidence")
        .when(F.col("is_class") & F.col("inlined"), "nested").when(F.col("is_class"), "reference").otherwise("native")
    )
    return a.withColumn("kind", kind).drop("is_class", "is_enum")


def reference_slots(slots: DataFrame) -> DataFrame:
    """class, slots: the names of each class's references, sorted and joined."""
    return slots.where("kind = 'reference'").groupBy("class").agg(F.array_join(F.array_sort(F.collect_set("attr")), ",").alias("slots"))


def tree_root(classes: DataFrame) -> DataFrame:
    """The only root class; an error if there is none or several."""
    roots = classes.where("tree_root")
    return roots.agg(F.count("*").alias("n"), F.max("class").alias("class")).select(F.when(F.col("n") == 1, F.col("class")).otherwise(F.raise_error(F.lit("one tree root is needed"))).alias("class"))


def reachable_classes(classes: DataFrame, attributes: DataFrame, root: DataFrame, owned_only: bool = False) -> DataFrame:
    """Classes reached from root (class) by ranges, parents and all subclasses of a range."""
    ranges = attribute_ranges(attributes.where("inlined") if owned_only else attributes)
    edges = ranges.join(classes.select(F.col("class").alias("range")), "range", "left_semi").select(F.col("class").alias("src"), F.col("range").alias("dst"))
    edges = edges.union(classes.where("parent IS NOT NULL").select("parent", "class"))
    if not owned_only:
        edges = edges.union(classes.where("parent IS NOT NULL").select("class", "parent"))
    return closure(edges.distinct(), root.select(F.col("class").alias("node"))).select(F.col("node").alias("class")).distinct()


def project(attributes: DataFrame, enums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The evidence-wrapped twin of each attribute, and the constraints that a wrapper can't keep.

    Identifiers become local_id strings, designators strings, scalars and enums
    wrappers (lists one wrapper over a list); class ranges stay. Attributes marked
    deterministic go.
    """
    a = attributes.where("NOT array_contains(subsets, 'deterministic')").join(enums.select(F.col("enum").alias("range"), F.lit(True).alias("is_enum")), "range", "left")
    base = F.lit(None).cast("string")
    for name, wrapper in WRAPPERS.items():
        base = F.when(F.col("range") == name, wrapper).otherwise(base)
    base = F.when(F.col("is_enum"), F.concat(F.lit("Extracted"), "range")).otherwise(base)
    out = F.when(F.col("identifier") | F.col("designator"), "string").when(base.isNotNull(), F.concat(base, F.when(F.col("multivalued"), "List").otherwise(""))).otherwise(F.col("range"))
    kept = a.select("class", F.when(F.col("identifier"), "local_id").otherwise(F.col("attr")).alias("attr"), out.alias("range"), (F.col("multivalued") & base.isNull()).alias("multivalued"))
    lost = a.where(base.isNotNull() & F.col("minimum").isNotNull()).select("class", "attr", F.lit("minimum").alias("dropped"), F.col("minimum").cast("string").alias("value"))
    return kept, lost


def enum_wrappers(uses: DataFrame) -> DataFrame:
    """(enum, multivalued, declaration, ord) -> one wrapper each, the last declaration wins, sorted by name."""
    w = uses.groupBy("enum", "multivalued").agg(F.max_by("declaration", "ord").alias("declaration"))
    return w.select(F.concat(F.lit("Extracted"), "enum", F.when(F.col("multivalued"), "List").otherwise("")).alias("wrapper"), "enum", "multivalued", "declaration")


def naturalize(text, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def add_required(slots: DataFrame, additions: DataFrame) -> DataFrame:
    """Additions (class, attr) stand before a class's own slots; adding to an unknown class is an error."""
    unknown = additions.join(slots.select("class").distinct(), "class", "left_anti")
    first = unknown.head(1)
    if first:
        raise ValueError(f"no class {first[0]['class']} to add to")
    both = additions.select("class", "attr", F.lit(0).alias("side"), F.lit(0).alias("o")).union(slots.select("class", "attr", F.lit(1), F.col("ord")))
    return both.select("class", "attr", F.row_number().over(Window.partitionBy("class").orderBy("side", "o", "attr")).alias("ord"))


def apply_deviations(schema: dict[str, dict], deviations: list[dict]) -> dict[str, dict]:
    """Ordered patches of a small catalogue {class: {slot: definition}}; each says why, and a missing target is an error."""
    out = {c: dict(slots) for c, slots in schema.items()}

    def need(ok: bool, d: dict):
        if not ok:
            raise KeyError(f"{d['op']} has no target: {d}")

    for d in deviations:
        if not d.get("why"):
            raise ValueError(f"a deviation must say why: {d}")
        op, c, s = d["op"], d.get("class"), d.get("slot")
        if op == "add_class":
            need(c not in out, d)
            out[c] = dict(d.get("slots", {}))
        elif op == "drop_class":
            need(c in out, d)
            del out[c]
        else:
            need(c in out and (op == "add_slot") != (s in out[c]), d)
            if op == "drop_slot":
                del out[c][s]
            elif op in ("add_slot", "replace_slot"):
                out[c][s] = d["definition"]
            elif op == "describe_slot":
                old = dict(out[c][s])
                old["description"] = f"{old.get('description', '')} {d['text']}".strip() if d.get("mode", "append") == "append" else d["text"]
                out[c][s] = old
            else:
                raise ValueError(f"unknown operation {op}")
    return out


def place_modules(classes: DataFrame, enums: DataFrame, wrappers: DataFrame) -> DataFrame:
    """module, element, kind: wrappers stand with their enum, and modules without an element are left out."""
    a = classes.select("module", F.col("class").alias("element"), F.lit("class").alias("kind"))
    b = enums.select("module", F.col("enum").alias("element"), F.lit("enum").alias("kind"))
    c = wrappers.join(enums.select("enum", "module"), "enum").select("module", F.col("wrapper").alias("element"), F.lit("wrapper").alias("kind"))
    return a.union(b).union(c)


def describe(placed: DataFrame) -> DataFrame:
    """module, kind, n."""
    return placed.groupBy("module", "kind").agg(F.count("*").alias("n"))


def unreferenced(enums: DataFrame, attributes: DataFrame) -> DataFrame:
    return enums.join(attribute_ranges(attributes).select(F.col("range").alias("enum")).distinct(), "enum", "left_anti").select("enum")


def prune(classes: DataFrame, attributes: DataFrame, subset: str, root: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes that marked attributes keep alive from the root, and required attributes that a survivor would lose."""
    marked = attributes.where(is_selected(subset))
    alive = reachable_classes(classes, marked, root)
    lost = attributes.join(alive, "class", "left_semi").where(F.col("required") & ~is_selected(subset)).select("class", "attr")
    return alive, lost


def entity_lists(classes: DataFrame, attributes: DataFrame, root: DataFrame) -> DataFrame:
    """key, path: the lists that a payload may hold. Those of the root class first, then those of its inlined single parts (one level, in their order); of one key the first counts."""
    all_ = attributes_for(classes, attributes).select("class", "attr", "ord", "range", "multivalued", "inlined")
    top = all_.join(root, "class", "left_semi")
    direct = top.where("multivalued").select(F.col("attr").alias("key"), F.col("attr").alias("path"), F.lit(-1).alias("a"), F.col("ord").alias("b"))
    parts = top.where("NOT multivalued AND inlined").select(F.col("attr").alias("part"), F.col("ord").alias("a"), F.col("range").alias("class"))
    inner = parts.join(all_.where("multivalued").select("class", "attr", F.col("ord").alias("b")), "class").select(F.col("attr").alias("key"), F.concat_ws(".", "part", "attr").alias("path"), "a", "b")
    return direct.union(inner).groupBy("key").agg(F.min_by("path", F.struct("a", "b")).alias("path"))


def unknown_rule_slots(rules: DataFrame, classes: DataFrame, attributes: DataFrame) -> DataFrame:
    """(class, rule, slot) -> class, rule, slots: the slots that a rule names and its class doesn't have, sorted and joined."""
    have = attributes_for(classes, attributes).select("class", F.col("attr").alias("slot"))
    return rules.join(have, ["class", "slot"], "left_anti").groupBy("class", "rule").agg(F.array_join(F.array_sort(F.collect_set("slot")), ", ").alias("slots"))


def unstated_members(members: DataFrame) -> DataFrame:
    """(enum, member): vocabularies that offer ``unstated``, which only a status may say."""
    return members.where("member = 'unstated'").select("enum").distinct()


def two_way(left: DataFrame, right: DataFrame, key: str, allowed: DataFrame | None = None) -> DataFrame:
    """key, side: missing (left only), extra (right only) or common; allowed keys are left out."""
    l, r = left.select(key).distinct().withColumn("l", F.lit(True)), right.select(key).distinct().withColumn("r", F.lit(True))
    out = l.join(r, key, "full_outer").select(key, F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "extra").otherwise("common").alias("side"))
    return out.join(allowed, key, "left_anti") if allowed is not None else out


def exactly_one(df: DataFrame, key: str, a: Column, b: Column) -> DataFrame:
    return df.select(key, F.when(a & b, "both").when(a | b, "one").otherwise("neither").alias("marks"))


def inventory(df: DataFrame, value: str, domain: list) -> DataFrame:
    """value, n, valid."""
    return df.groupBy(value).agg(F.count("*").alias("n")).withColumn("valid", F.col(value).cast("string").isin([str(d) for d in domain]))


def vocabulary_parity(slots: DataFrame) -> Column:
    """First failure of (source_open, target_open, enum_reached, source_many, target_many)."""
    return F.when(F.col("source_open") != F.col("target_open"), "openness").when(~F.col("enum_reached"), "enum").when(F.col("source_many") != F.col("target_many"), "cardinality").otherwise("ok")
