"""Declarative class rules compiled to columns, and the schedule of checks.

A rule is {preconditions, postconditions}; each is a tree of slot_conditions
{slot: {equals_string, equals_string_in, value_presence, any_of}}, any_of, all_of,
none_of. A record breaks a rule when the preconditions hold and the postconditions
don't. A keyword that isn't known is reported, never passed over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

FINDING = ["study_id", "path", "severity", "code", "message"]
SLOT_WORDS = ("equals_string", "equals_string_in", "value_presence", "any_of", "none_of", "all_of")
TREE_WORDS = ("slot_conditions", "any_of", "all_of", "none_of")


class Unsupported(ValueError):
    pass


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def _slot(value: Column, says: dict) -> Column:
    parts = []
    for word, arg in says.items():
        if word == "equals_string":
            parts.append(F.coalesce(value.cast("string") == arg, F.lit(False)))
        elif word == "equals_string_in":
            parts.append(F.coalesce(value.cast("string").isin(*arg), F.lit(False)))
        elif word == "value_presence":
            parts.append(value.isNotNull() if arg == "PRESENT" else value.isNull())
        elif word in ("any_of", "all_of", "none_of"):
            inner = [_slot(value, x) for x in arg]
            parts.append({"any_of": _any(inner), "all_of": _all(inner), "none_of": ~_any(inner)}[word])
        else:
            raise Unsupported(word)
    return _all(parts)


def condition(tree: dict, slot=F.col) -> Column:
    """A condition tree as a boolean column that is never null."""
    parts = []
    for word, arg in tree.items():
        if word == "slot_conditions":
            parts += [_slot(slot(name), says) for name, says in arg.items()]
        elif word in TREE_WORDS:
            inner = [condition(x, slot) for x in arg]
            parts.append({"any_of": _any(inner), "all_of": _all(inner), "none_of": ~_any(inner)}[word])
        else:
            raise Unsupported(word)
    return _all(parts)


def breaks(rule: dict, slot=F.col) -> Column:
    return condition(rule.get("preconditions", {}), slot) & ~condition(rule.get("postconditions", {}), slot)


def findings(df: DataFrame, code, message, where: Column, severity: str = "error", study: str = "study_id", path: str = "path") -> DataFrame:
    """The rows for which ``where`` holds, in the common form."""
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.where(where).select(F.col(study).cast("string").alias("study_id"), F.col(path).cast("string").alias("path"), F.lit(severity).alias("severity"), text(code).alias("code"), text(message).alias("message"))


def check_rules(records: DataFrame, rules: list[tuple[str, dict]]) -> DataFrame:
    """Findings of named rules over (study_id, path, slots...); an unsupported rule gives one finding for the whole table."""
    out = None
    for name, rule in rules:
        try:
            found = findings(records, f"rule:{name}", f"breaks {name}", breaks(rule))
        except Unsupported as e:
            found = records.sparkSession.createDataFrame([(None, None, "error", f"rule:{name}", f"unsupported keyword {e}")], ", ".join(f"{c} string" for c in FINDING))
        out = found if out is None else out.unionByName(found)
    return out


def run_checks(checks: list) -> DataFrame:
    """One table of all checks' findings; the checks are thunks that give finding frames, in order."""
    return reduce(lambda a, b: a.unionByName(b), [c().withColumn("check", F.lit(i)) for i, c in enumerate(checks)])


def render(found: DataFrame, most: int = 5) -> DataFrame:
    """study_id, n, text: the first findings in order and how many more."""
    from ..operators.records import digest

    line = F.concat(F.col("severity"), F.lit(" "), F.col("path"), F.lit(": "), F.col("message"))
    return digest(found, ["study_id"], ["severity", "path", "code"], line, most)


def verdict(found: DataFrame) -> bool:
    """Whether nothing is an error; warnings never fail."""
    return found.where("severity = 'error'").isEmpty()
