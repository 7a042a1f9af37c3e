"""License scans: Aho-Corasick finds notice phrases and identifier tags in word sequences, shunting-yard evaluates tagged expressions."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The words of an identifier tag, and what must follow them: the rest of the line is the expression.
TAG, AFTER = "spdx license identifier", re.compile(rb"[ \t]*:[ \t]*([^\r\n]*)")
# Phrase (words as the scan sees them), label, weight as evidence.
BASE = (("cc by", "cc-by", 0.6), ("general public license", "gpl", 0.8), ("all rights reserved", "reserved", 0.5))
NOTICES = (
    ("apache license", "apache", 0.8), ("bsd license", "bsd", 0.8), ("cc by nc", "cc-by-nc", 0.8), ("cc by nd", "cc-by-nd", 0.8),
    ("cc by sa", "cc-by-sa", 0.8), ("cc0", "cc0", 0.8), ("creative commons", "cc", 0.6), ("eclipse public license", "epl", 0.8),
    ("isc license", "isc", 0.8), ("lesser general public license", "lgpl", 0.8), ("affero general public license", "agpl", 0.8),
    ("mit license", "mit", 0.8), ("mozilla public license", "mpl", 0.8), ("public domain", "public-domain", 0.4),
    ("permission is hereby granted free of charge", "mit", 0.8), ("redistribution and use in source and binary forms", "bsd", 0.8),
    ("without warranty of any kind", "no-warranty", 0.4), ("the unlicense", "unlicense", 0.6), ("licensed under", "licensed", 0.4),
    ("released under", "licensed", 0.3), (TAG, "spdx", 0.9),
)
#: Licences that an evaluation counts as allowed. (fixed values)
ALLOWED = frozenset(("0bsd", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "cc-by-4.0", "cc0-1.0", "isc", "mit", "unlicense", "zlib"))
#: Identifiers of licences and of exceptions that an expression may name, in small letters. (fixed values)
KNOWN = frozenset(
    """0bsd aal afl-2.0 afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 apsl-2.0
    artistic-1.0 artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause
    bsl-1.0 busl-1.1 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0
    cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 curl ecl-2.0 efl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.2-only gfdl-1.3-only gfdl-1.3-or-later
    gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg ipl-1.0 isc
    lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng lppl-1.3c
    mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa npl-1.1 odbl-1.0 ofl-1.0 ofl-1.1 openldap-2.8 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0
    qpl-1.0 ruby sleepycat tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1""".split()
)
EXCEPTIONS = frozenset("autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 libtool-exception linux-syscall-note llvm-exception openjdk-assembly-exception-1.0 qt-gpl-exception-1.0 u-boot-exception-2.0 wxwindows-exception-3.1".split())
#: Binding strength of the operators. (fixed values)
BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
#: Everything but 0-9, a-z and non-ASCII becomes a space, A-Z their small letters.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def postfix(text: str) -> list[str]:
    """Shunting-yard: an expression's operands and operators in postfix order. ValueError if it isn't well formed."""
    out: list[str] = []
    held: list[str] = []
    operand = False  # whether the token before ended an operand
    for token in TOKEN.findall(text):
        word = token.lower()
        if word in BINDS or word == ")":
            if not operand:
                raise ValueError(text)
            while held and held[-1] != "(" and (word == ")" or BINDS[held[-1]] >= BINDS[word]):
                out.append(held.pop())
            if word != ")":
                held.append(word)
                operand = False
            elif not held:
                raise ValueError(text)
            else:
                held.pop()
        elif operand:
            raise ValueError(text)
        elif word == "(":
            held.append(word)
        else:
            out.append(word)
            operand = True
    if not operand or "(" in held:
        raise ValueError(text)
    return out + held[::-1]


def evaluate(text: str, allowed=ALLOWED) -> tuple[bool, bool, list[str], list[str]]:
    """(well formed, allowed, licences, unknown names): ``or`` needs one allowed side, ``and`` both; ``with`` keeps its licence's answer.

    A ``+`` behind a licence (or later) keeps its answer too. Names that are in
    neither table, other than LicenseRef- ones, are unknown: they are not allowed
    and not among the licences.
    """
    text = re.sub(r"[ \t]*(\*/|-->|#\}).*$", "", text)
    try:
        steps = postfix(text)
    except ValueError:
        return False, False, [], []
    stack: list[tuple[bool, list[str]]] = []
    known: set[str] = set()
    unknown: set[str] = set()
    for step in steps:
        if step in BINDS:
            (b, right), (a, left) = stack.pop(), stack.pop()
            if step == "with":
                if len(right) == 1 and right[0] in EXCEPTIONS:
                    unknown.discard(right[0])
                    stack.append((a, [*left[:-1], f"{left[-1]} with {right[0]}"]))
                    known.update(stack[-1][1] if left[-1] not in unknown else ())
                else:
                    unknown.update(right)
                    stack.append((False, left))
            else:
                stack.append((a and b if step == "and" else a or b, left + right))
        else:
            name = step.removesuffix("+")
            (known if name in KNOWN or name.startswith("licenseref-") else unknown).add(step)
            stack.append((name in allowed, [step]))
    answer, names = stack[0]
    return True, answer, sorted({n for n in names if n in known}), sorted(unknown)


def automaton(phrases) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    merged: dict[str, list] = {}
    for phrase, label, weight, base in phrases:
        merged.setdefault(f" {phrase} ", []).append((label, weight, base))
    for phrase, values in merged.items():
        found.add_word(phrase, (len(phrase), phrase.strip(), values))
    found.make_automaton()
    return found


def scan(docs: DataFrame, base=BASE, notices=NOTICES, allowed=ALLOWED) -> DataFrame:
    """One row per document: doc_id, n_words, places, expressions, score.

    places: struct(label, phrase, word, base) for every place where a phrase's
    words stand consecutively, in order of their first word (counted from 0).
    expressions: struct(text, valid, allowed, licences, unknown) for each identifier
    tag's expression (to the end of its line). score: 0 without evidence, else 1 minus the product of (1 - weight)
    over the distinct labels. Null texts are empty, null ids stay null; repeated
    rows give equal rows, an empty table gives none; overlapping phrases all count,
    places of one word are in the order of their phrases' length. Other columns are ignored.
    """
    phrases = [(*p, True) for p in base] + [(*p, False) for p in notices]
    weights: dict[str, float] = {}
    for _, label, weight, _ in phrases:
        weights[label] = max(weight, weights.get(label, 0.0))

    def one(machine, text: str):
        raw = text.encode("utf-8", "replace")
        folded = raw.translate(FOLD)
        words = folded.split()
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        places, at, index = [], 0, 0
        for end, (size, phrase, values) in sorted(machine.iter(line), key=lambda x: x[0] - x[1][0]):
            start = end - size + 1
            index += line.count(" ", at, start)
            at = start
            places += [{"label": label, "phrase": phrase, "word": index, "base": is_base} for label, _, is_base in values]
        tags = []
        if lasts := [p["word"] + 2 for p in places if p["phrase"] == TAG]:
            ends = [m.end() for m in re.finditer(rb"[^ ]+", folded)]
            for k in dict.fromkeys(lasts):
                if said := AFTER.match(raw, ends[k]):
                    line_of = said[1].decode("utf-8", "replace")
                    valid, answer, names, unknown = evaluate(line_of, allowed)
                    tags.append({"text": line_of, "valid": valid, "allowed": answer, "licences": names, "unknown": unknown})
        rest = 1.0
        for label in sorted({p["label"] for p in places}):
            rest *= 1 - weights[label]
        return len(words), places, tags, 1 - rest if places else 0.0

    place = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.string()), ("word", pa.int64()), ("base", pa.bool_())]))
    tag = pa.list_(pa.struct([("text", pa.string()), ("valid", pa.bool_()), ("allowed", pa.bool_()), ("licences", pa.list_(pa.string())), ("unknown", pa.list_(pa.string()))]))

    def run(batches):
        machine = automaton(phrases)
        for batch in batches:
            for a in range(0, len(batch), 1000):
                ids, texts = batch.column(0)[a : a + 1000], batch.column(1)[a : a + 1000]
                found = [one(machine, t or "") for t in texts.to_pylist()]
                n, places, tags, score = zip(*found)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(places, place), pa.array(tags, tag), pa.array(score, pa.float64())], names=["doc_id", "n_words", "places", "expressions", "score"])

    schema = "doc_id long, n_words long, places array<struct<label:string,phrase:string,word:bigint,base:boolean>>, expressions array<struct<text:string,valid:boolean,allowed:boolean,licences:array<string>,unknown:array<string>>>, score double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
