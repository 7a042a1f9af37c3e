"""Operators on small cases: each with one that fires and one that stays silent."""

import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from recordloom.functions import text as T
from recordloom.operators import catalogue as C, checks as V, closure as G, records as R, sections as S, spans, views as D
from recordloom.plans import rules as P
from recordloom.sources import readers, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw, want", [("a\r\nb\rc\n", "a\nb\nc\n"), ("", ""), ("\r\r\n", "\n\n")])
def test_normalize(spark, raw, want):
    assert one(spark, T.normalize(F.lit(raw))) == want == one(spark, T.normalize(T.normalize(F.lit(raw))))


def test_fold_keeps_length(spark):
    odd = "‘x’—“y” z​﻿\U0001F600"
    folded = one(spark, T.fold(F.lit(odd)))
    assert folded == "'x'-\"y\" z  \U0001F600" and len(folded) == len(odd)


@pytest.mark.parametrize("cell, want", [("-34, 10, 22", [-34, 10, 22]), ("(− 52,- 42,56)", [-52, -42, 56]), ("1 2 3", [1, 2, 3]), ("12 34", None), ("a b c", None)])
def test_triple(spark, cell, want):
    assert one(spark, T.triple(F.lit(cell))) == want


@pytest.mark.parametrize("text, crossing", [("group-by-stage", True), ("voxel-by-voxel", False), ("an interaction", True), ("plain", False)])
def test_crossing(spark, text, crossing):
    assert one(spark, T.names_a_crossing(F.lit(text))) is crossing


@pytest.mark.parametrize(
    "text, quote, start, end, exact",
    [
        ("one two two", "two", 4, 7, True), ("\U0001F600 a “b”\nc", 'a "b" c', 2, 9, False), ("x", "y", None, None, None), ("x", " ", None, None, None),
        ("a.b a+b", "a+b", 4, 7, True), ("q\\Ez", "\\E", 1, 3, True), ("curly ’s  end", "curly 's end", 0, 13, False), ("", "a", None, None, None),
    ],
)
def test_resolve(spark, text, quote, start, end, exact):
    r = spans.resolve(spark.createDataFrame([(text, quote)], "text string, quote string")).first()
    assert (r.start_char, r.end_char, r.exact) == (start, end, exact)
    assert start is None or r.span == text[start:end]


def test_nearest(spark):
    df = spark.createDataFrame([("ab ab ab", "ab", 4), ("ab ab ab", "ab", 100)], "text string, quote string, near int")
    assert [r.start_char for r in spans.resolve(df, "near").collect()] == [3, 6]


def test_anchors_equal_brute_force(spark):
    words = "the quick brown fox jumps over a lazy dog today".split()
    docs = spark.createDataFrame([(i, " ".join(words[i:] + words[:i])) for i in range(10)], "doc_id long, text string")
    quotes = spark.createDataFrame([(1, "quick brown fox jumps over a lazy"), (2, "dog today the"), (3, "not there at all my good friend"), (4, "ox"), (5, "a lazy dog today"), (6, "brown")], "item_id long, quote string")
    want = sorted((d.doc_id, q.item_id, d.text.find(q.quote), d.text.find(q.quote) + len(q.quote)) for d in docs.collect() for q in quotes.collect() if q.quote in d.text)
    assert sorted(map(tuple, spans.find_exact(docs, quotes).collect())) == want and {w[1] for w in want} == {1, 2, 4, 5, 6}


def test_caseless(spark):
    from recordloom.functions import text as T

    letters = [chr(c) for r in (range(0x41, 0x590), range(0x1E00, 0x2000), range(0xFB00, 0xFB07)) for c in r]
    got = spark.createDataFrame([(c,) for c in letters], "c string").select("c", T.caseless("c").alias("f")).collect()
    assert not [(r.c, r.f) for r in got if r.f != r.c.casefold()]


def test_layers_and_chains(spark):
    from recordloom.operators import closure as G

    edges = spark.range(9 * 16).selectExpr("id DIV 16 AS a", "id % 4 AS x", "id DIV 4 % 4 AS y").selectExpr("a * 4 + x AS src", "(a + 1) * 4 + y AS dst")
    got = G.closure(edges, spark.createDataFrame([(0,)], "node long")).collect()
    assert sorted((r.node, r.depth) for r in got) == [(0, 0)] + [(k, k // 4) for k in range(4, 40)]


def test_slice_without_heading(spark):
    docs = spark.createDataFrame([(1, "# A\nx")], "doc_id long, text string")
    assert S.slice_section(docs, "A").first().text == "# A\nx" and S.slice_section(docs, "B", missing="null").first().text is None
    with pytest.raises(Exception, match="no heading 'B'"):
        S.slice_section(docs, "B").collect()


@pytest.mark.parametrize("s, e, span, status", [(0, 3, "one", "ok"), (1, 4, "one", "text_differs"), (3, 3, "", "out_of_range"), (0, 99, "one", "out_of_range"), (None, 3, "one", "not_integer")])
def test_verify(spark, s, e, span, status):
    df = spark.createDataFrame([("one two", s, e, span)], "text string, s int, e int, span string")
    assert df.select(spans.verify("text", "s", "e", "span").alias("x")).first().x == status


def test_sections(spark):
    text = "# T\n## A\nx\n### B\ny\n## \n#### D\nz\n## C\n"
    docs = spark.createDataFrame([(1, text), (2, "no heading"), (3, "")], "doc_id long, text string")
    got = {r.title: r for r in S.build_sections(docs).collect()}
    assert [got[t].parent_section for t in "TABCD"] == [None, "T", "A", "T", "A"] or got["D"].parent_section in ("A", "B")
    assert text[got["A"].start_char : got["A"].end_char] == "## A\nx\n### B\ny\n"
    assert got["T"].end_char == len(text)
    paths = S.section_path(S.build_sections(docs), spark.createDataFrame([(1, text.index("y")), (2, 0)], "doc_id long, offset long"))
    assert {r.doc_id: r.path for r in paths.collect()} == {1: "T > A > B", 2: None}
    assert S.slice_section(docs, "A").first().text.startswith("## A")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=10))
def test_closure(spark, pairs):
    edges = spark.createDataFrame(sorted(set(pairs)), "src long, dst long")
    roots = edges.selectExpr("src AS node").distinct()
    got = {(r.root, r.node) for r in G.closure(edges, roots).collect()}
    want = set()
    for root in {a for a, _ in pairs}:
        seen, todo = {root}, [root]
        while todo:
            x = todo.pop()
            for a, b in pairs:
                if a == x and b not in seen:
                    seen.add(b)
                    todo.append(b)
        want |= {(root, n) for n in seen}
    assert got == want
    assert {r.node for r in G.reachable(edges, roots.limit(1)).collect()} == {n for r, n in want if r == min(a for a, _ in want if a == roots.limit(1).first().node)}


def test_deviations():
    schema = {"A": {"x": {"range": "string", "description": "d"}}}
    out = C.apply_deviations(schema, [{"op": "add_slot", "class": "A", "slot": "y", "definition": {}, "why": "w"}, {"op": "describe_slot", "class": "A", "slot": "x", "text": "more", "why": "w"}, {"op": "add_class", "class": "B", "why": "w"}, {"op": "drop_slot", "class": "A", "slot": "y", "why": "w"}])
    assert out == {"A": {"x": {"range": "string", "description": "d more"}}, "B": {}}
    with pytest.raises(KeyError):
        C.apply_deviations(schema, [{"op": "drop_slot", "class": "A", "slot": "q", "why": "w"}])
    with pytest.raises(ValueError):
        C.apply_deviations(schema, [{"op": "drop_class", "class": "A"}])


def test_catalogue_edges(spark):
    classes = spark.createDataFrame([("A", None, True), ("B", "A", True)], "class string, parent string, tree_root boolean")
    with pytest.raises(Exception, match="one tree root"):
        C.tree_root(classes).collect()
    slots = spark.createDataFrame([("A", "x", 1)], "class string, attr string, ord int")
    assert [r.attr for r in C.add_required(slots, spark.createDataFrame([("A", "first")], "class string, attr string")).orderBy("ord").collect()] == ["first", "x"]
    with pytest.raises(ValueError):
        C.add_required(slots, spark.createDataFrame([("Q", "first")], "class string, attr string"))
    uses = spark.createDataFrame([("E", False, "old", 1), ("E", False, "new", 2), ("E", True, "l", 1)], "enum string, multivalued boolean, declaration string, ord int")
    assert {(r.wrapper, r.declaration) for r in C.enum_wrappers(uses).collect()} == {("ExtractedE", "new"), ("ExtractedEList", "l")}
    enums = spark.createDataFrame([("m", "E")], "module string, enum string")
    placed = C.place_modules(spark.createDataFrame([("m", "A")], "module string, class string"), enums, C.enum_wrappers(uses))
    assert {(r.kind, r.n) for r in C.describe(placed).collect()} == {("class", 1), ("enum", 1), ("wrapper", 2)}


def test_merge_payloads(spark):
    a = {"study": {"name": "x", "n": 1}, "groups": [{"local_id": "g1"}], "odd": 1}
    b = {"study": {"name": "y"}, "groups": [{"local_id": "g2"}], "tasks": []}
    p = spark.createDataFrame([("s", 1, "a", json.dumps(a)), ("s", 2, "b", json.dumps(b))], "study_id string, rank int, file string, j string").withColumn("payload", F.try_parse_json("j"))
    attributes, entities, found = R.merge_payloads(p, ["groups", "tasks"])
    assert {r.key: r.value for r in attributes.collect()} == {"name": '"y"', "n": "1"}
    assert [json.loads(r.entity)["local_id"] for r in entities.orderBy("pos").collect()] == ["g1", "g2"]
    assert {(r.path, r.code) for r in found.collect()} == {("odd", "unknown_key"), ("study.name", "overwritten")}


def test_wrappers(spark):
    rec = {"a": {"extraction_status": "extracted", "value": 1}, "b": [{"c": {"extraction_status": "not_reported"}}], "d": {"x": 1}}
    df = spark.createDataFrame([(1, json.dumps(rec))], "id long, j string").withColumn("record", F.parse_json("j"))
    assert {(r.path, r.status) for r in R.wrappers(df).select("path", "status").collect()} == {("a", "extracted"), ("b[0].c", "not_reported")}


def test_small_repairs(spark):
    levels = spark.createDataFrame([("t", "Healthy controls"), ("u", "AD"), ("u", "ad")], "term_id string, level string")
    cells = spark.createDataFrame([("t", "healthy  controls"), ("t", "Healthy controls"), ("u", "Ad"), ("t", "AD group")], "term_id string, level string")
    got = {(r.term_id, r.level, r.aligned) for r in R.align_levels(cells, levels, ["term_id"]).collect()}
    assert got == {("t", "Healthy controls", True), ("t", "Healthy controls", False), ("u", "Ad", False), ("t", "AD group", False)}
    keys = spark.createDataFrame([(1, "study.groups"), (1, "title"), (1, "groups"), (1, "junk")], "id long, path string")
    assert {r.path: r.new_path for r in R.normalize_keys(keys, ["groups"], ["groups", "title"]).collect()} == {"study.groups": "groups", "title": "study.title", "groups": "groups", "junk": None}
    pts = spark.createDataFrame([("a", "b", "", False), ("", "c", "", True)], "path string, message string, x string, y boolean")
    assert one(spark, D.paper_gate(F.lit(None).cast("array<string>"), F.lit("t"))) == "unknown"
    assert pts.count() == 2


def test_table_block_order_of_equal_places(spark):
    rows = [(1, 5, t, f"s{t}", "k") for t in (4, 2, 9, 1, 7, 3)] + [(1, 3, 8, "s8", "k")] + [(2, None, t, "s", "k") for t in (6, 5)] + [(2, 1, 9, "s", "k")]
    for part in (rows, rows[::-1]):
        got = R.table_block(spark.createDataFrame(part, "study_id long, pos long, table_id long, space string, kind string")).orderBy("study_id", "index").collect()
        assert [(r.study_id, r.table_id) for r in got] == [(1, 8), (1, 1), (1, 2), (1, 3), (1, 4), (1, 7), (1, 9), (2, 9), (2, 5), (2, 6)]


def test_cycle_and_scope(spark):
    models = spark.createDataFrame([("a",), ("b",)], "model_id string")
    inputs = spark.createDataFrame([("a", "b"), ("b", "a")], "model_id string, input_id string")
    assert {r.path for r in V.stage_cycles(inputs, models, []).collect()} == {"a > b > a", "b > a > b"}
    terms = spark.createDataFrame([("a", "x"), ("b", "x")], "model_id string, term_id string")
    assert {(r.root, r.owner) for r in V.terms_in_scope(inputs, models, terms, []).collect()} == {("a", "a"), ("b", "b")}


KINDS = [
    ([("g", "a", "positive"), ("g", "b", "negative")], {}, "contrast"), ([("g", "a", "positive")], {}, "simple_effect"), ([("g", "a", "undirected"), ("g", "b", "undirected")], {}, "omnibus"),
    ([("g", "a", "positive"), ("g", "b", "negative"), ("h", "c", "positive"), ("h", "d", "negative")], {}, "interaction"), ([("p", None, "positive")], {"p": ("categorical", None, True)}, "interaction"),
    ([("p", None, "undirected")], {"p": ("categorical", None, True)}, "omnibus"), ([("c", None, "positive")], {"c": ("continuous", "within_subject", False)}, "parametric_modulation"),
    ([("c", None, "negative")], {"c": ("continuous", "between_subject", False)}, "cross_subject_regression"), ([("g", "a", "held")], {}, None), ([("g", "a", "undirected"), ("g", "b", "held")], {}, None),
    ([("g", "a", "not_reported"), ("g", "b", "not_reported")], {}, "contrast"), ([("c", None, "positive")], {"c": ("continuous", None, False)}, None), ([("g", "a", "positive"), ("g", "b", "held")], {}, "simple_effect"),
]


@pytest.mark.parametrize("cells, terms, kind", KINDS)
def test_effect_kind(spark, cells, terms, kind):
    rows = [(1, t, lv, d, *terms.get(t, ("categorical", None, False)), True) for t, lv, d in cells]
    df = spark.createDataFrame(rows, "analysis_id long, term_id string, level string, direction string, term_type string, variation string, is_product boolean, in_scope boolean")
    assert D.effect_kind(df, ["analysis_id"]).first().kind == kind


def test_rules(spark):
    df = spark.createDataFrame([("s", "p", "region", None), ("s", "q", "region", "r1"), ("s", "r", "whole", None)], "study_id string, path string, scope string, regions string")
    rule = {"preconditions": {"slot_conditions": {"scope": {"equals_string": "region"}}}, "postconditions": {"slot_conditions": {"regions": {"value_presence": "PRESENT"}}}}
    assert [r.path for r in P.check_rules(df, [("x", rule)]).collect()] == ["p"]
    with pytest.raises(P.Unsupported):
        P.condition({"exactly_one_of": []})
    assert P.verdict(P.check_rules(df.where("path = 'r'"), [("x", rule)]))


def test_readers(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_bytes(b"x\r\ny")
    assert readers.read_texts(spark, str(tmp_path / "d")).first().text == "x\ny"
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "b.json").write_text('{"study": {}}')
    (tmp_path / "s1" / "c.json").write_text("{")
    (tmp_path / "s1" / "aliases.json").write_text('{"aliases": {"o": "n"}}')
    got = {r.file: (r.study_id, r.rank, r.problem is None) for r in readers.read_payloads(spark, str(tmp_path / "s1")).drop("payload").collect()}
    assert got == {"b.json": ("s1", 1, True), "c.json": ("s1", 2, False)}
    assert [tuple(r) for r in readers.read_aliases(spark, str(tmp_path / "s1")).collect()] == [("s1", "o", "n")]
    (tmp_path / "t.jsonl").write_text('{"table_id": "a", "contains_coordinates": true, "metadata": {"data_path": "x/y/t1.csv"}}\n\n{"table_id": "b", "contains_coordinates": true, "metadata": {"data_path": "t2.csv"}}\n')
    m = readers.read_manifest(spark, str(tmp_path / "t.jsonl"))
    assert [(r.line, r.data_file) for r in m.orderBy("line").collect()] == [(1, "t1.csv"), (3, "t2.csv")]
    kept, warned = readers.with_files(m, spark.createDataFrame([("t1.csv",)], "data_file string"))
    assert kept.count() == 1 and warned.first().table_id == "b"
    assert readers.read_manifest(spark, str(tmp_path / "none.jsonl")).isEmpty()
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "g.csv").write_text('a,b\n"x, y\nz"\n1,2,3\n')
    assert [r.cells for r in readers.read_grids(spark, str(tmp_path / "g")).orderBy("row").collect()] == [["a", "b"], ["x, y\nz"], ["1", "2", "3"]]
    good, bad = readers.parse_list(spark.createDataFrame([("1\ts",), ("# c",), ("",), ("broken",), ("2\tt\tz",)], "value string"))
    assert {tuple(r) for r in good.collect()} == {("1", "s", None), ("2", "t", "z")} and bad.count() == 1
    x = spark.createDataFrame([(1, "<article><article-title>T</article-title><kwd>k</kwd><abstract><p>A</p></abstract><body><p>B</p></body></article>")], "doc_id long, xml string")
    assert readers.article_text(x).first().text == "T\n\nk\n\nA\n\nB"
    y = spark.createDataFrame([(1, "<article><article-title>a &lt; b &amp;amp; c</article-title><kwd>k</kwd><kwd> </kwd><kwd>l</kwd><abstract><p>A</p></abstract><abstract kind='x'><p>A2</p></abstract><body><sec><title>S</title><p>one <xref>1</xref></p><table-wrap><td>9</td></table-wrap><p>two</p><table-wrap/><table-wrap>8</table-wrap></sec></body></article>")], "doc_id long, xml string")
    assert readers.article_text(y).first().text.startswith("a < b &amp; c\n\nk, l\n\nA\n\nA2\n\nS\n\none 1\n\ntwo")
    assert "one 1\n\n[placeholder-1]\n\ntwo" in readers.article_text(y, keep_tables=True).first().text
    for name, text in (("a", "imports: [b]\nclasses: {X: 1}"), ("b", "classes: {Y: 2, X: 0}")):
        (tmp_path / "schema").mkdir(exist_ok=True)
        (tmp_path / "schema" / f"{name}.yaml").write_text(text)
    pytest.importorskip("yaml")
    assert readers.merge_schema(readers.read_schema(readers.yaml_modules(spark, str(tmp_path / "schema")), "a"), "classes") == {"X": 1, "Y": 2}
    modules = {"a": {"imports": ["b"], "classes": {"X": 1}}, "b": {"imports": ["a"], "classes": {"X": 0, "Y": 2}}}
    assert readers.merge_schema(readers.read_schema(modules.get, "a"), "classes") == {"X": 1, "Y": 2}
    with pytest.raises(FileNotFoundError):
        readers.read_schema({"a": {"imports": ["z"]}}.get, "a")


def test_tidy_returns_native_memory(spark):
    from recordloom.session import tidy

    assert tidy(spark) is True


def test_sinks_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, "b")], "id long, v string")
    sinks.write_checked(df, str(tmp_path / "c"))
    for _ in range(2):
        sinks.write_once(df, str(tmp_path / "once"), "id")
    assert spark.read.parquet(str(tmp_path / "once")).count() == 2
    sinks.write_records(df, str(tmp_path / "r"))
    assert {r.value for r in spark.read.text(str(tmp_path / "r")).collect()} == {'{"id":1,"v":"é"}', '{"id":2,"v":"b"}'}
    sinks.write_provenance(spark.createDataFrame([(1, "t", "no")], "doc_id long, text string, declared string"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).first().drifted
    from recordloom.streaming.incremental import follow

    for _ in range(2):
        follow(spark, str(tmp_path / "c"), df.schema, "id", lambda b: b.withColumn("n", F.length("v")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        df.where("id = 2").union(spark.createDataFrame([(3, "new")], df.schema)).write.mode("append").parquet(str(tmp_path / "c"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
