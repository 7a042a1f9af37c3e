"""Readers: text, payloads, manifests, ragged grids, lists, articles."""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import normalize, text_hash


def basename(path) -> Column:
    return F.regexp_extract(F.col(path) if isinstance(path, str) else path, r"([^/]+)/?$", 1)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (file name without ending), text (LF line ends), sha256."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace(basename(F.col("_metadata.file_path")), r"\.[^.]*$", "").alias("doc_id"), normalize("value").alias("text"))
    return raw.withColumn("sha256", text_hash("text"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """study_id (folder), file, rank (by name), payload VARIANT, problem; ``aliases.json`` is left out."""
    raw = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").text(path, wholetext=True)
    raw = raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("study_id"), F.col("_metadata.file_name").alias("file"), "value").where("file != 'aliases.json'")
    parsed = raw.select("study_id", "file", F.try_parse_json("value").alias("payload"))

    return parsed.withColumn("rank", F.row_number().over(Window.partitionBy("study_id").orderBy("file"))).withColumn("problem", F.when(F.col("payload").isNull(), "not JSON, or a key stands twice"))


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """study_id, alias, target from ``aliases.json`` files."""
    raw = spark.read.option("pathGlobFilter", "aliases.json").option("recursiveFileLookup", "true").text(path, wholetext=True)
    got = raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("study_id"), F.from_json("value", "aliases map<string,string>").alias("j"))
    return got.select("study_id", F.explode("j.aliases").alias("alias", "target"))


MANIFEST = "table_id string, table_number string, caption string, footer string, contains_coordinates boolean, metadata struct<table_label:string,data_path:string>"


def parse_manifest(lines: DataFrame) -> DataFrame:
    """(line from 1, value) -> one row per filled line: line, the manifest's fields, data_file (basename). Blank lines count but give none."""
    got = lines.where("trim(value) != ''").select("line", F.from_json("value", MANIFEST).alias("m"))
    return got.select("line", "m.table_id", "m.table_number", "m.caption", "m.footer", "m.contains_coordinates", F.col("m.metadata.table_label").alias("label"), basename(F.col("m.metadata.data_path")).alias("data_file"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSONL manifest; a missing file is an empty one."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return parse_manifest(spark.createDataFrame([], "line int, value string"))
    lines = whole.select(F.posexplode(F.split(normalize("value"), "\n")).alias("line", "value"))
    return parse_manifest(lines.withColumn("line", F.col("line") + 1))


def with_files(manifest: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Coordinate tables whose data_file exists, and a warning row for each one that doesn't."""
    wanted = manifest.where("contains_coordinates")
    present = files.select("data_file").distinct()
    missing = wanted.join(present, "data_file", "left_anti").select("table_id", F.concat(F.lit("no file "), F.coalesce("data_file", F.lit("?"))).alias("warning"))
    return wanted.join(present, "data_file", "left_semi"), missing


def parse_grids(files: DataFrame) -> DataFrame:
    """(table_id, value) CSV texts -> table_id, row (from 0), cells: ragged rows as they are.

    CSV's quoting spans lines, so each text is read whole by Python's csv module in
    Arrow batches.
    """

    def run(frames):
        for frame in frames:
            out = [(t, i, cells) for t, value in zip(frame.table_id, frame.value) for i, cells in enumerate(csv.reader(io.StringIO(value or "", newline="")))]
            yield pd.DataFrame(out, columns=["table_id", "row", "cells"])

    return files.select(F.col("table_id").cast("string").alias("table_id"), "value").mapInPandas(run, "table_id string, row int, cells array<string>")


def read_grids(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("pathGlobFilter", "*.csv").text(path, wholetext=True)
    return parse_grids(raw.select(basename(F.col("_metadata.file_path")).alias("table_id"), "value"))


def parse_list(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(value) lines ``id<TAB>study[<TAB>axis]`` -> rows and malformed lines; ``#`` begins a comment."""
    kept = lines.where("trim(value) != '' AND NOT startswith(ltrim(value), '#')").withColumn("p", F.split("value", "\t"))
    good = F.size("p").isin(2, 3)
    return kept.where(good).select(F.trim(F.col("p")[0]).alias("id"), F.trim(F.col("p")[1]).alias("study"), F.trim(F.get("p", F.lit(2))).alias("axis")), kept.where(~good).select(F.concat(F.lit("malformed: "), "value").alias("warning"))


def read_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_list(spark.read.text(path))


def first_of(keys: DataFrame, key: str, sources: list[tuple[str, DataFrame]], value: str) -> tuple[DataFrame, DataFrame]:
    """Each key's value from the first source that has it (with the source's name), and a warning for keys none has."""
    out = keys.select(key).distinct()
    for i, (_, s) in enumerate(sources):
        out = out.join(s.select(key, F.col(value).alias(f"__v{i}")), key, "left")
    name = F.coalesce(*[F.when(F.col(f"__v{i}").isNotNull(), F.lit(n)) for i, (n, _) in enumerate(sources)])
    out = out.select(key, F.coalesce(*[F.col(f"__v{i}") for i in range(len(sources))]).alias(value), name.alias("source"))
    return out.where("source IS NOT NULL"), out.where("source IS NULL").select(key, F.lit("no source").alias("warning"))


def plain_xml(xml: Column) -> Column:
    """Text of marked-up XML: a blank line after paragraphs, titles and sections, tags gone, references to characters decoded."""
    out = F.regexp_replace(F.regexp_replace(xml, r"(?s)<!--.*?-->", ""), r"</(?:p|title|sec|abstract|list-item|caption)>", "\n\n")
    out = F.regexp_replace(out, r"(?s)<[^>]+>", "")
    for name, letter in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("#160", "\u00a0"), ("#8211", "–"), ("#8217", "’"), ("amp", "&")):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(letter))
    return F.trim(F.regexp_replace(out, r"[ \t]*\n(?:[ \t]*\n)+[ \t]*", "\n\n"), F.lit(" \t\n"))


def article_text(xml: DataFrame, keep_tables: bool = False) -> DataFrame:
    """(doc_id, xml) articles -> doc_id, text: title, keywords, all abstracts and the body with blank lines between, empty parts left out.

    Cross-references keep their text. Tables go, or with ``keep_tables`` leave
    ``[placeholder-N]``, from 1 in order, for ``spans.place_tables``.
    """
    first = lambda tag: F.regexp_extract("xml", rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    every = lambda tag: F.regexp_extract_all("xml", F.lit(rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    filled = lambda texts, by: F.nullif(F.array_join(F.filter(F.transform(texts, plain_xml), lambda k: k != ""), by), F.lit(""))
    pieces = F.split(first("body"), r"(?s)<table-wrap\b.*?</table-wrap>", -1)
    last = F.size(pieces) - 1
    mark = lambda p, i: F.concat(p, F.when(i < last, F.concat(F.lit("\n\n[placeholder-"), i + 1, F.lit("]\n\n"))).otherwise(""))
    body = F.array_join(F.transform(pieces, mark) if keep_tables else pieces, "\n\n")
    title = F.nullif(plain_xml(first("article-title")), F.lit(""))
    return xml.select("doc_id", F.concat_ws("\n\n", title, filled(every("kwd"), ", "), filled(every("abstract"), "\n\n"), F.nullif(plain_xml(body), F.lit(""))).alias("text"))


def yaml_modules(spark: SparkSession, folder: str):
    """A ``load`` for read_schema: module ``name`` is ``folder/name.yaml``, read by Spark, wherever the folder is. Needs the yaml package."""
    import yaml

    found = {r.name: r.value for r in spark.read.text(folder, wholetext=True, pathGlobFilter="*.yaml").select(basename(F.col("_metadata.file_path")).alias("name"), "value").collect()}
    known = {k.removesuffix(".yaml"): v for k, v in found.items()}
    return lambda name: yaml.safe_load(known[name]) if name in known else None


def read_schema(load, root: str) -> dict[str, dict]:
    """Modules by name, imports before importers; ``load(name)`` gives {imports: [...], ...}. A missing import is an error, a cycle is not."""
    out: dict[str, dict] = {}
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        module = load(name)
        if module is None:
            raise FileNotFoundError(f"schema module {name}")
        for other in module.get("imports", []):
            visit(other)
        out[name] = module

    visit(root)
    return out


def merge_schema(modules: dict[str, dict], section: str) -> dict:
    """One section of all modules; a later module's entry replaces an earlier one."""
    return {k: v for m in modules.values() for k, v in m.get(section, {}).items()}
