"""Track documents (JSON of several shapes), listings, tags and priority picks."""

from __future__ import annotations

import ast
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, folder and raw text of each .json below ``path``, hidden files left out."""
    rows = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    name = F.element_at(F.split("path", "/"), -1)
    return rows.where(~name.startswith(".")).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))


def first_of_folder(documents: DataFrame) -> DataFrame:
    return documents.groupBy("folder").agg(F.min_by("raw", "path").alias("raw"), F.min("path").alias("path"))


def dig(raw: Column, path: str, kind: str, default=None) -> Column:
    """A nested value with a type, null or the default where it is missing or of another type."""
    value = F.try_variant_get(F.try_parse_json(raw), path, kind)
    return value if default is None else F.coalesce(value, F.lit(default))


def tempo(raw: Column) -> Column:
    """Beats per minute whether written as a number, a nested value or a numeric string; 'Unknown' is null."""
    return F.coalesce(dig(raw, "$.bpm.value", "double"), dig(raw, "$.bpm", "double"), dig(raw, "$.bpm", "string").try_cast("double"))


def beats(documents: DataFrame) -> DataFrame:
    """path, i, t of beat times written as a list, below ``beats`` or as a comma-separated text."""
    v = F.try_parse_json("raw")
    listed = F.coalesce(F.try_variant_get(v, "$.beat_times", "array<double>"), F.try_variant_get(v, "$.beats.used", "array<double>"), number_list(F.try_variant_get(v, "$.beat_times", "string")))
    return documents.select("path", F.posexplode(listed).alias("i", "t"))


def number_list(text: Column) -> Column:
    """The numbers of a comma-separated text; what is no number is dropped."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double")), lambda x: x.isNotNull())


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """onset_time, pattern of headerless rows: a time, then the steps; what is no number is null."""
    parts = F.split("value", ",")
    return spark.read.text(path).select(F.trim(parts[0]).try_cast("double").alias("onset_time"), F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.trim(x).try_cast("int")).alias("pattern"))


LOG_SCHEMA = "track_name string, source string, event string, start double, end double, position string, stem string, target string, bpm double, duration_s double, schema_version string"


def read_log(spark: SparkSession, path: str, schema: str = LOG_SCHEMA) -> DataFrame:
    """The event log as ``append_csv`` writes it, read by its header; columns that a file lacks are null."""
    return spark.read.option("header", "true").option("enforceSchema", "false").schema(schema).csv(path)


def read_rules(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rules and event definitions of a rule file, read as literals and never run.

    The file assigns ``STYLE_DEFINITIONS`` (group -> style -> rules) or ``DEFINITIONS`` (name -> target, stem, position, conditions,
    style_tag), the last assignment of a name counts; other statements are left out.  Rules come as (style_group, style, feature, op, value,
    mode), definitions as (name, target, stem, position, condition, value, style_tag), a row per condition, its value as JSON.
    """
    found: dict = {}
    for node in ast.parse("\n".join(r.value for r in spark.read.text(path).collect())).body:  # a rule file, not data
        if isinstance(node, ast.Assign) and isinstance(node.targets[0], ast.Name) and node.targets[0].id in ("STYLE_DEFINITIONS", "DEFINITIONS"):
            found[node.targets[0].id] = ast.literal_eval(node.value)
    rules = [(g, s, r["feature"], r["op"], float(r["value"]), r.get("mode")) for g, styles in found.get("STYLE_DEFINITIONS", {}).items() for s, body in styles.items() for r in body.get("rules", [])]
    defs = [(n, d.get("target"), d.get("stem"), d.get("position"), c, json.dumps(v), d.get("style_tag")) for n, d in found.get("DEFINITIONS", {}).items() for c, v in d.get("conditions", {}).items()]
    return spark.createDataFrame(rules, "style_group string, style string, feature string, op string, value double, mode string"), spark.createDataFrame(defs, "name string, target string, stem string, position string, condition string, value string, style_tag string")


def with_mix(stems: DataFrame, mix: DataFrame, name: str = "mix") -> DataFrame:
    """Streams of the stems and of the mix as one relation (``track_id``, ``stem``, ``t``, ``v``)."""
    return stems.unionByName(mix.withColumn("stem", F.lit(name)).select(*stems.columns))


def list_files(spark: SparkSession, path: str, extensions: tuple[str, ...]) -> DataFrame:
    """path, name, extension, bytes of the files below ``path`` with one of the (lower-case) extensions."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"))
    rows = rows.withColumns({"name": F.element_at(F.split("path", "/"), -1), "extension": F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))})
    return rows.where(F.col("extension").isin(*extensions) & ~F.col("name").startswith("."))


def sample_files(files: DataFrame, per_folder: int, most_bytes: int, seed: int) -> DataFrame:
    """Up to ``per_folder`` files a folder in an order fixed by the seed, each base name once overall."""
    rows = files.where(F.col("bytes") <= most_bytes).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    w = Window.partitionBy("folder").orderBy(F.xxhash64(F.lit(seed), "path"), "path")
    named = Window.partitionBy("name").orderBy("path")
    return rows.withColumn("k", F.row_number().over(named)).where("k = 1").withColumn("k", F.row_number().over(w)).where(F.col("k") <= per_folder).drop("k")


def pick_by_priority(rows: DataFrame, keys: list[str], column: str, priority: list[str]) -> DataFrame:
    """One row per key: the first of the priority list, else the first by name."""
    order = F.coalesce(*[F.when(F.col(column) == p, F.lit(k)) for k, p in enumerate(priority)], F.lit(len(priority)))
    return rows.groupBy(*keys).agg(F.min(F.struct(order.alias("o"), F.struct(column, *[c for c in rows.columns if c not in (*keys, column)]).alias("r"))).alias("m")).select(*keys, "m.r.*")


def tag_lines(lines: DataFrame) -> DataFrame:
    """path, tempo, key, genre of ``tag=value`` lines (path, line_no, line): the first of each kind counts."""
    parts = F.split("line", "=", 2)
    rows = lines.select("path", "line_no", F.lower(F.trim(parts[0])).alias("tag"), F.trim(F.get(parts, F.lit(1))).alias("value")).where("value is not null")
    first = lambda *names: F.min_by("value", F.when(F.exists(F.array(*map(F.lit, names)), lambda n: F.contains(F.col("tag"), n)), F.col("line_no")))
    return rows.groupBy("path").agg(*[first(*names).alias(out) for out, names in (("tempo", ("bpm", "tempo")), ("key", ("key",)), ("genre", ("genre",)))])
