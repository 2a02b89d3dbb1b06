"""Readers: files and marked texts as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh.functions import text as T


def manifest(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, name, size, modified, sha, job_id) of the files below a folder; contents are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.substring(F.sha2("content", 256), 1, 16).alias("sha"), F.substring(F.sha2(F.col("path").cast("binary"), 256), 1, 12).alias("job_id"))


def whole_texts(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(path, name, text), a row per file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def entity_lines(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """(job, entity, type, layer, section, context) of JSON lines files; the job is the parent folder."""
    schema = "entity string, type string, layer string, section string, context string"
    files = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(folder)
    return files.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1).alias("job"), "*")


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(entry): lines that are neither blank nor comments, each once, longest first."""
    lines = spark.read.text(path).select(T.strip(F.col("value")).alias("entry")).where("entry <> '' and not startswith(entry, '#')")
    return lines.distinct().orderBy(F.desc(F.length("entry")), "entry")


def sidecars(spark: SparkSession, folder: str, pattern: str, schema: str) -> DataFrame:
    """JSON side files with their job (the parent folder)."""
    files = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(folder)
    return files.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1).alias("job"), "*")


def table_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, cells) of Markdown pipe tables: separators are dropped, blank cells keep their place."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line", "t")).withColumn("t", T.strip(F.col("t"))).where("startswith(t, '|') and not t rlike '^[|\\\\s:-]+$'")
    inner = F.regexp_replace("t", r"^\||\|$", "")
    return lines.select(key, "line", F.transform(F.split(inner, r"\|"), T.strip).alias("cells"))


def html_meta(html: Column, name: str) -> Column:
    """Content of a meta tag; empty if there is none."""
    return F.regexp_extract(html, rf"""(?is)<meta[^>]+name=["']{name}["'][^>]+content=["']([^"']*)["']""", 1)


def html_title(html: Column) -> Column:
    return T.strip(F.regexp_extract(html, "(?is)<title>(.*?)</title>", 1))


def html_text(html: Column) -> Column:
    """Text of a page: scripts, styles and tags removed, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(html, "(?is)<(script|style)[^>]*>.*?</\\1>", " "), "(?s)<[^>]+>", " ")
    return T.strip(F.regexp_replace(bare, r"\s+", " "))


def json_file(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The object, or the objects of the list, in one JSON file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def json_text(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """The same of a text, as read from standard input."""
    return spark.createDataFrame([(text,)], "value string").select(F.from_json("value", schema).alias("v")).select("v.*")


def graph_tables(spark: SparkSession, path: str, lists: tuple[str, ...] = ("layers",), flags: tuple[str, ...] = ("transversal",), numbers: tuple[str, ...] = ("weight", "frequency")) -> tuple[DataFrame, DataFrame]:
    """(nodes with nid, edges with src and dst) of a GraphML file, their data as columns.

    The file holds text only: lists are cut at bars, flags are true where they say
    so in any case, and numbers are doubles.
    """

    def table(row: str, ends: dict[str, str]) -> DataFrame:
        schema = ", ".join(f"_{k} string" for k in ends) + ", data array<struct<_key: string, _VALUE: string>>"
        rows = spark.read.format("xml").option("rowTag", row).schema(schema).load(path)
        rows = rows.select(*(F.col(f"_{k}").alias(v) for k, v in ends.items()), F.map_from_entries(F.transform(F.coalesce("data", F.array().cast("array<struct<_key:string,_VALUE:string>>")), lambda d: F.struct(d["_key"], d["_VALUE"]))).alias("_data"))
        keys = sorted(r.k for r in rows.select(F.explode(F.map_keys("_data")).alias("k")).distinct().collect())  # the attributes' names
        value = lambda k: F.element_at("_data", F.lit(k))

        def column(k: str):
            if k in lists:
                return F.when(F.coalesce(value(k), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(value(k), r"\|"))
            if k in flags:
                return F.coalesce(F.lower(value(k)) == "true", F.lit(False))
            return value(k).cast("double") if k in numbers else value(k)

        return rows.select(*ends.values(), *(column(k).alias(k) for k in keys))

    return table("node", {"id": "nid"}), table("edge", {"source": "src", "target": "dst"})


def graphml(spark: SparkSession, path: str, row: str = "node") -> DataFrame:
    """Rows of a GraphML file: node or edge elements."""
    return spark.read.format("xml").option("rowTag", row).load(path)
