"""Readers and writers: mesh dumps, faces, specs, transcripts, logs, packages, Markdown tables, versioned output.

Readers take a path or a DataFrame of texts; a bad document becomes a row with a problem, never an exception.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DUMP = "source string, units string, meshes array<struct<name:string, vertices:array<array<double>>, triangles:array<array<int>>, material_ids:array<int>, polygon_sizes:array<int>>>, helpers array<struct<name:string, location:array<double>>>"
FACES = "array<struct<object:string, index:int, points:array<array<double>>>>"
SPEC = "id string, spec_version string, profile string, levels array<struct<name:string, elev_m:double>>, floors array<struct<level:string, contour:array<struct<x:double, y:double, r:double>>, typical_of:string, repeat_to:string>>"


def parse_dumps(texts: DataFrame, key: str, text: str) -> dict[str, DataFrame]:
    """Mesh dumps to ``vertices``, ``triangles``, ``levels`` and ``problems``; collision meshes (UCX_) are left out.

    A triangle's corners count from 0 inside its mesh; vertices carry (mesh_id, vid).
    """
    doc = texts.select(F.col(key).alias("model_id"), F.from_json(text, DUMP).alias("d"))
    meshes = doc.select("model_id", F.posexplode("d.meshes").alias("mesh_id", "m")).where("not startswith(m.name, 'UCX_')")
    point = lambda c, i: F.col(c)[i]
    vertices = meshes.select("model_id", "mesh_id", F.posexplode("m.vertices").alias("vid", "p")).select("model_id", "mesh_id", "vid", *[point("p", i).alias(c) for i, c in enumerate("xyz")])
    triangles = meshes.select("model_id", "mesh_id", F.col("m.material_ids").alias("ids"), F.posexplode("m.triangles").alias("tri", "t")).select("model_id", "mesh_id", "tri", *[point("t", i).alias(c) for i, c in enumerate("abc")], F.get("ids", "tri").alias("material"))
    levels = doc.select("model_id", F.explode("d.helpers").alias("h")).where("startswith(h.name, 'LEVEL_')").select("model_id", F.expr("substring(h.name, 7)").alias("level"), F.col("h.location")[2].alias("elev"))
    problems = doc.where("d.meshes is null").select("model_id", F.lit("unreadable").alias("problem"))
    return {"vertices": vertices, "triangles": triangles, "levels": levels, "problems": problems}


def read_dumps(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Mesh dumps of a folder, one JSON document a file; the model is the file's name."""
    texts = spark.read.text(path, wholetext=True).withColumn("model", F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]+)?$", 1))
    return parse_dumps(texts, "model", "value")


def parse_faces(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Face lists ``[{object, index, points}]`` to corner rows ``model_id, object, face, corner, x, y, z``."""
    faces = texts.select(F.col(key).alias("model_id"), F.explode(F.from_json(text, FACES)).alias("f"))
    return faces.select("model_id", F.col("f.object").alias("object"), F.col("f.index").alias("face"), F.posexplode("f.points").alias("corner", "p")).select("model_id", "object", "face", "corner", *[F.col("p")[i].alias(c) for i, c in enumerate("xyz")])


def parse_specs(texts: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(specs, corrupt): a spec needs an id and at least one level."""
    doc = texts.select(F.col(key).alias("key"), F.col(text).alias("text"), F.from_json(text, SPEC).alias("spec"))
    good = F.col("spec.id").isNotNull() & (F.coalesce(F.size("spec.levels"), F.lit(0)) > 0)
    return doc.where(good).select("key", "spec.*"), doc.where(~good | F.col("spec").isNull()).select("key", "text")


def parse_lines(lines: DataFrame, text: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON Lines to (records, problems): the columns of ``lines`` with struct ``record``, and the lines that are no JSON object."""
    ok = F.startswith(F.trim(F.col(text)), F.lit("{")) & F.try_parse_json(text).isNotNull()
    return lines.where(ok).withColumn("record", F.from_json(text, schema)), lines.where(~ok | F.col(text).isNull())


def read_transcripts(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, unreadable lines for each file) of JSON Lines files."""
    lines = spark.read.text(path).withColumn("file", F.input_file_name())
    records, bad = parse_lines(lines, "value", schema)
    return records, bad.groupBy("file").agg(F.count("*").alias("unreadable"))


def recent(log: DataFrame, ts: str, days: int, now: Column | None = None) -> DataFrame:
    """Rows of the last days before ``now`` (the log's latest time if None)."""
    if now is None:
        return log.crossJoin(F.broadcast(log.agg(F.max(ts).alias("_now")))).where(F.col(ts) >= F.col("_now") - F.expr(f"interval {days} days")).drop("_now")
    return log.where(F.col(ts) >= now - F.expr(f"interval {days} days"))


def markdown_rows(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of pipe tables: ``key, line, cells``; an escaped pipe stays in its cell, rules of dashes are left out."""
    lines = texts.select(F.col(key).alias("key"), F.posexplode(F.split(text, "\n")).alias("line", "value")).where("value like '%|%'")
    inner = F.regexp_replace(F.trim("value"), r"^\||(?<!\\)\|$", "")
    cells = F.transform(F.split(inner, r"(?<!\\)\|"), lambda c: F.replace(F.trim(c), F.lit("\\|"), F.lit("|")))
    return lines.select("key", "line", cells.alias("cells")).where(~F.forall("cells", lambda c: c.rlike("^:?-*:?$")))


def page_index(pages: DataFrame, key: str, text: str) -> DataFrame:
    """``key, characters, needs_ocr, digest`` of document pages; a blank page needs optical reading."""
    t = F.coalesce(F.col(text), F.lit(""))
    return pages.select(F.col(key).alias("key"), F.length(F.trim(t)).cast("long").alias("characters"), (F.length(F.trim(t)) == 0).alias("needs_ocr"), F.sha2(t, 256).alias("digest"))


def _members(most_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = []
            for package, content in zip(df.package, df.content):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        seen: set[str] = set()
                        left = most_bytes
                        for info in z.infolist():
                            left -= info.file_size
                            bad = "unsafe_path" if info.filename.startswith("/") or ".." in info.filename.split("/") else "double" if info.filename in seen else "too_large" if left < 0 else None
                            seen.add(info.filename)
                            rows.append((package, info.filename, info.file_size, None if bad else z.read(info), bad))
                except (zipfile.BadZipFile, RuntimeError, ValueError, EOFError, NotImplementedError):
                    rows.append((package, None, None, None, "unreadable"))
            yield pd.DataFrame(rows, columns=["package", "path", "size", "content", "problem"])

    return run


def package_members(packages: DataFrame, most_bytes: int = 1 << 30) -> DataFrame:
    """ZIP packages (``package, content``) to their members; what is unsafe, double, too large or broken says so."""
    return packages.select("package", "content").mapInPandas(_members(most_bytes), "package string, path string, size long, content binary, problem string")


def rules_table(spark: SparkSession, profiles: dict[str, dict]) -> DataFrame:
    """Nested rule profiles to ``profile, path, value`` leaves (as JSON text)."""
    import json

    rows: list[tuple[str, str, str]] = []

    def walk(profile: str, path: str, value: object) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                walk(profile, f"{path}.{k}" if path else str(k), v)
        else:
            rows.append((profile, path, json.dumps(value, sort_keys=True)))

    for name, body in profiles.items():
        walk(name, "", body)
    return spark.createDataFrame(rows, "profile string, path string, value string")


def image_facts(files: DataFrame, content: str) -> DataFrame:
    """Width, height, bit depth and colour type of PNG files from their header bytes; ``ok`` is false for others."""
    hexed = F.hex(F.substring(F.col(content), 1, 29))
    number = lambda at, n: F.conv(F.substring(hexed, 2 * at + 1, 2 * n), 16, 10).cast("long")
    ok = F.startswith(hexed, F.lit("89504E470D0A1A0A")) & (F.substring(hexed, 25, 8) == "49484452")
    return files.withColumn("ok", ok).withColumns({"width": F.when(ok, number(16, 4)), "height": F.when(ok, number(20, 4)), "bits": F.when(ok, number(24, 1)), "colour": F.when(ok, number(25, 1))})


def model_header(files: DataFrame, content: str) -> DataFrame:
    """Version of a binary model file: the magic of 23 bytes, then four little-endian bytes; null for other files."""
    magic = F.substring(F.col(content), 1, 20) == F.lit("Kaydara FBX Binary  ").cast("binary")
    hexed = F.hex(F.substring(F.col(content), 24, 4))
    turned = F.concat(*[F.substring(hexed, i, 2) for i in (7, 5, 3, 1)])
    return files.withColumn("version", F.when(magic, F.conv(turned, 16, 10).cast("int")))


def write_versioned(df: DataFrame, path: str, version: str) -> str:
    """Write a new version; one that exists is never overwritten (Spark raises)."""
    target = f"{path}/version={version}"
    df.write.mode("errorifexists").parquet(target)
    return target


def to_markdown(df: DataFrame, by: str, columns: list[str], order: list[str]) -> DataFrame:
    """A Markdown table for each ``by``: ``by, text``."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), F.lit(" |"))
    head = f"| {' | '.join(columns)} |\n|{' --- |' * len(columns)}\n"
    rows = F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))
    return df.groupBy(by).agg(F.concat(F.lit(head), F.array_join(F.transform(rows, lambda r: r["_line"]), "\n")).alias("text"))
