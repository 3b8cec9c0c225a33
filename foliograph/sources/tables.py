"""Reading and writing the pipeline's relations.

Parquet through Spark's readers only, so any store that Spark reaches will do; JSON and Markdown reports are small and
written by the driver through the same file systems.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Tables that a finished run has, by schema version
REQUIRED = {
    "semkg_v1": (
        "anchors sections element_sentences references graph_nodes graph_edges struct_nodes authorities paragraph_authority_edges authority_mentions typed_edges claims "
        "constraints claim_constraints constraint_attributes claim_edges claim_rejections typed_edge_claims claim_authority_mentions claim_precedence resolved_claims "
        "resolution_groups compiled_directives constraints_resolved"
    ).split()
}


def _path(spark: SparkSession, at: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, at: str) -> bool:
    fs, path = _path(spark, at)
    return fs.exists(path)


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType | str) -> DataFrame:
    """A relation, or an empty one of that schema where the file is missing."""
    at = f"{folder}/{name}.parquet"
    return spark.read.schema(schema).parquet(at) if exists(spark, at) else spark.createDataFrame([], schema)


def write_table(df: DataFrame, folder: str, name: str) -> str:
    at = f"{folder}/{name}.parquet"
    df.write.mode("overwrite").parquet(at)
    return at


def write_text(spark: SparkSession, at: str, text: str) -> None:
    fs, path = _path(spark, at)
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, at: str) -> str | None:
    """A small file's text, or null where it is missing (S3)."""
    if not exists(spark, at):
        return None
    return "\n".join(r.value for r in spark.read.text(at, wholetext=True).collect())


def read_json(spark: SparkSession, at: str) -> dict:
    text = read_text(spark, at)
    return json.loads(text) if text else {}


def missing_tables(spark: SparkSession, folder: str, version: str = "semkg_v1") -> list[str]:
    return [t for t in REQUIRED[version] if not exists(spark, f"{folder}/{t}.parquet")]


def read_spans(spark: SparkSession, at: str) -> DataFrame:
    """Spans as a PDF reader leaves them: no blank text, a box of four, pages from 1."""
    return spark.read.parquet(at).where((F.trim(F.coalesce("text", F.lit(""))) != "") & (F.size("bbox") >= 4) & (F.col("page") >= 1))


def ensure_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in its order; missing ones are null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def require(df: DataFrame, *names: str) -> DataFrame:
    lacking = sorted(set(names) - set(df.columns))
    if lacking:
        raise ValueError(f"columns are missing: {', '.join(lacking)}")
    return df


def quality_report(spark: SparkSession, checks: DataFrame, folder: str) -> tuple[str, str]:
    """Checks, one row each, as JSON and Markdown."""
    rows = [r.asDict() for r in checks.limit(10_000).collect()]
    done = sum(bool(r["passed"]) for r in rows)
    write_text(spark, f"{folder}/quality_report.json", json.dumps({"passed": done, "total": len(rows), "checks": rows}, indent=1, default=str))
    table = "\n".join(f"| {r['gate_id']} | {'pass' if r['passed'] else 'fail'} | {r['succeeded']} | {r['total']} |" for r in rows)
    write_text(spark, f"{folder}/quality_report.md", f"# Quality report\n\n{done} of {len(rows)} checks passed.\n\n| check | result | good | of |\n| --- | --- | --- | --- |\n{table}\n")
    return f"{folder}/quality_report.json", f"{folder}/quality_report.md"
