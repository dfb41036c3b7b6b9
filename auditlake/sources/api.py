"""Landed API responses: log-file listings, query result pages, limits, id ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.operators.filters import limits_named
from auditlake.schemas import CATALOG, LIMIT_ENTRY

PAGE = "totalSize bigint, done boolean, nextRecordsUrl string"


def read_pages(
    spark: SparkSession, pages_dir: str, records: str = "array<string>", per_line: bool = False
) -> DataFrame:
    """Result pages, one row per page: one page per file, or one per line.

    Rows read as strings keep their exact text, number literals included. The folder
    of a page names its query.
    """
    return (
        spark.read.schema(f"{PAGE}, records {records}")
        .option("multiLine", str(not per_line).lower())
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
        .json(pages_dir)
        .select(
            F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("query"),
            F.col("_metadata.file_path").alias("page"),
            "totalSize", "done", "nextRecordsUrl", "records",
        )
    )


def read_log_catalog(spark: SparkSession, pages_dir: str, per_line: bool = False) -> DataFrame:
    """Log-file listing rows of all pages."""
    pages = read_pages(spark, pages_dir, f"array<struct<{CATALOG}>>", per_line)
    return pages.select(F.explode("records").alias("r")).select("r.*")


def read_query_pages(spark: SparkSession, pages_dir: str, per_line: bool = False) -> DataFrame:
    """Rows of all result pages as `(query, row_json)`."""
    return read_pages(spark, pages_dir, per_line=per_line).select("query", F.explode("records").alias("row_json"))


def incomplete_result_sets(pages: DataFrame) -> DataFrame:
    """Queries whose pages do not add up: no last page, or rows missing. Their
    watermark must not move."""
    return (
        pages.groupBy("query")
        .agg(
            F.sum(F.size("records")).cast("bigint").alias("rows"),
            F.max("totalSize").alias("total_size"),
            F.bool_or("done").alias("done"),
        )
        .where(~F.col("done") | (F.col("rows") != F.col("total_size")))
    )


def read_limits(
    spark: SparkSession, path: str, names: Sequence[str] | None = None, per_line: bool = False
) -> DataFrame:
    """Limit snapshots, one per file or one per line, as `(name, entry)` rows."""
    docs = (
        spark.read.text(path, wholetext=not per_line)
        .select(F.from_json("value", f"map<string,{LIMIT_ENTRY}>", {"mode": "FAILFAST"}).alias("m"))
    )
    rows = docs.select(F.explode("m").alias("name", "entry"))
    return limits_named(rows, names)


def read_expected_ids(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Expected-id ledger documents as `(source, grp, ord, id)`. Ids of log-file rows
    are pooled over all files. A large ledger may be split into many documents, one per file or
    one per line. `ord` sorts ids as they are listed: documents by path and place, ids by place in their
    list. A file that holds several documents where one is read stops the scan."""
    group = "map<string,array<string>>"
    schema = f"orgId: string, streams: {group}, eventLogFiles: {group}, customRecords: {group}"
    texts = spark.read.text(path, wholetext=not per_line).where(F.trim("value") != "").select(
        "value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("place")
    )
    # As members of an array, a second document in a text is malformed; alone it would be passed over.
    text = F.regexp_replace("value", r"^\ufeff?\s+|^\ufeff", "")
    members = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    found = F.from_json(members, f"array<struct<{schema}>>", {"mode": "FAILFAST"})
    doc = texts.select("place", F.posexplode(found).alias("number", "doc")).select("place", "number", "doc.*")
    kinds = [("streams", "stream", F.col("grp")), ("eventLogFiles", "eventlog", F.lit("")),
             ("customRecords", "soql", F.col("grp"))]
    parts = [
        doc.select("place", "number", F.explode(column).alias("grp", "ids"))
        .select("place", "number", F.lit(source).alias("source"), grp.alias("grp"), F.col("grp").alias("list"),
                F.posexplode("ids").alias("at", "id"))
        .select("source", "grp", "list", F.struct("place", "number", "at").alias("ord"), "id")
        for column, source, grp in kinds
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
