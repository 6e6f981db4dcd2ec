"""Raw archives: .eml files, Parquet archives, datasets, and what a folder holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgrove.schema import RAW


def _path_part(pattern: str):
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def read_eml(spark: SparkSession, root: str) -> DataFrame:
    """root/<list>/<email_id>.eml as (list, email_id, content bytes, source_file)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[eE][mM][lL]").load(f"{root}/*")
    name = F.col("path")
    return files.select(F.url_decode(F.regexp_extract(name, r"([^/]+)/[^/]+$", 1)).alias("list"), F.url_decode(F.regexp_extract(name, r"([^/]+)\.[eE][mM][lL]$", 1)).alias("email_id"), "content", name.alias("source_file"))


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    """root/<list>/*.parquet with the fixed schema (email_id, content)."""
    df = spark.read.schema(RAW).option("pathGlobFilter", "*.[pP][aA][rR][qQ][uU][eE][tT]").parquet(f"{root}/*")
    return df.select(F.regexp_replace(_path_part(r"([^/]+)/[^/]+$"), "^list=", "").alias("list"), "email_id", F.col("content").cast("binary").alias("content"), F.col("_metadata.file_path").alias("source_file"))


def read_raw(spark: SparkSession, root: str, kinds: tuple[str, ...] = ("eml", "parquet")) -> DataFrame:
    """All messages below root whatever their kind; other files are skipped."""
    parts = [{"eml": read_eml, "parquet": read_archives}[k](spark, root) for k in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_archive(df: DataFrame, out: str, mails_per_file: int = 10_000) -> None:
    df.select("list", "email_id", F.col("content").cast("string").alias("content")).write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", mails_per_file).partitionBy("list").parquet(out)


def read_dataset(spark: SparkSession, path: str, lists: list[str] | None = None) -> DataFrame:
    """A parsed or pseudonymised dataset; list stays a string and prunes partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col("list").isin(lists)) if lists else df


def read_lineage_texts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.text(f"{root}/*/__lineage.yaml", wholetext=True).where("trim(value) <> ''")


def register_tables(spark: SparkSession, **paths: str) -> list[str]:
    """Temp views of what is there: dataset, anon_dataset, lineage, id_map; dataset falls back on anon_dataset."""
    found = {name: path for name, path in paths.items() if path}
    if "dataset" not in found and "anon_dataset" not in found:
        raise ValueError("neither a dataset nor a pseudonymised dataset is given")
    found.setdefault("dataset", found.get("anon_dataset"))
    for name, path in found.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return sorted(found)


def run_sql(spark: SparkSession, text: str, out: str | None = None) -> DataFrame:
    """Run SQL over the registered views; out: a CSV, or Parquet where the result is nested."""
    df = spark.sql(text.strip().rstrip(";"))
    if out:
        if any(k.startswith(("array", "struct", "map")) for _, k in df.dtypes):
            df.write.mode("overwrite").parquet(out)
        else:
            df.write.mode("overwrite").option("header", True).csv(out)
    return df


def inspect(df: DataFrame) -> DataFrame:
    """Rows and files of each partition."""
    return df.groupBy("list").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("_metadata.file_path").alias("files"))


def lookup(df: DataFrame, value: str, column: str = "email_id") -> DataFrame:
    return df.where(F.col(f"`{column}`").cast("string") == value)
