"""Raw archive to parsed dataset, errors and lineage."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgrove.functions import dates, extract, identity
from mailgrove.operators.mime import SCHEMA, parse_series
from mailgrove.schema import EMAIL, LINEAGE_KEYS

#: Bodies are large: fewer rows in an Arrow batch than Spark's default.
BATCH = 1000


def parse(raw: DataFrame, now_micros: int) -> DataFrame:
    """raw (email_id, content as text or bytes, list, ...) -> the parsed columns, `error` and `list`."""
    raw.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))

    @F.pandas_udf(SCHEMA)
    def run(content: pd.Series) -> pd.DataFrame:
        return parse_series(content, now_micros)

    m = raw.withColumn("m", run(F.col("content").cast("binary"))).select("email_id", *(["list"] if "list" in raw.columns else []), "m.*")
    date = F.timestamp_micros(dates.select_date(F.col("date_options"), F.lit(now_micros))).cast("timestamp_ntz")
    made = m.withColumns({"date": date, "trailers": extract.trailers(F.col("raw_body")), "code": extract.patches(F.col("raw_body")), "__file_name": F.col("email_id")})
    return made.select(*[F.col(f"`{f.name}`") for f in EMAIL], "error", *(["list"] if "list" in raw.columns else []))


def split_errors(parsed: DataFrame, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, errors (list, email_id, error)); fail_fast raises at the first error when good rows are read."""
    if fail_fast:
        good = parsed.where(F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.col("__file_name"), F.lit(": "), F.col("error"))).cast("boolean")).otherwise(True))
    else:
        good = parsed.where("error IS NULL")
    flat = F.regexp_replace("error", r"\r?\n", r"\\n")
    return good.drop("error"), parsed.where("error IS NOT NULL").select("list", F.col("__file_name").alias("email_id"), flat.alias("error"))


def write_dataset(parsed: DataFrame, out: str, fail_fast: bool = False) -> None:
    """dataset/list=.../ and errors/list=.../; the lists that are written replace what was there."""
    good, bad = split_errors(parsed, fail_fast)
    good.write.mode("overwrite").option("compression", "zstd").partitionBy("list").parquet(f"{out}/dataset")
    bad.write.mode("overwrite").partitionBy("list").csv(f"{out}/errors")


def lineage(texts: DataFrame, parse_time: str, build: str) -> DataFrame:
    """texts (value): whole lineage files, documents apart by `---` lines -> one row a document.

    Flat `key: value` lines; missing keys become "", bad timestamps NULL, and documents without
    any known key are skipped.
    """
    docs = texts.select(F.explode(F.split("value", r"(?md)^---\s*$")).alias("doc"))
    value = lambda k: F.regexp_replace(F.trim(F.regexp_extract("doc", rf"(?md)^{k}:\s*(.*)$", 1)), r"^[\"']|[\"']$", "")
    rows = docs.where(F.col("doc").rlike("(?md)^(" + "|".join(LINEAGE_KEYS) + "):")).select(*[value(k).alias(k) for k in LINEAGE_KEYS])
    stamp = F.expr("try_cast(archive_timestamp AS timestamp)").cast("timestamp_ntz")
    return rows.withColumns({"archive_timestamp": stamp, "parse_timestamp": F.lit(parse_time).cast("timestamp_ntz"), "parser_build_info": F.lit(build)})


def write_lineage(rows: DataFrame, out: str) -> bool:
    """One ZSTD file; none when there are no rows."""
    if rows.isEmpty():
        return False
    rows.coalesce(1).write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "22").parquet(out)
    return True


def write_pseudonymised(dataset: DataFrame, out: str, level: int = 12, strict: bool = False) -> None:
    """The dataset with pseudonyms and its id map, both by list, from narrow projections of one scan each."""
    for name, df in (("dataset", identity.pseudonymise_frame(dataset, strict)), ("id_map_from", identity.id_map(dataset))):
        w = df.write.mode("overwrite").option("compression", "zstd")
        (w.option("parquet.compression.codec.zstd.level", str(level)) if level else w).partitionBy("list").parquet(f"{out}/{name}")


def run_pipeline(spark: SparkSession, raw: DataFrame, out: str, now_micros: int) -> dict[str, float]:
    """Parse and pseudonymise; seconds of each stage."""
    import time

    took, began = {}, time.time()
    write_dataset(parse(raw, now_micros), f"{out}/parsed")
    took["parse"] = time.time() - began
    began = time.time()
    write_pseudonymised(spark.read.parquet(f"{out}/parsed/dataset"), f"{out}/pseudonymised")
    took["pseudonymise"] = time.time() - began
    return took
