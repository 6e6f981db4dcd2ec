"""Registers the domain functions for SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from mailgrove.functions.addresses import normalize
from mailgrove.functions.extract import TRAILER
from mailgrove.functions.identity import pseudonymise_text


def register(spark: SparkSession) -> None:
    """normalize_address(s), pseudonymise(s), and the table function trailers_of(body)."""
    import re

    @F.pandas_udf("string")
    def normalize_address(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else normalize(v))

    @F.pandas_udf("string")
    def pseudonymise(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else pseudonymise_text(v))

    pattern = re.compile(TRAILER.replace("(?md)", "(?m)"))

    @udtf(returnType="attribution: string, identification: string")
    class TrailersOf:
        def eval(self, body: str):
            for m in pattern.finditer((body or "").split("\n-- \n")[0]):
                yield m[1], normalize(f"{m[2].strip()} <{m[3].strip()}>")

    spark.udf.register("normalize_address", normalize_address)
    spark.udf.register("pseudonymise", pseudonymise)
    spark.udtf.register("trailers_of", TrailersOf)
