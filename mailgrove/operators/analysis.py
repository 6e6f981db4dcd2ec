"""The ready-made analyses over the parsed dataset: DataFrame in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def select_lists(df: DataFrame, lists: list[str] | None) -> DataFrame:
    """Only these lists (partition pruning); all without any."""
    return df.where(F.col("list").isin(lists)) if lists else df


def author_distribution(df: DataFrame, identity: str, lists: list[str] | None = None) -> DataFrame:
    """E-mails a year and list of senders that match a Java regular expression; a NULL year is a group."""
    mine = select_lists(df, lists).where(F.col("`from`").rlike(identity))
    return mine.groupBy("list", F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("year").asc_nulls_first(), "list")


def list_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("list").agg(F.count("`from`").alias("size"))


def list_size_summary(df: DataFrame) -> DataFrame:
    """Smallest, quartiles (linear) and largest list; ties of size go to the first name for min, the last for max."""
    s = list_sizes(df)
    return s.agg(
        F.min_by("list", F.struct("size", "list")).alias("min_list"),
        F.min("size").alias("min_size"),
        F.percentile("size", 0.25).alias("q1"),
        F.percentile("size", 0.5).alias("q2"),
        F.percentile("size", 0.75).alias("q3"),
        F.max("size").alias("max_size"),
        F.max_by("list", F.struct("size", "list")).alias("max_list"),
    )


def unique_authors(df: DataFrame) -> DataFrame:
    """Lists of each sender, one entry an e-mail."""
    return df.groupBy(F.col("`from`").alias("from")).agg(F.sort_array(F.collect_list("list")).alias("list"))


def id_map_authors(ids: DataFrame) -> DataFrame:
    return ids.groupBy("__original_from", "from").agg(F.sort_array(F.collect_list("list")).alias("list"))


def date_stats(df: DataFrame) -> DataFrame:
    """Earliest date and the date at the nearest rank of the first quarter, over all dates.

    Ranks come from counts of distinct seconds, so that no task has to sort all rows.
    """
    per = df.where("date IS NOT NULL").groupBy(F.date_trunc("day", "date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    running = per.withColumn("upto", F.sum("n").over(Window.orderBy("day")))  # one row a day
    total = per.agg(F.sum("n").alias("total"))
    at = running.crossJoin(total).withColumn("rank", F.floor((F.col("total") - 1) * 0.25 + 0.5) + 1).where("upto >= rank AND upto - n < rank").select("day", (F.col("rank") - F.col("upto") + F.col("n")).alias("nth"))
    within = df.where("date IS NOT NULL").join(F.broadcast(at), F.date_trunc("day", F.col("date")) == F.col("day"))  # one row
    nth = within.withColumn("r", F.row_number().over(Window.partitionBy("day").orderBy("date"))).where("r = nth").select(F.col("date").alias("q1_date"))
    return df.agg(F.min("date").alias("min_date")).crossJoin(nth)


def patch_missing(df: DataFrame, legacy: bool = False) -> DataFrame:
    """E-mails announced as patches without any; legacy: an even number of patches, or not announced at all."""
    announced = F.col("subject").startswith("[PATCH")
    cond = (announced.cast("int").bitwiseAND(F.size("code")) == 0) & F.col("code").isNotNull() if legacy else announced & (F.col("code").isNull() | (F.size("code") == 0))
    return df.where(cond).select("list", "message_id", "subject", "date", "__file_name")


def date_missing(df: DataFrame) -> DataFrame:
    return df.where(F.col("date").isNull() & F.col("client_date").isNotNull() & (F.size("client_date") > 0)).select("list", "message_id", "subject", "date", "__file_name")


def auxiliary_contributors(df: DataFrame, since: str = "2020-01-01", window_days: int = 60, step_days: int = 5) -> DataFrame:
    """Reviewed-by and Tested-by trailers of each list around each grid point: (point, list, contributors).

    Grid: from the first date plus the window, in steps, before the last date. A trailer counts
    at a point t when t - window <= date <= t + 1 day. Each trailer is dealt to the few points it
    counts for, so the join is a hash aggregate and not a range join.
    """
    rows = df.where(F.col("date") > F.lit(since).cast("timestamp_ntz"))
    span = rows.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    events = rows.select("list", "date", F.explode("trailers").alias("t")).where(F.lower("t.attribution").rlike("^(reviewed-by|tested-by)")).groupBy("list", "date").agg(F.count(F.lit(1)).alias("n"))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    day = 86_400_000_000
    step, first = step_days * day, micros(F.col("lo")) + window_days * day
    # k with first + k*step - window <= date <= first + k*step + 1 day
    low = F.ceil((micros(F.col("date")) - day - first) / step)
    high = F.floor((micros(F.col("date")) + window_days * day - first) / step)
    last = F.ceil((micros(F.col("hi")) - first) / step) - 1  # strictly before the last date
    dealt = events.crossJoin(F.broadcast(span)).select("list", "n", F.explode(F.when(F.greatest(low, F.lit(0)) <= F.least(high, last), F.sequence(F.greatest(low, F.lit(0)), F.least(high, last)))).alias("k"))
    counted = dealt.groupBy("list", "k").agg(F.sum("n").alias("n"))
    grid = span.where(last >= 0).select(F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"), F.col("lo"))
    every = grid.crossJoin(F.broadcast(rows.select("list").distinct()))
    point = F.timestamp_micros(micros(F.col("lo")) + window_days * day + F.col("k") * step).cast("timestamp_ntz")
    return every.join(counted, ["list", "k"], "left").select(point.alias("point"), "list", F.coalesce("n", F.lit(0)).alias("contributors"))


def daily_activity(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("date").alias("day")).agg(F.count(F.lit(1)).alias("count")).orderBy("day")


def top_senders(df: DataFrame, n: int = 10) -> DataFrame:
    return df.groupBy(F.col("`from`").alias("sender")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "sender").limit(n)
