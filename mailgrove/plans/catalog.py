"""Every query of the library with its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgrove.functions import addresses, dates, extract, identity, ids
from mailgrove.operators import analysis
from mailgrove.plans.mailbox import SQL as MAIL
from mailgrove.plans.mailbox import mailbox
from mailgrove.plans.relational import RELATIONAL
from mailgrove.session import table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SECONDS = "yyyy-MM-dd HH:mm:ss"
WHO = "^Customer#0000000[0-4]"


def _on_mail(make: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(mailbox(spark, sf_dir))


def _text(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumn(column, F.date_format(column, SECONDS))


def _sql(text: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for t in TABLES:
            if t in text:
                table(spark, sf_dir, t).createOrReplaceTempView(t)
        return spark.sql(text)

    return run


def _joined(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn(by, F.array_join(by, "||"))


def _aux(df):
    return analysis.auxiliary_contributors(df, "1998-01-01").withColumn("point", F.date_format("point", SECONDS))


def _each(df: DataFrame, items: Column) -> DataFrame:
    """A row (message_id, pos, t) for each of the items, none of them NULL. The plain explode would have the items worked out once more, by a filter on their number that the optimizer adds below it."""
    return df.select("message_id", F.posexplode_outer(items).alias("pos", "t")).where("t IS NOT NULL")


def _trailers(df):
    # trailers are taken apart once they are rows, so that only the parts that are asked for are made
    parts = _each(df, extract.found(F.col("raw_body"))).select("message_id", "pos", extract.attribution(F.col("t")).alias("attribution"), extract.named_mail(F.col("t")).alias("identification"))
    return parts.withColumn("identification", addresses.normalize_address(F.col("identification")))


def _patch_sections(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    body = F.concat(F.lit("Change "), F.col("p_name"), F.lit("\n---\n p.c | 2 +-\n\ndiff --git a/p.c b/p.c\n-"), F.col("p_brand"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("\n---\nsecond\ndiff --git a/q.c b/q.c\n+"), F.col("p_type"))).otherwise(F.when(F.col("p_size") % 3 == 1, "\n---\nno more").otherwise("")))
    return part.select("p_partkey", F.posexplode(extract.patches(body)).alias("pos", "patch"))


def _addresses(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    local = F.lower(F.translate("c_name", "#", "."))
    shape = F.col("c_custkey") % 5
    raw = F.when(shape == 0, F.concat("c_name", F.lit(" <"), local, F.lit(" (a) mail.example>"))).when(shape == 1, F.concat(local, F.lit(" at mail.example"))).when(shape == 2, F.concat(F.lit("  "), local, F.lit("@mail.example "))).when(shape == 3, F.concat("c_name", F.lit(" "), local, F.lit("@mail.example"))).otherwise(F.col("c_name"))
    return c.select("c_custkey", addresses.normalize_address(raw).alias("address"))


def _best(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    local = F.lower(F.translate("c_name", "#", "."))
    values = F.array(F.concat(local, F.lit(" at mail.example")), F.concat(local, F.lit("@mail.example")), F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(" <"), local, F.lit("@mail.example>"))).otherwise(local))
    return c.select("c_custkey", addresses.best_address(values).alias("best"))


def _select_date(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    micros = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    odd = F.when(F.col("l_linenumber") == 3, F.lit(0).cast("long")).when(F.col("l_linenumber") == 4, micros + 86_400_000_000 * 36_500).otherwise(micros)
    per = lines.groupBy("l_orderkey").agg(F.collect_list(odd).alias("options"))
    now = F.lit(1_779_062_556_000_000)
    return per.select("l_orderkey", dates.select_date(F.col("options"), now).alias("chosen_micros"))


def _millennium(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate") - 1900
    broken = F.make_timestamp_ntz(F.when(F.col("o_orderkey") % 2 == 0, year).otherwise(year % 100), F.month("o_orderdate"), F.least(F.dayofmonth("o_orderdate"), F.lit(28)), F.lit(1), F.lit(2), F.lit(3))
    fixed = dates.fix_millennium(broken, F.lit("2026-05-18 00:02:36").cast("timestamp_ntz"))
    return o.select("o_orderkey", F.date_format(fixed, SECONDS).alias("fixed"))


def _email_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", ids.format_email_id(F.col("o_orderkey"), F.col("o_custkey") % 3, F.sha1(F.col("o_orderkey").cast("string"))).alias("email_id"))
    return o.withColumn("p", ids.parse_email_id(F.col("email_id"))).select("o_orderkey", "email_id", "p.position", "p.epoch", "p.sha")


def _globs(df):
    taken, _ = ids.expand_globs(["auto*", "*ing", "machinery", "none?"], ["automobile", "building", "furniture", "household", "machinery"])
    return analysis.list_sizes(analysis.select_lists(df, taken))


def _thread_edges(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    a, b = c.alias("a"), c.alias("b")
    return a.join(b, (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("b.turn") == F.col("a.turn") - 1)).groupBy(F.col("b.role").alias("parent"), F.col("a.role").alias("child")).agg(F.count(F.lit(1)).alias("edges"))


def _lineage(df):
    """Lineage of every third message joined by identifier and list."""
    lineage = df.select(F.col("__file_name").alias("email_index"), F.col("list").alias("list_name")).where(F.col("email_index").cast("long") % 3 == 0)
    return df.join(lineage, (F.col("__file_name") == F.col("email_index")) & (F.col("list") == F.col("list_name"))).groupBy("list").agg(F.count(F.lit(1)).alias("archived"))


def _unarchived(df):
    lineage = df.select(F.col("__file_name").alias("email_index")).where(F.col("email_index").cast("long") % 3 == 0)
    return df.join(lineage, F.col("__file_name") == F.col("email_index"), "left_anti").groupBy("list").agg(F.count(F.lit(1)).alias("unarchived"))


def _stream(spark, sf_dir):
    from mailgrove.streaming.incremental import daily_counts_once

    return daily_counts_once(spark, f"{sf_dir}/events.parquet").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "count")


QUERIES: dict[str, tuple] = {
    "author_distribution": (_on_mail(lambda d: analysis.author_distribution(d, WHO)), f"WITH {MAIL} SELECT list, CAST(year(date) AS INTEGER) AS year, count(*) AS count FROM mail WHERE regexp_matches(sender, '{WHO}') GROUP BY ALL"),
    "list_sizes": (_on_mail(analysis.list_sizes), f"WITH {MAIL} SELECT list, count(sender) AS size FROM mail GROUP BY list"),
    "list_size_quartiles": (
        _on_mail(analysis.list_size_summary),
        f"WITH {MAIL}, s AS (SELECT list, count(sender) AS size FROM mail GROUP BY list) SELECT (SELECT list FROM s ORDER BY size, list LIMIT 1) AS min_list, min(size) AS min_size, quantile_cont(size, 0.25) AS q1, quantile_cont(size, 0.5) AS q2, quantile_cont(size, 0.75) AS q3, max(size) AS max_size, (SELECT list FROM s ORDER BY size DESC, list DESC LIMIT 1) AS max_list FROM s",
    ),
    "unique_authors": (_on_mail(lambda d: _joined(analysis.unique_authors(d), "list").withColumnRenamed("from", "sender")), f"WITH {MAIL} SELECT sender, string_agg(list, '||' ORDER BY list) AS list FROM mail GROUP BY sender"),
    "id_map_authors": (
        _on_mail(lambda d: _joined(analysis.id_map_authors(identity.id_map(d)), "list").select(F.col("__original_from").alias("original"), F.col("from").alias("hashed"), "list")),
        f"WITH {MAIL} SELECT sender AS original, sha1(c_name) || ' <' || sha1(address) || '>' AS hashed, string_agg(list, '||' ORDER BY list) AS list FROM mail GROUP BY ALL",
    ),
    "date_stats": (
        _on_mail(lambda d: _text(_text(analysis.date_stats(d), "min_date"), "q1_date")),
        f"WITH {MAIL}, r AS (SELECT date, row_number() OVER (ORDER BY date) AS r, count(*) OVER () AS n FROM mail WHERE date IS NOT NULL) SELECT strftime(min(date), '%Y-%m-%d %H:%M:%S') AS min_date, strftime(max(date) FILTER (WHERE r = floor((n - 1) * 0.25 + 0.5) + 1), '%Y-%m-%d %H:%M:%S') AS q1_date FROM r",
    ),
    "patch_missing": (_on_mail(lambda d: _text(analysis.patch_missing(d))), f"WITH {MAIL} SELECT list, message_id, subject, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, CAST(o_orderkey AS VARCHAR) AS __file_name FROM mail WHERE subject LIKE '[PATCH%' AND n_code = 0"),
    "patch_missing_legacy": (
        _on_mail(lambda d: _text(analysis.patch_missing(d, legacy=True))),
        f"WITH {MAIL} SELECT list, message_id, subject, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, CAST(o_orderkey AS VARCHAR) AS __file_name FROM mail WHERE n_code > 0 AND (subject NOT LIKE '[PATCH%' OR n_code % 2 = 0)",
    ),
    "date_missing": (_on_mail(lambda d: _text(analysis.date_missing(d))), f"WITH {MAIL} SELECT list, message_id, subject, CAST(NULL AS VARCHAR) AS date, CAST(o_orderkey AS VARCHAR) AS __file_name FROM mail WHERE date IS NULL AND has_client_date"),
    "auxiliary_contributors": (
        _on_mail(_aux),
        f"""WITH {MAIL}, m AS (SELECT * FROM mail WHERE date > TIMESTAMP '1998-01-01'), span AS (SELECT min(date) AS lo, max(date) AS hi FROM m),
        g AS (SELECT point FROM (SELECT unnest(generate_series(lo + INTERVAL 60 DAY, hi, INTERVAL 5 DAY)) AS point, hi FROM span) WHERE point < hi),
        e AS (SELECT list, date, count(*) AS n FROM m JOIN trailer ON l_orderkey = o_orderkey WHERE attribution IN ('Reviewed-by', 'Tested-by') GROUP BY ALL)
        SELECT strftime(point, '%Y-%m-%d %H:%M:%S') AS point, l.list, CAST(coalesce(sum(n), 0) AS BIGINT) AS contributors FROM g CROSS JOIN (SELECT DISTINCT list FROM m) l
        LEFT JOIN e ON e.list = l.list AND e.date >= point - INTERVAL 60 DAY AND e.date <= point + INTERVAL 1 DAY GROUP BY ALL""",
    ),
    "daily_activity": (_on_mail(lambda d: _text(analysis.daily_activity(d), "day").withColumn("day", F.substring("day", 1, 10))), f"WITH {MAIL} SELECT strftime(date, '%Y-%m-%d') AS day, count(*) AS count FROM mail GROUP BY ALL"),
    "top_senders": (_on_mail(analysis.top_senders), f"WITH {MAIL} SELECT sender, count(*) AS count FROM mail GROUP BY sender ORDER BY count DESC, sender LIMIT 10"),
    "partition_row_counts": (_on_mail(lambda d: d.groupBy("list").count()), f"WITH {MAIL} SELECT list, count(*) AS count FROM mail GROUP BY list"),
    "row_lookup": (_on_mail(lambda d: d.where(F.col("__file_name").cast("string") == "7").select("list", "message_id", "subject")), f"WITH {MAIL} SELECT list, message_id, subject FROM mail WHERE CAST(o_orderkey AS VARCHAR) = '7'"),
    "trailers_exploded": (_on_mail(_trailers), f"WITH {MAIL} SELECT l_orderkey || '@orders' AS message_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, attribution) - 1 AS INTEGER) AS pos, attribution, s_name || ' <' || address || '>' AS identification FROM trailer"),
    "trailer_counts": (_on_mail(lambda d: _trailers(d).groupBy("attribution").agg(F.count(F.lit(1)).alias("n"))), f"WITH {MAIL} SELECT attribution, count(*) AS n FROM trailer GROUP BY attribution"),
    "patch_sections": (
        _patch_sections,
        "SELECT p_partkey, 0 AS pos, '---' || chr(10) || ' p.c | 2 +-' || chr(10) || chr(10) || 'diff --git a/p.c b/p.c' || chr(10) || '-' || p_brand AS patch FROM part UNION ALL SELECT p_partkey, 1, '---' || chr(10) || 'second' || chr(10) || 'diff --git a/q.c b/q.c' || chr(10) || '+' || p_type FROM part WHERE p_size % 3 = 0",
    ),
    "anonymize_from": (_on_mail(lambda d: identity.pseudonymise_frame(d.select("message_id", "from")).withColumnRenamed("from", "sender")), f"WITH {MAIL} SELECT message_id, sha1(c_name) || ' <' || sha1(address) || '>' AS sender FROM mail"),
    "anonymize_trailers": (
        _on_mail(lambda d: _each(identity.pseudonymise_frame(d.select("message_id", "trailers")), F.col("trailers")).select("message_id", "t.attribution", "t.identification")),
        f"WITH {MAIL} SELECT l_orderkey || '@orders' AS message_id, attribution, sha1(s_name) || ' <' || sha1(address) || '>' AS identification FROM trailer",
    ),
    "anonymize_list": (
        _on_mail(lambda d: d.select("message_id", identity.pseudonymise_list(F.array(F.col("`from`"), F.lit("dev@lists.example"))).alias("to")).select("message_id", F.array_join("to", "||").alias("to_hashed"))),
        f"WITH {MAIL} SELECT message_id, sha1(c_name) || ' <' || sha1(address) || '>' || '||' || sha1('dev@lists.example') AS to_hashed FROM mail",
    ),
    "anonymize_text": (
        _on_mail(lambda d: d.select("message_id", identity.pseudonymise(F.concat(F.lit("From: "), F.col("`from`"), F.lit("\n\nhello"))).alias("body"))),
        f"WITH {MAIL} SELECT message_id, 'From: ' || sha1(c_name) || ' <' || sha1(address) || '>' || chr(10) || chr(10) || 'hello' AS body FROM mail",
    ),
    "normalize_address": (
        _addresses,
        "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name || ' <' || lower(replace(c_name, '#', '.')) || '@mail.example>' WHEN 1 THEN lower(replace(c_name, '#', '.')) || '@mail.example' WHEN 2 THEN lower(replace(c_name, '#', '.')) || '@mail.example' WHEN 3 THEN c_name || ' <' || lower(replace(c_name, '#', '.')) || '@mail.example>' ELSE c_name END AS address FROM customer",
    ),
    "best_from": (_best, "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name || ' <' ELSE '' END || lower(replace(c_name, '#', '.')) || '@mail.example' || CASE WHEN c_custkey % 2 = 0 THEN '>' ELSE '' END AS best FROM customer"),
    "select_date": (_select_date, None),
    "millennium_fix": (
        _millennium,
        "SELECT o_orderkey, strftime(make_timestamp(CASE WHEN o_orderkey % 2 = 0 OR year(o_orderdate) % 100 >= 50 THEN year(o_orderdate) ELSE year(o_orderdate) % 100 + 2000 END, month(o_orderdate), least(day(o_orderdate), 28), 1, 2, 3), '%Y-%m-%d %H:%M:%S') AS fixed FROM orders",
    ),
    "email_id_roundtrip": (_email_ids, "SELECT o_orderkey, printf('%010d', o_orderkey) || '-e' || o_custkey % 3 || '-' || sha1(CAST(o_orderkey AS VARCHAR)) AS email_id, o_orderkey AS position, CAST(o_custkey % 3 AS VARCHAR) AS epoch, sha1(CAST(o_orderkey AS VARCHAR)) AS sha FROM orders"),
    "glob_lists": (_on_mail(_globs), f"WITH {MAIL} SELECT list, count(sender) AS size FROM mail WHERE list LIKE 'auto%' OR list LIKE '%ing' OR list = 'machinery' GROUP BY list"),
    "range_select": (lambda s, d: table(s, d, "orders").where(ids.in_ranges(F.col("o_orderkey"), "1,3-50,100,200-300")).select("o_orderkey", "o_totalprice"), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 100) OR o_orderkey BETWEEN 3 AND 50 OR o_orderkey BETWEEN 200 AND 300"),
    "thread_edges": (_thread_edges, "SELECT b.role AS parent, a.role AS child, count(*) AS edges FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1 GROUP BY ALL"),
    "lineage_join": (_on_mail(_lineage), f"WITH {MAIL} SELECT list, count(*) AS archived FROM mail WHERE o_orderkey % 3 = 0 GROUP BY list"),
    "unarchived_anti": (_on_mail(_unarchived), f"WITH {MAIL} SELECT list, count(*) AS unarchived FROM mail WHERE o_orderkey % 3 <> 0 GROUP BY list"),
    "stream_daily_counts": (_stream, "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS count FROM events GROUP BY ALL"),
} | {name: (_sql(spark_sql), duck) for name, (spark_sql, duck) in RELATIONAL.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
