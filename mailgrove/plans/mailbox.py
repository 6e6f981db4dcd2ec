"""A mailbox in the parsed schema derived from order tables, the same in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgrove.session import table


def mailbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    lines, part, supplier = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    tag = F.when(F.col("l_returnflag") == "R", "Reviewed-by").when(F.col("l_returnflag") == "A", "Tested-by").otherwise("Signed-off-by")
    # once a supplier, not once a line
    supplier = supplier.select("s_suppkey", F.concat(F.col("s_name"), F.lit(" <"), F.lower(F.translate("s_name", "#", ".")), F.lit("@suppliers.example>")).alias("who"))
    made = (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .join(part, lines.l_partkey == part.p_partkey)
        .groupBy("l_orderkey")
        .agg(
            F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", tag.alias("attribution"), F.col("who").alias("identification")))), lambda x: F.struct(x["attribution"].alias("attribution"), x["identification"].alias("identification"))).alias("trailers"),
            F.sort_array(F.collect_list(F.when(F.col("l_linestatus") == "O", F.col("p_name")))).alias("open_parts"),
        )
    )
    key = F.col("o_orderkey").cast("string")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
        .join(made, orders.o_orderkey == made.l_orderkey, "left")
        .select(
            F.concat(F.col("c_name"), F.lit(" <"), F.lower(F.translate("c_name", "#", ".")), F.lit("@"), F.lower(F.translate("n_name", "_", "-")), F.lit(".example>")).alias("from"),
            F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderdate")).alias("date"),
            F.concat(F.when(F.col("o_orderpriority").substr(1, 1).isin("1", "2"), "[PATCH] order ").otherwise("Re: order "), key).alias("subject"),
            F.concat(key, F.lit("@orders")).alias("message_id"),
            F.when(F.col("o_orderkey") % 13 != 0, F.array(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("client_date"),
            F.coalesce("trailers", F.expr("array()")).alias("trailers"),
            F.when(F.size("open_parts") > 0, F.col("open_parts")).alias("code"),
            F.concat(F.lit("About order "), key, F.lit("\n\n"), F.array_join(F.transform(F.coalesce("trailers", F.expr("array()")), lambda t: F.concat(t["attribution"], F.lit(": "), t["identification"])), "\n"), F.lit("\n")).alias("raw_body"),
            key.alias("__file_name"),
            F.lower("c_mktsegment").alias("list"),
        )
    )


SQL = """
mail AS (
  SELECT c_name || ' <' || lower(replace(c_name, '#', '.')) || '@' || lower(replace(n_name, '_', '-')) || '.example>' AS sender,
    c_name, lower(replace(c_name, '#', '.')) || '@' || lower(replace(n_name, '_', '-')) || '.example' AS address,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate END AS date, o_orderkey,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN '[PATCH] order ' ELSE 'Re: order ' END || o_orderkey AS subject,
    o_orderkey || '@orders' AS message_id, o_orderkey % 13 <> 0 AS has_client_date, lower(c_mktsegment) AS list,
    (SELECT count(*) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE l.l_orderkey = o_orderkey AND l.l_linestatus = 'O') AS n_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), trailer AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_returnflag WHEN 'R' THEN 'Reviewed-by' WHEN 'A' THEN 'Tested-by' ELSE 'Signed-off-by' END AS attribution,
    s_name, lower(replace(s_name, '#', '.')) || '@suppliers.example' AS address
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
)"""
