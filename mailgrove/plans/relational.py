"""The SQL surface on the star-schema tables: name -> (Spark SQL, DuckDB SQL)."""

from __future__ import annotations

_BOTH = {
    "sql_inner_join": "SELECT n_name, count(*) AS n, sum(o_totalprice) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "sql_left_join": "SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
    "sql_right_join": "SELECT p_partkey, count(l_orderkey) AS n FROM lineitem RIGHT JOIN part ON l_partkey = p_partkey GROUP BY p_partkey",
    "sql_full_join": "SELECT c_nationkey, s_nationkey, n_c, n_s FROM (SELECT c_nationkey, count(*) AS n_c FROM customer WHERE c_nationkey < 15 GROUP BY c_nationkey) a FULL JOIN (SELECT s_nationkey, count(*) AS n_s FROM supplier WHERE s_nationkey >= 10 GROUP BY s_nationkey) b ON c_nationkey = s_nationkey",
    "sql_semi_exists": "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)",
    "sql_anti_not_exists": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "sql_in_subquery": "SELECT count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40)",
    "sql_cross_join": "SELECT r_name, n_name FROM region CROSS JOIN nation WHERE n_regionkey <> r_regionkey",
    "sql_theta_join": "SELECT a.n_name AS a_name, b.n_name AS b_name FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey = b.n_regionkey",
    "sql_self_join": "SELECT a.conv_id, count(*) AS pairs FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn < b.turn GROUP BY a.conv_id",
    "sql_scalar_subquery": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)",
    "sql_correlated_subquery": "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT 1.5 * avg(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)",
    "sql_cte": "WITH big AS (SELECT o_custkey, sum(o_totalprice) AS t FROM orders GROUP BY o_custkey), top AS (SELECT * FROM big WHERE t > 500000) SELECT c_mktsegment, count(*) AS n FROM top JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment",
    "sql_case_between_like": "SELECT CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size BETWEEN 11 AND 30 THEN 'medium' ELSE 'large' END AS kind, count(*) AS n FROM part WHERE p_name LIKE '%a%' GROUP BY CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size BETWEEN 11 AND 30 THEN 'medium' ELSE 'large' END",
    "sql_distinct_from": "SELECT count(*) AS n FROM orders WHERE nullif(o_orderstatus, 'F') IS DISTINCT FROM 'O'",
    "sql_having": "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*) > 20",
    "sql_count_distinct": "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag",
    "sql_filter_agg": "SELECT l_linestatus, count(*) FILTER (WHERE l_quantity > 25) AS many, count(*) AS n FROM lineitem GROUP BY l_linestatus",
    "sql_grouping_sets": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())",
    "sql_cube": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "sql_rollup": "SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)",
    "sql_statistics": "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY l_returnflag",
    "sql_ranking": "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS rk, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS dr, ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nt FROM orders",
    "sql_lag_lead": "SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before, lead(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS after FROM orders",
    "sql_first_last_nth": "SELECT o_orderkey, first_value(o_orderkey) OVER w AS f, last_value(o_orderkey) OVER w AS l, nth_value(o_orderkey, 2) OVER w AS n2 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
    "sql_rows_frame": "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS n, max(event_id) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS later FROM events",
    "sql_range_frame": "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN 100 PRECEDING AND 100 FOLLOWING) AS near FROM events",
    "sql_running_total": "SELECT o_orderkey, sum(1) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS running FROM orders",
    "sql_sort_limit_offset": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 5",
    "sql_topk": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10",
    "sql_union": "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier",
    "sql_union_all": "SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) u GROUP BY k",
    "sql_intersect": "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_suppkey < 20",
    "sql_except": "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45",
    "sql_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "sql_strings": "SELECT n_nationkey, upper(n_name) AS u, length(n_name) AS len, substr(n_name, 1, 3) AS head, replace(n_name, '_', '-') AS r, trim(concat('  ', n_name)) AS t, reverse(n_name) AS rev, lpad(n_name, 12, '*') AS lp FROM nation",
    "sql_conditional": "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS s, greatest(o_custkey, o_orderkey) AS g, least(o_custkey, o_orderkey) AS l FROM orders",
    "sql_math": "SELECT p_partkey, abs(p_size - 25) AS d, p_size % 7 AS m, round(sqrt(p_size), 6) AS r, floor(p_retailprice) AS f FROM part",
    "sql_hash": "SELECT c_custkey, md5(c_name) AS m, sha2(c_name, 256) AS s FROM customer",
    "sql_extended_price": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS disc, round(avg(l_discount), 6) AS ad, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus",
}
_DUCK = {
    "sql_inner_join": "round",
    "sql_hash": "SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS s FROM customer",
    "sql_math": "SELECT p_partkey, abs(p_size - 25) AS d, p_size % 7 AS m, round(sqrt(p_size), 6) AS r, CAST(floor(p_retailprice) AS BIGINT) AS f FROM part",
    "sql_running_total": "SELECT o_orderkey, CAST(sum(1) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS running FROM orders",
}
_BOTH["sql_inner_join"] = _BOTH["sql_inner_join"].replace("sum(o_totalprice)", "round(sum(o_totalprice), 2)")
del _DUCK["sql_inner_join"]

RELATIONAL: dict[str, tuple[str, str]] = {name: (sql, _DUCK.get(name, sql)) for name, sql in _BOTH.items()} | {
    "sql_array_agg": (
        "SELECT o_custkey, array_join(sort_array(collect_list(cast(o_orderkey AS string))), ',') AS orders, size(collect_list(o_orderkey)) AS n FROM orders GROUP BY o_custkey",
        "SELECT o_custkey, array_to_string(list_sort(list(CAST(o_orderkey AS VARCHAR))), ',') AS orders, CAST(len(list(o_orderkey)) AS INTEGER) AS n FROM orders GROUP BY o_custkey",
    ),
    "sql_unnest": (
        "SELECT label, count(*) AS n, round(sum(x), 3) AS s FROM (SELECT label, explode(embedding) AS x FROM embeddings) e GROUP BY label",
        "SELECT label, count(*) AS n, round(sum(CAST(x AS DOUBLE)), 3) AS s FROM (SELECT label, unnest(embedding) AS x FROM embeddings) e GROUP BY label",
    ),
    "sql_nested_access": (
        "SELECT vec_id, size(embedding) AS n, round(cast(element_at(embedding, 2) AS double), 6) AS second FROM embeddings",
        "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, round(CAST(embedding[2] AS DOUBLE), 6) AS second FROM embeddings",
    ),
    "sql_json": (
        "SELECT event_id, event_type, props IS NOT NULL AS has_props FROM events WHERE event_type RLIKE '^[a-m]'",
        "SELECT event_id, event_type, props IS NOT NULL AS has_props FROM events WHERE regexp_matches(event_type, '^[a-m]')",
    ),
    "sql_dates": (
        "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, datediff(o_orderdate, TIMESTAMP_NTZ '1995-01-01') AS d, date_format(date_trunc('month', o_orderdate), 'yyyy-MM-dd') AS first FROM orders",
        "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS INTEGER) AS d, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first FROM orders",
    ),
    "sql_percentile": (
        "SELECT l_returnflag, percentile(l_quantity, 0.5) AS med, percentile(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY l_returnflag",
        "SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS med, quantile_cont(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY l_returnflag",
    ),
}
