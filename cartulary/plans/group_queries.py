"""Queries over positions within groups and sets of names."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartulary.operators import grouping
from cartulary.plans.base import query, table

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]
RANK_SQL = f"row_number() over (partition by l_orderkey, l_returnflag order by {', '.join(LINE_ORDER)}) - 1"


@query(f"select l_orderkey, l_returnflag, l_partkey, l_linenumber, l_extendedprice, {RANK_SQL} as grp from lineitem")
def group_index(spark, sf_dir):
    return grouping.group_index(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"], LINE_ORDER).select("l_orderkey", "l_returnflag", "l_partkey", "l_linenumber", "l_extendedprice", "grp")


@query(f"with r as (select *, {RANK_SQL} as grp from lineitem) select l_orderkey, grp, string_agg(l_returnflag || '=' || l_partkey, ',' order by l_returnflag) as files from r group by 1, 2")
def group_pivot_entries(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return grouping.pivot_entries(lines, ["l_orderkey"], "l_returnflag", "l_partkey", LINE_ORDER).select("l_orderkey", "grp", grouping.map_text(F.col("files")).alias("files"))


@query(f"with r as (select *, {RANK_SQL} as grp from lineitem) select l_orderkey, string_agg(l_returnflag || '=' || l_partkey, ',' order by l_returnflag) as files from r where grp = 0 group by 1")
def group_pivot_first(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return grouping.pivot_entries(lines, ["l_orderkey"], "l_returnflag", "l_partkey", LINE_ORDER, first_group_only=True).select("l_orderkey", grouping.map_text(F.col("files")).alias("files"))


@query("select o_custkey, o_orderkey, o_orderstatus, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders) where rn = 1")
def first_entry_per_subject(spark, sf_dir):
    return grouping.first_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("select l_orderkey, case when bool_or(l_returnflag = 'R') then 'R' when bool_or(l_returnflag = 'A') then 'A' else null end as pick from lineitem group by 1")
def priority_pick(spark, sf_dir):
    held = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("held"))
    return held.select("l_orderkey", grouping.priority_pick(F.col("held"), ["R", "A"]).alias("pick"))


@query("select o_orderstatus, string_agg(distinct o_orderpriority, ',' order by o_orderpriority) as kinds from orders group by 1")
def modality_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_orderstatus").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("kinds"))


@query("select c_custkey, c_name from customer order by md5('7|' || c_custkey), c_custkey limit 20")
def seeded_sample(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").orderBy(F.md5(F.concat(F.lit("7|"), "c_custkey").cast("binary")), "c_custkey").limit(20)


@query("select c_custkey, c_name from customer order by c_custkey limit 10")
def first_rows(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(10)
