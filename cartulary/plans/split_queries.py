"""Queries of the split and its tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartulary.operators import split
from cartulary.plans.base import query, table

RECORDS_SQL = "records as (select c_mktsegment as dataset, 'C' || o_custkey % 900 as subject, o_orderpriority as modality, o_orderkey from orders join customer on o_custkey = c_custkey)"
SPLIT_SQL = f"""
with {RECORDS_SQL},
held as (select distinct dataset, lower(subject) as subject, modality from records),
coverage as (select dataset, modality, count(*) as coverage from held group by all),
rarest as (select dataset, subject, arg_min(modality, (coverage, modality)) as stratum from held join coverage using (dataset, modality) group by all),
ranked as (select *, row_number() over (partition by dataset, stratum order by md5('42|' || subject), subject) as rn, count(*) over (partition by dataset, stratum) as n from rarest),
splits as (select dataset, subject, stratum, case when rn <= floor(n * 0.8::double) then 'train' when rn <= floor(n * 0.8::double) + floor(n * 0.1::double) then 'val' else 'test' end as split from ranked)"""
LABELLED_SQL = SPLIT_SQL + ", labelled as (select r.*, s.split from records r join splits s on r.dataset = s.dataset and lower(r.subject) = s.subject)"


def records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return orders.join(customers, "o_custkey").select(F.col("c_mktsegment").alias("dataset"), F.concat(F.lit("C"), F.col("o_custkey") % 900).alias("subject"), F.col("o_orderpriority").alias("modality"), "o_orderkey")


def labelled(spark, sf_dir):
    told = records(spark, sf_dir)
    return split.label_records(told, split.assign_splits(told))


@query(SPLIT_SQL + " select * from splits")
def split_stratified(spark, sf_dir):
    return split.assign_splits(records(spark, sf_dir))


@query(LABELLED_SQL + " select o_orderkey, dataset, subject, modality, split from labelled")
def split_records(spark, sf_dir):
    return labelled(spark, sf_dir)


@query("""
with s as (select c_name as subject, case when c_nationkey < 5 then 'validation' else 'training' end as pool from customer),
n as (select round_even(count(*) * 0.1, 0) as test, round_even(count(*) * 0.1, 0) as val, count(*) filter (pool = 'validation') as v from s),
r as (select *, row_number() over (partition by pool order by md5('42|' || subject), subject) as rn from s)
select subject, pool, case when pool = 'validation' and rn <= test then 'test' when pool = 'validation' then 'val' when rn <= greatest(0, val - (v - test)) then 'val' else 'train' end as split from r, n""")
def split_two_pool(spark, sf_dir):
    pool = F.when(F.col("c_nationkey") < 5, "validation").otherwise("training")
    return split.assign_two_pools(table(spark, sf_dir, "customer").select(F.col("c_name").alias("subject"), pool.alias("pool")))


@query(LABELLED_SQL + """ select 0::bigint as n_overlapping, 0::bigint as n_unassigned, (select count(*) from records) as n_records, (select count(*) from labelled) as n_labelled""")
def split_check(spark, sf_dir):
    return split.check_splits(records(spark, sf_dir), labelled(spark, sf_dir))


@query(LABELLED_SQL + """
select coalesce(modality, 'All') as modality, count(*) filter (split = 'train') as train, count(*) filter (split = 'val') as val, count(*) filter (split = 'test') as test, count(*) as total,
  round(100.0 * count(*) / (select count(*) from labelled), 1) as share from labelled group by rollup(modality)""")
def distribution_table(spark, sf_dir):
    return split.distribution_table(labelled(spark, sf_dir))


@query(f"with {RECORDS_SQL}, coverage as (select dataset, modality, count(distinct lower(subject)) as n from records group by all) select dataset, string_agg(modality, ',' order by n, modality) as modalities from coverage group by 1")
def modality_order(spark, sf_dir):
    return split.modality_order(records(spark, sf_dir)).select("dataset", F.array_join("modalities", ",").alias("modalities"))


@query(f"""
with {RECORDS_SQL}, cased as (select dataset, case when o_orderkey % 2 = 0 then subject else lower(subject) end as subject, modality from records)
select dataset, lower(subject) as subject, count(*) as n_records, array_to_string(list_sort(list(distinct subject)), ',') as spellings, array_to_string(list_sort(list(distinct modality)), ',') as modalities from cased group by 1, 2""")
def subject_records(spark, sf_dir):
    """The records of each subject, however it is spelt."""
    told = records(spark, sf_dir)
    cased = told.withColumn("subject", F.when(F.col("o_orderkey") % 2 == 0, F.col("subject")).otherwise(F.lower("subject")))
    out = split.records_by_subject(cased)
    return out.select("dataset", "subject", "n_records", F.array_join("spellings", ",").alias("spellings"), F.array_join("modalities", ",").alias("modalities"))
