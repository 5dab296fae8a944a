"""Queries that bring names, keys and values to standard forms, and joins by them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cartulary.functions import scalars, variants
from cartulary.operators import joins, normalize, parallel, settings
from cartulary.operators.containment import maybe_broadcast
from cartulary.operators.normalize import Field
from cartulary.operators.validate import outside, validate
from cartulary.plans.base import query, shared_dir, table
from cartulary.sources.ledger import FlagLedger

ORDER_FIELDS = [
    Field("order_id", ("O_ORDERKEY",)),
    Field("customer_id", (" o_custkey",)),
    Field("status", ("o_orderstatus",), {"finished": ("F",), "open": ("o",), "partial": ("P",)}),
    Field("urgency", ("o_orderpriority",), {"high": ("1-URGENT", "2-high"), "medium": ("3-MEDIUM",), "low": ("4-not specified", "5-LOW")}),
]


@query("select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as status, o_orderpriority as urgency from orders")
def normalize_columns(spark, sf_dir):
    return normalize.normalise_columns(table(spark, sf_dir, "orders"), ORDER_FIELDS, strict=False)


@query("""
select o_orderkey as order_id, o_custkey as customer_id, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' when 'P' then 'partial' end as status,
  case left(o_orderpriority, 1) when '1' then 'high' when '2' then 'high' when '3' then 'medium' else 'low' end as urgency from orders""")
def normalize_values(spark, sf_dir):
    named = normalize.normalise_columns(table(spark, sf_dir, "orders"), ORDER_FIELDS, strict=False)
    ids = ["order_id", "customer_id"]
    texts = named.select(*ids, F.concat(F.lit(" "), F.lower("status")).alias("status"), F.concat("urgency", F.lit("  ")).alias("urgency"))
    return normalize.normalise_values(texts, ORDER_FIELDS[2:])


@query("select o_orderkey, case when o_orderstatus = 'P' then null else lower(o_orderstatus) end as status, case when o_orderstatus = 'P' then 'status' else '' end as rejects from orders")
def normalize_rejects(spark, sf_dir):
    known = Field("status", (), {"f": (), "o": ()})
    out = normalize.normalise_values(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")), [known], strict=False)
    return out.select("o_orderkey", "status", F.array_join("_rejects", ",").alias("rejects"))


@query("""
select event_id, case event_id % 6 when 0 then '' when 1 then '' when 2 then user_id || 'd' when 3 then user_id::varchar when 4 then 'abc' else user_id || '_0' end as value,
  event_id % 6 in (2, 5) as bad_number, event_id % 6 = 3 and user_id > 50 as out_of_range from events""")
def na_and_numeric_checks(spark, sf_dir):
    user, k = F.col("user_id").cast("string"), F.col("event_id") % 6
    cell = F.when(k == 0, " N/A ").when(k == 1, "na").when(k == 2, F.concat(user, F.lit("d"))).when(k == 3, F.concat(F.lit(" "), user)).when(k == 4, "abc").otherwise(F.concat(user, F.lit("_0")))
    return table(spark, sf_dir, "events").select("event_id", normalize.check_cell(cell, 0, 50).alias("c")).select("event_id", "c.*")


@query("select c_custkey, regexp_replace(lower(trim(c_name)), '^customer#?0*', '') as key from customer where regexp_replace(lower(trim(c_name)), '^customer#?0*', '') <> ''")
def strip_prefix_key(spark, sf_dir):
    key = normalize.strip_prefix(F.concat(F.lit("  "), "c_name"), ["^client", "^customer#?0*"])
    return table(spark, sf_dir, "customer").select("c_custkey", key.alias("key")).where("key is not null")


@query("""
with last as (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders)
select c_custkey, c_mktsegment, o_orderkey, coalesce(o_orderpriority, '') as o_orderpriority from customer left join last on o_custkey * 2 = c_custkey and rn = 1""")
def demographics_left_join(spark, sf_dir):
    # customers with an odd key have nobody
    people = table(spark, sf_dir, "orders").select((F.col("o_custkey") * 2).alias("c_custkey"), "o_orderkey", "o_orderpriority", "o_orderdate")
    out = joins.attach(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), people, ["c_custkey"], ["o_orderdate", "o_orderkey"])
    return out.select("c_custkey", "c_mktsegment", "o_orderkey", F.coalesce("o_orderpriority", F.lit("")).alias("o_orderpriority"))


@query("""
with far as (select replace(event_type, 'error', 'fault') as event_type, max(json_extract_string(props, '$.k')::int)::varchar as k from events group by 1)
select e.event_id, case when json_extract_string(props, '$.k') <> '0' and event_id % 3 > 0 then 'k=' || json_extract_string(props, '$.k') || ',unit='
  when far.k is not null then 'k=' || far.k || ',unit=far' else '' end as fields from events e left join far using (event_type)""")
def json_fallback_lookup(spark, sf_dir):
    from cartulary.operators.grouping import map_text

    events = table(spark, sf_dir, "events")
    near = F.from_json("props", "map<string,string>")
    named = F.replace("event_type", F.lit("error"), F.lit("fault"))  # so that errors find no far one
    far = events.groupBy(named.alias("event_type")).agg(F.max(F.get_json_object("props", "$.k").cast("int")).cast("string").alias("far_k"))
    both = events.join(maybe_broadcast(far), "event_type", "left")
    far_map = F.when(F.col("far_k").isNotNull(), F.create_map(F.lit("k"), "far_k", F.lit("unit"), F.lit("far")))
    near_map = F.when(F.col("event_id") % 3 > 0, near)
    return both.select("event_id", map_text(joins.fallback_lookup(near_map, far_map, ["k", "unit"])).alias("fields"))


@query("select coalesce(d.key, o.key) as key, coalesce(o.value, d.value) as value from (select 'k' || r_regionkey as key, r_name as value from region) d full join (select 'k' || (n_nationkey + 3) as key, n_name as value from nation) o on d.key = o.key")
def settings_merge(spark, sf_dir):
    defaults = table(spark, sf_dir, "region").select(F.concat(F.lit("k"), "r_regionkey").alias("key"), F.col("r_name").alias("value"))
    overrides = table(spark, sf_dir, "nation").select(F.concat(F.lit("k"), F.col("n_nationkey") + 3).alias("key"), F.col("n_name").alias("value"))
    return settings.merge_tables(defaults, overrides, "key", "value")


LEDGER_SQL = """
with ledger as (
  select doc_id as dataset, 'quality' as flag, case when quality = 1 then 'true' else 'false' end as value from labels
  union all select doc_id, 'toxic', case when doc_id % 7 = 0 then null when doc_id % 5 = 0 then '"yes"' when toxic = 1 then 'true' else 'false' end from labels),
state as (select dataset, count(*) filter (flag in ('quality', 'toxic') and value in ('true', 'false')) = 2 as patched from ledger group by dataset)"""


def ledger(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    word = lambda c: F.when(F.col(c) == 1, "true").otherwise("false")
    a = labels.select(F.col("doc_id").alias("dataset"), F.lit("quality").alias("flag"), word("quality").alias("value"))
    odd = F.when(F.col("doc_id") % 7 != 0, F.when(F.col("doc_id") % 5 == 0, '"yes"').otherwise(word("toxic")))
    b = labels.select(F.col("doc_id").alias("dataset"), F.lit("toxic").alias("flag"), odd.alias("value"))
    return a.union(b)


@query(LEDGER_SQL + " select dataset, flag, case when patched then 'false' else value end as value, patched from ledger join state using (dataset)")
def flag_reset(spark, sf_dir):
    return settings.reset_flags(ledger(spark, sf_dir), ["quality", "toxic"])


@query(LEDGER_SQL + " select count(*) filter (patched) as n_patched, count(*) filter (not patched) as n_failed from state")
def flag_reset_summary(spark, sf_dir):
    return settings.reset_summary(ledger(spark, sf_dir), ["quality", "toxic"])


@query(LEDGER_SQL + " select doc_id as dataset from documents where doc_id not in (select dataset from ledger where flag = 'quality' and value = 'true')")
def stage_pending(spark, sf_dir):
    return settings.pending(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("dataset")), ledger(spark, sf_dir), "quality")


@query(LEDGER_SQL + """, reset as (select dataset, flag, case when patched then 'false' else value end as value from ledger join state using (dataset) where flag <> 'toxic' or dataset % 11 > 0)
select dataset, flag, value from reset union all select doc_id, 'isCreated', 'true' from documents""")
def ledger_versions(spark, sf_dir):
    """A ledger of three writers' updates: flags of two kinds, a reset of what is there, flags taken out; read back from its versions."""
    told = ledger(spark, sf_dir)
    store = FlagLedger(spark, f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}")
    store.update(told.where("flag = 'quality'"))
    store.update(told.where("flag = 'toxic'"))
    store.update(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("dataset"), F.lit("isCreated").alias("flag"), F.lit("true").alias("value")))
    store.update(lambda now: settings.reset_flags(now, ["quality", "toxic"]).where("patched").select("dataset", "flag", "value"))
    store.remove(lambda now: now.where("flag = 'toxic' and dataset % 11 = 0"))
    return store.read().select(F.col("dataset").cast("bigint").alias("dataset"), "flag", "value")


@query("select n_nationkey, case when n_nationkey % 2 = 0 then 'N' || n_nationkey else n_name end as n_name from nation union all select 100, 'new'")
def ledger_upsert(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    changes = nations.where("n_nationkey % 2 = 0").select("n_nationkey", F.concat(F.lit("N"), "n_nationkey").alias("n_name")).union(spark.range(1).select(F.lit(100), F.lit("new")))
    return settings.upsert(nations, changes, ["n_nationkey"])


@query("""
with v as (select vec_id, list_min(embedding)::double as vmin, list_max(embedding)::double as vmax, list_aggregate(embedding, 'avg')::double as vmean, label from embeddings),
e as (select vec_id, concat_ws(',', case when vmin < -0.3 then 'low' end, case when vmax > 0.3 then 'high' end, case when abs(vmean) > 0.02 then 'mean' end, case when label = 3 then 'label' end) as errors from v)
select vec_id, errors, errors = '' as valid from e""")
def validate_rules(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.array_min("embedding").cast("double").alias("vmin"), F.array_max("embedding").cast("double").alias("vmax"),
        F.aggregate(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x, lambda a: a / F.size("embedding")).alias("vmean"),
    )
    top = float("inf")
    checks = {"low": outside(F.col("vmin"), -0.3, top), "high": outside(F.col("vmax"), -top, 0.3), "mean": outside(F.col("vmean"), -0.02, 0.02), "label": F.col("label") == 3}
    return validate(v, checks).select("vec_id", F.array_join("errors", ",").alias("errors"), "valid")


@query("select c_custkey, case when c_custkey % 3 = 0 then true when c_custkey % 3 = 1 then false end as flag from customer")
def boolean_words(spark, sf_dir):
    k = F.col("c_custkey")
    word = F.when(k % 3 == 0, F.when(k % 2 == 0, " Yes").otherwise("T")).when(k % 3 == 1, F.when(k % 2 == 0, "no ").otherwise("0"))
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.parse_bool(word).alias("flag"))


@query(r"""select p_partkey, array_to_string(list_transform(regexp_extract_all(lower(p_name) || '_' || lower(p_type) || '3t', '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') as title from part""")
def title_words(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", scalars.title_case(F.concat(F.upper("p_name"), F.lit("_"), "p_type", F.lit("3t"))).alias("title"))


@query("""select n_nationkey, case when n_nationkey % 2 = 0 and n_nationkey % 3 = 0 then 'skip' when n_nationkey % 2 = 0 then 'reset' when n_nationkey % 3 = 0 then 'skip' else 'run' end as action,
  case when n_nationkey % 2 = 0 and n_nationkey % 3 = 0 then 'skip' when n_nationkey % 2 = 0 then 'reset' when n_nationkey % 3 = 0 then 'rerun' else 'run' end as redo from nation""")
def stage_actions(spark, sf_dir):
    """Flags held against what the folders hold."""
    state = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") % 2 == 0).alias("done"), (F.col("n_nationkey") % 3 == 0).alias("filled"))
    redone = settings.stage_actions(state, redo=True).select("n_nationkey", F.col("action").alias("redo"))
    return settings.stage_actions(state).select("n_nationkey", "action").join(redone, "n_nationkey")


REPORT_SQL = "select user_id as dataset, ts as at, event_id as seq, case when event_type in ('purchase', 'error') then 'done' when event_type in ('view', 'click') then 'content' end as kind, event_type in ('purchase', 'view') as value from events"


@query("""
with s as (select user_id as dataset, coalesce(arg_max(event_type = 'purchase', (ts, event_id)) filter (event_type in ('purchase', 'error')), false) as done,
  coalesce(arg_max(event_type = 'view', (ts, event_id)) filter (event_type in ('view', 'click')), false) as filled from events where event_type in ('purchase', 'error', 'view', 'click') group by 1)
select dataset::varchar as dataset, done, filled, case when done and filled then 'skip' when done then 'reset' when filled then 'rerun' else 'run' end as action from s""")
def streaming_stage_actions(spark, sf_dir):
    """What is to be done for each user, from reports that arrive in three parts; each part is taken by a stream that starts from the checkpoint of the one before."""
    from cartulary.streaming.incremental import run_available, write_by_batch
    from cartulary.streaming.stages import follow_stages, newest_actions

    root = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    # a session of its own: a stream keeps as many partitions of state as it begins with, here no more than there are cores
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))))
    table(own, sf_dir, "events").createOrReplaceTempView("events_reported")
    reports = own.sql(REPORT_SQL.replace("from events", "from events_reported"))
    for k in range(3):
        reports.where((F.dayofmonth("at") - 1).between(11 * k, 11 * k + 10)).write.mode("append").parquet(f"{root}/reports")
        stream = own.readStream.schema(reports.schema).parquet(f"{root}/reports")
        run_available(follow_stages(stream, redo=True), write_by_batch(f"{root}/out"), f"{root}/checkpoint", mode="update")
    return newest_actions(spark.read.parquet(f"{root}/out"), "batch")


NESTED_SQL = """
with d as (select event_id, json_extract_string(props, '$.k')::int as k from events),
s as (select event_id, case when event_id % 5 = 0 then '"yes"' when event_id % 5 = 1 then null when k % 2 = 0 then 'true' else 'false' end as done, case when event_id % 7 = 0 then '1' when event_id % 7 = 1 then 'null' else 'true' end as fresh, k from d),
t as (select *, coalesce(done in ('true', 'false'), false) and fresh = 'true' as patched from s)"""


def nested_settings(spark, sf_dir):
    """Settings of each event as JSON text, flags inside objects: of the wrong kind, null or not there in some."""
    i, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")
    done = F.when(i % 5 == 0, '"yes"').when(i % 5 != 1, F.when(k % 2 == 0, "true").otherwise("false"))
    fresh = F.when(i % 7 == 0, "1").when(i % 7 == 1, "null").otherwise("true")
    stage = F.concat(F.lit('{"k": '), k, F.coalesce(F.concat(F.lit(', "isDone": '), done), F.lit("")), F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"stage": '), stage, F.lit(', "isFresh": '), fresh, F.lit("}")).alias("settings"))


@query(NESTED_SQL + """ select event_id, patched, case when patched then '{"isFresh":false,"stage":{"isDone":false,"k":' || k || '}}'
  else '{"stage": {"k": ' || k || coalesce(', "isDone": ' || done, '') || '}, "isFresh": ' || fresh || '}' end as settings from t""")
def nested_flag_reset(spark, sf_dir):
    """Flags inside JSON objects, reset where all are there and boolean."""
    return variants.reset_nested(nested_settings(spark, sf_dir), "settings", ["stage.isDone", "isFresh"])


@query(NESTED_SQL + """ select event_id, flag, kind, value from (
  select event_id, 'stage.isDone' as flag, case when done is null then 'MISSING' when done = '"yes"' then 'STRING' else 'BOOLEAN' end as kind, case when done in ('true', 'false') then done = 'true' end as value from t
  union all select event_id, 'isFresh', case fresh when '1' then 'BIGINT' when 'null' then 'VOID' else 'BOOLEAN' end, case when fresh = 'true' then true end from t)""")
def nested_flags(spark, sf_dir):
    """What kind of value each flag has inside the JSON objects."""
    return variants.flags_of(nested_settings(spark, sf_dir), "event_id", "settings", ["stage.isDone", "isFresh"])


@query("select event_id, case when event_id % 9 not in (4, 5) then json_extract_string(props, '$.k')::bigint end as k, case event_id % 9 when 4 then 'JSONDecodeError' when 5 then 'KeyError' end as error from events")
def mapped_rows(spark, sf_dir):
    """A Python function over every event; where it fails, the row says so."""
    import json

    told = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 9 == 4, "{broken").when(F.col("event_id") % 9 == 5, "{}").otherwise(F.col("props")).alias("props"))
    out = parallel.map_rows(told, lambda row: {"k": json.loads(row["props"])["k"]}, "k bigint")
    return out.select("row.event_id", "result.k", F.split_part("error", F.lit(":"), F.lit(1)).alias("error"))
