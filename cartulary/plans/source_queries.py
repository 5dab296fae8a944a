"""Queries through readers and writers: tables go out as files in the shared folder, by the tasks, and come back."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions import patterns
from cartulary.operators import registry, steps  # noqa: F401  (steps register themselves)
from cartulary.plans import split_queries
from cartulary.plans.base import query, shared_dir, table
from cartulary.sources import listing, sinks, tables
from cartulary.sources.stores import store_of


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def write_files(rows: DataFrame, root: str) -> int:
    """Write ``rows(path, text)`` as files below ``root``, each in the task that has its row; how many."""

    def write(batches):
        store, base = store_of(root)
        for batch in batches:
            for folder in sorted({f"{base}/{p}".rpartition("/")[0] for p in batch["path"]}):
                store.create_dir(folder, recursive=True)
            for path, text in zip(batch["path"], batch["text"], strict=True):
                with store.open_output_stream(f"{base}/{path}", compression=None) as f:
                    f.write(text.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    return rows.select("path", "text").mapInPandas(write, "n bigint").agg(F.sum("n")).first()[0] or 0


@query("select c_custkey::varchar as c_custkey, c_name, case when c_custkey % 4 = 0 then null when c_custkey % 4 = 1 then 'a \"b\" c' else c_mktsegment end as cell from customer")
def tsv_cells(spark, sf_dir):
    """A table of participants out as tab-separated text and read back: all cells texts, blank ones null, quotes kept."""
    root = fresh_dir(spark, "tsv")
    k = F.col("c_custkey") % 4
    told = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(k == 1, 'a "b" c').when(k > 1, F.col("c_mktsegment")).alias("cell"))
    told.write.csv(root, sep="\t", header=True, quote='"', escape='"')
    return tables.read_tsv(spark, root)


@query("select 'd' as dataset, n_nationkey::varchar as n_nationkey, \"column\", value from (select n_nationkey, unnest(['n_nationkey', 'n_name']) as \"column\", unnest([n_nationkey::varchar, n_name]) as value from nation)")
def tsv_melted(spark, sf_dir):
    """A table's cells in the long form in which tables of other headers can join it."""
    root = fresh_dir(spark, "tsv")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.csv(root, sep="\t", header=True)
    long = tables.melt(tables.read_tsv(spark, root), "d")
    named = long.where("`column` = 'n_nationkey'").select("row_idx", F.col("value").alias("n_nationkey"))
    return long.join(named, "row_idx").select("dataset", "n_nationkey", "column", "value")


ENTRY_SQL = "select c_mktsegment as dataset, 'sub-' || c_custkey as subject, c_nationkey as \"group\", case when c_custkey % 2 = 0 then 'a/t1.nii' end as t1w, c_name || '.nii' as flair from customer"


def entries(spark, sf_dir) -> DataFrame:
    files = F.create_map(F.lit("flair"), F.concat("c_name", F.lit(".nii")))
    more = F.when(F.col("c_custkey") % 2 == 0, F.map_concat(files, F.create_map(F.lit("t1w"), F.lit("a/t1.nii")))).otherwise(files)
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("dataset"), F.concat(F.lit("sub-"), "c_custkey").alias("subject"), F.col("c_nationkey").alias("group"), more.alias("mris"))


@query(ENTRY_SQL)
def catalogue_written(spark, sf_dir):
    """Entries as a catalogue, a folder a dataset, and read back."""
    root = fresh_dir(spark, "catalogue")
    sinks.write_catalogue(entries(spark, sf_dir), root)
    back = spark.read.schema("dataset string, subject string, `group` int, mris map<string,string>").json(root)
    return back.select("dataset", "subject", "group", F.try_element_at("mris", F.lit("t1w")).alias("t1w"), F.try_element_at("mris", F.lit("flair")).alias("flair"))


@query(ENTRY_SQL)
def catalogue_documents(spark, sf_dir):
    """Entries as JSON documents, lists by dataset, and read back entry by entry; a document holds some customers of one segment."""
    root = fresh_dir(spark, "documents")
    told = entries(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("subject"), F.lit(max(1, table(spark, sf_dir, "customer").count() // 2000))))
    documents = told.groupBy("dataset", "part").agg(F.collect_list(F.struct("subject", "group", "mris")).alias("es"))
    documents.select(F.concat_ws("-", "dataset", "part").alias("file"), F.to_json(F.create_map("dataset", "es")).alias("value")).write.partitionBy("file").text(root)
    back = tables.read_catalogue(spark, f"{root}/*")
    return back.select("dataset", "subject", "group", F.try_element_at("mris", F.lit("t1w")).alias("t1w"), F.try_element_at("mris", F.lit("flair")).alias("flair"))


@query(split_queries.LABELLED_SQL + " select split, o_orderkey, subject from labelled")
def split_written(spark, sf_dir):
    """Labelled records as a folder a split, and read back."""
    root = fresh_dir(spark, "split")
    sinks.write_splits(split_queries.labelled(spark, sf_dir), root)
    return spark.read.schema("o_orderkey bigint, subject string, split string").json(root).select("split", "o_orderkey", "subject")


TREE_SQL = "select page_id, case when page_id % 4 = 0 then 'keep' when page_id % 4 = 1 then 'k2ep' else 'other ' || page_id % 3 end || '/' || lower(substr(md5(page_id::varchar), 1, 1)) || '/' || page_id || case when page_id % 2 = 0 then '.img' else '.txt' end as path, octet_length(encode(url)) as length from pages"


def tree(spark, sf_dir) -> str:
    root, k = fresh_dir(spark, "tree"), F.col("page_id")
    top = F.when(k % 4 == 0, "keep").when(k % 4 == 1, "k2ep").otherwise(F.concat(F.lit("other "), k % 3))
    path = F.concat(top, F.lit("/"), F.substring(F.md5(k.cast("string").cast("binary")), 1, 1), F.lit("/"), k, F.when(k % 2 == 0, ".img").otherwise(".txt"))
    write_files(table(spark, sf_dir, "pages").select(path.alias("path"), F.col("url").alias("text")), root)
    return root


@query(f"select path, length from ({TREE_SQL})")
def listed_files(spark, sf_dir):
    """Every file of a tree, with its size."""
    return listing.list_files(spark, tree(spark, sf_dir)).select("path", "length")


@query(f"select path, length from ({TREE_SQL}) where regexp_matches(path, '^keep/.*\\.img$') or regexp_matches(path, '^other 1/[0-7]/.*$')")
def inventory_files(spark, sf_dir):
    """Files that globs ask for; only the top folders that may hold some are listed in depth."""
    return listing.inventory(spark, tree(spark, sf_dir), ["keep/*.img", "other [1]/[0-7]/*", "none/*"]).select("path", "length")


@query(f"select distinct split_part(path, '/', 1) as name from ({TREE_SQL})")
def dataset_folders(spark, sf_dir):
    """The folders of datasets."""
    return spark.createDataFrame([(n,) for n in listing.subdirectories(spark, tree(spark, sf_dir), True)], "name string")


SIDECAR_SQL = "select p_partkey, case when p_partkey % 5 = 0 then null else p_brand end as maker, case when p_partkey % 5 = 0 then null when p_partkey % 3 = 0 then p_size::varchar else p_size || 'T' end as strength from part"


@query(SIDECAR_SQL)
def sidecars_read(spark, sf_dir):
    """A sidecar for each part, some malformed, as maps of texts."""
    root, k = fresh_dir(spark, "sidecars"), F.col("p_partkey")
    strength = F.when(k % 3 == 0, F.col("p_size").cast("string")).otherwise(F.concat(F.lit('"'), "p_size", F.lit('T"')))
    text = F.when(k % 5 == 0, "[1, 2").otherwise(F.concat(F.lit('{"Manufacturer": "'), "p_brand", F.lit('", "MagneticFieldStrength": '), strength, F.lit("}")))
    write_files(table(spark, sf_dir, "part").select(F.format_string("%d/scan %d.json", k % 50, k).alias("path"), text.alias("text")), root)
    back = tables.read_sidecars(spark, root)
    cell = lambda f: F.try_element_at("fields", F.lit(f))
    return back.select(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("bigint").alias("p_partkey"), cell("Manufacturer").alias("maker"), cell("MagneticFieldStrength").alias("strength"))


@query("select n_name as dataset, n_nationkey % 4 = 0 as broken, case when n_nationkey % 4 > 0 then 'The ' || n_name end as title, case when n_nationkey % 4 > 0 then n_regionkey::varchar end as note from nation")
def infos_read(spark, sf_dir):
    """An info file for each nation, some of them no mapping."""
    root, k = fresh_dir(spark, "infos"), F.col("n_nationkey")
    text = F.when(k % 4 == 0, "- a\n- b\n").otherwise(F.concat(F.lit("title: The "), "n_name", F.lit("\nnote: "), "n_regionkey", F.lit("\n")))
    write_files(table(spark, sf_dir, "nation").select(F.concat("n_name", F.lit("/info.yaml")).alias("path"), text.alias("text")), root)
    info = tables.read_infos(spark, root)
    return info.select("dataset", (F.size("info") == 0).alias("broken"), F.try_element_at("info", F.lit("title")).alias("title"), F.try_element_at("info", F.lit("note")).alias("note"))


@query(r"""select page_id, regexp_matches(url, '^(https?)://[^\n]*/([0-9])[0-9]*') as starts, regexp_matches(url, '^[^\n]*/([0-9]+)\z') as ends, regexp_matches(url, '^https?://(www\.)?[\p{L}\p{N}_-]+\.') as word from pages""")
def python_patterns(spark, sf_dir):
    """Patterns in Python's syntax, matched in the plan."""
    hit = lambda p: F.col("url").rlike(patterns.from_start(p))
    return table(spark, sf_dir, "pages").select("page_id", hit(r"(?P<scheme>https?)://.*/(?P<d>[0-9])[0-9]*").alias("starts"), hit(r".*/(?P<n>\d+)\Z").alias("ends"), hit(r"https?://(?P<w>www\.)?(?(w)[\w-]+|[\w-]+)\.").alias("word"))


@query(split_queries.SPLIT_SQL + ", r as (select * from records) select r.o_orderkey, s.split from r join splits s on r.dataset = s.dataset and lower(r.subject) = s.subject")
def named_steps(spark, sf_dir):
    """Records through steps by name: the pass-through preprocessor, then the split's exporter."""
    told = split_queries.records(spark, sf_dir).withColumn("path", F.col("subject"))
    done = registry.preprocessors.run(told, "pass_through")
    out = registry.exporters.run(done, "split", seed=42, train=0.8, val=0.1, test=0.1)
    return out.where("preprocessed = subject").select("o_orderkey", "split")


def prepared_tree(spark, sf_dir) -> tuple[str, str]:
    """(datasets, tables of participants) of the suppliers: a dataset for each region, a file for each supplier and some twice, settings, sidecars and people."""
    root, k = fresh_dir(spark, "raw"), F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("region")), "s_nationkey")
    where = F.concat(F.lit("raw/D"), "region", F.lit("/Download/sub-"), k, F.lit("/ses-"), k % 3, F.lit("/anat/"))
    names = F.filter(F.array(F.lit("a_T1w.nii.gz"), F.when(k % 4 == 0, "b_T1w.nii.gz"), F.when(k % 2 == 0, "x_T2w.nii.gz"), F.lit("other.txt")), lambda x: x.isNotNull())
    files = suppliers.select(F.explode(names).alias("name"), where.alias("where")).select(F.concat("where", "name").alias("path"), F.lit("x").alias("text"))
    cars = suppliers.where(k % 5 < 2).select(F.concat(where, F.lit("a_T1w.json")).alias("path"), F.concat(F.lit('{"Manufacturer": "'), F.when(k % 5 == 0, "").otherwise(F.col("s_name")), F.lit('"}')).alias("text"))
    regex = {"subject": "^sub-.*$", "session": "^ses-", "type": "^anat$", "modality": {"t1w": "^.*T1w.nii.gz$", "t2w": "^.*T2w.nii.gz$"}}
    settings = json.dumps({"mapping": {"regex": regex}})
    regions = table(spark, sf_dir, "region")
    top = regions.select(F.explode(F.array(F.struct(F.concat(F.lit("raw/D"), "r_regionkey", F.lit("/metadata.json")).alias("path"), F.lit(settings).alias("text")), F.struct(F.concat(F.lit("raw/D"), "r_regionkey", F.lit("/Download/T1w.json")).alias("path"), F.concat(F.lit('{"Manufacturer": "far'), "r_regionkey", F.lit('"}')).alias("text")))).alias("f")).select("f.*")
    write_files(files.unionByName(cars).unionByName(top), root)
    people = suppliers.where(k % 3 < 2).select(F.concat(F.lit("D"), "region").alias("dataset"), F.concat(F.when(k % 2 == 0, "sub-").otherwise(""), k).alias("participant_id"), F.when(k % 7 == 0, "n/a").otherwise((k % 90).cast("string")).alias("Age"))
    for r in regions.collect():  # five datasets
        people.where(F.col("dataset") == f"D{r.r_regionkey}").drop("dataset").write.csv(f"{root}/people/D{r.r_regionkey}/participants.tsv", sep="\t", header=True)
    return f"{root}/raw", f"{root}/people"


@query("""
with s as (select s_suppkey as k, 'D' || n_regionkey as dataset, s_name, n_regionkey as r from supplier join nation on s_nationkey = n_nationkey),
e as (select *, unnest(case when k % 4 = 0 then [0, 1] else [0] end) as g from s)
select dataset, 'sub-' || k as subject, 'ses-' || k % 3 as session, g as "group", case when g = 0 then 'a_T1w.nii.gz' else 'b_T1w.nii.gz' end as t1w, case when g = 0 and k % 2 = 0 then 'sub-' || k || '/ses-' || k % 3 || '/anat/x_T2w.nii.gz' end as t2w,
  case when g = 0 and k % 5 = 1 then s_name else 'far' || r end as maker, case when k % 3 < 2 and k % 7 > 0 then (k % 90)::varchar end as age from e""")
def prepared_entries(spark, sf_dir):
    """The whole preparation of a folder of datasets: mapping, sidecars with their fallback, participants."""
    from cartulary.operators.normalize import Field
    from cartulary.prepare import prepare

    raw, people = prepared_tree(spark, sf_dir)
    out = prepare(spark, raw, people=people, fields=[Field("participant_id"), Field("age", ("Age",))])
    if out.problems:
        raise ValueError(str(out.problems))
    cell = lambda m, *ks: F.try_element_at(m, F.lit(ks[0])) if len(ks) == 1 else F.try_element_at(F.try_element_at(m, F.lit(ks[0])), F.lit(ks[1]))
    return out.entries.select("dataset", "subject", "session", "group", cell(F.col("mris"), "t1w").alias("t1w"), cell(F.col("download"), "t2w").alias("t2w"), cell(F.col("scanner"), "t1w", "Manufacturer").alias("maker"), cell(F.col("demographics"), "age").alias("age"))
