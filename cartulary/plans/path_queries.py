"""Queries over paths, names and listings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions import patterns, scalars
from cartulary.operators.containment import contains_join, last_containing
from cartulary.operators.joins import exactly_one, missing_extra, select_datasets
from cartulary.operators.paths import PathRules, parse_paths, rebuilt
from cartulary.plans.base import query, shared_dir, table
from cartulary.sources.listing import parse_remote_listing

PATH_SQL = "regexp_replace(url, '^https?://', '')"


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^https?://", "").alias("path"))


@query(f"select page_id, {PATH_SQL} as path from pages where regexp_matches({PATH_SQL}, '^(?s:.*\\.example\\.com/en/.*)$') or regexp_matches({PATH_SQL}, '^(?s:.*/fr/[13]..*)$')")
def glob_filter_full(spark, sf_dir):
    return page_paths(spark, sf_dir).where(patterns.matches_glob(F.col("path"), ["*.example.com/en/*", "*/fr/[13]?*"]))


@query(f"select page_id, {PATH_SQL} as path from pages where split_part({PATH_SQL}, '/', 1) like '%.example.net' or regexp_matches(split_part({PATH_SQL}, '/', 1), '^t[^a]e.*\\.org$')")
def glob_filter_first(spark, sf_dir):
    return page_paths(spark, sf_dir).where(patterns.matches_glob_first_level(F.col("path"), ["*.example.net/nowhere/x", "t[!a]e*.org/zz*"]))


RULES = PathRules(subject=r"[^/]*\.example\.(com|net)$", session="^(en|de|fr)$", modality=(("three", "^[0-9]{3}"), ("two", "^[0-9]{2}"), ("any", "^.")), exclude=("m.*",))


@query(f"""
with p as (select page_id, {PATH_SQL} as path, split_part({PATH_SQL}, '/', 1) as subject, split_part({PATH_SQL}, '/', 2) as session from pages),
r as (select *, substr(path, length(subject) + length(session) + 3) as rest from p)
select page_id, subject, session, '' as type, rest,
  case when regexp_matches(rest, '^[0-9]{{3}}') then 'three' when regexp_matches(rest, '^[0-9]{{2}}') then 'two' else 'any' end as modality, true as rebuilt
from r where regexp_matches(subject, '^[^/]*\\.example\\.(com|net)$') and session in ('en', 'de', 'fr') and rest <> '' and subject not like 'm.%'""")
def segment_prefix_parse(spark, sf_dir):
    out = parse_paths(page_paths(spark, sf_dir), RULES)
    return out.select("page_id", "subject", "session", "type", "rest", "modality", rebuilt().alias("rebuilt"))


@query("select doc_id, case when regexp_matches(source, '^src[02468]$') then 'even' when regexp_matches(source, '^src1') then 'teen' when regexp_matches(source, '^src') then 'other' end as class from documents")
def classify_first_match(spark, sf_dir):
    named = [("even", "src[02468]$"), ("teen", "src1"), ("other", "src")]
    return table(spark, sf_dir, "documents").select("doc_id", patterns.first_match(F.col("source"), named).alias("class"))


@query("""select s_suppkey, s_name from supplier where (regexp_matches(s_name, '^Supplier#.*[0-4]$') or s_name like 'Supplier#%7') and not (s_name like '%11' or regexp_matches(s_name, '^.*2.$'))""")
def include_exclude_subjects(spark, sf_dir):
    keep = patterns.included(F.col("s_name"), ["Supplier#*[0-4]", "Supplier#*7"], ["*11", "*2?"])
    return table(spark, sf_dir, "supplier").where(keep).select("s_suppkey", "s_name")


@query("select n_nationkey, n_name from nation where n_nationkey not in (select s_nationkey from supplier where s_acctbal < 0) and n_nationkey in (select c_nationkey from customer where c_acctbal > 5000)")
def dataset_selection(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_nationkey").alias("n_nationkey"))
    poor = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    return select_datasets(select_datasets(nations, rich, None, "n_nationkey"), None, poor.join(nations, "n_nationkey", "left_semi").join(rich, "n_nationkey", "left_semi"), "n_nationkey")


@query(f"""
with p as (select page_id, {PATH_SQL} || '.tar.gz' as path from pages), n as (select *, regexp_extract(path, '[^/]*$') as name from p)
select page_id, len(string_split(path, '/'))::bigint as n_parts, name, regexp_replace(name, '^(.+)\\.[^.]+$', '\\1') as stem, regexp_extract(name, '^.+(\\.[^.]+)$', 1) as suffix,
  regexp_replace(path, '/[^/]*$', '') as parent from n""")
def path_scalars(spark, sf_dir):
    path = F.concat("path", F.lit(".tar.gz"))
    return page_paths(spark, sf_dir).select(
        "page_id", F.size(F.split(path, "/")).cast("bigint").alias("n_parts"), scalars.path_name(path).alias("name"), scalars.path_stem(path).alias("stem"),
        scalars.path_suffix(path).alias("suffix"), scalars.path_parent(path).alias("parent"),
    )


@query("""
select page_id, case page_id % 3 when 0 then regexp_replace(regexp_extract(url, '[^/?#]*\\.[a-z]+/[a-z]+'), '$', '/a') || '.json' when 1 then 'x/' || page_id || '.json' else 'x/' || page_id || '.v2.json' end as sidecar from pages""")
def sidecar_paths(spark, sf_dir):
    base = F.concat(F.regexp_extract("url", r"[^/?#]*\.[a-z]+/[a-z]+", 0), F.lit("/a.nii.gz"))
    odd = F.concat(F.lit("x/"), F.col("page_id"), F.lit(".v2.NII.GZ"))
    path = F.when(F.col("page_id") % 3 == 0, base).when(F.col("page_id") % 3 == 1, odd).otherwise(F.concat(F.lit("x/"), F.col("page_id"), F.lit(".v2.1.nii")))
    return table(spark, sf_dir, "pages").select("page_id", scalars.sidecar_path(path).alias("sidecar"))


@query(r"""
select page_id, page_id % 4 = 0 as is_dir, case when page_id % 4 = 0 then 'dir ' || page_id else 'file with ' || page_id || '.nii.gz' end as name from pages""")
def listing_parse(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id")
    line = F.when(F.col("page_id") % 4 == 0, F.format_string("                           PRE dir %d/", "page_id")).otherwise(F.format_string("2023-01-01 10:00:00       1234 file with   %d.nii.gz", "page_id"))
    return pages.select("page_id", parse_remote_listing(line).alias("r")).select("page_id", "r.*")


def page_listing(spark, sf_dir):
    """The pages' paths as a store's tool lists them, host by host: a folder for every seventh page, a file for the others; written to the shared folder."""
    path = f"{shared_dir(spark)}/listing-{uuid.uuid4().hex}"
    pages = page_paths(spark, sf_dir).select("page_id", F.split_part("path", F.lit("/"), F.lit(1)).alias("prefix"), F.regexp_replace("path", "^[^/]*/", "").alias("name"))
    told = F.format_string("2024-%02d-01 10:00:%02d  %8d  %s", F.col("page_id") % 12 + 1, F.col("page_id") % 60, F.col("page_id") * 10, "name")
    line = F.when(F.col("page_id") % 7 == 0, F.format_string("                           PRE %s/", "name")).otherwise(told)
    pages.select("prefix", line.alias("value")).write.partitionBy("prefix").text(path)
    return path


@query(f"""
with p as (select page_id, split_part({PATH_SQL}, '/', 1) as prefix, regexp_replace({PATH_SQL}, '^[^/]*/', '') as name from pages)
select prefix, case when page_id % 7 = 0 then rtrim(name, '/') else name end as name, page_id % 7 = 0 as is_dir, case when page_id % 7 > 0 then page_id * 10 end as size, case when page_id % 7 > 0 then make_timestamp(2024, page_id % 12 + 1, 1, 10, 0, page_id % 60) end as modified from p""")
def listing_scan(spark, sf_dir):
    """A whole listing read back through the data source, a partition for each host's file or part of one."""
    from cartulary.sources import remote

    remote.register(spark)
    return spark.read.format("listing").option("path", page_listing(spark, sf_dir)).load()


@query(f"""
with p as (select page_id, split_part({PATH_SQL}, '/', 1) as prefix, regexp_replace({PATH_SQL}, '^[^/]*/', '') as name from pages)
select prefix, count(*) as n_files, sum(page_id * 10)::bigint as size from p where prefix like '%s%' and page_id % 7 > 0 and page_id * 10 >= 200 and name like 'en/%' group by 1""")
def listing_pushed(spark, sf_dir):
    """Files of some hosts: the conditions go to the source, so other hosts aren't listed."""
    found = listing_scan(spark, sf_dir).where("prefix like '%s%' and not is_dir and size >= 200 and name like 'en/%'")
    return found.groupBy("prefix").agg(F.count("*").alias("n_files"), F.sum("size").alias("size"))


@query("""
with e as (select distinct case when o_orderkey % 3 = 0 then -o_orderkey else o_orderkey end as k from orders), f as (select distinct case when l_orderkey % 5 = 0 then -l_orderkey else l_orderkey end as k from lineitem)
select coalesce(e.k, f.k) as orderkey, case when f.k is null then 'missing' else 'extra' end as status from e full join f on e.k = f.k where e.k is null or f.k is null""")
def verify_missing_extra(spark, sf_dir):
    # all rows of both; keys that one side alone has come from arithmetic
    expected = table(spark, sf_dir, "orders").select(F.expr("if(o_orderkey % 3 = 0, -o_orderkey, o_orderkey)").alias("orderkey"))
    found = table(spark, sf_dir, "lineitem").select(F.expr("if(l_orderkey % 5 = 0, -l_orderkey, l_orderkey)").alias("orderkey"))
    return missing_extra(expected, found, ["orderkey"])


@query("""
select o_orderkey, o_orderstatus, l_partkey from orders join (select l_orderkey, min(l_partkey) as l_partkey from lineitem group by l_orderkey having count(*) = 1) on o_orderkey = l_orderkey""")
def exactly_one_match(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(exactly_one(lines, ["o_orderkey"], "l_partkey"), "o_orderkey")


@query("select doc_id, item_id from documents d join benchmark b on contains(d.text, b.text)")
def contains_match(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("needle"))
    return contains_join(docs, items, "text", "needle", ["doc_id"]).select("doc_id", "item_id")


@query(f"""
with p as (select page_id, {PATH_SQL} as path from pages), w as (select n_nationkey, case n_nationkey % 4 when 0 then 'en' when 1 then 'xamp' when 2 then 'e.com/d' else '~' end as part, (n_nationkey % 10)::varchar as digit from nation)
select n_nationkey, part, digit, arg_max(path, (page_id, path)) as path from w left join p on contains(path, part) and contains(path, digit) group by 1, 2, 3""")
def last_match_wins(spark, sf_dir):
    k = F.col("n_nationkey")
    part = F.when(k % 4 == 0, "en").when(k % 4 == 1, "xamp").when(k % 4 == 2, "e.com/d").otherwise("~")
    wanted = table(spark, sf_dir, "nation").select("n_nationkey", part.alias("part"), (k % 10).cast("string").alias("digit"))
    return last_containing(page_paths(spark, sf_dir), wanted, "path", ["part", "digit"], ["page_id"])
