"""Aggregate reports and what is written from them."""

from __future__ import annotations

import gzip
import struct
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.functions import bibtex, scalars
from cartulary.operators import render, reports
from cartulary.operators.validate import HeaderRules, validate_headers
from cartulary.plans.base import query, shared_dir, table
from cartulary.sources import catalogue, copying, listing, nifti, sinks
from cartulary.sources.stores import store_of


@query("""select count(distinct conv_id) as n_subjects, count(distinct (conv_id, role)) as n_sessions, count(*) as n_total, count(*) filter (role = 'user') as n_user,
  count(*) filter (role = 'assistant') as n_assistant, count(*) filter (role = 'system') as n_system from conversations""")
def stats_summary(spark, sf_dir):
    return reports.subject_summary(table(spark, sf_dir, "conversations"), "conv_id", "role", "role", ["user", "assistant", "system"])


@query("""with per as (select s_nationkey, l_returnflag, count(*) as n from lineitem join supplier on l_suppkey = s_suppkey group by all)
select l_returnflag, sum(n)::bigint as n_rows, count(*) as n_datasets, round(100.0 * sum(n) / sum(sum(n)) over (), 4) as pct from per group by 1""")
def catalogue_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return reports.catalogue_counts(lines.join(suppliers, "l_suppkey"), "s_nationkey", "l_returnflag")


@query("""select n_name, count(distinct c_custkey) as n_subjects, count(*) filter (o_orderstatus = 'F') as n_finished, count(*) filter (o_orderstatus = 'O') as n_open,
  count(*) filter (o_orderstatus = 'P') as n_partial from nation join customer on n_nationkey = c_nationkey join orders on c_custkey = o_custkey group by 1 order by 1""")
def dataset_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(*(F.count_if(F.col("o_orderstatus") == k).alias(n) for k, n in (("F", "n_finished"), ("O", "n_open"), ("P", "n_partial"))))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    joined = orders.join(customers, "c_custkey").groupBy("n_nationkey").agg(F.count("*").alias("n_subjects"), *(F.sum(c).cast("bigint").alias(c) for c in ("n_finished", "n_open", "n_partial")))
    return joined.join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey").drop("n_nationkey").orderBy("n_name")


@query("""select r_name, count(*) filter (n_nationkey % 3 = 0) as n_flagged, sum(case when n_nationkey % 4 = 0 then 0 else n_nationkey % 4 end)::bigint as n_patterns,
  count(*) filter (n_nationkey % 4 > 0) as n_with_any from nation join region on n_regionkey = r_regionkey group by 1""")
def settings_counts(spark, sf_dir):
    k = F.col("n_nationkey")
    patterns = F.slice(F.array(F.lit("a*"), F.lit("b"), F.lit("c?")), F.lit(1), k % 4)
    told = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("r_regionkey"), (k % 3 == 0).alias("flag"), F.size(patterns).alias("patterns"))
    counted = told.groupBy("r_regionkey").agg(F.count_if("flag").alias("n_flagged"), F.sum("patterns").cast("bigint").alias("n_patterns"), F.count_if(F.col("patterns") > 0).alias("n_with_any"))
    return counted.join(table(spark, sf_dir, "region"), "r_regionkey").drop("r_regionkey")


@query("""select upper(p_brand) as brand, array_to_string(list_transform(regexp_extract_all(p_name, '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') as model, round_even(p_size * 0.3::double * 2, 0) / 2 as strength,
  count(*) as n, sum(count(*)) over (partition by upper(p_brand))::bigint as n_within from part group by 1, 2, 3""")
def combo_counter(spark, sf_dir):
    keys = {"brand": F.upper("p_brand"), "model": scalars.title_case(F.col("p_name")), "strength": scalars.round_to_half(F.col("p_size") * F.lit(0.3))}
    return reports.combination_counts(table(spark, sf_dir, "part"), keys, "brand")


@query("""with s as (select nullif(case when c_custkey % 9 = 0 then '' else c_mktsegment end, '') as category from customer) select category, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 4) as pct from s where category is not null group by 1""")
def categorical_pct(spark, sf_dir):
    told = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 9 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"))
    return reports.category_shares(told, "segment")


@query("""select lang, count(quality) as n_quality, count(toxic) as n_toxic, count(*) filter (quality = 1 and toxic = 1) as n_both, count(*) filter (quality = 1 and toxic = 0) as n_clean, count(*) filter (quality is null) as n_unlabelled
from documents left join labels using (doc_id) group by 1""")
def presence_counts(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    q, t = F.col("quality"), F.col("toxic")
    conditions = {"n_quality": q.isNotNull(), "n_toxic": t.isNotNull(), "n_both": (q == 1) & (t == 1), "n_clean": (q == 1) & (t == 0), "n_unlabelled": q.isNull()}
    return reports.conditional_counts(both, conditions, ["lang"])


@query("select c_mktsegment, count(c_acctbal) as n, round(avg(c_acctbal), 6) as mean, round(stddev_pop(c_acctbal), 6) as std from customer group by 1")
def mean_std_pop(spark, sf_dir):
    return reports.mean_and_spread(table(spark, sf_dir, "customer"), "c_acctbal", ["c_mktsegment"])


BIN_SQL = "least(greatest(ceil(p_size * 2.2::double / 5)::int - 1, 0), 19)"


@query(f"""with c as (select {BIN_SQL} as bin, p_type from part) select b.bin::int as bin, count(*) filter (p_type = 'ECONOMY') as "n_ECONOMY", count(*) filter (p_type = 'STANDARD') as "n_STANDARD", count(*) filter (p_type = 'PROMO') as "n_PROMO"
from (select unnest(range(20)) as bin) b left join c on c.bin = b.bin group by 1""")
def nearest_bin_hist(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select((F.col("p_size") * F.lit(2.2)).alias("age"), "p_type")
    return reports.binned(parts, "age", "p_type", ["ECONOMY", "STANDARD", "PROMO"])


@query(f"""with c as (select {BIN_SQL} as bin, count(*) as n from part group by 1), r as (select bin, sum(n) over (order by bin) as upto, sum(n) over () as total from c)
select min(bin)::int as median_bin, max(total)::bigint as n_total from r where upto * 2 >= total""")
def median_bin(spark, sf_dir):
    return reports.median_bin(table(spark, sf_dir, "part").select((F.col("p_size") * F.lit(2.2)).alias("age")), "age")


@query("""select 'quality' as flag, count(*) filter (quality = 1) as n from labels union all select 'toxic', count(*) filter (toxic = 1) from labels union all select 'any', count(*) filter (quality = 1 or toxic = 1) from labels""")
def any_flag_counts(spark, sf_dir):
    return reports.flag_counts(table(spark, sf_dir, "labels"), {"quality": F.col("quality") == 1, "toxic": F.col("toxic") == 1})


@query("select ts::date as day, count(*) as n, max(value) as max_value, round(avg(value), 6) as mean_value from events group by 1")
def metric_rollup(spark, sf_dir):
    return reports.sampled_metrics(table(spark, sf_dir, "events"), "ts", "value")


@query("select event_type, max(value) as max_value, max(user_id) as max_user, count(*) filter (value > 50) as n_high from events group by 1")
def peak_by_type(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type").agg(F.max("value").alias("max_value"), F.max("user_id").alias("max_user"), F.count_if(F.col("value") > 50).alias("n_high"))


@query(r"""select p_partkey, regexp_replace('50% & ' || p_name || '_#' || p_size || '{$}', '([&%$#_{}])', '\\\1', 'g') as cell from part""")
def latex_escape(spark, sf_dir):
    cell = F.concat(F.lit("50% & "), "p_name", F.lit("_#"), "p_size", F.lit("{$}"))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.latex_escape(cell).alias("cell"))


@query("""select 1::bigint as line_no, '| r_regionkey | r_name |' as line union all select 2, '|---|---|' union all select row_number() over (order by r_regionkey) + 2, '| ' || r_regionkey || ' | ' || r_name || ' |' from region""")
def markdown_rows(spark, sf_dir):
    return render.markdown_lines(table(spark, sf_dir, "region").select("r_regionkey", "r_name"), ["r_regionkey"])


@query(r"""select 'nCustomers' as name, '\newcommand{\nCustomers}{' || count(*) || '}' as line from customer union all select 'nSegments', '\newcommand{\nSegments}{' || count(distinct c_mktsegment) || '}' from customer""")
def macro_report(spark, sf_dir):
    return render.macros(table(spark, sf_dir, "customer").agg(F.count("*").alias("nCustomers"), F.count_distinct("c_mktsegment").alias("nSegments")))


@query("""with r as (select n_regionkey, n_name, row_number() over (partition by n_regionkey order by n_name) as rn from nation)
select n_regionkey, n_name, case when rn = 1 then n_regionkey::varchar else '' end as shown from r""")
def grouped_labels(spark, sf_dir):
    told = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("region"), "n_regionkey", "n_name")
    return render.grouped_labels(told, "region", ["n_name"]).select("n_regionkey", "n_name", "shown")


@query("select 'N' || min(n_nationkey) as dataset, '@article{key' || n_regionkey || ', title={é}}' as entry from nation group by n_regionkey")
def bibliography(spark, sf_dir):
    told = table(spark, sf_dir, "nation")
    # the accent is written apart here and comes out composed
    infos = told.select(F.concat(F.lit("N"), F.format_string("%02d", "n_nationkey")).alias("dataset"), F.concat(F.lit("@article{key"), "n_regionkey", F.lit(", title={é}}")).alias("citation"))
    out = render.bibliography(infos)
    return out.select(F.regexp_replace("dataset", "^N0*(?=[0-9])", "N").alias("dataset"), "entry")


@query("select n_nationkey, 'key' || n_regionkey as cite from nation where n_nationkey % 2 = 0 union all select n_nationkey, null from nation where n_nationkey % 2 = 1")
def citation_keys(spark, sf_dir):
    bib = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("@misc{ key"), "n_regionkey", F.lit(", year=2020}"))).otherwise("none")
    return table(spark, sf_dir, "nation").select("n_nationkey", render.citation_key(bib).alias("cite"))


@query(r"""
with d as (select doc_id as k, coalesce(source, 'none') as source, coalesce(lang, 'xx') as lang from documents)
select k as doc_id, case when k % 17 = 0 or k % 19 = 0 then null else 'doc' || k end as key,
  case when k % 17 = 0 or k % 19 = 0 then '' else 'Müller, J.-P., van ' || lang || ', Q. R., & The ' || source || ' and Friends (' || case when k % 5 = 0 then 'n.d.' else (2000 + k % 25)::varchar end || '). On {' || k || '} & More. Journal of ' || source
    || ', ' || (k % 90 + 1) || case when k % 3 = 0 then '(' || k % 12 || ')' else '' end || ', ' || k || '–' || (k + 9) || '.' || case when k % 2 = 0 then ' https://doi.org/10.1/' || k else '' end end as apa,
  case when k % 17 = 0 then 'broken' when k % 19 = 0 then '2 entries' end as problem from d""")
def references(spark, sf_dir):
    """An entry for each document, some malformed, some doubled, as a reference in APA style."""
    k, source, lang = F.col("doc_id"), F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("xx"))
    year = F.when(k % 5 > 0, F.concat(F.lit(", year = y # "), F.lpad((k % 25).cast("string"), 2, "0")))
    number = F.when(k % 3 == 0, F.concat(F.lit(", number="), k % 12))
    doi = F.when(k % 2 == 0, F.concat(F.lit(", doi={https://doi.org/10.1/"), k, F.lit("}")))
    start = F.concat(F.lit('@string{y = "20"} @article{doc'), k, F.lit(', author = "M{\\\"u}ller, Jean-Paul and Quentin Roland van '), lang, F.lit(" and {The "), source, F.lit(' and Friends}", title={On \\{'), k, F.lit("\\} {\\& {M}ore}.}, journal = {Journal of } # {"), source, F.lit("}"))
    more = F.concat(F.lit(", volume="), k % 90 + 1, F.lit(", pages={"), k, F.lit("--"), k + 9, F.lit("}"))
    entry = F.concat(start, *(F.coalesce(x, F.lit("")) for x in (year, number, more, doi)), F.when(k % 17 == 0, "").otherwise("}"), F.when(k % 19 == 0, " @misc{x, year=1}").otherwise(""))
    told = table(spark, sf_dir, "documents").select(k, bibtex.reference(entry).alias("r"))
    problem = F.when(F.col("r.error").endswith(" entries"), F.col("r.error")).when(F.col("r.error").isNotNull(), "broken")
    return told.select("doc_id", "r.key", "r.apa", problem.alias("problem"))


@query("""select r_regionkey, '# ' || r_name || chr(10) || chr(10) || case when r_regionkey % 2 = 0 then '## Note' || chr(10) || chr(10) || 'n' || r_regionkey || chr(10) || chr(10) else '' end || '## Use' || chr(10) || chr(10) || 'free' || chr(10) as text from region""")
def readme_text(spark, sf_dir):
    note = F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("n"), "r_regionkey")).otherwise(" ")
    return table(spark, sf_dir, "region").select("r_regionkey", render.readme(F.col("r_name"), [("Note", note), ("Use", F.lit("free"))]).alias("text"))


#: A volume for each part, told by its key k and its size s: sizes, numbers, order of bytes, scaling, faults.
VOLUME_COLUMNS = {
    "nx": "3 + s % 6", "ny": "4 + k % 3", "nt": "case when k % 17 = 0 then 2 else 1 end", "zoom": "case when k % 11 = 0 then 1.5 else 1.0 end", "unit": "case when k % 13 = 0 then 1 else 2 end", "sform": "case when k % 19 = 0 then 2 else 1 end",
    "kind": "k % 4", "swapped": "k % 5 = 0", "version": "case when k % 3 = 0 then 2 else 1 end", "zipped": "k % 2 = 0", "scaled": "k % 7 = 0", "short": "k % 23 = 0",
}


def volume_of(r) -> bytes:
    """The file of a row of ``VOLUME_COLUMNS``: voxel i is (7 i + k) modulo s + 1, scaled by 2 i - 3 where told."""
    import numpy as np

    end, code, kind = (">" if r.swapped else "<"), (2, 4, 16, 64)[r.kind], ("u1", "i2", "f4", "f8")[r.kind]
    size = {1: 348, 2: 540}[r.version]
    dim = [3 + (r.nt > 1), r.nx, r.ny, 5, r.nt, 1, 1, 1]
    fields = {"dim": dim, "datatype": [code], "pixdim": [1.0, float(r.zoom), 1, 1, 1, 1, 1, 1], "offset": [size + 4], "slope": [2 if r.scaled else 0], "inter": [-3 if r.scaled else 0], "units": [r.unit], "qform": [1], "sform": [r.sform], "srow": [1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0]}
    head = bytearray(size + 4)
    struct.pack_into(end + "i", head, 0, size)
    for k, v in fields.items():
        f, at = nifti.HEADERS[size][k]
        struct.pack_into(end + f, head, at, *v)
    at, magic = nifti.MAGIC[size]
    head[at : at + 3] = magic[0]
    n = r.nx * r.ny * 5 * r.nt
    data = bytes(head) + ((7 * np.arange(n) + r.k) % (r.s + 1)).astype(end + kind).tobytes()
    data = data[:-1] if r.short else data
    return gzip.compress(data, 1) if r.zipped else data


def write_volumes(told: DataFrame, root: str) -> int:
    """Write each row's file in the task that has the row; how many."""

    def write(batches):
        store, base = store_of(root)
        for batch in batches:
            for folder in sorted({f"{base}/{k % 100:02d}" for k in batch["k"]}):
                store.create_dir(folder, recursive=True)
            for r in batch.itertuples():
                with store.open_output_stream(f"{base}/{r.k % 100:02d}/{r.k}.nii{'.gz' if r.zipped else ''}", compression=None) as f:
                    f.write(volume_of(r))
            yield batch[["k"]]

    return told.mapInPandas(write, "k bigint").count()


@query("with p as (select p_partkey as k, p_size as s from part), v as (select k, s, " + ", ".join(f"{c} as {n}" for n, c in VOLUME_COLUMNS.items()) + """ from p),
x as (select k, unnest(range(nx * ny * 5 * nt)) as i from v), y as (select k, (case when scaled then 2 * ((7 * i + k) % (s + 1)) - 3 else (7 * i + k) % (s + 1) end)::double as value from x join v using (k)),
t as (select k, min(value) as vmin, max(value) as vmax, round(sum(value) / count(*), 9) as vmean, count(*) filter (value <> 0) as nonzero from y group by 1),
e as (select *, concat_ws(',', case when nt > 1 or nx not between 4 and 7 or ny not between 4 and 5 then 'shape' end, case when zoom > 1.2 then 'voxel_size' end, case when unit <> 2 then 'space_unit' end, case when vmin < 0 then 'values' end,
  case when sform <> 1 then 'sform_code' end, case when nonzero = 0 then 'all_zero' end, case when vmean < 4 then 'mean' end) as found from v join t using (k))
select k || case when zipped then '.nii.gz' else '.nii' end as name, case when short then 'load' else found end as errors, not short and found = '' as valid, case when not short then 'RAS' end as orientation,
  case when not short then vmin end as vmin, case when not short then vmax end as vmax, case when not short then vmean end as vmean, case when not short then nonzero end as nonzero from e""")
def nifti_header_scan(spark, sf_dir):
    """A volume for each part, written by the tasks to the shared folder and read as any folder of volumes is."""
    root = f"{shared_dir(spark)}/volumes-{uuid.uuid4().hex}"
    told = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("s"))
    write_volumes(told.select("k", "s", *(F.expr(c).alias(n) for n, c in VOLUME_COLUMNS.items())).repartition("k"), root)
    rules = HeaderRules(least_shape=(4, 4, 5), most_shape=(7, 5, 5))
    out = validate_headers(nifti.read_headers(spark, root), rules)
    return out.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.array_join("errors", ",").alias("errors"), "valid", "orientation", "vmin", "vmax", F.round("vmean", 9).alias("vmean"), "nonzero")


def either(*cases: int) -> str:
    """SQL: the part's key or its size, counted round to 24, is one of ``cases``."""
    listed = ", ".join(map(str, cases))
    return f"(p_partkey % 24 in ({listed}) or p_size % 24 in ({listed}))"


#: Columns of a header for each part: a case of each rule's bounds, two in a row where the key and the size differ.
HEADER_COLUMNS = {
    "shape": f"case when {either(1)} then {{0}}79, 80, 60{{1}} when {either(2)} then {{0}}512, 512, 512{{1}} when {either(3)} then {{0}}80, 80, 60, 1{{1}} when {either(4)} then {{0}}80, 80{{1}} when {either(5)} then {{0}}513, 80, 60{{1}} else {{0}}80, 80, 60{{1}} end",
    "z1": f"cast(case when {either(8, 9)} then 1.2 when {either(6, 7)} then 1.0 else 1.1 end as float)",
    "z2": f"cast(case when {either(8)} then 1.3 when {either(6)} then 5.0 else 1.2 end as float)",
    "z3": f"cast(case when {either(6)} then 5.0 else 1.2 end as float)",
    "units": f"case when {either(10)} then 10 when {either(11)} then 1 when {either(12)} then 0 else 2 end",
    "qfac": f"cast(case when {either(13)} then 0 when {either(14)} then -1 else 1 end as double)",
    "sform": f"case when {either(15)} then 2 when {either(17)} then 0 else 1 end",
    "qform": f"case when {either(16)} then 2 when {either(17)} then 0 else 1 end",
    "nonzero": f"case when {either(18)} then 0 else 7 end",
    "vmin": f"cast(case when {either(19)} then -1 else 0 end as double)",
    "vmax": f"cast(case when {either(20)} then 1000001 else 1000000 end as double)",
    "vmean": f"cast(case when {either(21)} then 3.9 when {either(22)} then 'NaN' when {either(0)} then 100001 else 4 end as double)",
    "datatype": f"case when {either(2, 12)} then 4 else 16 end",
    "intent": f"case when {either(7)} then 3 else 0 end",
    "shift": f"cast(case when {either(9)} then 0.01 when {either(10)} then 0.0001 else 0 end as double)",
    "orientation": f"case when {either(14)} then 'LPS' else 'RAS' end",
    "failed": f"case when {either(23)} then 'cut short' end",
}
HEADER_SQL = "with h as (select p_partkey, " + ", ".join(f"{c.format('[', ']').replace(chr(39) + 'NaN' + chr(39), 'null')} as {k}" for k, c in HEADER_COLUMNS.items() if k != "vmean")
HEADER_SQL += ", " + HEADER_COLUMNS["vmean"].replace("'NaN'", "'NaN'::double") + " as vmean from part), "
LATER = "z1 < 1.2::float or (z1 = 1.2::float and (z2 < 1.2::float or (z2 = 1.2::float and z3 <= 1.2::float)))"
AXES = "z1 <= 1.2::float and z2 <= 1.2::float and z3 <= 1.2::float"
SHAPE = "len(shape) = 3 and shape[1] between 80 and 512 and shape[2] between 80 and 512 and shape[3] between 60 and 512"


def header_errors(voxel: str, more: bool) -> str:
    told = {
        "shape": f"not ({SHAPE})", "voxel_size": f"not ({voxel})", "datatype": "datatype <> 16" if more else None, "space_unit": "units % 8 <> 2", "qfac": "qfac not in (-1, 1)", "affine": "abs(shift) > 0.001" if more else None,
        "values": "vmin < 0 or vmax > 1000000", "sform_code": "sform <> 1", "qform_code": "qform <> 1", "intent": "intent <> 0" if more else None, "all_zero": "nonzero = 0",
        "mean": "not isnan(vmean) and (vmean < 4 or vmean > 100000)", "orientation": "orientation <> 'RAS'" if more else None,
    }
    return "case when failed is not null then 'load' else concat_ws(',', " + ", ".join(f"case when {c} then '{k}' end" for k, c in told.items() if c) + ") end"


def header_table(spark, sf_dir):
    h = table(spark, sf_dir, "part").selectExpr("p_partkey", *(f"{c.format('array(', ')')} as {k}" for k, c in HEADER_COLUMNS.items()))
    affine = F.array(*(F.lit(float(i % 5 == 0)) + (F.col("shift") if i == 3 else F.lit(0.0)) for i in range(16)))
    return h.select(
        "p_partkey", "shape", F.array("z1", "z2", "z3").alias("zooms"), F.col("units").alias("xyzt_units"), "qfac", F.col("sform").alias("sform_code"), F.col("qform").alias("qform_code"), "nonzero", "vmin", "vmax", "vmean",
        "datatype", F.col("intent").alias("intent_code"), affine.alias("affine"), "orientation", F.col("failed").alias("load_error"),
    )


@query(HEADER_SQL + f"e as (select p_partkey, {header_errors(LATER, False)} as errors from h) select p_partkey, errors, errors = '' as valid from e")
def header_rules(spark, sf_dir):
    """The rules that are on by default, at their bounds."""
    return validate_headers(header_table(spark, sf_dir)).select("p_partkey", F.array_join("errors", ",").alias("errors"), "valid")


@query(HEADER_SQL + f"e as (select p_partkey, {header_errors(AXES, True)} as errors from h) select p_partkey, errors, errors = '' as valid from e")
def header_rules_all(spark, sf_dir):
    """Every rule, voxel sizes axis by axis."""
    rules = HeaderRules(strict_voxel=True, datatype=16, intent=0, orientation="RAS", affine=tuple(float(i % 5 == 0) for i in range(16)))
    return validate_headers(header_table(spark, sf_dir), rules).select("p_partkey", F.array_join("errors", ",").alias("errors"), "valid")


SCANNER_SQL = "scans as (select case p_partkey % 6 when 0 then 'seg' else p_type end as modality, case when p_partkey % 4 <> 1 then p_brand else '' end as maker, case p_size % 5 when 0 then '' when 1 then '1.5' when 2 then '10.5' else (p_size % 5)::varchar end as strength, case when p_partkey % 4 <> 1 then p_mfgr end as model from (select *, p_brand || 'X' as p_mfgr from part))"


def scans(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size") % 5
    known = k % 4 != 1
    return table(spark, sf_dir, "part").select(
        F.when(k % 6 == 0, "seg").otherwise(F.col("p_type")).alias("modality"), F.when(known, F.col("p_brand")).otherwise("").alias("maker"),
        F.when(s == 0, "").when(s == 1, "1.5").when(s == 2, "10.5").otherwise(s.cast("string")).alias("strength"), F.when(known, F.concat("p_brand", F.lit("X"))).alias("model"),
    )


@query(f"with {SCANNER_SQL}, k as (select *, maker <> '' or strength <> '' as known from scans where modality <> 'seg') select count(*) as n_total, count(*) filter (not known) as n_missing, round(100.0 * count(*) filter (known) / count(*), 2) as coverage, array_to_string(list_sort(list(distinct maker) filter (maker <> '')), ', ') as makers from k")
def scanner_coverage(spark, sf_dir):
    return reports.scanner_coverage(scans(spark, sf_dir), "modality", "maker", "strength")


@query(f"with {SCANNER_SQL} select modality, count(*) as n_total, count(*) filter (maker = '' and strength = '') as n_missing from scans where modality <> 'seg' group by 1")
def scanner_missing(spark, sf_dir):
    return reports.scanner_missing(scans(spark, sf_dir), "modality", "maker", "strength")


@query(f"with {SCANNER_SQL}, n as (select strength, count(*) as n from scans where modality <> 'seg' and strength <> '' group by 1) select strength, n, row_number() over (order by strength::double, strength) as place from n")
def strength_counts(spark, sf_dir):
    return reports.strength_counts(scans(spark, sf_dir), "modality", "strength")


@query(f"with {SCANNER_SQL}, n as (select modality, maker, coalesce(model, '') as model, strength, count(*) as n from scans where modality <> 'seg' group by all) select *, row_number() over (order by modality, maker, model, strength) as place from n")
def scanner_table(spark, sf_dir):
    """The table of scanners in the order of its four keys, strengths as texts."""
    told = reports.images_only(scans(spark, sf_dir), "modality").groupBy("modality", "maker", F.coalesce("model", F.lit("")).alias("model"), "strength").agg(F.count("*").alias("n"))
    return reports.placed(told, ["modality", "maker", "model", "strength"])


@query("select n_name, row_number() over (order by n_name) as place from nation")
def datasets_by_name(spark, sf_dir):
    return reports.placed(table(spark, sf_dir, "nation").select("n_name"), ["n_name"])


@query("select kind, max(n) as most from (select user_id, event_type as kind, count(*) as n from events group by all) group by 1")
def most_files(spark, sf_dir):
    return reports.most_in_group(table(spark, sf_dir, "events").withColumnRenamed("event_type", "kind"), ["user_id"], "kind")


@query("select conv_id, array_to_string(list_sort(list(distinct role)), ',') as roles, min(turn) as least_turn from conversations group by 1")
def sorted_sessions(spark, sf_dir):
    out = reports.distinct_sorted(table(spark, sf_dir, "conversations"), "conv_id", "role", "turn")
    return out.select("conv_id", F.array_join("found", ",").alias("roles"), F.col("least_group").alias("least_turn"))


@query(r"""with n as (select row_number() over (order by n_name) + 6 as line_no, replace(n_name, '_', '\_') || ' & ' || n_nationkey || ' \\' as line from nation)
select * from n union all select * from (values (1::bigint, '\begin{longtable}{ll}'), (2, '\caption{Nations} \label{tab:n} \\'), (3, '\hline'), (4, 'n\_name & n\_nationkey \\'), (5, '\hline'), (6, '\endhead')) t
union all select count(*) + 7, '\hline' from nation union all select count(*) + 8, '\end{longtable}' from nation""")
def longtable_lines(spark, sf_dir):
    return render.longtable(table(spark, sf_dir, "nation").select("n_name", "n_nationkey"), ["n_name"], "Nations", "tab:n")


def page_files(spark, sf_dir) -> str:
    """Each page's html as a file, written by the tasks to the shared folder."""
    root = f"{shared_dir(spark)}/pages-{uuid.uuid4().hex}"

    def write(batches):
        store, base = store_of(root)
        for batch in batches:
            for folder in sorted({f"{base}/{k % 10}" for k in batch["page_id"]}):
                store.create_dir(folder, recursive=True)
            for r in batch.itertuples():
                with store.open_output_stream(f"{base}/{r.page_id % 10}/page {r.page_id}.html", compression=None) as f:
                    f.write((r.html or "").encode())
            yield batch[["page_id"]]

    table(spark, sf_dir, "pages").select("page_id", "html").mapInPandas(write, "page_id bigint").count()
    return root


@query("select page_id, page_id % 10 || '/page ' || page_id || '.html' as path, octet_length(encode(coalesce(html, ''))) as size, md5(coalesce(html, '')) as digest from pages where page_id % 3 > 0")
def copied_tree(spark, sf_dir):
    """The files of the pages that a table names, copied by the tasks into a tree of their own and read back."""
    source, target = page_files(spark, sf_dir), f"{shared_dir(spark)}/slim-{uuid.uuid4().hex}"
    named = table(spark, sf_dir, "pages").where("page_id % 3 > 0").select(F.create_map(F.lit("page"), F.format_string("%d/page %d.html", F.col("page_id") % 10, "page_id")).alias("files"))
    copying.copy_tree(sinks.copy_plan(named, "files", source, target).select("src", F.substring_index("dst", f"{target}/", -1).alias("path")), target)
    found = listing.read_files(spark, target)
    path = F.substring_index("path", f"/{target.rpartition('/')[2]}/", -1)
    return found.select(F.regexp_extract("path", r"page (\d+)\.html$", 1).cast("bigint").alias("page_id"), path.alias("path"), F.col("length").alias("size"), F.md5("content").alias("digest"))


@query("select date_trunc('day', ts)::date as day, count(*) as n, max(value) as max_value, round(avg(value), 6) as mean_value from events group by 1")
def streaming_metric_rollup(spark, sf_dir):
    """The daily metrics again, from a stream of files that is read as far as it has arrived."""
    from cartulary.streaming.incremental import run_available, window_metrics

    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    fs, path = spark._jvm.org.apache.hadoop.fs, f"{sf_dir}/events.parquet"
    p = fs.Path(path)
    folder = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    reader = spark.readStream.schema(schema)  # a stream reads a folder
    stream = reader.parquet(path) if folder else reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    run_available(window_metrics(stream, "ts", "value"), lambda b, k: b.write.mode("overwrite").parquet(f"{root}/out"), f"{root}/checkpoint", mode="complete")
    return spark.read.parquet(f"{root}/out").select(F.col("start").cast("date").alias("day"), "n", "max_value", "mean_value")


#: Orders of a catalogue document, about, and bytes of the ranges in which it is read.
DOCUMENT_ORDERS, DOCUMENT_RANGE = 4000, 1 << 18


def order_documents(spark, sf_dir) -> str:
    """Catalogue documents, each the lists of some customers' orders; names and texts hold quotes, brackets and backslashes."""
    root = f"{shared_dir(spark)}/orders-{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders")
    documents = max(1, orders.count() // DOCUMENT_ORDERS)
    entry = F.struct("o_orderkey", F.concat(F.lit('}], "\\'), "o_orderpriority", F.lit('\\" [{')).alias("note"), F.struct("o_orderstatus", "o_totalprice").alias("of"))
    lists = orders.groupBy("o_custkey").agg(F.collect_list(entry).alias("es"))  # a customer's orders
    named = lists.select(F.pmod(F.xxhash64("o_custkey"), F.lit(documents)).alias("document"), F.struct(F.concat(F.lit('c"{'), "o_custkey").alias("name"), "es").alias("member"))
    told = named.groupBy("document").agg(F.to_json(F.map_from_entries(F.collect_list("member"))).alias("value"))
    told.write.partitionBy("document").text(root)
    return root


@query("""select 'c"{' || o_custkey as dataset, o_orderkey, '}], "\\' || o_orderpriority || '\\" [{' as note, o_orderstatus, o_totalprice from orders""")
def catalogue_in_ranges(spark, sf_dir):
    """Entries of whole documents, each read by as many tasks as it has ranges of bytes."""
    entry = "struct<o_orderkey:bigint,note:string,of:struct<o_orderstatus:string,o_totalprice:double>>"
    return catalogue.read_large_catalogue(spark, f"{order_documents(spark, sf_dir)}/*", entry, DOCUMENT_RANGE).select("dataset", "o_orderkey", "note", "of.*")
