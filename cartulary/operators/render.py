"""Tables as text: Markdown, LaTeX, macros and bibliographies; ordered lines are rows until they are written."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.scalars import latex_escape, normalise_nfc
from cartulary.operators.ranking import numbered_lines


def markdown_row(columns: Sequence[str]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |"))


def markdown_lines(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """(line_no, line): header, rule and a line a row."""
    head = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    top = df.sparkSession.range(2).select((F.col("id") + 1).alias("line_no"), F.when(F.col("id") == 0, head[0]).otherwise(head[1]).alias("line"))
    return top.unionByName(numbered_lines(df, order, markdown_row(df.columns), 3))


def latex_row(columns: Sequence[str]) -> Column:
    return F.concat(F.concat_ws(" & ", *(latex_escape(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns)), F.lit(" \\\\"))


def longtable(df: DataFrame, order: Sequence[str], caption: str, label: str) -> DataFrame:
    """(line_no, line) of a LaTeX table that may run over several pages: opening with a repeated header, a line a row, closing.  LaTeX's keywords are fixed values."""
    spark, header = df.sparkSession, " & ".join(re.sub(r"([&%$#_{}])", r"\\\1", c) for c in df.columns) + " \\\\"
    opening = ["\\begin{longtable}{" + "l" * len(df.columns) + "}", f"\\caption{{{caption}}} \\label{{{label}}} \\\\", "\\hline", header, "\\hline", "\\endhead"]
    top = spark.createDataFrame([(i + 1, x) for i, x in enumerate(opening)], "line_no bigint, line string")
    body = numbered_lines(df, order, latex_row(df.columns), len(opening) + 1)
    end = df.agg((F.count("*") + len(opening) + 1).alias("at")).select(F.explode(F.array(F.struct(F.col("at").alias("line_no"), F.lit("\\hline").alias("line")), F.struct((F.col("at") + 1).alias("line_no"), F.lit("\\end{longtable}").alias("line")))).alias("x")).select("x.*")
    return top.unionByName(body).unionByName(end)


def grouped_labels(df: DataFrame, label: str, order: Sequence[str]) -> DataFrame:
    """``label`` shown in the first row of each group only."""
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy(label).orderBy(*order)) == 1
    return df.withColumn("shown", F.when(first, F.col(label)).otherwise(""))


def macros(wide: DataFrame) -> DataFrame:
    """A row (name, line) for each column of a one-row table: ``\\newcommand{\\name}{value}``."""
    names = wide.columns
    long = wide.select(*(F.col(c).cast("string").alias(c) for c in names)).unpivot([], names, "name", "value")
    return long.select("name", F.concat(F.lit("\\newcommand{\\"), F.col("name"), F.lit("}{"), F.coalesce("value", F.lit("")), F.lit("}")).alias("line"))


def citation_key(bibtex: Column) -> Column:
    """The key of a single BibTeX entry; null without one; several raise."""
    keys = F.regexp_extract_all(bibtex, F.lit(r"@\w+\s*\{\s*([^,\s]+)\s*,"), F.lit(1))
    return F.when(F.size(keys) > 1, F.raise_error(F.lit("more than one entry")).cast("string")).otherwise(F.get(keys, F.lit(0)))


def bibliography(infos: DataFrame, dataset: str = "dataset", citation: str = "citation") -> DataFrame:
    """Entries in order of dataset, each once, in Unicode composed form."""
    told = infos.where(F.trim(citation) != "").select(F.col(dataset), normalise_nfc(F.trim(F.col(citation))).alias("entry"))
    return told.groupBy("entry").agg(F.min(dataset).alias("dataset")).orderBy("dataset", "entry")


def readme(title: Column, sections: Sequence[tuple[str, Column]]) -> Column:
    """A title and the sections that aren't empty."""
    parts = [F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.concat(F.lit(f"## {name}\n\n"), F.trim(c), F.lit("\n"))) for name, c in sections]
    return F.concat(F.lit("# "), title, F.lit("\n\n"), F.concat_ws("\n", *parts))
