"""File paths to records: a staged parse whose stages are columns of one row, so nothing is shuffled."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.patterns import compile_patterns, first_match, included, match_segments


@dataclass(frozen=True)
class PathRules:
    """Patterns of the stages; an empty session or type is not looked for and stays empty."""

    subject: str
    session: str = ""
    type: str = ""
    modality: Sequence[tuple[str, str]] = ()
    include: Sequence[str] = ()
    exclude: Sequence[str] = ()
    first_group_only: bool = False
    keep: Sequence[str] = field(default=())


def parse_paths(files: DataFrame, rules: PathRules, path: str = "path") -> DataFrame:
    """``files`` with subject, session, type, modality and rest of each path; paths that fail a stage are dropped."""
    compile_patterns({"subject": rules.subject, "session": rules.session, "type": rules.type, **dict(rules.modality)})
    out = files.withColumn("_parts", F.split(path, "/")).withColumn("_m", match_segments(F.col("_parts"), F.lit(0), rules.subject))
    out = out.where("_m is not null").withColumn("subject", F.col("_m.text")).withColumn("_next", F.col("_m.next"))
    out = out.where(included(F.col("subject"), rules.include, rules.exclude))
    for name, regex in (("session", rules.session), ("type", rules.type)):
        if not regex.strip():
            out = out.withColumn(name, F.lit(""))
            continue
        out = out.withColumn("_m", match_segments(F.col("_parts"), F.col("_next"), regex)).where("_m is not null")
        out = out.withColumn(name, F.col("_m.text")).withColumn("_next", F.col("_m.next"))
    left = F.size("_parts") - F.col("_next")
    out = out.where(left > 0).withColumn("rest", F.array_join(F.slice("_parts", F.col("_next") + 1, left), "/"))
    return out.withColumn("modality", first_match(F.col("rest"), rules.modality)).where("modality is not null").drop("_parts", "_m", "_next")


def rebuilt(path: str = "path") -> Column:
    """Whether the parsed parts joined again give the path."""
    return F.concat_ws("/", *(F.nullif(F.col(c), F.lit("")) for c in ("subject", "session", "type", "rest"))) == F.col(path)
