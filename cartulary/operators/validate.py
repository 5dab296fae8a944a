"""Rules over image headers: errors are collected for each row in one pass, and no row is dropped."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HeaderRules:
    """The default bounds of the rules; None turns a rule off."""

    least_shape: tuple[int, ...] = (80, 80, 60)
    most_shape: tuple[int, ...] = (512, 512, 512)
    most_voxel: tuple[float, ...] = (1.2, 1.2, 1.2)
    strict_voxel: bool = False
    datatype: int | None = None
    space_unit: int | None = 2
    qfac: tuple[float, ...] | None = (-1.0, 1.0)
    values: tuple[float, float] | None = (0.0, 1e6)
    form_code: int | None = 1
    intent: int | None = None
    mean: tuple[float, float] | None = (4.0, 1e5)
    orientation: str | None = None
    affine: tuple[float, ...] | None = None
    affine_tolerance: float = 1e-3


def outside(c: Column, low: float, high: float) -> Column:
    """Out of bounds; NaN counts as inside, since it compares as neither."""
    return F.coalesce(~F.isnan(c.cast("double")) & ((c < low) | (c > high)), F.lit(False))


def header_checks(r: HeaderRules) -> dict[str, Column]:
    """Name to failure condition, for a table of headers (see ``sources.nifti``)."""
    n = len(r.least_shape)
    shape = F.col("shape")
    out = {"shape": (F.size(shape) != n) | F.coalesce(F.exists(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: ~F.get(shape, i).between(F.get(F.array(*map(F.lit, r.least_shape)), i), F.get(F.array(*map(F.lit, r.most_shape)), i))), F.lit(True))}
    zooms = [F.get(F.col("zooms"), F.lit(i)).cast("float") for i in range(n)]
    bounds = [F.lit(z).cast("float") for z in r.most_voxel]
    if r.strict_voxel:
        fine = zooms[0] <= bounds[0]
        for z, b in zip(zooms[1:], bounds[1:], strict=True):
            fine = fine & (z <= b)
    else:  # the first axis that differs decides
        fine = F.struct(*(z.alias(f"a{i}") for i, z in enumerate(zooms))) <= F.struct(*(b.alias(f"a{i}") for i, b in enumerate(bounds)))
    out["voxel_size"] = ~fine
    if r.datatype is not None:
        out["datatype"] = F.col("datatype") != r.datatype
    if r.space_unit is not None:
        out["space_unit"] = F.col("xyzt_units").bitwiseAND(7) != r.space_unit
    if r.qfac is not None:
        out["qfac"] = ~F.col("qfac").isin(*r.qfac)
    if r.affine is not None:
        out["affine"] = F.exists(F.arrays_zip(F.col("affine"), F.array(*map(F.lit, r.affine)).alias("want")), lambda x: F.abs(x["affine"] - x["want"]) > r.affine_tolerance)
    if r.values is not None:
        out["values"] = outside(F.col("vmin"), r.values[0], float("inf")) | outside(F.col("vmax"), float("-inf"), r.values[1])
    if r.form_code is not None:
        out["sform_code"] = F.col("sform_code") != r.form_code
        out["qform_code"] = F.col("qform_code") != r.form_code
    if r.intent is not None:
        out["intent"] = F.col("intent_code") != r.intent
    out["all_zero"] = F.col("nonzero") == 0
    if r.mean is not None:
        out["mean"] = outside(F.col("vmean"), *r.mean)
    if r.orientation is not None:
        out["orientation"] = F.col("orientation") != r.orientation
    return out


def validate(df: DataFrame, checks: Mapping[str, Column], error: str | None = None) -> DataFrame:
    """``df`` with errors (names of failed checks, in order) and valid; a load ``error`` is the only error of its row."""
    failed = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for k, c in checks.items())))
    if error:
        failed = F.when(F.col(error).isNotNull(), F.array(F.lit("load"))).otherwise(failed)
    return df.withColumn("errors", failed).withColumn("valid", F.size("errors") == 0)


def validate_headers(headers: DataFrame, rules: HeaderRules | None = None) -> DataFrame:
    return validate(headers, header_checks(rules or HeaderRules()), "load_error")
