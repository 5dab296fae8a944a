"""Writers of catalogues, splits and slim copies of the files they name."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_catalogue(entries: DataFrame, path: str, form: str = "json") -> None:
    """Entries in a folder for each dataset; earlier contents are replaced."""
    entries.write.mode("overwrite").partitionBy("dataset").format(form).save(path)


def catalogue_document(entries: DataFrame) -> DataFrame:
    """(dataset, document): the JSON list of each dataset's entries, in order; a document holds one dataset, never the whole."""
    rest = [c for c in entries.columns if c != "dataset"]
    return entries.groupBy("dataset").agg(F.to_json(F.sort_array(F.collect_list(F.to_json(F.struct(*rest))))).alias("document"))


def write_splits(labelled: DataFrame, path: str) -> None:
    """Records in a folder for each split."""
    labelled.write.mode("overwrite").partitionBy("split").json(path)


def copy_plan(labelled: DataFrame, files: str, source: str, target: str) -> DataFrame:
    """src, dst for every file in the map ``files``, each once, with its relative path kept."""
    paths = labelled.select(F.explode(F.map_values(files)).alias("p")).distinct()
    return paths.select(F.concat(F.lit(source.rstrip("/") + "/"), "p").alias("src"), F.concat(F.lit(target.rstrip("/") + "/"), "p").alias("dst"))


def output_name(entry: Column, modality: Column, suffix: str = "") -> Column:
    """``subject.session.type.group/name_modality.nii.gz`` below a preprocessing folder; blank parts are left out."""
    folder = F.concat_ws(".", *(F.nullif(entry[k].cast("string"), F.lit("")) for k in ("subject", "session", "type", "group")))
    return F.concat(folder, F.lit("/norm_bet/"), folder, F.lit(suffix + "_"), modality, F.lit(".nii.gz"))


def copy_files(plan: DataFrame) -> DataFrame:
    """Copy ``plan(src, dst)`` in the tasks; src, dst, error (null where it went well)."""

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            errors = []
            for src, dst in zip(batch["src"], batch["dst"], strict=True):
                try:
                    (a, p), (b, q) = fs.FileSystem.from_uri(src), fs.FileSystem.from_uri(dst)
                    b.create_dir(q.rpartition("/")[0], recursive=True)
                    fs.copy_files(p, q, source_filesystem=a, destination_filesystem=b)
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield batch.assign(error=errors)

    return plan.select("src", "dst").mapInPandas(copy, "src string, dst string, error string")
