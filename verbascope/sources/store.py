"""One store for the runs of an evaluation: rows of every stage, and one record for each run, model and dataset.

Rows lie below ``<root>/<stage>`` in a folder per run, dataset, model and version, records below ``<root>/meta``. A
version is written whole before the record that names it, and rows count only under the version their record names:
a job that dies leaves the store as it was. A repeated run replaces its own records and rows, and no others.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbascope import schema as sc
from verbascope.functions import text as t
from verbascope.operators.filters import missing_text
from verbascope.operators.joins import null_safe_join, small_side
from verbascope.session import folder_exists, remove_folder, stable_copy

KEY = ("run_id", "dataset", "model_slug")
META = "meta"

# Stages of a run.
TRANSLATED = "translations"
SCORED = "scored"

_PLACE = ("stage", *KEY)
RECORD = T.StructType([*sc.RUN_META.fields, *(T.StructField(c, T.StringType()) for c in (*_PLACE, "version", "fingerprint", "settings"))])


class RunConflict(ValueError):
    """A run id that stands for other settings, or a model whose folder belongs to another model."""


def fingerprint(settings: Mapping[str, object]) -> str:
    """Digest of what a run was asked to do; the order of the settings does not matter."""
    return hashlib.sha256(json.dumps(dict(settings), sort_keys=True, default=str).encode()).hexdigest()


def write_records(records: DataFrame, path: str) -> None:
    """Write metadata records as JSON, each in the place of an earlier one of its stage, run, dataset and model.

    Only the folders of the given keys are overwritten.
    """
    given = sc.normalise(records.withColumn("model_slug", t.model_slug(F.col("model"))), RECORD)
    writer = given.repartition(*_PLACE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("ignoreNullFields", "false").partitionBy(*_PLACE).json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``; none gives no rows. Keys stay text, also where they look like numbers."""
    if not folder_exists(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).json(path)


@dataclass(frozen=True)
class RunStore:
    spark: SparkSession
    root: str

    def records(self, stage: str | None = None, run_id: str | None = None) -> DataFrame:
        """One row for each stage, run, dataset and model that is complete."""
        found = read_records(self.spark, f"{self.root}/{META}")
        if stage is not None:
            found = found.where(F.col("stage") == stage)
        return found if run_id is None else found.where(F.col("run_id") == run_id)

    def _rows(self, stage: str) -> DataFrame:
        """All versions of a stage; the places stay text, also where they look like numbers."""
        path = f"{self.root}/{stage}"
        found = self.spark.read.option("mergeSchema", "true").parquet(path).schema
        as_text = [T.StructField(f.name, T.StringType()) if f.name in (*KEY, "version") else f for f in found.fields]
        return self.spark.read.schema(T.StructType(as_text)).parquet(path)

    def read(self, stage: str, run_id: str | None = None, model: str | None = None, dataset: str | None = None) -> DataFrame:
        """Rows of a stage in their recorded versions; folders of other runs and models are not read."""
        if not folder_exists(self.spark, f"{self.root}/{stage}"):
            raise FileNotFoundError(f"no {stage} in {self.root}")
        rows = self._rows(stage)
        records = self.records(stage, run_id)
        for column, value in (("run_id", run_id), ("dataset", dataset), ("model_slug", model and t.slug_of(model))):
            if value is not None:
                rows, records = (df.where(F.col(column) == value) for df in (rows, records))
        named, _ = small_side(records.select(*KEY, "version"))
        return null_safe_join(rows, named, [*KEY, "version"], "left_semi").drop("version")

    def _check(self, stage: str, run_id: str, keys: DataFrame, print_: str, replace: bool) -> list[Row]:
        """Records that the keys have by now; an error if they are of another model, or of other settings."""
        shared = keys.groupBy("model_slug").agg(F.sort_array(F.collect_set("model")).alias("models")).where(F.size("models") > 1).first()
        if shared is not None:
            raise RunConflict(f"models {shared['models']} have one folder name")
        earlier = self.records(stage, run_id).withColumnRenamed("model", "held").drop("run_id", "stage")
        same = null_safe_join(earlier, keys, ["model_slug", "dataset"]).collect()
        for record in same:
            where = f"{stage} of {record['held']!r} on {record['dataset']!r} in run {run_id!r}"
            if record["model"] != record["held"]:
                raise RunConflict(f"{where}: {record['model']!r} would share its folder")
            if record["fingerprint"] != print_ and not replace:
                raise RunConflict(f"{where} were made with other settings: {record['settings']}")
        return same

    def _named(self, keys: Iterable[tuple[str, str]]) -> DataFrame:
        frame = self.spark.createDataFrame(list(keys), "model string, dataset string")
        return frame.withColumn("model_slug", t.model_slug(F.col("model")))

    def refuse_conflicts(
        self, stage: str, run_id: str, settings: Mapping[str, object], keys: Iterable[tuple[str, str]], replace: bool = False
    ) -> None:
        """Raise what :meth:`write` would, before anything expensive is done for the rows."""
        self._check(stage, run_id, self._named(keys), fingerprint(settings), replace)

    def write(
        self,
        stage: str,
        rows: DataFrame,
        run_id: str,
        settings: Mapping[str, object],
        keys: Iterable[tuple[str, str]] | None = None,
        facts: Callable[[DataFrame], DataFrame] | None = None,
        replace: bool = False,
    ) -> DataFrame:
        """Write ``rows`` (model, dataset, ...) as one stage of a run and return its records.

        ``keys`` names the models and datasets of the rows, one record each, also for those without rows; without it
        they are looked up in the rows, which computes these. What is there under equal settings is replaced; other
        settings are an error, raised before the rows are computed, unless ``replace``. ``facts`` adds columns to the
        records, once the rows are written. Rows go below a version of their own; the records then move to it, and
        versions that no record names are removed. Two writers of one key at a time are not told apart.
        """
        print_ = fingerprint(settings)
        if keys is None:
            named = stable_copy(rows.select("model", "dataset", t.model_slug(F.col("model")).alias("model_slug")).distinct())
        else:
            named = self._named(keys)
        before = self._check(stage, run_id, named, print_, replace)
        number = max((int(record["version"].partition("-")[0]) for record in before), default=0) + 1
        version = f"{number:06d}-{uuid4().hex[:12]}"

        placed = rows.drop("run_id", "model_slug", "version").withColumns(
            {"run_id": F.lit(run_id), "model_slug": t.model_slug(F.col("model")), "version": F.lit(version)}
        )
        path = f"{self.root}/{stage}"
        writer = placed.hint("rebalance", *KEY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*KEY, "version").parquet(path)
        self._record(stage, named, run_id, version, settings, facts)
        for record in before:
            self._remove(path, {**{c: record[c] for c in ("dataset", "model_slug", "version")}, "run_id": run_id})
        return self.records(stage, run_id).where(F.col("version") == version)

    def _record(
        self, stage: str, named: DataFrame, run_id: str, version: str, settings: Mapping[str, object], facts: Callable[[DataFrame], DataFrame] | None
    ) -> None:
        """Count what was written and put the records in their places."""
        written = self._rows(stage).where((F.col("run_id") == run_id) & (F.col("version") == version))
        error = F.col("error") if "error" in written.columns else F.lit(None).cast("string")
        counts = written.groupBy("model", "dataset").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~missing_text(error)).alias("n_errors"))
        keys = named.select("model", "dataset")
        records = null_safe_join(keys, counts, keys.columns, "left").na.fill(0, ["n_rows", "n_errors"]).withColumns({
            "stage": F.lit(stage), "run_id": F.lit(run_id), "version": F.lit(version), "fingerprint": F.lit(fingerprint(settings)),
            "settings": F.lit(json.dumps(dict(settings), sort_keys=True, default=str)), "timestamp": F.current_timestamp(),
        })
        write_records(facts(records) if facts else records, f"{self.root}/{META}")

    def _remove(self, path: str, place: Mapping[str, str | None]) -> None:
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        remove_folder(self.spark, "/".join([path, *(names.getPartitionPathString(c, place[c]) for c in (*KEY, "version"))]))
