"""Model answers kept by content, so that a job asks for each answer once, however often it is started.

An answer belongs to a question: the model, its revision, the task, the settings and the texts, named by one digest.
A job looks its questions up first, asks the model for the open ones, each distinct question once, and takes all its
answers from the table. What is answered is kept in slices, and within a slice task by task: a job that is stopped
loses no more than what its running tasks had asked.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from uuid import uuid4

import pyarrow as pa
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbascope.operators.models import ModelFactory, loaded
from verbascope.session import folder_exists, scratch, ship_package, stable_copy, stable_table

# Open questions that are asked, and kept, together.
SLICE_QUESTIONS = 100_000

_ANSWERS = "key string, answer string, score double, error string"
_ARROW = pa.schema([("key", pa.string()), ("answer", pa.string()), ("score", pa.float64()), ("error", pa.string())])


def model_profile(gpus: int = 0, cpus: int = 1, memory: str | None = None) -> ResourceProfile:
    """Executors and tasks of a model's stage: so many GPUs, cores and so much memory for each task.

    For cluster managers that give stages executors of their own; local mode knows no profiles.
    """
    executor, task = ExecutorResourceRequests().cores(cpus), TaskResourceRequests().cpus(cpus)
    if memory:
        executor = executor.memory(memory)
    if gpus:
        executor, task = executor.resource("gpu", gpus), task.resource("gpu", gpus)
    return ResourceProfileBuilder().require(executor).require(task).build


@dataclass(frozen=True)
class Question:
    """What is asked of which model; the settings are handed to its factory."""

    model: str
    task: str
    settings: Mapping[str, object] = field(default_factory=dict)
    revision: str | None = None

    def text(self) -> str:
        return json.dumps([self.model, self.revision, self.task, dict(self.settings)], sort_keys=True, default=str)

    def key(self, texts: Sequence[Column]) -> Column:
        """Digest of the question put to given texts, a null one being unlike an empty one; null if the first is null."""
        given = F.to_json(F.struct(*[c.alias(f"t{i}") for i, c in enumerate(texts)]), {"ignoreNullFields": "false"})
        return F.when(texts[0].isNotNull(), F.sha2(F.concat(F.lit(self.text()), given).cast("binary"), 256))


Ask = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def one_by_one(factory: ModelFactory, settings: Mapping[str, object], in_flight: int) -> Ask:
    """Ask a model text -> text, ``in_flight`` requests at once; a failing one is that question's error."""

    job = uuid4().hex

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(max_workers=in_flight) as pool:
            for batch in batches:
                model = loaded(job, factory, settings)

                def attempt(text: str) -> tuple[str | None, str | None]:
                    try:
                        return model(text), None
                    except Exception as problem:  # noqa: BLE001 - recorded with the question
                        return None, str(problem)

                found = list(pool.map(attempt, batch.column("t0").to_pylist()))
                answers, errors = ([x[i] for x in found] for i in (0, 1))
                yield pa.record_batch([batch.column("key"), pa.array(answers, pa.string()), pa.nulls(len(found), pa.float64()), pa.array(errors, pa.string())], schema=_ARROW)

    return ask


def by_batch(factory: ModelFactory, settings: Mapping[str, object], size: int) -> Ask:
    """Ask a model lists of texts -> scores, ``size`` questions at once; a failing call ends the task."""

    job = uuid4().hex

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                texts = [part.column(name).to_pylist() for name in part.schema.names if name != "key"]
                scores = pa.array([float(x) for x in loaded(job, factory, settings)(*texts)], pa.float64())
                none = pa.nulls(part.num_rows, pa.string())
                yield pa.record_batch([part.column("key"), none, scores, none], schema=_ARROW)

    return ask


@dataclass(frozen=True)
class AnswerTable:
    """Answers below a folder that every executor reaches, in one subfolder a question."""

    spark: SparkSession
    path: str
    slice_questions: int = SLICE_QUESTIONS
    profile: ResourceProfile | None = None

    def _folder(self, question: Question) -> str:
        return f"{self.path}/{hashlib.sha256(question.text().encode()).hexdigest()[:32]}"

    def raw(self, question: Question) -> DataFrame:
        """Everything that was ever answered: key, answer, score and error."""
        folder = self._folder(question)
        if not folder_exists(self.spark, folder):
            return self.spark.createDataFrame([], _ANSWERS)
        return self.spark.read.schema(_ANSWERS).option("recursiveFileLookup", "true").parquet(folder)

    def known(self, question: Question, with_errors: bool = True) -> DataFrame:
        """One answer for each key; of several, one without an error."""
        found = self.raw(question)
        if not with_errors:
            found = found.where(F.col("error").isNull())
        best = F.min(F.struct(F.col("error").isNotNull().alias("failed"), "answer", "score", "error")).alias("best")
        return found.groupBy("key").agg(best).select("key", "best.answer", "best.score", "best.error")

    def ask(self, rows: DataFrame, question: Question, texts: Sequence[Column], ask: Ask, retry_errors: bool = True) -> None:
        """Have the question answered for the ``texts`` of all ``rows``, each distinct one once.

        Questions that failed in an earlier job are asked again, unless ``retry_errors`` is false. Rows whose first text
        is null ask nothing.
        """
        ship_package(self.spark)
        names = [c.alias(f"t{i}") for i, c in enumerate(texts)]
        asked = rows.select(question.key(texts).alias("key"), *names).where(F.col("key").isNotNull()).dropDuplicates(["key"])
        answered = self.known(question, with_errors=not retry_errors).select("key")
        with scratch(self.spark):
            questions = stable_table(asked.join(answered, "key", "left_anti"))
            slices = -(-questions.count() // self.slice_questions)
            if slices > 1:
                questions = stable_table(questions.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(slices))), "slice")
            for number in range(slices):
                part = questions.where(F.col("slice") == number).drop("slice") if slices > 1 else questions
                found = part.mapInArrow(ask, _ANSWERS, profile=self.profile)
                # A task's answers stay once it has ended, also if the job that it belongs to is stopped later.
                writer = found.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
                writer.parquet(f"{self._folder(question)}/{number}")

    def attach(self, rows: DataFrame, question: Question, texts: Sequence[Column], name: str = "answer") -> DataFrame:
        """``rows`` with a struct ``name`` (answer, score, error): the answer to their ``texts``, null if there is none."""
        # Computed first, so that the join has a shuffle of its own on either side and can split a hot question.
        answers = stable_copy(self.known(question).select(F.col("key").alias("__key"), F.struct("answer", "score", "error").alias(name)))
        keyed = rows.withColumn("__key", question.key(texts))
        none = F.lit(None).cast("struct<answer: string, score: double, error: string>")
        asked, silent = keyed.where(F.col("__key").isNotNull()), keyed.where(F.col("__key").isNull())
        return asked.join(answers, "__key", "left").unionByName(silent.withColumn(name, none)).drop("__key")
