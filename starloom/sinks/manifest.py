"""Committed batches of a load: one small file per batch, written aside and renamed at the end.

A batch whose file is there is done and is not loaded again; one whose load broke off has no file and is loaded
anew. The file's number is the batch's place in the order of commits. A rename to a name that is taken fails, so
of two writers one commits and the other one starts again. A commit may reserve a range of ids: the
next batch goes on where the last one ended, without gap or overlap.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.identity import number_stored_rows
from starloom.sinks.publish import file_system


class ConflictError(Exception):
    """Another writer has committed in the meantime; load the batch again."""


@dataclass(frozen=True)
class Commit:
    number: int
    batch: str
    facts: dict = field(default_factory=dict)  # what the loader keeps: rows, folders, months, ids


class Manifest:
    """The commits below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def commits(self) -> list[Commit]:
        """All commits in order. One file per batch: they are few and small."""
        files, folder = file_system(self.spark, self.folder)
        if not files.exists(folder):
            return []
        paths = [s.getPath().toString() for s in files.listStatus(folder) if s.getPath().getName().endswith(".json")]
        if not paths:
            return []
        found = [json.loads(r.value) for r in self.spark.read.option("wholetext", True).text(paths).collect()]
        return sorted((Commit(**c) for c in found), key=lambda c: c.number)

    def committed(self, batch: str) -> Commit | None:
        return next((c for c in self.commits() if c.batch == batch), None)

    def next_id(self) -> int:
        """The first id that no batch has reserved."""
        return max((c.facts["next_id"] for c in self.commits() if "next_id" in c.facts), default=0)

    def commit(self, batch: str, number: int, **facts) -> Commit:
        """Make the batch the ``number``-th commit, or raise a :class:`ConflictError`."""
        done = Commit(number, batch, facts)
        files, folder = file_system(self.spark, self.folder)
        files.mkdirs(folder)
        jvm = self.spark._jvm
        aside = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}.tmp")
        out = files.create(aside, False)
        try:
            out.write(bytearray(json.dumps({"number": number, "batch": batch, "facts": facts}).encode()))
        finally:
            out.close()
        place = jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), self.spark._jsc.hadoopConfiguration())
        kinds = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(aside), files.makeQualified(place), kinds)
        except Py4JJavaError as error:
            files.delete(aside, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise ConflictError(f"commit {number} of {self.folder} is taken") from error
            raise
        return done


def append_batch(df: DataFrame, folder: str, batch: str, *, id_column: str | None = None) -> Commit:
    """Append the rows to the batches below ``folder`` unless this batch is there already.

    With ``id_column`` the rows are numbered on from the last batch. A batch that is delivered again keeps its rows
    and ids; the rows of one that broke off are seen by no reader.
    """
    spark = df.sparkSession
    manifest = Manifest(spark, f"{folder.rstrip('/')}/_commits")
    commits = manifest.commits()
    done = next((c for c in commits if c.batch == batch), None)
    if done is not None:
        return done
    first = max((c.facts["next_id"] for c in commits), default=0)
    path = f"{folder.rstrip('/')}/rows/{len(commits):012d}-{uuid.uuid4().hex[:8]}"
    if id_column is not None:
        # the first writing fixes the order of the rows, the second one gives them their numbers
        df.write.parquet(f"{path}.unnumbered")
        df = number_stored_rows(spark.read.schema(df.schema).parquet(f"{path}.unnumbered"), id_column, first)
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(path)
    n = int(counted.get["n"])
    done = manifest.commit(batch, len(commits), path=path, rows=n, first_id=first, next_id=first + n)
    if id_column is not None:
        files, aside = file_system(spark, f"{path}.unnumbered")
        files.delete(aside, True)
    return done


def read_batches(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The rows of all committed batches."""
    paths = [c.facts["path"] for c in Manifest(spark, f"{folder.rstrip('/')}/_commits").commits()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
