"""Materialisation points of the pipeline.

Each stage is written as Parquet under the folder the cluster names in
``spark.checkpoint.dir`` and read back, which cuts the lineage (a lost executor
recomputes from the last written stage, not from the base tables), keeps the
plans short, and gives the planner real file sizes.  A resumable run names its stages by
its inputs and parameters, so it also outlives its driver.  Without that setting a
local session (tests, the bench) gets a fresh temporary folder; any other
master must configure it.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..params import Params


def checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wishrank-ckpt-"))
    return sc.getCheckpointDir()


#: Part of every run's fingerprint; raise it when stages of older code must not be reused.
STAGE_VERSION = 2
#: Written into a stage's folder after its rows; holds their schema.
DONE = "_done.json"


def file_facts(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of every data file under ``paths``, sorted."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(conf).listFiles(at, True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def run_fingerprint(spark: SparkSession, params: Params, paths: list[str]) -> str:
    """One name for a run's inputs (files, lengths, times of change) and parameters."""
    facts = file_facts(spark, paths)
    if not facts:
        raise ValueError("a run can only be resumed when its inputs are files")
    return hashlib.sha256(repr((STAGE_VERSION, params, facts)).encode()).hexdigest()[:24]


class Stager:
    """Writes named stages of one run under ``<checkpoint root>/wishrank/<run id>/``.

    The run id is random, or the fingerprint of the run's inputs and parameters
    (``resumable``).  A stage counts as written once its completion mark stands beside its
    rows, so a run that was cut off anywhere goes on where it stopped: stages with a mark
    are read, others are written (again).  ``written`` names those written by this object.
    """

    def __init__(self, spark: SparkSession, params: Params, run_id: str | None = None):
        self.spark = spark
        self.enabled = params.materialize
        self.resumes = run_id is not None
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self.written: list[str] = []
        self._root: str | None = None

    @classmethod
    def resumable(cls, spark: SparkSession, params: Params, paths: list[str]) -> "Stager":
        return cls(spark, params, run_fingerprint(spark, params, paths))

    @property
    def root(self) -> str:
        if self._root is None:
            self._root = os.path.join(checkpoint_root(self.spark), "wishrank", self.run_id)
        return self._root

    def _at(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def close(self) -> None:
        """Delete this run's stages (through Hadoop, wherever the folder lies)."""
        if self._root is None:
            return
        fs, at = self._at(self._root)
        fs.delete(at, True)
        self._root = None

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def _schema_of_done(self, name: str) -> StructType | None:
        fs, at = self._at(os.path.join(self.path(name), DONE))
        if not fs.exists(at):
            return None
        mark = fs.open(at)
        try:
            return StructType.fromJson(json.loads(mark.readUTF()))
        finally:
            mark.close()

    def _mark(self, name: str, schema: StructType) -> None:
        fs, at = self._at(os.path.join(self.path(name), DONE))
        out = fs.create(at, True)
        out.writeUTF(schema.json())
        out.close()

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        if not self.enabled:
            return df
        path = self.path(name)
        schema = self._schema_of_done(name) if self.resumes else None
        if schema is None:
            df.write.mode("overwrite").parquet(path)  # takes an older mark away first
            schema = df.schema
            self._mark(name, schema)
            self.written.append(name)
        return self.spark.read.schema(schema).parquet(path)
