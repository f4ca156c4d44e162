"""Result tables by run: repeatable writes, and one switch that readers follow.

Every run writes its rows beside those of other runs, under its own ``run_id``; writing a run
again replaces its own rows and no others, so a repeated job never doubles anything.  Readers
see the published run only.  Publishing changes a single name, so the tables of a run appear
together, and a job that dies before it leaves the former set as it was.

* In a database: tables ``<name>_runs`` partitioned by run_id, a view ``<name>`` over each, and
  a view ``current_run`` whose replacement is the switch.
* Under a path: folders ``<name>/run_id=<id>`` and empty files ``_published/<number>-<id>``, of
  which the highest number counts; creating one is the switch.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run_id"
CURRENT = "current_run"


class ResultStore:
    def __init__(self, spark: SparkSession, database: str | None = None, path: str | None = None):
        if (database is None) == (path is None):
            raise ValueError("give a database or a path")
        self.spark, self.database, self.path = spark, database, path and path.rstrip("/")

    # ------------------------------------------------------------- helpers
    @staticmethod
    def _checked(run_id: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.]+", run_id):
            raise ValueError(f"run id {run_id!r}: letters, digits, dots and underscores only")
        return run_id

    def _fs(self, path: str):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(conf), at

    def _names(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    # -------------------------------------------------------------- writing
    def put(self, run_id: str, name: str, rows: DataFrame) -> None:
        """``rows`` become those of ``run_id`` in table ``name``, whatever it had before."""
        run_id = self._checked(run_id)
        if self.path:
            rows.write.mode("overwrite").parquet(f"{self.path}/{name}/{RUN}={run_id}")
            return
        table, own = f"{self.database}.{name}_runs", [f"`{c}`" for c in rows.columns]
        if not self.spark.catalog.tableExists(table):
            empty = rows.limit(0).withColumn(RUN, F.lit("").cast("string"))
            empty.write.format("parquet").partitionBy(RUN).saveAsTable(table)
        view = f"_wr_{name}_{re.sub('[^A-Za-z0-9]', '_', run_id)}"
        rows.createOrReplaceTempView(view)
        try:  # a static partition is replaced alone, also by no rows at all
            target = [f"`{c}`" for c in self.spark.table(table).columns if c != RUN]
            if sorted(target) != sorted(own):
                raise ValueError(f"{table} has columns {target}, the rows have {own}")
            self.spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({RUN} = '{run_id}') SELECT {', '.join(target)} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def publish(self, run_id: str) -> None:
        """From now on readers see the tables of ``run_id``."""
        run_id = self._checked(run_id)
        if self.path:
            number = max([int(n.split("-")[0]) for n in self._names(f"{self.path}/_published")], default=0) + 1
            fs, at = self._fs(f"{self.path}/_published/{number:09d}-{run_id}")
            fs.create(at, False).close()
            return
        # The views are the same for every run, so they may be made before the switch.
        current = f"{self.database}.{CURRENT}"
        if not self.spark.catalog.tableExists(current):
            self.spark.sql(f"CREATE VIEW {current} AS SELECT CAST(NULL AS STRING) AS {RUN}")
        for name in self.tables():
            if not self.spark.catalog.tableExists(f"{self.database}.{name}"):
                own = ", ".join(f"`{c}`" for c in self.spark.table(f"{self.database}.{name}_runs").columns if c != RUN)
                self.spark.sql(f"CREATE VIEW {self.database}.{name} AS SELECT {own} FROM {self.database}.{name}_runs WHERE {RUN} = (SELECT {RUN} FROM {current})")
        self.spark.sql(f"CREATE OR REPLACE VIEW {current} AS SELECT '{run_id}' AS {RUN}")

    def drop(self, run_id: str) -> None:
        """Deletes the rows of a run that is not published."""
        run_id = self._checked(run_id)
        if run_id == self.current():
            raise ValueError(f"{run_id} is published")
        for name in self.tables():
            if self.path:
                fs, at = self._fs(f"{self.path}/{name}/{RUN}={run_id}")
                fs.delete(at, True)
            else:
                self.spark.sql(f"ALTER TABLE {self.database}.{name}_runs DROP IF EXISTS PARTITION ({RUN} = '{run_id}')")

    # -------------------------------------------------------------- reading
    def tables(self) -> list[str]:
        if self.path:
            return sorted(n for n in self._names(self.path) if not n.startswith("_"))
        own = [t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary]
        return sorted(n.removesuffix("_runs") for n in own if n.endswith("_runs"))

    def current(self) -> str | None:
        """The published run, if any."""
        if self.path:
            last = max(self._names(f"{self.path}/_published"), default=None)
            return last and last.split("-", 1)[1]
        if not self.spark.catalog.tableExists(f"{self.database}.{CURRENT}"):
            return None
        return self.spark.table(f"{self.database}.{CURRENT}").first()[RUN]

    def read(self, name: str, run_id: str | None = None) -> DataFrame:
        """A table of the published run, or of another one by its id."""
        if self.path:
            run_id = run_id or self.current()
            if run_id is None:
                raise ValueError(f"nothing is published under {self.path}")
            return self.spark.read.parquet(f"{self.path}/{name}/{RUN}={self._checked(run_id)}")
        if run_id is None:
            return self.spark.table(f"{self.database}.{name}")
        return self.spark.table(f"{self.database}.{name}_runs").filter(F.col(RUN) == self._checked(run_id)).drop(RUN)
