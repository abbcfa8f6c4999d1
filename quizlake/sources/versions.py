"""Result folders that are replaced as a whole: immutable folders and a log that names the current ones.

Every write goes to a folder of its own. It counts only once the log has an entry that names it, and
an entry is one row in one file that Spark's commit protocol moves into place at the end of the job:
readers see the state before or the state after, whatever dies in between. One entry states all
targets, so several tables change together (a final table appears and the partial one goes in the
same step). Nothing that a reader may hold is overwritten or deleted by a commit; ``vacuum`` removes
folders that the current entry no longer names.

A folder's row count is part of the entry: a folder that was lost or lost files is an error, never a
silent fresh start. One run has one writer; two that commit the same version are told apart by their
tokens, all readers follow the smaller one, and the other writer's commit fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LOG_SCHEMA = "version bigint, token string, targets map<string, array<struct<folder: string, rows: bigint>>>"


class LostResults(RuntimeError):
    """The log names results that are not there (any more)."""


def folder_missing(exc: AnalysisException) -> bool:
    """The folder does not exist (an existing folder without readable files is another matter)."""
    return exc.getCondition() == "PATH_NOT_FOUND"


class VersionLog:
    """Current result folders by target name, below one path of the shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entries(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log")
        except AnalysisException as exc:
            if not folder_missing(exc):
                raise
            return None

    def _current(self):
        entries = self._entries()
        if entries is None:
            return None
        first = F.struct((-F.col("version")).alias("v"), "token")
        return entries.orderBy(first).first()  # one entry per commit; vacuum keeps the last

    def version(self) -> int:
        """Number of the current entry, 0 before the first."""
        row = self._current()
        return row["version"] if row else 0

    def targets(self) -> dict[str, list[tuple[str, int]]]:
        """Folders (name, rows) of every target that the current entry holds."""
        row = self._current()
        return {k: [(f["folder"], f["rows"]) for f in v] for k, v in row["targets"].items()} if row else {}

    def read(self, target: str, schema=None) -> DataFrame | None:
        """The current rows of ``target``; None if no commit has it."""
        folders = self.targets().get(target)
        if folders is None:
            return None
        paths = [f"{self.path}/data/{name}" for name, _ in folders]
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            df = reader.parquet(*paths)
        except AnalysisException as exc:
            raise LostResults(f"{target}: a folder that the log names cannot be read: {exc}") from exc
        expected = sum(n for _, n in folders)
        found = df.count()  # from the files' footers
        if found != expected:
            raise LostResults(f"{target}: {found} rows found, {expected} committed")
        return df

    def write(self, df: DataFrame) -> tuple[str, int]:
        """Rows of ``df`` in a new folder that no entry names yet: (folder, rows)."""
        name = uuid.uuid4().hex
        path = f"{self.path}/data/{name}"
        df.write.parquet(path)
        return name, self.spark.read.schema(df.schema).parquet(path).count()  # from the files' footers

    def commit(self, replace: dict[str, DataFrame | None] | None = None,
               append: dict[str, DataFrame] | None = None) -> int:
        """Replace targets (None: the target goes) and add rows to targets, all in one step."""
        version = self.version()
        targets = self.targets()
        for name, df in (replace or {}).items():
            if df is None:
                targets.pop(name, None)
            else:
                targets[name] = [self.write(df)]
        for name, df in (append or {}).items():
            targets.setdefault(name, []).append(self.write(df))
        return self._append(version + 1, targets)

    def _append(self, version: int, targets: dict) -> int:
        token = uuid.uuid4().hex
        row = (version, token, {k: [tuple(f) for f in v] for k, v in targets.items()})
        (self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{self.path}/log"))
        winner = self._entries().where(F.col("version") == version).agg(F.min("token")).first()[0]
        if winner != token:
            raise RuntimeError(f"version {version} was committed by another writer")
        return version

    def vacuum(self) -> int:
        """Delete folders that the current entry does not name, and earlier entries; the number of
        folders removed. Only for a log without concurrent readers or writers."""
        kept = {f for folders in self.targets().values() for f, _ in folders}
        current = self._current()
        if current is None:
            return 0
        jvm = self.spark.sparkContext._jvm
        to_path = jvm.org.apache.hadoop.fs.Path
        root = to_path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        removed = 0
        data = to_path(f"{self.path}/data")
        for status in fs.listStatus(data) if fs.exists(data) else []:
            if status.getPath().getName() not in kept:
                fs.delete(status.getPath(), True)
                removed += 1
        entries = [(r["f"], r["token"]) for r in self._entries().select(
            F.col("_metadata.file_path").alias("f"), "token").collect()]
        for path, token in entries:
            if token != current["token"]:
                fs.delete(to_path(path), False)
        return removed
