"""A store of Parquet tables with whole-store commits, on any file system that Spark reaches.

A table is a list of changes, each a folder of its own: rows that were added, and keys whose rows (of the changes before)
are gone. A commit writes the folders of its changes and then publishes all of them at once by creating the next manifest
file, which fails if another commit was faster. So a commit writes what is new, not the tables. Readers see the tables of
one manifest, so a crash between writes leaves nothing half-done, and a search never sees chunks without their vectors. A
table of more than ``MOST_CHANGES`` changes is written as one again by the next commit, and ``vacuum`` removes folders that
no manifest of the last few names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.runs import CHECKPOINT, RUNS

TABLES = {
    "cases": "case_id string, file_path string, file_name string, file_hash string, case_number string, case_type string, year int, judgment_date date, filing_date date, petitioner string, respondent string, bench string, judges array<string>, acts_cited array<string>, citations array<string>, outcome string, page_count int, word_count int, extraction_method string, extraction_confidence double, created_at timestamp_ntz, updated_at timestamp_ntz",
    "chunks": "case_id string, chunk_index int, text string, char_count int, approx_token_count int, total_chunks int, vec_id bigint, created_at timestamp_ntz",
    "index": "vec_id bigint, case_id string, chunk_index int, list_id int, embedding array<float>",
    "centres": "list_id int, centre array<double>",
    "checkpoint": CHECKPOINT,
    "runs": RUNS,
}
PARTITIONED = {"index": ["list_id"]}
MOST_CHANGES = 20


@dataclass
class Change:
    """Rows to add, after those whose ``key`` is in ``gone`` (a table of that column) have left."""

    add: DataFrame | None = None
    key: str | None = None
    gone: DataFrame | None = None


class CommitConflict(RuntimeError):
    """Another commit came first."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def create(self, drop: bool = False) -> None:
        """Make the store if it is missing; ``drop``: without anything in it."""
        if drop:
            self._fs.delete(self._path(self.root), True)
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))

    def _manifests(self) -> list[str]:
        folder = self._path(f"{self.root}/manifests")
        if not self._fs.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json"))

    def manifest(self) -> tuple[int, dict[str, list[dict]]]:
        """Number of the latest manifest, and the changes of each table: {"folder", "gone"}, where gone is a key's name or null."""
        names = self._manifests()
        return self._manifest(names[-1]) if names else (0, {})

    def _manifest(self, name: str) -> tuple[int, dict[str, list[dict]]]:
        stream = self._fs.open(self._path(f"{self.root}/manifests/{name}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return int(name.split(".")[0]), json.loads(text)

    def read(self, table: str) -> DataFrame:
        """The table as the latest manifest has it; empty if it was never written."""
        return self._read(table, self.manifest()[1].get(table, []))

    def _read(self, table: str, changes: list[dict]) -> DataFrame:
        """Runs of added folders are one scan each; a folder of keys takes its rows out of what came before."""
        schema, rows, added = TABLES[table], None, []

        def flushed(rows: DataFrame | None) -> DataFrame | None:
            if not added:
                return rows
            own = [self.spark.read.schema(schema).option("basePath", f).parquet(f) for f in added] if table in PARTITIONED else [self.spark.read.schema(schema).parquet(*added)]
            added.clear()
            for o in own:
                rows = o if rows is None else rows.unionByName(o)
            return rows

        for c in changes:
            folder = f"{self.root}/{table}/{c['folder']}"
            if c["gone"] is None:
                added.append(folder)
                continue
            rows = flushed(rows)
            if rows is not None:
                rows = rows.join(self.spark.read.parquet(folder), c["gone"], "left_anti")
        rows = flushed(rows)
        columns = self._columns(table)
        return self.spark.createDataFrame([], schema) if rows is None else rows.select(*columns)

    def _columns(self, table: str) -> list[str]:
        return [f.name for f in self.spark.createDataFrame([], TABLES[table]).schema.fields]

    def _write(self, table: str, rows: DataFrame, keys: bool = False) -> str:
        version = uuid.uuid4().hex
        writer = (rows if keys else rows.select(*self._columns(table))).write
        if table in PARTITIONED and not keys:
            writer = writer.partitionBy(*PARTITIONED[table])
        writer.parquet(f"{self.root}/{table}/{version}")
        return version

    def commit(self, tables: dict[str, DataFrame | Change]) -> int:
        """Write the changes, or whole tables in place of what they were, and publish them together; the number of the manifest."""
        number, held = self.manifest()
        held = {k: list(v) for k, v in held.items()}
        for name, change in tables.items():
            if not isinstance(change, Change):
                held[name] = [{"folder": self._write(name, change), "gone": None}]
                continue
            if len(held.get(name, [])) > MOST_CHANGES:
                held[name] = [{"folder": self._write(name, self._read(name, held[name])), "gone": None}]
            own = held.setdefault(name, [])
            if change.gone is not None and own:
                own.append({"folder": self._write(name, change.gone.select(change.key).distinct(), keys=True), "gone": change.key})
            if change.add is not None:
                own.append({"folder": self._write(name, change.add), "gone": None})
        target = self._path(f"{self.root}/manifests/{number + 1:09d}.json")
        self._fs.mkdirs(target.getParent())
        try:
            stream = self._fs.create(target, False)
        except Exception as e:
            raise CommitConflict(f"manifest {number + 1} exists") from e
        try:
            stream.write(bytearray(json.dumps(held).encode()))
        finally:
            stream.close()
        return number + 1

    def vacuum(self, keep: int = 3) -> int:
        """Delete folders that none of the last ``keep`` manifests names, and the older manifests; the number of folders. Not while a commit runs."""
        names = self._manifests()
        used = {(t, c["folder"]) for n in names[-keep:] for t, changes in self._manifest(n)[1].items() for c in changes}
        gone = 0
        for table in TABLES:
            folder = self._path(f"{self.root}/{table}")
            for status in self._fs.listStatus(folder) if self._fs.exists(folder) else ():
                if (table, status.getPath().getName()) not in used:
                    self._fs.delete(status.getPath(), True)
                    gone += 1
        for n in names[:-keep]:
            self._fs.delete(self._path(f"{self.root}/manifests/{n}"), False)
        return gone

    def export_jdbc(self, table: str, url: str, name: str | None = None, key: str | None = None, **options: str) -> None:
        """Write a table to a database; lists go as JSON text. With ``key``, rows that are there already are replaced.

        Tasks write to a table of their own first; the database then moves its rows in one transaction.
        """
        name, rows = name or table, self.read(table)
        flat = rows.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in rows.schema.fields])
        flat = flat.select(*[F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in flat.schema.fields])
        if key is None:
            flat.write.format("jdbc").options(url=url, dbtable=name, **options).mode("append").save()
            return
        staged = f"{name}_new"
        flat.write.format("jdbc").options(url=url, dbtable=staged, **options).mode("overwrite").save()
        columns = ", ".join(f'"{c}"' for c in flat.columns)
        connection = self.spark._jvm.java.sql.DriverManager.getConnection(url, options.get("user"), options.get("password")) if "user" in options else self.spark._jvm.java.sql.DriverManager.getConnection(url)
        try:
            if not connection.getMetaData().getTables(None, None, name.upper() if connection.getMetaData().storesUpperCaseIdentifiers() else name, None).next():
                flat.limit(0).write.format("jdbc").options(url=url, dbtable=name, **options).mode("append").save()
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in (f'DELETE FROM {name} WHERE "{key}" IN (SELECT "{key}" FROM {staged})', f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {staged}", f"DROP TABLE {staged}"):
                statement.executeUpdate(sql)
            connection.commit()
        finally:
            connection.close()

    def import_jdbc(self, table: str, url: str, name: str | None = None, **options: str) -> DataFrame:
        """A table of a database in this store's columns; lists come from JSON text."""
        rows = self.spark.read.format("jdbc").options(url=url, dbtable=name or table, **options).load()
        given = {c.lower(): c for c in rows.columns}
        fields = self.spark.createDataFrame([], TABLES[table]).schema.fields
        return rows.select(*[(F.from_json(given[f.name], f.dataType.simpleString()) if isinstance(f.dataType, T.ArrayType) else F.col(given[f.name]).cast(f.dataType)).alias(f.name) for f in fields])
