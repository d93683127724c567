"""The graph as snapshot tables: every save writes new folders and then a list of those in force, so that readers never
see half a load."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from foliograph.operators.graph_model import Graph

Parts = dict[str, str]


class GraphStore:
    """Parquet snapshots under a folder. `versions/<number>` lists the folders of every table that are in force; the
    greatest number counts. A save that fails leaves no new list, so the old one stays. A table may be kept in parts,
    which are replaced one by one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- the lists

    def _fs(self) -> tuple:
        p = self._hadoop_path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _hadoop_path(self, text: str):  # noqa: ANN202
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _version(self) -> int:
        fs, _ = self._fs()
        folder = self._hadoop_path(f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return max((int(n) for n in names if n.isdigit()), default=0)

    def tables(self) -> dict[str, Parts]:
        """Folders in force, by table and part."""
        version = self._version()
        return json.loads(self.spark.read.text(f"{self.path}/versions/{version:012}", wholetext=True).first()[0]) if version else {}

    def _publish(self, tables: dict[str, Parts]) -> None:
        """Writes the next list aside and renames it, which takes effect at once or not at all."""
        fs, _ = self._fs()
        aside, name = self._hadoop_path(f"{self.path}/aside-{uuid.uuid4().hex}"), self._hadoop_path(f"{self.path}/versions/{self._version() + 1:012}")
        fs.mkdirs(name.getParent())
        out = fs.create(aside, False)
        out.write(json.dumps(tables).encode())
        out.close()
        if not fs.rename(aside, name):
            fs.delete(aside, False)
            raise RuntimeError(f"another save was published before: {name}")

    # -- saving and loading

    def save(self, tables: dict[str, DataFrame] | Graph, parts: dict[str, tuple[DataFrame, str]] | None = None) -> str:
        """Writes tables as a whole, and parts of tables given as (rows, column that names the part); all other tables and
        parts stay in force. Returns the name of the folder written. Entity edges are partitioned by type."""
        name = f"snapshot-{uuid.uuid4().hex}"
        now = self.tables()
        for table, df in tables.items():
            writer = df.write.mode("overwrite")
            (writer.partitionBy("type") if table == "entity_edges" else writer).parquet(f"{self.path}/{name}/{table}")
            now[table] = {"": f"{name}/{table}"}
        fs, _ = self._fs()
        for table, (df, column) in (parts or {}).items():
            df.write.mode("overwrite").partitionBy(column).parquet(f"{self.path}/{name}/{table}")
            for s in fs.listStatus(self._hadoop_path(f"{self.path}/{name}/{table}")):
                if "=" in (folder := s.getPath().getName()):
                    now.setdefault(table, {})[folder.split("=", 1)[1]] = f"{name}/{table}/{folder}"
        self._publish(now)
        return name

    def load(self, table: str, parts: list[str] | None = None) -> DataFrame | None:
        """A table, or the named parts of it that there are; null if there is nothing."""
        at = self.tables().get(table, {})
        folders = [f"{self.path}/{folder}" for part, folder in sorted(at.items()) if parts is None or part in parts]
        return self.spark.read.parquet(*folders) if folders else None

    def vacuum(self) -> None:
        """Removes the folders and lists that are no longer in force. No reader may hold an older list then."""
        fs, root = self._fs()
        used = {folder.split("/")[0] for at in self.tables().values() for folder in at.values()}
        for s in fs.listStatus(root) if fs.exists(root) else ():
            folder = s.getPath().getName()
            if folder.startswith("snapshot-") and folder not in used or folder.startswith("aside-"):
                fs.delete(s.getPath(), True)
        current = self._version()
        for s in fs.listStatus(self._hadoop_path(f"{self.path}/versions")) if current else ():
            if s.getPath().getName() != f"{current:012}":
                fs.delete(s.getPath(), False)

    def clear(self) -> None:
        """Removes everything."""
        fs, root = self._fs()
        fs.delete(root, True)
