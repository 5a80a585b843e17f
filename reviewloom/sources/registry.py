"""Named, versioned datasets as Parquet folders: ``<root>/<name>/version=<n>``."""

from __future__ import annotations

from collections.abc import Sequence
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from reviewloom.operators.quality import clean_dataset, drop_duplicates
from reviewloom.operators.sampling import assign_splits
from reviewloom.operators.tables import with_label


_LOCK = Lock()


class DatasetNotFound(LookupError):
    pass


def create_once(fs, path) -> bool:
    """Create a file that must not exist; False if someone else did.

    Shared file systems refuse a second creator themselves. A local one looks before it creates, so threads of one
    driver take turns.
    """
    with _LOCK:
        try:
            fs.create(path, False).close()
            return True
        except Exception:  # noqa: BLE001 - py4j wraps the file system's own exceptions
            if fs.exists(path):
                return False
            raise


class Registry:
    """Every write makes a new version, so a job may read the version it is about to replace."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path

    def _children(self, path: str) -> list[str]:
        fs, folder = self._fs(path)
        if not fs.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/version={version}"

    def versions(self, name: str) -> list[int]:
        """Versions whose write finished."""
        found = [int(c.split("=")[1]) for c in self._children(f"{self.root}/{name}") if c.startswith("version=")]
        return sorted(v for v in found if self._finished(name, v))

    def _finished(self, name: str, version: int) -> bool:
        fs, marker = self._fs(f"{self._path(name, version)}/_SUCCESS")
        return fs.exists(marker)

    def latest_version(self, name: str) -> int:
        versions = self.versions(name)
        if not versions:
            raise DatasetNotFound(name)
        return versions[-1]

    def list_datasets(self) -> list[str]:
        return [name for name in self._children(self.root) if self.versions(name)]

    def read_dataset(self, name: str, version: int | None = None) -> DataFrame:
        version = self.latest_version(name) if version is None else version
        if not self._finished(name, version):
            raise DatasetNotFound(f"{name} version {version}")
        return self.spark.read.parquet(self._path(name, version))

    def read_versions(self, name: str, versions: Sequence[int]) -> DataFrame:
        """Several finished versions of one schema together, with a ``version`` column."""
        paths = [self._path(name, v) for v in versions]
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*paths)

    def _claim(self, name: str) -> int:
        """Next version number; creating its claim file is atomic, so two writers never share one."""
        version = max([int(c.split("=")[1]) for c in self._children(f"{self.root}/{name}") if "=" in c], default=0) + 1
        while True:
            if create_once(*self._fs(f"{self.root}/{name}/_claims/{version}")):
                return version
            version += 1

    def write_dataset(self, df: DataFrame, name: str) -> int:
        """Register a dataset, or a new version of it; returns the version."""
        version = self._claim(name)
        df.write.parquet(self._path(name, version))
        return version

    def write_batch(self, df: DataFrame, name: str, query: str, batch: int) -> int:
        """Register a batch of a streaming query once, however often it is run; returns its version.

        The version is noted before it is written. A batch whose version is finished leaves it as it is, but its rows
        are run through, as the state of a streaming query moves on with them. Only one driver at a time may run a query.
        """
        notes = f"{self.root}/{name}/_batches/{query}/{batch}"
        noted = self._children(notes)
        version = int(noted[0]) if noted else self._claim(name)
        if not noted:
            fs, note = self._fs(f"{notes}/{version}")
            fs.mkdirs(note)
        if self._finished(name, version):
            df.write.format("noop").mode("overwrite").save()
        else:
            df.write.mode("overwrite").parquet(self._path(name, version))
        return version

    # Registered-dataset forms of the table operators: read the latest version, write the next.

    def label_dataset(self, name: str, col: str, value) -> int:
        return self.write_dataset(with_label(self.read_dataset(name), col, value), name)

    def split_dataset(self, name: str, id_col: str, fractions=None, **options) -> int:
        return self.write_dataset(assign_splits(self.read_dataset(name), id_col, fractions, **options), name)

    def clean_dataset(self, name: str, id_col: str, text_col: str) -> int:
        return self.write_dataset(clean_dataset(self.read_dataset(name), id_col, text_col), name)

    def dedupe_dataset(self, name: str, cols: Sequence[str], order: str) -> int:
        return self.write_dataset(drop_duplicates(self.read_dataset(name), cols, order), name)
