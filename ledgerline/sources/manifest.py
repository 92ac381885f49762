"""Lists of the folders that make up a table, switched by one rename.

A version names every folder that is live. It is written under a temporary name
and renamed, so that readers see the old list or the new one, and folders that no
version names are waste of a job that was killed. Versions are kept by batch: a
batch that runs again starts from the last version of the batches before it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

# Fixed value: width of the numbers in version names, so that they sort.
DIGITS = 12


@dataclass(frozen=True)
class Version:
    """Live folders by month after a batch, and the newest complete month by then."""

    batch: int = -1
    newest: int | None = None
    folders: dict[int, list[str]] = field(default_factory=dict)

    def paths(self, months: list[int] | None = None) -> list[str]:
        wanted = sorted(self.folders) if months is None else months
        return [path for month in wanted for path in self.folders.get(month, [])]


class Manifest:
    """Versions in a folder of any file system that Spark can open."""

    def __init__(self, spark: SparkSession, folder: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.folder = self.hadoop.Path(folder)
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        if not self.files.exists(self.folder):
            return []
        names = [f.getPath().getName() for f in self.files.listStatus(self.folder)]
        return sorted(n for n in names if not n.startswith("_"))

    def read(self, before: int | None = None) -> Version:
        """The last version, or the last of the batches before the given one."""
        names = [n for n in self._names() if before is None or int(n.split("-")[0]) - 1 < before]
        if not names:
            return Version()
        stream = self.files.open(self.hadoop.Path(self.folder, names[-1]))
        try:
            kept = json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()
        folders = {int(month): paths for month, paths in kept["folders"].items()}
        return Version(kept["batch"], kept["newest"], folders)

    def commit(self, version: Version) -> None:
        """Make a version the last of its batch. Names count batches from -1 on as 0."""
        number = f"{version.batch + 1:0{DIGITS}}"
        mine = [n for n in self._names() if n.startswith(number)]
        turn = int(mine[-1].split("-")[1]) + 1 if mine else 0
        draft = self.hadoop.Path(self.folder, f"_{uuid.uuid4().hex}")
        stream = self.files.create(draft)
        try:
            stream.write(bytearray(json.dumps(asdict(version)).encode()))
        finally:
            stream.close()
        name = f"{number}-{turn:0{DIGITS}}"
        if not self.files.rename(draft, self.hadoop.Path(self.folder, name)):
            raise OSError(f"cannot rename a manifest to {name}")

    def live(self, replayable: bool) -> set[str]:
        """Folders of the last version and, while its batch may run again, of the one before."""
        last = self.read()
        before = self.read(before=last.batch) if replayable else Version()
        return {*last.paths(), *before.paths()}

    def remove(self, paths: list[str]) -> None:
        for path in paths:
            self.files.delete(self.hadoop.Path(path), True)

    def subfolders(self, path: str, depth: int) -> list[str]:
        """Folders so many levels below a path."""
        found = [path]
        for _ in range(depth):
            levels = [self.hadoop.Path(p) for p in found]
            listed = [f for p in levels if self.files.exists(p) for f in self.files.listStatus(p)]
            found = [f.getPath().toString() for f in listed if f.isDirectory()]
        return found
