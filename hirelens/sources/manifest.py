"""What of a table (or of several) is valid, in one small file.

Writers put rows into folders that nobody reads yet and then publish a new
version of the manifest: a JSON file, written aside and renamed.  Readers take
the newest version.  One rename so makes everything a writer did visible at
once; a writer that breaks off before has changed nothing that is read.  (On a
store without an atomic rename the file, a few kilobytes, is written in one
request.)  Of two writers that publish the same version the second fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from hirelens.sources.files import delete, matching, path_exists, read_text, rename, write_text

#: Versions that stay, for readers that have just read an older one.
KEEP = 20


class Manifest:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.folder = spark, f"{base.rstrip('/')}/_manifest"

    def _versions(self) -> list[str]:
        return sorted(matching(self.spark, f"{self.folder}/v*.json"))

    def read(self) -> dict:
        """The newest version; empty if nothing was published."""
        versions = self._versions()
        return json.loads(read_text(self.spark, versions[-1])) if versions else {}

    def publish(self, content: dict) -> None:
        """Make ``content`` the newest version."""
        versions = self._versions()
        number = int(versions[-1].rsplit("/v", 1)[1][:-5]) + 1 if versions else 0
        aside = f"{self.folder}/_new-{uuid.uuid4().hex}"
        write_text(self.spark, aside, json.dumps(content, sort_keys=True))
        if not rename(self.spark, aside, f"{self.folder}/v{number:010d}.json"):
            delete(self.spark, aside)
            raise RuntimeError(f"another writer has published version {number} in {self.folder}")
        for old in versions[:-KEEP]:
            delete(self.spark, old)

    def exists(self) -> bool:
        return path_exists(self.spark, self.folder)
