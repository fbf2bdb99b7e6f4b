"""Versioned tables on plain files: immutable data folders, a manifest for each version, one pointer file.

A writer puts its rows into a new folder below ``data/``, lists the folders of the new version in
``_manifests/<n>.json`` and then switches ``_current`` to n, in one rename.  Until then readers see the version before, whole;
a writer that breaks off leaves folders that no manifest names.  A reader that resolved a version
keeps reading its folders, as these never change; ``vacuum`` removes what the newest versions no longer name.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from levain.sources import fs


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def current(self) -> dict:
        """The newest manifest; version 0 if nothing was committed yet."""
        n = fs.read_text(self.spark, f"{self.path}/_current")
        return self.manifest(int(n)) if n else {"version": 0, "tables": {}, "schemas": {}, "batches": []}

    def manifest(self, version: int) -> dict:
        return json.loads(fs.read_text(self.spark, f"{self.path}/_manifests/{version}.json"))

    def since(self, version: int) -> list[dict]:
        """The manifests after ``version``, oldest first."""
        return [self.manifest(n) for n in range(version + 1, self.current()["version"] + 1) if fs.exists(self.spark, f"{self.path}/_manifests/{n}.json")]

    def new_folder(self) -> str:
        """A path for data that nobody else writes to."""
        return f"{self.path}/data/{uuid.uuid4().hex}"

    def commit(self, manifest: dict) -> None:
        """Make ``manifest`` (one version above the current one) the current one."""
        at = self.current()["version"]
        if manifest["version"] != at + 1:
            raise RuntimeError(f"{self.path}: version {manifest['version']} does not follow {at}; another writer was here")
        fs.write_text(self.spark, f"{self.path}/_manifests/{manifest['version']}.json", json.dumps(manifest))
        fs.replace(self.spark, f"{self.path}/_current", str(manifest["version"]))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the data folders that none of the ``keep`` newest versions names; returns their names."""
        newest = self.current()["version"]
        kept = [m for n in range(max(1, newest - keep + 1), newest + 1) for m in [self.manifest(n)]]
        named = {folder.removeprefix(f"{self.path}/data/").split("/")[0] for m in kept for folders in m["tables"].values() for folder in folders}
        gone = [x for x in fs.children(self.spark, f"{self.path}/data") if x not in named]
        for x in gone:
            fs.remove(self.spark, f"{self.path}/data/{x}")
        return gone


def with_batch(batches: list[list[int]], batch: int) -> list[list[int]]:
    """Sorted ranges [first, last] of batch numbers with ``batch`` added."""
    out: list[list[int]] = []
    for lo, hi in sorted([*batches, [batch, batch]]):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def has_batch(batches: list[list[int]], batch: int) -> bool:
    return any(lo <= batch <= hi for lo, hi in batches)
