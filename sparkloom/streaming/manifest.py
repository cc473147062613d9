"""Versions of a table that is made of folders: a small document names the folders that are the table.

A writer first writes folders that no version names, then publishes the next version: the document is written under
a hidden name and renamed, so a reader finds either the old version or the new one, and both are whole. Folders that
a version no longer names are removed some versions later, when nobody reads the old version any more.

One writer at a time. All paths go through the file system that Spark reads them with.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from sparkloom.workspace import Store


@dataclass(frozen=True)
class Version:
    """A published version: its number (-1: none yet) and its document."""

    number: int = -1
    content: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    path: str
    keep: int = 3  # versions that stay readable

    def _folder(self) -> str:
        return f"{self.path}/_versions"

    def current(self, spark: SparkSession) -> Version:
        """The newest version; listing costs the versions kept, whatever the table holds."""
        store = Store(spark, self.path)
        numbers = [int(name[:-5]) for name in store.names(self._folder()) if name[:-5].isdigit()]
        return self.at(spark, max(numbers)) if numbers else Version()

    def at(self, spark: SparkSession, number: int) -> Version:
        """A version that is still kept."""
        return Version(number, json.loads(Store(spark, self.path).text(f"{self._folder()}/{number}.json")))

    def publish(self, spark: SparkSession, before: Version, content: dict, retired: list[str]) -> Version:
        """The version after `before`. `retired` names folders, relative to the path, that it needs no more.

        Fails if somebody else has published a version after `before`.
        """
        store, number = Store(spark, self.path), before.number + 1
        waiting = before.content.get("_retired", []) + [[number, name] for name in retired]
        gone = [name for since, name in waiting if since <= number - self.keep]
        content = {**content, "_retired": [[since, name] for since, name in waiting if since > number - self.keep]}
        store.publish(f"{self._folder()}/{number}.json", json.dumps(content))
        for name in gone:
            store.remove(f"{self.path}/{name}")
        for name in store.names(self._folder()):
            if name[:-5].isdigit() and int(name[:-5]) <= number - self.keep:
                store.remove(f"{self._folder()}/{name}")
        return Version(number, content)
