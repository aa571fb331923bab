"""Settings in a TOML or JSON file, and the paths that they name."""

from __future__ import annotations

import json
import os
import tomllib
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

#: What each kind of run reads and writes, by the names of paths; ``name/below`` is a place inside one.
DECLARED: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "inspect": (("raw",), ("reports/inspect",)),
    "ingest": (("raw",), ("inventory",)),
    "curate": (("inventory", "labels", "raw"), ("curated", "reports/curation", "inventory")),
    "privacy": (("inventory", "raw", "labels", "people", "salt"), ("deidentified", "reports/privacy", "inventory")),
    "labels": (("inventory", "labels"), ("inventory",)),
    "gates": (("inventory", "labels", "people"), ("reports/gates",)),
    "release": (("inventory", "labels", "curated", "salt"), ("releases",)),
    "train": (("releases", "inventory", "curated"), ("runs",)),
    "evaluate": (("runs", "releases", "inventory", "curated"), ("evaluations",)),
    "select": (("releases", "inventory", "curated", "labels", "salt"), ("reports/selection", "releases")),
}


@dataclass(frozen=True)
class Settings:
    """``paths`` by name, relative to ``root`` unless they are whole, and everything else."""

    root: str
    paths: dict[str, str]
    rest: dict = field(default_factory=dict)

    def resolve(self, name: str) -> str:
        """The place of ``name`` or ``name/below``; a name that isn't set raises."""
        first, _, below = name.partition("/")
        if first not in self.paths:
            raise KeyError(f"no path is called {first!r}; known are {sorted(self.paths)}")
        place = self.paths[first]
        whole = place if "://" in place or os.path.isabs(place) else f"{self.root.rstrip('/')}/{place}"
        return f"{whole.rstrip('/')}/{below}" if below else whole

    def declared(self, command: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """The inputs and outputs of a kind of run, as far as their paths are set; one that isn't
        declared has none."""
        return tuple(tuple(self.resolve(n) for n in names if n.partition("/")[0] in self.paths) for names in DECLARED.get(command, ((), ())))


def load(spark: SparkSession, path: str) -> Settings:
    """Read settings through Spark, so that any store will do. ``root`` is the file's folder unless
    the file sets one."""
    text = spark.read.text(path, wholetext=True).first()
    said = text["value"] if text else ""
    found = json.loads(said or "{}") if path.endswith(".json") else tomllib.loads(said)
    root = found.pop("root", path.rpartition("/")[0] or ".")
    return Settings(root, found.pop("paths", {}), found)
