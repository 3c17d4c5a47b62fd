"""Stage commits of a batch run: what is finished, for which input.

A run has an id, which names the versioned folders that it writes; nothing a
reader uses is overwritten. When all tables of a stage are written, a marker
records them; when all stages are committed, the catalog's tables are switched
to the new folders one by one (a change of location, no copy), and the run is
marked as published. A rerun over the same input with the same parameters
takes up an unpublished run: it skips the committed stages and goes on with
the first one that is not, with the ingestion time of that run.

Markers are small JSON files, written under a temporary name and renamed, so
a marker is whole or absent. What identifies an input is the list of its files
(names, sizes, times) and the plan above them; an input without files is taken
to be new, unless the caller names its state.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, file_statuses, list_names, path_exists, read_text, write_text_atomically

#: Folder of the markers, under the layout's root.
FOLDER = "_commits"


def input_state(df: DataFrame, *parameters) -> str | None:
    """A digest of a frame's files, of the plan above them and of parameters;
    None if it has no files."""
    files = df.inputFiles()
    if not files:
        return None
    states = file_statuses(df.sparkSession, files)
    if len(states) != len(set(files)):
        return None  # files that cannot be found by name: taken to be new
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    return hashlib.sha256(json.dumps([states, plan, [str(p) for p in parameters]]).encode()).hexdigest()


@dataclass
class Run:
    """One run: its markers, and the folders that it wrote or found written."""

    spark: SparkSession
    root: str
    state: str
    ingest_ts: str
    id: str
    written: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    def _marker(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{FOLDER}/{self.id}/{name}.json"

    def versioned(self, path: str) -> str:
        """Where this run writes what stands under ``path``."""
        return f"{path.rstrip('/')}/run={self.id}"

    def stage(self, name: str, write: Callable[[], list[str]]) -> None:
        """Run ``write``, which returns the folders it wrote, and commit them;
        skip it if this run has committed the stage and its folders are there."""
        marker = self._marker(name)
        if path_exists(self.spark, marker):
            folders = json.loads(read_text(self.spark, marker))["folders"]
            if all(path_exists(self.spark, f"{f}/_SUCCESS") for f in folders):
                self.skipped.append(name)
                return
        folders = write()
        write_text_atomically(self.spark, marker, json.dumps({"stage": name, "state": self.state, "folders": folders}))
        self.written.append(name)

    def publish(self, switch: Callable[[], None], keep: int = 2) -> None:
        """Switch the catalog to this run's folders and mark it published;
        folders of all but the last ``keep`` published runs go."""
        switch()
        write_text_atomically(self.spark, f"{self.root.rstrip('/')}/{FOLDER}/{self.id}.json", json.dumps({**self._own(), "published": True}))
        runs = [r for r in known_runs(self.spark, self.root) if r["published"] and r["id"] != self.id]
        for old in sorted(runs, key=lambda r: r["ingest_ts"])[: max(0, len(runs) - keep + 1)]:
            self._forget(old["id"])

    def _own(self) -> dict:
        return {"id": self.id, "state": self.state, "ingest_ts": self.ingest_ts}

    def _forget(self, run_id: str) -> None:
        """Delete the folders of an older run, then its markers."""
        folder = f"{self.root.rstrip('/')}/{FOLDER}/{run_id}"
        for name in list_names(self.spark, folder):
            for f in json.loads(read_text(self.spark, f"{folder}/{name}"))["folders"]:
                if f.rstrip("/").endswith(f"run={run_id}"):
                    delete_path(self.spark, f)
        delete_path(self.spark, folder)
        delete_path(self.spark, f"{folder}.json")


def known_runs(spark: SparkSession, root: str) -> list[dict]:
    folder = f"{root.rstrip('/')}/{FOLDER}"
    names = [n for n in list_names(spark, folder) if n.endswith(".json")]
    return [{"published": False, **json.loads(read_text(spark, f"{folder}/{n}"))} for n in names]


def open_run(spark: SparkSession, root: str, state: str | None, ingest_ts: str) -> Run:
    """The unpublished run over this input, or a new one. A run that was given
    another ingestion time is not taken up."""
    for r in known_runs(spark, root):
        if state is not None and r["state"] == state and not r["published"]:
            return Run(spark, root, r["state"], r["ingest_ts"], r["id"])
    run = Run(spark, root, state or uuid.uuid4().hex, ingest_ts, uuid.uuid4().hex[:12])
    write_text_atomically(spark, f"{root.rstrip('/')}/{FOLDER}/{run.id}.json", json.dumps(run._own()))
    return run


def config_state(cfg) -> str:
    return json.dumps(asdict(cfg), default=str, sort_keys=True)
