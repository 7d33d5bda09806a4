"""The commit record of a job's output folder: which batches, and which state, readers may see.

A batch writes several tables: clean and failed rows, completed labels, known bars, the
look-back state.  None of it counts until one small file is there,
``_commits/<sequence>.json``, which a batch writes last and which takes its name by one
rename.  The file is the whole truth at that point: the last batch of every run, the folder
of the newest state, and the counts of the batch.  So

* readers keep to the batches of the newest record, and a batch whose tables are half
  written, or written and not recorded, is invisible, before its replay and during it;
* a batch that is recorded is not written again when the stream replays it;
* the order of states is that of the sequence, not of clocks or names.

Records grow with the runs of a folder, not with its batches.  Older ones are dropped but
for the last ``KEPT``.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.sinks import folders

FOLDER, KEPT = "_commits", 8


@dataclass
class Commit:
    """The newest record: ``runs`` maps a run to its last batch."""

    seq: int = 0
    runs: dict[str, int] = field(default_factory=dict)
    state: str | None = None
    batches: dict[str, dict] = field(default_factory=dict)  # of every run: the counts of its last batch

    def holds(self, run_id: str, batch_id: int) -> bool:
        return self.runs.get(run_id, -1) >= batch_id

    def visible(self) -> Column:
        """Whether a row's ``run_id`` and ``batch_id`` are recorded (a filter on partition columns)."""
        seen = F.lit(False)
        for run, last in self.runs.items():
            seen = seen | ((F.col("run_id") == run) & (F.col("batch_id") <= last))
        return seen


def _records(spark: SparkSession, output: str) -> list[str]:
    return [n for n in folders.files(spark, f"{output}/{FOLDER}") if n.endswith(".json")]


def newest(spark: SparkSession, output: str) -> Commit:
    """The newest record of an output folder; an empty one if no batch was recorded."""
    known = _records(spark, output)
    if not known:
        return Commit()
    return Commit(**json.loads(folders.read_text(spark, f"{output}/{FOLDER}/{known[-1]}")))


def record(spark: SparkSession, output: str, last: Commit, run_id: str, batch_id: int,
           counts: dict[str, int], state: str | None) -> Commit:
    """Make a batch visible: one new record behind ``last``.

    A second writer of the same folder that has recorded its batch meanwhile is an error: the
    batch then runs again, from that writer's state.
    """
    now = Commit(last.seq + 1, {**last.runs, run_id: batch_id}, state or last.state, {**last.batches, run_id: counts})
    name = f"{now.seq:012d}.json"
    folders.write_text(spark, f"{output}/{FOLDER}/{name}", json.dumps(asdict(now)))
    for old in _records(spark, output)[:-KEPT]:
        folders.delete(spark, f"{output}/{FOLDER}/{old}")
    return now


def committed(df: DataFrame, output: str) -> DataFrame:
    """The rows of a batch table (with ``run_id`` and ``batch_id``) that are recorded."""
    spark = df.sparkSession
    if not folders.exists(spark, f"{output}/{FOLDER}"):
        return df.filter(F.lit(False))
    return df.filter(newest(spark, output).visible())
