"""Stages that write tables, with an audit of each write and a record of what is done.

A stage replaces one year of its tables. Rows, nulls and times of what was stored are counted
after the write, and the audit row is stored last: a stage whose tables all have theirs is done.
A run that was killed goes on at the first stage that is not.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hourloom.sources.tables import AUDIT, audits, mark_finished, read_year, remove, unmark_finished, write_audited

#: Folder of the finished years below that of the tables.
FINISHED = "finished"


@dataclass(frozen=True)
class Stage:
    """``tables`` are what it writes, with their schemas; ``after`` the stages it reads."""

    tables: Mapping[str, T.StructType]
    after: tuple[str, ...] = ()
    ts: str | None = None


@dataclass
class StageRun:
    """The stages of one year below ``root``.

    ``only`` names the stages to run; the others must be done, and are read. With ``resume``
    those that are done are read too. A stage that runs takes back the records of itself and
    of all that follow from it, so what was made of its old rows does not count as done.
    An unknown name in ``only`` is an error. The settings of a run are not recorded:
    whoever resumes gives the same ones.
    """

    spark: SparkSession
    root: str
    year: int
    stages: Mapping[str, Stage]
    fmt: str = "parquet"
    only: Collection[str] | None = None
    resume: bool = False
    ran: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        unknown = set(self.only or ()) - set(self.stages)
        if unknown:
            raise ValueError(f"no such stages: {sorted(unknown)}; known are {list(self.stages)}")
        rows = audits(self.spark, self.path(AUDIT)).where(f"year = {int(self.year)}").select("name").collect()
        self.recorded = {r["name"] for r in rows}

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def done(self, stage: str) -> bool:
        return self.recorded.issuperset(self.stages[stage].tables)

    def finish(self) -> bool:
        """Mark the year as finished if all its stages are done."""
        complete = all(self.done(s) for s in self.stages)
        if complete:
            mark_finished(self.spark, self.path(FINISHED), self.year)
        return complete

    def following(self, stage: str) -> set[str]:
        """The stage and all that read it, directly or not."""
        found = {stage}
        for name, later in self.stages.items():
            if found.intersection(later.after):
                found.add(name)
        return found

    def take_back(self, stage: str) -> None:
        unmark_finished(self.spark, self.path(FINISHED), self.year)
        for name in self.following(stage):
            for table in self.stages[name].tables:
                if table in self.recorded:
                    remove(self.spark, self.record(table))
                    self.recorded.discard(table)

    def record(self, table: str) -> str:
        return f"{self.path(AUDIT)}/{table}-{self.year}"

    def run(self, name: str, make: Callable[[], Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
        """The stage's tables as stored; ``make`` gives their rows and is called only if the stage runs."""
        stage = self.stages[name]
        chosen = self.only is None or name in self.only
        if chosen and not (self.resume and self.done(name)):
            waiting = [s for s in stage.after if not self.done(s)]
            if waiting:
                raise ValueError(f"stage {name} of {self.year} reads {waiting}, which are not done")
            self.take_back(name)
            made = make()
            if set(made) != set(stage.tables):
                raise ValueError(f"stage {name} makes {sorted(stage.tables)}, not {sorted(made)}")
            for table, schema in stage.tables.items():
                write_audited(made[table], self.path(table), schema, self.year, self.record(table), table, self.fmt, stage.ts)
                self.recorded.add(table)
            self.ran.append(name)
        return self.read(name)

    def read(self, name: str) -> dict[str, DataFrame]:
        """The tables of a stage that is done; none of one that is not."""
        if not self.done(name):
            return {}
        return {t: read_year(self.spark, self.path(t), s, self.year, self.fmt) for t, s in self.stages[name].tables.items()}
