"""Tables that grow by segments: state that a loop saves without writing it anew.

A table is a list of Parquet segments, each written once. What a round adds is one more segment a table; a commit, one small
file that appears at once, names the segments that count and carries the round's notes. Segments without a commit count for
nothing, so a run that ends between two writes goes on from the last commit, and writes them again.

Where `fan` segments of a level have come together, merge() makes them one of the next level, so a row is written again
once a level, at most log(rounds) / log(fan) times, and a table has at most `fan` segments a level. Tables whose rows
can be taken back (a queue and what has left it) are folded instead: fold() puts the rows that are left in place of all
segments. What no commit names any more is removed after the next commit. One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from .stage import Files


class Log:
    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str], fan: int = 8) -> None:
        """schemas: the columns of each table, as DDL."""
        self.spark, self.folder, self.schemas, self.fan = spark, folder.rstrip("/"), schemas, fan
        self.files = Files(spark, folder)
        self.number, self.notes = 0, {}
        self.segments: dict[str, list[list]] = {t: [] for t in schemas}  # [level, name], the oldest first
        self._gone: list[str] = []

    def resume(self) -> Log:
        """The state of the last commit, or an empty one."""
        done = [int(n) for n in self.files.names(f"{self.folder}/commits") if n.isdigit()]
        if done:
            last = json.loads(self.files.read(f"{self.folder}/commits/{max(done):010d}"))
            self.number, self.segments, self.notes = last["number"], last["segments"], last["notes"]
        return self

    def path(self, table: str, name: str) -> str:
        return f"{self.folder}/{table}/{name}"

    def read(self, table: str, last: int | None = None) -> DataFrame:
        """All rows of a table, or those of its last segments."""
        names = [n for _, n in self.segments[table]][-last if last else None :]
        if not names:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*(self.path(table, n) for n in names))

    def _write(self, table: str, level: int, rows: DataFrame) -> list:
        names = [c.strip().split()[0] for c in self.schemas[table].split(",")]
        segment = f"{self.number + 1:010d}-{level}"
        rows.select(*names).write.mode("overwrite").parquet(self.path(table, segment))
        return [level, segment]

    def add(self, table: str, rows: DataFrame) -> DataFrame:
        """One more segment; returns its rows."""
        self.segments[table] = [*self.segments[table], self._write(table, 0, rows)]
        return self.read(table, 1)

    def fold(self, table: str, rows: DataFrame) -> None:
        """The rows in place of all segments."""
        before = self.segments[table]
        self.segments[table] = [self._write(table, 1 + max((k for k, _ in before), default=0), rows)]
        self._gone += [self.path(table, n) for _, n in before]

    def merge(self, table: str) -> None:
        """Make `fan` segments of a level one of the next, on as many levels as have come to that."""
        level = 0
        while len(run := [s for s in self.segments[table] if s[0] == level]) >= self.fan:
            rows = self.spark.read.schema(self.schemas[table]).parquet(*(self.path(table, n) for _, n in run))
            one = self._write(table, level + 1, rows)
            at = self.segments[table].index(run[0])
            self.segments[table] = [*self.segments[table][:at], one, *(s for s in self.segments[table][at:] if s not in run)]
            self._gone += [self.path(table, n) for _, n in run]
            level += 1

    def commit(self, **notes) -> None:
        """From now on the segments count; the notes go with them."""
        number = self.number + 1
        self.files.put(f"{self.folder}/commits/{number:010d}", json.dumps({"number": number, "segments": self.segments, "notes": notes}))
        self.number, self.notes = number, notes
        for path in self._gone:
            self.files.remove(path)
        self._gone = []
        if number > 2:
            self.files.remove(f"{self.folder}/commits/{number - 2:010d}")
