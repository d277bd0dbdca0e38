"""Chunk tables written by the tasks under their own names.

Rows come sorted by chunk. A task writes each of its chunks beside its final name and moves it there when it is whole, so a task that is run
again only replaces tables by equal ones, and nothing is left for the driver to rename. Workers write through pyarrow.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from cellamp.sources.ranges import locate


@dataclass
class Written(WriterCommitMessage):
    tables: int


class ChunkTableWriter(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str]):
        self.out, self.name, self.columns = options["path"], f"{options['sample']}.summTable.txt", columns

    def write(self, iterator: Iterator[Row]) -> Written:
        system, out = locate(self.out)
        attempt, tables = TaskContext.get().taskAttemptId(), 0
        for chunk, rows in itertools.groupby(iterator, key=lambda row: row[0]):
            folder = f"{out}/{chunk:04d}"
            system.create_dir(folder)
            part = f"{folder}/.{self.name}.{attempt}.part"
            with system.open_output_stream(part, compression=None) as table:
                table.write(("\t".join(self.columns[1:]) + "\n").encode())
                for row in rows:
                    table.write(("\t".join("" if v is None else v for v in row[1:]) + "\n").encode())
            system.move(part, f"{folder}/{self.name}")
            tables += 1
        return Written(tables)

    def _files(self) -> Iterator[tuple[fs.FileSystem, str, str]]:
        system, out = locate(self.out)
        for info in system.get_file_info(fs.FileSelector(out, allow_not_found=True, recursive=True)):
            yield system, info.path, info.base_name

    def commit(self, messages: list[Written | None]) -> None:
        system, out = locate(self.out)
        system.create_dir(out)
        with system.open_output_stream(f"{out}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        """Takes away what the tasks have written; there was no table of this name before."""
        for system, path, name in self._files():
            if name == self.name or (name.startswith(f".{self.name}.") and name.endswith(".part")):
                system.delete_file(path)


class ChunkTableSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cellamp_chunk_tables"

    def writer(self, schema: StructType, overwrite: bool) -> ChunkTableWriter:
        return ChunkTableWriter({**self.options, "path": os.path.join(self.options["path"], "").rstrip("/")}, schema.names)
