"""A folder of alerts to which each micro-batch is added once and as a whole.

    write_alerts(alerts, "alert_table", checkpoint, {"path": path})
    read_alerts(spark, path)

Tasks write files of JSON lines that nobody reads yet. When all are done, a
micro-batch's files are listed in one small file named by its number, which
appears at once or not at all. A micro-batch that is repeated after a failure
finds its list there and its new files are deleted; one that fails deletes
what it wrote. Files of tasks that were lost with their executor are in no
list, so they are never read.
"""

from __future__ import annotations

import json
import posixpath
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# The sink travels with the query, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "alert_table"


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote."""

    file: str | None


class AlertTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def streamWriter(self, schema: StructType, overwrite: bool) -> AlertWriter:
        if "path" not in self.options:
            raise ValueError(f"{NAME} needs the option path")
        if schema.names != ["value"]:
            raise ValueError(f"{NAME} takes one column value, not {schema.names}")
        return AlertWriter(self.options["path"])


class AlertWriter(DataSourceStreamWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator) -> Written:
        system, root = _place(self.path)
        rows = iter(iterator)
        first = next(rows, None)
        if first is None:
            return Written(None)
        name = f"files/{uuid.uuid4().hex}.jsonl"
        system.create_dir(f"{root}/files")
        with system.open_output_stream(f"{root}/{name}") as out:
            out.write(f"{first[0]}\n".encode())
            for row in rows:
                out.write(f"{row[0]}\n".encode())
        return Written(name)

    def commit(self, messages: list, batchId: int) -> None:
        from pyarrow import fs

        system, root = _place(self.path)
        target = f"{root}/batches/{batchId:020d}.json"
        if system.get_file_info(target).type != fs.FileType.NotFound:
            # Listed before the failure; Spark does not know and has repeated it.
            self.abort(messages, batchId)
            return
        files = [m.file for m in messages if m is not None and m.file]
        system.create_dir(f"{root}/batches")
        draft = f"{root}/batches/_{batchId}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(files).encode())
        system.move(draft, target)

    def abort(self, messages: list, batchId: int) -> None:
        system, root = _place(self.path)
        for message in messages:
            if message is not None and message.file:
                system.delete_file(f"{root}/{message.file}")


def _place(path: str) -> tuple:
    """The file system of a path, and the path on it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        system, path = fs.FileSystem.from_uri(path)
        return system, path.rstrip("/")
    return fs.LocalFileSystem(), path.rstrip("/")


def listed_files(path: str) -> list[str]:
    """The files of all finished micro-batches, in their order."""
    from pyarrow import fs

    system, root = _place(path)
    selector = fs.FileSelector(f"{root}/batches", allow_not_found=True)
    batches = sorted(f.path for f in system.get_file_info(selector) if f.base_name[0] != "_")
    files = []
    for batch in batches:
        with system.open_input_file(batch) as file:
            files += json.loads(file.read().decode())
    return files


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the alerts, as JSON, of all finished micro-batches.

    The lists are read on the driver, a short line per file.
    """
    files = listed_files(path)
    if not files:
        return spark.createDataFrame([], "value string")
    return spark.read.schema("value string").text([posixpath.join(path.rstrip("/"), f) for f in files])
