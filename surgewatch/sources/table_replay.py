"""A recorded table as a stream with offsets of its own.

    spark.dataSource.register(TableReplay)
    spark.readStream.format("table_replay").schema(...).option("path", ...)

Offsets count the row groups of the table's Parquet files, in the order of
their names, so files that are added later must sort behind the others. Each
row group is one partition. Positions: ``TRIM_HORIZON`` reads all, ``LATEST``
what is added after the first start, ``AT_TIMESTAMP`` begins with the first
row group that, by its statistics, may hold rows from ``timestamp`` on, and
leaves out older rows of ``timecol``. Where a stream began is in its
checkpoint: later starts do not look at the position.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from surgewatch.sources import positions
from surgewatch.sources.positions import StartPosition, start_time

# The source travels with the query, so executors need no copy of these modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(positions)

NAME = "table_replay"
OPTIONS = ("path", "position", "timestamp", "timecol")


class RowGroup(InputPartition):
    """One row group of a file."""

    def __init__(self, path: str, group: int) -> None:
        self.path, self.group = path, group


class TableReplay(DataSource):
    """See the module; ``read_records`` with this format gives it its position."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        fs, paths = parquet_files(self.options["path"])
        if not paths:
            raise ValueError("an empty table needs a schema")
        with fs.open_input_file(paths[0]) as file:
            return from_arrow_schema(pq.read_schema(file))

    def streamReader(self, schema: StructType) -> ReplayReader:
        unknown = sorted(set(self.options) - set(OPTIONS))
        if unknown:
            raise ValueError(f"{NAME} has no option {', '.join(unknown)}")
        return ReplayReader(schema, dict(self.options))


class ReplayReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.path = schema, options["path"]
        self.position = StartPosition.of(options.get("position", "TRIM_HORIZON"))
        self.time_col = options.get("timecol")
        self.begin: datetime | None = None
        if self.position is StartPosition.AT_TIMESTAMP:
            if not self.time_col or "timestamp" not in options:
                raise ValueError("AT_TIMESTAMP needs the options timestamp and timecol")
            self.begin = start_time(options["timestamp"])

    def initialOffset(self) -> dict:
        groups = self._groups(stats=self.position is StartPosition.AT_TIMESTAMP)
        if self.position is StartPosition.LATEST:
            return {"group": len(groups)}
        if self.position is StartPosition.AT_TIMESTAMP:
            possible = (n for n, (_, _, last) in enumerate(groups) if last is None or last >= self.begin)
            return {"group": next(possible, len(groups))}
        return {"group": 0}

    def latestOffset(self) -> dict:
        return {"group": len(self._groups())}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        groups = self._groups()
        if len(groups) < end["group"]:
            raise ValueError(f"row groups of {self.path} are gone: {len(groups)} of {end['group']} are left")
        return [RowGroup(path, group) for path, group, _ in groups[start["group"] : end["group"]]]

    def read(self, partition: RowGroup) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, _ = parquet_files(self.path)
        schema = to_arrow_schema(self.schema)
        names = list(dict.fromkeys([*schema.names, *([self.time_col] if self.begin else [])]))
        with fs.open_input_file(partition.path) as file:
            table = pq.ParquetFile(file).read_row_group(partition.group, columns=names)
        if self.begin:
            column = table[self.time_col]
            begin = self.begin if column.type.tz else self.begin.replace(tzinfo=None)
            table = table.filter(pc.greater_equal(column, pa.scalar(begin, column.type)))
        yield from table.select(schema.names).cast(schema).to_batches()

    def commit(self, end: dict) -> None:
        pass

    def _groups(self, stats: bool = False) -> list[tuple[str, int, datetime | None]]:
        """File, number and, if asked for, newest time of each row group; from the files' footers."""
        import pyarrow.parquet as pq

        fs, paths = parquet_files(self.path)
        groups = []
        for path in paths:
            with fs.open_input_file(path) as file:
                footer = pq.ParquetFile(file).metadata
            column = footer.schema.names.index(self.time_col) if stats else None
            for group in range(footer.num_row_groups):
                last = None
                if stats:
                    found = footer.row_group(group).column(column).statistics
                    if found is not None and found.has_min_max:
                        last = found.max if found.max.tzinfo else found.max.replace(tzinfo=timezone.utc)
                groups.append((path, group, last))
        return groups


def parquet_files(path: str) -> tuple:
    """The file system of a path and the Parquet files of the table, by name."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        system, path = fs.FileSystem.from_uri(path)
    else:
        system = fs.LocalFileSystem()
    if system.get_file_info(path).type == fs.FileType.File:
        return system, [path]
    found = system.get_file_info(fs.FileSelector(path))
    names = [f.path for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"]
    return system, sorted(names)
