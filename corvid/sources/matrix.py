"""Spark data sources: raw float32 matrices, and a paced connector to a search service.

A matrix is a folder of files of little-endian float32 rows and nothing else, with a manifest that
says which rows lie in which file, or one file given with its number of columns. Readers are
partitioned by ranges of rows; the options firstRow and endRow skip partitions and bytes. (Filters
are not pushed: Spark 4.1 keeps a frame's pushed range for its later plans without a filter, which
then lose rows.) Writers write a file for each task; the manifest is written when all have ended, and with it the matrix is there. Paths go
through pyarrow's file systems, so any store that it knows can be read.

    spark.dataSource.register(MatrixSource)
    df.write.format("f32matrix").option("path", p).save()     # row long, v array<float>
    spark.read.format("f32matrix").option("firstRow", 100).option("endRow", 200).load(p)
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

MANIFEST = "manifest.json"
#: Rows that a reader holds at once.
BATCH_ROWS = 10_000


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class Rows(InputPartition):
    """Rows from first up to last (not included) of one file of so many columns, whose own first row has number start."""

    file: str
    columns: int
    start: int
    first: int
    last: int


class MatrixReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.each = options["path"], int(options.get("partitionrows", 1_000_000))
        self.columns = int(options.get("columns", 0))
        self.low, self.high = int(options.get("firstrow", 0)), int(options["endrow"]) if "endrow" in options else None

    def _files(self) -> tuple[int, list[tuple[str, int, int]]]:
        """(columns, (file, first row, rows))."""
        fs, root = _store(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            size = fs.get_file_info(root).size
            if self.columns < 1 or size % (4 * self.columns):
                raise ValueError(f"{self.path}: {size} bytes are no rows of {self.columns} float32")
            return self.columns, [(root, 0, size // (4 * self.columns))]
        with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
            held = json.loads(f.read())
        at, out = 0, []
        for name, n in held["files"]:
            out.append((f"{root}/{name}", at, n))
            at += n
        return held["columns"], out

    def partitions(self) -> list[InputPartition]:
        columns, files = self._files()
        found = []
        for name, start, n in files:
            low, high = max(start, self.low), start + n if self.high is None else min(start + n, self.high)
            found += [Rows(name, columns, start, k, min(high, k + self.each)) for k in range(low, high, self.each)]
        return found or [Rows("", 0, 0, 0, 0)]

    def read(self, partition: Rows):
        if partition.first >= partition.last:
            return
        fs, _ = _store(self.path)
        width = partition.columns
        with fs.open_input_file(partition.file) as f:
            for k in range(partition.first, partition.last, BATCH_ROWS):
                n = min(BATCH_ROWS, partition.last - k)
                raw = f.read_at(n * width * 4, (k - partition.start) * width * 4)
                if len(raw) != n * width * 4:
                    raise OSError(f"{partition.file} ends early")
                flat = pa.array(np.frombuffer(raw, "<f4"))
                v = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, k + n)), v], names=["row", "v"])


@dataclass
class Written(WriterCommitMessage):
    file: str
    first: int
    rows: int
    columns: int


class MatrixWriter(DataSourceArrowWriter):
    """A file for each task that has rows, in the order of their first row number; rows of a task keep their order."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        fs, root = _store(self.path)
        if not overwrite and fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise FileExistsError(f"{self.path} holds a matrix")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _store(self.path)
        name, rows, columns, first = f"part-{self.job}-{uuid.uuid4().hex}.f32", 0, 0, 0
        out = None
        for b in iterator:
            if not b.num_rows:
                continue
            v = b.column(b.schema.get_field_index("v"))
            width = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False)
            columns = columns or int(width[0])
            if v.null_count or (width != columns).any():
                raise ValueError("all rows of a matrix have one length")
            if out is None:
                first = b.column(b.schema.get_field_index("row"))[0].as_py()
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}")
            out.write(np.asarray(v.flatten().to_numpy(zero_copy_only=False), "<f4").tobytes())
            rows += b.num_rows
        if out is not None:
            out.close()
        return Written(name if rows else "", first, rows, columns)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _store(self.path)
        own = sorted((m for m in messages if m and m.rows), key=lambda m: (m.first, m.file))
        if len({m.columns for m in own}) > 1:
            self.abort(messages)
            raise ValueError("all rows of a matrix have one length")
        fs.create_dir(root, recursive=True)
        old = [] if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.NotFound else json.loads(fs.open_input_stream(f"{root}/{MANIFEST}").read())["files"]
        with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps({"columns": own[0].columns if own else 0, "files": [[m.file, m.rows] for m in own]}).encode())
        for name, _ in old:
            fs.delete_file(f"{root}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _store(self.path)
        for m in messages:
            if m and m.rows:
                fs.delete_file(f"{root}/{m.file}")


class MatrixSource(DataSource):
    """f32matrix: (row long, v array<float>). Options: path, columns (of a bare file), partitionRows, firstRow, endRow (not included)."""

    @classmethod
    def name(cls) -> str:
        return "f32matrix"

    def schema(self) -> str:
        return "row long, v array<float>"

    def reader(self, schema) -> DataSourceReader:
        return MatrixReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> MatrixWriter:
        return MatrixWriter(dict(self.options), overwrite)


@dataclass
class Asked(InputPartition):
    queries: list[tuple[int, str]]


class SearchReader(DataSourceReader):
    """Asks a service for each query, one after the other in a partition, with a pause between them."""

    def __init__(self, fetch, options: dict):
        self.fetch, self.n = fetch, int(options.get("num", 10))
        self.pause, self.each = float(options.get("pause", 0.1)), int(options.get("partitionqueries", 100))
        self.queries = [tuple(x) for x in json.loads(options["queries"])]

    def partitions(self) -> list[InputPartition]:
        return [Asked(self.queries[k : k + self.each]) for k in range(0, len(self.queries), self.each)] or [Asked([])]

    def read(self, partition: Asked):
        for turn, (key, query) in enumerate(partition.queries):
            if turn:
                time.sleep(self.pause)
            try:
                found = self.fetch(query, self.n)
            except Exception:  # noqa: BLE001  the service may fail in any way, and must not fail the job
                found = []
            for k, x in enumerate(found[: self.n], 1):
                yield key, k, x.get("title", ""), x.get("text", ""), x.get("url", "")


def search_source(fetch, name: str = "websearch") -> type[DataSource]:
    """A source of (q_id, rank, title, text, url) behind fetch(query, n) -> list of dicts.

    Options: queries, a JSON list of [q_id, text], as a service is asked for few; num; pause in
    seconds; partitionQueries, so that at most so many partitions ask at once.
    """

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "q_id long, rank long, title string, text string, url string"

        def reader(self, schema) -> DataSourceReader:
            return SearchReader(fetch, dict(self.options))

    return Source
