"""Archives of web responses: a header line, then header and body bytes of known length.

Formats: 'wpage' (wpage_id url scheme host path ip connect_time header_len body_len),
'arc' (url ip connect_time mime header_len body_len wpage_id) and 'arc-old' (url ip
connect_time mime length wpage_id, the body starting at its first '<'). Files may be
gzipped. ``register`` makes them readable by ``spark.read.format("web_archive")``.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FIELDS = {"wpage": 9, "arc": 7, "arc-old": 6}
SCHEMA = "wpage_id long, url string, scheme string, host string, path string, ip string, connect_time string, header binary, body binary"
MOST_BAD_LINES = 1_000_000
BATCH_BYTES = 8 << 20


def _none(s: str) -> str | None:
    return None if s == "None" else s


def records(stream: io.BufferedIOBase, kind: str) -> Iterator[tuple]:
    """Records of one file; bad header lines are skipped over, a cut-off record ends the file."""
    from urllib.parse import urlsplit

    bad = 0
    while line := stream.readline():
        p = line.decode("utf-8", "replace").rstrip("\n").split(" ")
        try:
            if len(p) != FIELDS[kind]:
                raise ValueError(line)
            if kind == "wpage":
                number, url, scheme, host, path, ip, time, head, body = p
            else:
                url, ip, time = p[:3]
                head, body, number = p[4:] if kind == "arc" else (p[4], "0", p[5])
                parts = urlsplit(url)
                scheme, host, path = parts.scheme, parts.netloc, (parts.path + ("?" + parts.query if parts.query else "")) or "/"
            number, head, body = int(number), int(head), int(body)
            if head < 0 or body < 0:
                raise ValueError(line)
        except ValueError:
            bad += 1
            if bad > MOST_BAD_LINES:
                return
            continue
        data = stream.read(head + body)
        if len(data) < head + body:
            return
        if kind == "arc-old":
            cut = data.find(b"<")
            head = cut if cut >= 0 else len(data)
        else:
            mark = stream.peek(1)[:1] if hasattr(stream, "peek") else b""
            if mark == b"\n":
                stream.read(1)
        yield number, url, scheme, host, path, _none(ip), time, data[:head], data[head:]


def write_records(rows: Iterator[tuple], stream: io.BufferedIOBase, kind: str = "wpage") -> None:
    for number, url, scheme, host, path, ip, time, head, body in rows:
        if kind == "wpage":
            line = f"{number} {url} {scheme} {host} {path} {ip} {time} {len(head)} {len(body)}\n"
        elif kind == "arc":
            line = f"{url} {ip} {time} text/html {len(head)} {len(body)} {number}\n"
        else:
            line = f"{url} {ip} {time} text/html {len(head) + len(body)} {number}\n"
        stream.write(line.encode() + head + body)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.kind, self.paths = options.get("kind", "wpage"), json.loads(options["list"]) if "list" in options else [options["path"]]

    def partitions(self) -> list[InputPartition]:
        """One task a file: records can only be found from a file's start."""
        return [_File(f) for path in self.paths for f in self._files(path)]

    @staticmethod
    def _files(path: str) -> list[str]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        files = [root]
        if system.get_file_info(root).type == fs.FileType.Directory:
            files = [f.path for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file and not f.base_name.startswith(("_", "."))]
        prefix = path.split("://", 1)[0] + "://" if "://" in path else ""
        return sorted(prefix + f for f in files)

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(partition.path) if "://" in partition.path else (fs.LocalFileSystem(), partition.path)
        raw = system.open_input_stream(path, compression=None)
        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if path.endswith(".gz") else io.BufferedReader(raw)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        types = [pa.int64(), *[pa.string()] * 6, pa.binary(), pa.binary()]
        rows, size = [], 0
        for r in records(stream, self.kind):
            rows.append(r)
            size += len(r[7]) + len(r[8])
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


class ArchiveWriter(DataSourceArrowWriter):
    """Files under a hidden name until their task is committed."""

    def __init__(self, options: dict) -> None:
        self.kind, self.path, self.most = options.get("kind", "wpage"), options["path"], int(options.get("most", 100 << 30))

    def _fs(self):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        system.create_dir(root, recursive=True)
        return system, root

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, root = self._fs()
        names, out, size = [], None, 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None or size >= self.most:
                    if out is not None:
                        out.close()
                    names.append(f"_{uuid.uuid4().hex}")
                    out, size = system.open_output_stream(f"{root}/{names[-1]}"), 0
                head = io.BytesIO()
                write_records(iter([row]), head, self.kind)
                size += out.write(head.getvalue())
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = self._fs()
        for name in (n for m in messages if m for n in m.names):
            system.move(f"{root}/{name}", f"{root}/part-{name[1:]}")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = self._fs()
        for name in (n for m in messages if m for n in m.names):
            system.delete_file(f"{root}/{name}")


class WebArchive(DataSource):
    """spark.read.format("web_archive").option("kind", "arc").load(path)"""

    @classmethod
    def name(cls) -> str:
        return "web_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ArchiveWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WebArchive)


def read(spark: SparkSession, path: str | list[str], kind: str = "wpage") -> DataFrame:
    """Records of a file, a folder or a list of either."""
    register(spark)
    reader = spark.read.format("web_archive").option("kind", kind)
    return reader.load(path) if isinstance(path, str) else reader.option("list", json.dumps(path)).load()


def write_files(pages: DataFrame, path: str, kind: str = "wpage", most_bytes: int = 100 << 30) -> None:
    """Archive rows as archive files below ``path``, rolled at ``most_bytes``; only files of tasks that ended stay."""
    register(pages.sparkSession)
    pages.select(*[f.split()[0] for f in SCHEMA.split(", ")]).write.format("web_archive").option("kind", kind).option("most", most_bytes).mode("append").save(path)


def connect_timestamp(column: str = "connect_time"):
    return F.try_to_timestamp(F.col(column), F.lit("yyyyMMddHHmmss"))


def write_archive(pages: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Archive rows (SCHEMA's columns) as compressed Parquet in files of a bounded number of records."""
    pages.select(*[f.split()[0] for f in SCHEMA.split(", ")]).write.option("compression", "zstd").option("maxRecordsPerFile", per_file).parquet(path)
