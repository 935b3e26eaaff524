"""Files that tasks write under temporary names and that a manifest makes visible.

A task writes each file under a name of its own attempt and reports a row about it.  Spark keeps
the rows of successful attempts only; these are written as a table, then the files they name are
renamed to their final names, and last the manifest is written.  Files of lost or repeated attempts
stay under temporary names and are in no manifest.  Renaming is idempotent, so it may be retried.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from tidemark.llm.frames import token

TEMPORARY = "_temporary"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a folder, which may be local, HDFS or an object store."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class Shard:
    """One file being written under a temporary name."""

    def __init__(self, root: str, name: str) -> None:
        self.files, path = place(root)
        self.name, self.temporary = name, f"{TEMPORARY}/{token()}-{name}"
        self.files.create_dir(f"{path}/{TEMPORARY}", recursive=True)
        self.out = self.files.open_output_stream(f"{path}/{self.temporary}")
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> dict:
        self.out.close()
        return {"temporary": self.temporary, "name": self.name, "bytes": self.size}


def publish(written: DataFrame, root: str) -> DataFrame:
    """Commits the files that ``written`` (temporary, name, ...) reports; returns the manifest."""
    spark = written.sparkSession

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = place(root)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(),
                                batch.column("name").to_pylist()):
                old, new = f"{path}/{old}", f"{path}/{new}"
                if files.get_file_info(old).type != fs.FileType.NotFound:
                    files.move(old, new)
                elif files.get_file_info(new).type == fs.FileType.NotFound:
                    raise FileNotFoundError(new)
            yield batch

    written.write.parquet(f"{root}/_written")
    staged = spark.read.schema(written.schema).parquet(f"{root}/_written")
    staged.mapInArrow(rename, staged.schema).write.parquet(f"{root}/_manifest")
    return spark.read.schema(written.schema).parquet(f"{root}/_manifest")


def read_bytes(root: str, name: str) -> pa.NativeFile:
    files, path = place(root)
    return files.open_input_stream(f"{path}/{name}")
