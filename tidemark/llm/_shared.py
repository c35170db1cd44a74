"""Files and tables in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame

from ..operators.tables import components, dropped, path_of, shared_dir, written

__all__ = ["SharedFile", "components", "dropped", "filesystem", "free_name", "one_file_a_task", "open_input", "path_of", "shared_dir", "tokenizer_file", "written"]


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a Hadoop-style URI names, and the path there."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    return pafs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}://{rest}")


class SharedFile:
    """A file written under a name of its own and moved into place when whole.

    A task that dies leaves only a file that no manifest names; its retry
    writes another one.
    """

    def __init__(self, folder: str, name: str):
        self.fs, root = filesystem(folder)
        self.fs.create_dir(root, recursive=True)
        self.name = f"{name}-{uuid.uuid4().hex[:12]}"
        self.path = f"{root}/{self.name}"
        self.uri = f"{folder.rstrip('/')}/{self.name}"
        self.out = self.fs.open_output_stream(f"{self.path}.part", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> str:
        self.out.close()
        self.fs.move(f"{self.path}.part", self.path)
        return self.uri


def open_input(uri: str):
    """A stream of the file's raw bytes, read in blocks."""
    fs, path = filesystem(uri)
    return fs.open_input_stream(path, compression=None, buffer_size=1 << 20)


def one_file_a_task(manifest: DataFrame, key: str) -> DataFrame:
    """The manifest dealt out so that each file is a task of its own, or nearly so."""
    parallel = manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.repartition(max(parallel * 4, 12), key)


def tokenizer_file(name: str) -> str:
    """Default place of a public tokenizer's file; TIDEMARK_TOKENIZERS names another folder."""
    folder = os.environ.get("TIDEMARK_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
