"""Files by URI from Spark's workers, through Arrow's file systems: reads at a position, and whole-file writes.

Local paths, ``s3://``/``s3a://`` and ``gs://`` need nothing else; ``hdfs://`` and ``viewfs://`` need Hadoop's native
client on the workers. Keys are taken literally (no percent-decoding, no wildcards)."""

from __future__ import annotations

import re


def file_system(uri: str):
    """(Arrow file system, path in it)."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":") if re.match(r"[a-z][a-z0-9+.-]*:/", uri) else ("file", "", uri)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if rest.startswith("/") else rest
    host, _, path = rest.lstrip("/").partition("/")
    if scheme in ("s3", "s3a", "s3n"):
        return fs.S3FileSystem(), f"{host}/{path}"
    if scheme in ("gs", "gcs"):
        return fs.GcsFileSystem(), f"{host}/{path}"
    return fs.HadoopFileSystem(f"{scheme}://{host}"), "/" + path


def open_file(uri: str):
    """A file that answers ``read_at(n, position)`` and ``size()``."""
    system, path = file_system(uri)
    return system.open_input_file(path)


def write_file(uri: str, data: bytes) -> None:
    """The whole file, in place of an earlier one; another reader never sees a part of it."""
    system, path = file_system(uri)
    if system.type_name in ("s3", "gcs"):  # an object appears when its stream closes
        with system.open_output_stream(path) as out:
            out.write(data)
        return
    import uuid

    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, path)


class ReadAhead:
    """``read(position, n)`` over an open file in blocks: small reads close together cost one request."""

    def __init__(self, file, block: int = 4096):
        self.file, self.block, self.at, self.held = file, block, 0, b""

    def __call__(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.held):
            self.at, self.held = at, bytes(self.file.read_at(max(n, self.block), at))
        return self.held[at - self.at:at - self.at + n]
