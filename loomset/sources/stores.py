"""File systems as Python tasks see them, for looking at names, sizes and first bytes."""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping
from typing import NamedTuple
from urllib.parse import urlsplit

#: Schemes that PyArrow opens, and the name it has for them.
SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs"}


class Found(NamedTuple):
    path: str
    is_dir: bool
    length: int


def opens(path: str) -> bool:
    """Whether tasks can look at this qualified path without Hadoop's connectors."""
    scheme = urlsplit(path).scheme
    return scheme in ("", "file") or scheme in SCHEMES


class Local:
    """A disk that all machines share, or the only machine's."""

    def __init__(self, base: str):
        # Hadoop writes ``file:/a/b`` or ``file:///a/b``, and escapes nothing.
        self.prefix = "file:" if base.startswith("file:") else ""

    def _plain(self, path: str) -> str:
        path = path.removeprefix("file:")
        return "/" + path.lstrip("/") if path.startswith("//") else path

    def children(self, directory: str) -> Iterator[Found]:
        top = self._plain(directory)
        with os.scandir(top) as inside:
            for entry in inside:
                # Checksums that Hadoop keeps beside its files and shows to nobody.
                if entry.name.startswith(".") and entry.name.endswith(".crc"):
                    continue
                is_dir = entry.is_dir()
                yield Found(self.prefix + entry.path, is_dir, 0 if is_dir else entry.stat().st_size)

    def is_dir(self, path: str) -> bool:
        return os.path.isdir(self._plain(path))

    def open(self, path: str):
        return open(self._plain(path), "rb")


class Arrow:
    """An object store or HDFS through PyArrow."""

    def __init__(self, base: str, options: Mapping[str, str]):
        from pyarrow import fs

        parts = urlsplit(base)
        self.scheme, self.host = parts.scheme, parts.netloc
        if SCHEMES[parts.scheme] == "s3":
            named = {"endpoint_override": options.get("endpoint"), "region": options.get("region")}
            self.fs = fs.S3FileSystem(**{k: v for k, v in named.items() if v})
            self.top = parts.netloc
        else:
            self.fs, inside = fs.FileSystem.from_uri(f"{SCHEMES[parts.scheme]}://{parts.netloc}/")
            self.top = inside.strip("/")

    def _inside(self, path: str) -> str:
        rest = path.split("://", 1)[1].split("/", 1)
        below = rest[1] if len(rest) > 1 else ""
        return f"{self.top}/{below}".rstrip("/")

    def children(self, directory: str) -> Iterator[Found]:
        from pyarrow import fs

        for info in self.fs.get_file_info(fs.FileSelector(self._inside(directory))):
            path = f"{directory.rstrip('/')}/{info.base_name}"
            yield Found(path, info.type == fs.FileType.Directory, info.size or 0)

    def is_dir(self, path: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(self._inside(path)).type == fs.FileType.Directory

    def open(self, path: str):
        return self.fs.open_input_stream(self._inside(path))


def store_of(path: str, options: Mapping[str, str] | None = None) -> Local | Arrow:
    scheme = urlsplit(path).scheme
    return Local(path) if scheme in ("", "file") else Arrow(path, options or {})
