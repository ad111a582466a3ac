"""Binary files in the shared folder, from any process, through Arrow's file systems."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import dataset, fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", uri))


def write_whole(uri: str, parts: list[bytes] | bytes) -> None:
    """Writes under another name and renames, so that a second attempt of a task does no harm."""
    system, path = resolve(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(draft) as out:
        for part in [parts] if isinstance(parts, bytes) else parts:
            out.write(part)
    _rename(system, draft, path)


def _rename(system: fs.FileSystem, draft: str, path: str) -> None:
    """Puts a draft in place of what an earlier attempt left; some stores refuse to rename onto a file."""
    try:
        system.move(draft, path)
    except OSError:
        system.delete_file(path)
        system.move(draft, path)


class Draft:
    """A file that grows piece by piece and gets its name at the end."""

    def __init__(self, uri: str) -> None:
        self.system, self.path = resolve(uri)
        self.system.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.draft = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.system.open_output_stream(self.draft)

    def write(self, piece: bytes) -> None:
        self.out.write(piece)

    def close(self) -> None:
        self.out.close()
        _rename(self.system, self.draft, self.path)


def read_whole(uri: str) -> bytes:
    system, path = resolve(uri)
    with system.open_input_stream(path) as source:
        return source.read()


def open_random(uri: str):
    system, path = resolve(uri)
    return system.open_input_file(path)


def read_table(uri: str) -> pa.Table:
    """A Parquet folder as one table; for tables of bounded size."""
    system, path = resolve(uri)
    return dataset.dataset(path, filesystem=system, format="parquet", exclude_invalid_files=True).to_table()


def batches(uri: str, rows: int) -> Iterator[pa.RecordBatch]:
    """A Parquet folder in batches of at most ``rows`` rows, one at a time."""
    system, path = resolve(uri)
    held = dataset.dataset(path, filesystem=system, format="parquet", exclude_invalid_files=True)
    yield from held.to_batches(batch_size=rows, batch_readahead=1, fragment_readahead=1) if held.schema.names else ()
