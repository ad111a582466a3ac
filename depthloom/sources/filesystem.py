"""Small files from any process, through Arrow's file systems."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        uri = f"file://{uri}"
    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", uri))


def write(uri: str, data: bytes) -> None:
    """Writes under a draft name and renames: a repeated task leaves one whole file."""
    system, path = resolve(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(draft) as out:
        out.write(data)
    take_name(system, draft, path)


def take_name(system: fs.FileSystem, draft: str, path: str) -> None:
    """Puts a draft in the place of its file."""
    try:
        system.move(draft, path)
    except OSError:  # some stores refuse to rename onto a file
        system.delete_file(path)
        system.move(draft, path)


def read(uri: str) -> bytes:
    system, path = resolve(uri)
    with system.open_input_stream(path) as source:
        return source.read()


def exists(uri: str) -> bool:
    system, path = resolve(uri)
    return system.get_file_info(path).type == fs.FileType.File


def delete(uri: str) -> None:
    system, path = resolve(uri)
    system.delete_file(path)
