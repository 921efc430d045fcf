"""Files of an operator's own format in a shared folder, through whatever file system its address names."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def new_file(folder: str, suffix: str) -> str:
    """A name that no other attempt of a task has; files of failed attempts are in no list and so never read."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def write_file(name: str, data: bytes) -> None:
    system, path = opened(name)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)


def read_file(name: str) -> bytes:
    system, path = opened(name)
    with system.open_input_file(path) as file:
        return file.read()
