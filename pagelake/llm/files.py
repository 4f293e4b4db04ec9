"""Binary files in a shared folder, written by tasks and listed in a manifest.

A task writes a file under a name of its own attempt and returns one summary
row; the driver lists the files of the successful attempts (one row per task)
in ``_manifest.json``.  A lost executor's file is never listed, its task writes
another.  Paths may be plain or carry any scheme that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs

MANIFEST = "_manifest.json"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if "://" in path else path.removeprefix("file:"))


def attempt_name(partition: int, suffix: str) -> str:
    return f"part-{partition:06d}-{uuid.uuid4().hex}{suffix}"


def open_write(path: str):
    system, inner = filesystem(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


def open_read(path: str):
    system, inner = filesystem(path)
    return system.open_input_file(inner)


def write_manifest(folder: str, entries: list[dict], **head) -> None:
    system, inner = filesystem(folder)
    system.create_dir(inner, recursive=True)
    with system.open_output_stream(f"{inner}/{MANIFEST}") as out:
        out.write(json.dumps({**head, "files": entries}).encode())


def read_manifest(folder: str) -> dict | None:
    system, inner = filesystem(folder)
    if system.get_file_info(f"{inner}/{MANIFEST}").type != fs.FileType.File:
        return None
    with system.open_input_stream(f"{inner}/{MANIFEST}") as f:
        return json.loads(f.read())


def list_files(folder: str, suffixes: tuple[str, ...]) -> list[dict]:
    """``{"path", "bytes"}`` of the manifest's files, or of every file with such a suffix where there is none."""
    known = read_manifest(folder)
    if known is not None:
        return [{"path": f"{folder}/{e['name']}", "bytes": e["bytes"]} for e in known["files"]]
    system, inner = filesystem(folder)
    head = folder[: len(folder) - len(inner)] if folder.endswith(inner) else ""
    found = [i for i in system.get_file_info(fs.FileSelector(inner, recursive=True)) if i.is_file and i.path.endswith(suffixes)]
    return [{"path": head + i.path, "bytes": i.size} for i in sorted(found, key=lambda i: i.path)]
