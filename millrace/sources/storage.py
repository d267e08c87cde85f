"""Shared storage as Python tasks see it: named objects below a folder."""

from __future__ import annotations

import re

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it.

    Absolute paths and ``file:`` names are local or mounted folders, which driver and
    executors have to share; any other scheme is one that pyarrow can open.
    """
    if re.match("^(?!file:)[A-Za-z][A-Za-z0-9+.-]*://", folder):
        return fs.FileSystem.from_uri(folder.rstrip("/"))
    return fs.LocalFileSystem(), "/" + re.sub("^file:", "", folder).strip("/")


def names_in(files: fs.FileSystem, folder: str, kind: fs.FileType) -> list[str]:
    """Sorted names of one kind in a folder; none where the folder is missing."""
    found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(info.base_name for info in found if info.type == kind)


def content(files: fs.FileSystem, path: str) -> bytes:
    with files.open_input_stream(path) as stream:
        return stream.read()


def put(files: fs.FileSystem, path: str, body: bytes) -> None:
    with files.open_output_stream(path) as stream:
        stream.write(body)


def replace(files: fs.FileSystem, source: str, target: str) -> None:
    """Move a whole file over ``target``; done already where the source is gone."""
    missing = fs.FileType.NotFound
    if files.get_file_info(source).type == missing and files.get_file_info(target).type != missing:
        return
    files.move(source, target)
