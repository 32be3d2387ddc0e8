"""Whole files written by tasks into a folder that all executors share."""

from __future__ import annotations

import uuid

from pyarrow import fs


def put(uri: str, content: bytes) -> None:
    """Write one file so that readers see all of it or nothing.

    A task that runs twice writes the same name with the same bytes; the last rename wins.
    """
    system, path = fs.FileSystem.from_uri(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(content)
    system.move(draft, path)
