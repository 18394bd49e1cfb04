"""Files that tasks write and read themselves, in the shared folder of the session (any store Arrow can open)."""

from __future__ import annotations

import uuid

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def create(folder: str, name: str) -> tuple[object, str]:
    """A new file under ``folder`` with a name of this attempt's own: a task that runs again never touches it.

    Only files named in the table that the finished tasks return are ever read.
    """
    store, path = located(folder)
    store.create_dir(path, recursive=True)
    uri = f"{folder}/{name}-{uuid.uuid4().hex}"
    return store.open_output_stream(f"{path}/{uri.rsplit('/', 1)[1]}"), uri


def opened(uri: str):
    store, path = located(uri)
    return store.open_input_file(path)
