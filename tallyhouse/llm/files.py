"""Binary files in the shared work folder, opened from tasks by URI."""

from __future__ import annotations

from pyarrow import fs


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def open_output(uri: str):
    """A new file, its folder made if missing."""
    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A file that can seek and be read in parts."""
    system, path = _open(uri)
    return system.open_input_file(path)
