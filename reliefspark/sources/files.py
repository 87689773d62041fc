"""Opening files by URI on the driver and on executors."""

from __future__ import annotations

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if ":" not in uri.split("/")[0]:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def read_at(uri: str, start: int, size: int) -> bytes:
    f, path = filesystem(uri)
    with f.open_input_file(path) as s:
        s.seek(start)
        return s.read(size)


def write(uri: str, data: bytes) -> None:
    f, path = filesystem(uri)
    f.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with f.open_output_stream(path, compression=None) as s:
        s.write(data)


def listing(uri: str, suffixes: tuple[str, ...]) -> list[str]:
    """The file itself, or the files of a folder with one of the suffixes, by name."""
    f, path = filesystem(uri)
    info = f.get_file_info(path)
    if info.type == fs.FileType.File:
        return [uri]
    names = sorted(i.base_name for i in f.get_file_info(fs.FileSelector(path)) if i.type == fs.FileType.File)
    return [f"{uri.rstrip('/')}/{n}" for n in names if n.lower().endswith(suffixes)]
