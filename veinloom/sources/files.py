"""Files of any store that pyarrow knows, opened by URI inside tasks."""

from __future__ import annotations

from pyarrow import fs


def opened(uri: str):
    """A seekable file."""
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def read_bytes(uri: str) -> bytes:
    if uri.startswith(("http://", "https://")):
        from urllib.request import urlopen

        with urlopen(uri, timeout=60) as answer:
            return answer.read()
    with opened(uri) as f:
        return f.read()


def listed(uri: str, end: str = "") -> list[tuple[str, int]]:
    """URI and modification time (nanoseconds) of each file in a folder, or of the file itself, by name."""
    store, path = fs.FileSystem.from_uri(uri)
    info = store.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        return []
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path))
    head = uri[: len(uri) - len(path)] if uri.endswith(path) else uri.split("://")[0] + "://"
    return sorted((head + i.path, i.mtime_ns or 0) for i in found if i.type == fs.FileType.File and i.path.endswith(end) and not i.base_name.startswith((".", "_")))
