"""File access for the Python readers and writers through ``pyarrow.fs``:
plain paths, ``file:``, ``hdfs://``, ``s3://`` and ``gs://`` URIs alike, so
the shared folder a cluster names (``spark.checkpoint.dir``) works whatever
its file system."""

from __future__ import annotations

import contextlib
import posixpath
import uuid

from pyarrow import fs as pafs


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def _join(base_uri: str, rel: str) -> str:
    return base_uri.rstrip("/") + "/" + rel.lstrip("/")


def list_files(path: str) -> list[str]:
    """Files under ``path`` (a file or a folder, recursively), sorted, as
    paths usable with ``open_read``; names starting with ``.`` or ``_`` are
    skipped, as Spark does."""
    fs, p = resolve(path)
    info = fs.get_file_info(p)
    prefix = path[: len(path) - len(p)] if "://" in path and path.endswith(p) else ""
    if info.type == pafs.FileType.File:
        return [path]
    if info.type != pafs.FileType.Directory:
        return []
    out = []
    for f in fs.get_file_info(pafs.FileSelector(p, recursive=True)):
        if f.type != pafs.FileType.File:
            continue
        rel = posixpath.relpath(f.path, p)
        if any(part.startswith((".", "_")) for part in rel.split("/")):
            continue
        out.append(prefix + f.path if prefix else f.path)
    return sorted(out)


def open_read(path: str):
    """A seekable binary file."""
    fs, p = resolve(path)
    return fs.open_input_file(p)


def exists(path: str) -> bool:
    fs, p = resolve(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


@contextlib.contextmanager
def atomic_writer(path: str):
    """A binary output stream for ``path``: data goes to a unique temporary
    name and is moved into place on success (a retried task replaces the
    file; a reader never sees a partial one; a failure leaves no file)."""
    fs, p = resolve(path)
    parent = posixpath.dirname(p)
    if parent:
        fs.create_dir(parent, recursive=True)
    tmp = posixpath.join(parent, f".{posixpath.basename(p)}.{uuid.uuid4().hex}.inprogress")
    out = fs.open_output_stream(tmp)
    try:
        yield out
        out.close()
        try:
            fs.move(tmp, p)
        except OSError:  # a file system whose rename does not replace
            if fs.get_file_info(p).type == pafs.FileType.NotFound:
                raise
            old = tmp + ".old"  # set aside, not deleted: a crash between the moves loses nothing
            fs.move(p, old)
            try:
                fs.move(tmp, p)
            except BaseException:
                fs.move(old, p)
                raise
            fs.delete_file(old)
    except BaseException:
        out.close()
        fs.delete_file(tmp)
        raise


def stat(path: str) -> tuple[int, float] | None:
    """(size, mtime seconds) of a file, or None if there is none."""
    fs, p = resolve(path)
    info = fs.get_file_info(p)
    if info.type != pafs.FileType.File:
        return None
    return info.size or 0, info.mtime.timestamp() if info.mtime is not None else 0.0


def write_atomic(path: str, chunks) -> None:
    with atomic_writer(path) as out:
        for c in chunks:
            out.write(c)


def remove(path: str) -> None:
    """Remove a file; one that is gone already is no error."""
    fs, p = resolve(path)
    with contextlib.suppress(FileNotFoundError):
        fs.delete_file(p)


def list_dir(path: str) -> list[tuple[str, bool, int, float]]:
    """(path, is_dir, size, mtime seconds) of the entries of one folder."""
    fs, p = resolve(path)
    prefix = path[: len(path) - len(p)] if "://" in path and path.endswith(p) else ""
    out = []
    for f in fs.get_file_info(pafs.FileSelector(p, recursive=False)):
        mt = f.mtime.timestamp() if f.mtime is not None else 0.0
        out.append((prefix + f.path, f.type == pafs.FileType.Directory, f.size or 0, mt))
    return sorted(out)


def walk_files(path: str) -> list[tuple[str, int, float]]:
    """(path, size, mtime seconds) of every file below ``path``."""
    fs, p = resolve(path)
    prefix = path[: len(path) - len(p)] if "://" in path and path.endswith(p) else ""
    out = []
    for f in fs.get_file_info(pafs.FileSelector(p, recursive=True)):
        if f.type == pafs.FileType.File:
            mt = f.mtime.timestamp() if f.mtime is not None else 0.0
            out.append((prefix + f.path, f.size or 0, mt))
    return sorted(out)


def join(base: str, rel: str) -> str:
    return _join(base, rel) if "://" in base else posixpath.join(base.removeprefix("file:"), rel.lstrip("/"))
