"""Small metadata helpers: existence, listing, sizes, tiny marker files.
Data never goes through here; Spark reads and writes all rows.

On the driver the Hadoop FileSystem of the active Spark session is used, so
every scheme and credential the cluster is configured for works (HDFS, S3A,
ABFS, GCS connector, local).  Inside Python tasks, where no JVM is reachable,
pyarrow filesystems are used (local, S3, GCS, HDFS)."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs as pafs


def _hadoop(uri: str):
    """(FileSystem, Path) through the active session's JVM, or None."""
    try:
        from pyspark import SparkContext
        sc = SparkContext._active_spark_context
        if sc is None:
            return None
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(uri)
        return path.getFileSystem(sc._jsc.hadoopConfiguration()), path
    except Exception:  # noqa: BLE001 - no JVM here (executor task): use pyarrow
        return None


def _split(uri: str):
    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return pafs.LocalFileSystem(), path
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def exists(uri: str) -> bool:
    h = _hadoop(uri)
    if h:
        return bool(h[0].exists(h[1]))
    f, p = _split(uri)
    return f.get_file_info(p).type != pafs.FileType.NotFound


def list_dirs(uri: str) -> list[str]:
    h = _hadoop(uri)
    if h:
        fs, path = h
        if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory())
    f, p = _split(uri)
    if f.get_file_info(p).type != pafs.FileType.Directory:
        return []
    infos = f.get_file_info(pafs.FileSelector(p, recursive=False))
    return sorted(i.base_name for i in infos if i.type == pafs.FileType.Directory)


def list_names(uri: str) -> list[str]:
    """Names of the files in a folder (none if it is missing)."""
    h = _hadoop(uri)
    if h:
        fs, path = h
        if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(path) if st.isFile())
    f, p = _split(uri)
    if f.get_file_info(p).type != pafs.FileType.Directory:
        return []
    infos = f.get_file_info(pafs.FileSelector(p, recursive=False))
    return sorted(i.base_name for i in infos if i.type == pafs.FileType.File)


def create_new(uri: str, text: str) -> bool:
    """Create a small file that must not exist yet, with its whole content or not at
    all; False if another writer was first."""
    f, p = _split(uri)
    if isinstance(f, pafs.LocalFileSystem):
        os.makedirs(os.path.dirname(p), exist_ok=True)
        tmp = f"{p}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(tmp, p)  # fails where the name is taken
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(tmp)
    fs, path = _hadoop(uri)
    try:
        out = fs.create(path, False)  # the file system decides between two writers
    except Exception as e:
        if fs.exists(path):
            return False
        raise e
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def total_size(uri: str) -> int:
    """Bytes of visible data files under ``uri`` (hidden ``_``/``.`` names skipped)."""
    h = _hadoop(uri)
    if h:
        fs, path = h
        if not fs.exists(path):
            return 0
        total, it = 0, fs.listFiles(path, True)
        base = len(fs.makeQualified(path).toUri().getPath())
        while it.hasNext():
            st = it.next()
            rel = st.getPath().toUri().getPath()[base:]
            if not any(part.startswith(("_", ".")) for part in rel.split("/") if part):
                total += st.getLen()
        return total
    f, p = _split(uri)
    if f.get_file_info(p).type == pafs.FileType.NotFound:
        return 0
    infos = f.get_file_info(pafs.FileSelector(p, recursive=True))
    return sum(i.size or 0 for i in infos if i.type == pafs.FileType.File
               and not any(part.startswith(("_", ".")) for part in i.path[len(p):].split("/") if part))


def write_text(uri: str, text: str) -> None:
    """Replace a small file by way of a temporary one with a name of its own.
    Readers never see a part of the content; one that does not hold the table's
    metadata lock may find no file for a moment."""
    h = _hadoop(uri)
    if h:
        return _hadoop_write(uri, text)
    f, p = _split(uri)
    parent = p.rsplit("/", 1)[0]
    f.create_dir(parent, recursive=True)
    tmp = f"{p}.{uuid.uuid4().hex}.tmp"
    with f.open_output_stream(tmp) as out:
        out.write(text.encode("utf-8"))
    f.move(tmp, p)


def _hadoop_write(uri: str, text: str) -> None:
    fs, path = _hadoop(uri)
    _, tmp = _hadoop(f"{uri}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(path):
        fs.delete(path, False)
    if not fs.rename(tmp, path):
        raise OSError(f"could not move {tmp} to {path}")


def read_text(uri: str) -> str | None:
    h = _hadoop(uri)
    if h:
        fs, path = h
        if not fs.exists(path):
            return None
        inp = fs.open(path)
        try:
            data = inp.readAllBytes()
        finally:
            inp.close()
        return bytes(data).decode("utf-8")
    f, p = _split(uri)
    if f.get_file_info(p).type == pafs.FileType.NotFound:
        return None
    with f.open_input_stream(p) as inp:
        return inp.read().decode("utf-8")


def read_head(uri: str, nbytes: int = 65536) -> bytes:
    h = _hadoop(uri)
    if h:
        inp = h[0].open(h[1])
        try:
            return bytes(inp.readNBytes(int(nbytes)))
        finally:
            inp.close()
    f, p = _split(uri)
    with f.open_input_file(p) as inp:
        return inp.read(nbytes)


def delete_dir(uri: str) -> None:
    h = _hadoop(uri)
    if h:
        if h[0].exists(h[1]):
            h[0].delete(h[1], True)
        return
    f, p = _split(uri)
    if f.get_file_info(p).type == pafs.FileType.Directory:
        f.delete_dir(p)
