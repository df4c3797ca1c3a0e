"""Landing files listed from an offset: a streaming data source of file names.

Names and folders carry their time (``2024-01-01/trades_093000.csv``), so a new
file sorts after all earlier ones.  An ordinary listing opens only the folders
that can hold a name after the last one, whatever the history beside them.  Every
``full_every``-th entry, and every ``full_every``-th listing that finds nothing, opens
all folders and delivers names that came late: those before the last one that no
earlier entry holds.

The offset is the number of an entry in an append-only log below ``log``.  An entry
holds at most ``max_files`` names and the last name of all so far, and never
changes, so a replayed batch has the same files.  One query owns a log, as it owns
its checkpoint.  An ordinary listing reads only the newest entry, a full one all
of them.  A trigger takes one entry; ``pending`` tells whether more are to come.

Options: ``path``, ``log``, ``pattern`` (of file names, ``*``), ``max_files``
(1000), ``full_every`` (10).  Names that begin with ``_`` or ``.`` are never data.
A missing or empty folder gives no rows.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import json
import sys

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tierflow.sinks import paths

# the source runs in Python workers that need not find this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(paths)

FORMAT = "landing_names"
SCHEMA = "path string, length long, modificationTime timestamp"


def entry_name(number: int) -> str:
    return f"e{number:010d}.json"


def _visible(name: str) -> bool:
    return not name.startswith(("_", "."))


class Entries:
    """The append-only log of listed names."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def numbers(self) -> list[int]:
        return sorted(int(n[1:11]) for n in paths.list_names(self.folder) if n.startswith("e") and n.endswith(".json"))

    def read(self, number: int) -> dict:
        return json.loads(paths.read_text(f"{self.folder}/{entry_name(number)}"))

    def add(self, number: int, entry: dict) -> None:
        paths.write_text(f"{self.folder}/{entry_name(number)}", json.dumps(entry))


def list_after(root: str, last: str, pattern: str = "*") -> list[tuple[str, int, float]]:
    """``(name relative to root, bytes, modified)`` of the files after ``last``, in
    order; only folders that can hold such a name are opened."""
    fs, top = paths._split(root.rstrip("/"))
    out, todo = [], [""]
    while todo:
        folder = todo.pop()
        at = f"{top}/{folder}".rstrip("/")
        for info in fs.get_file_info(pafs.FileSelector(at, recursive=False, allow_not_found=True)):
            name = folder + info.base_name
            if not _visible(info.base_name):
                continue
            if info.type == pafs.FileType.Directory:
                if name + "/" > last or last.startswith(name + "/"):
                    todo.append(name + "/")
            elif name > last and fnmatch.fnmatchcase(info.base_name, pattern):
                out.append((name, int(info.size), info.mtime.timestamp()))
    return sorted(out)


def pending(path: str, log: str, pattern: str = "*") -> bool:
    """Whether there are names after the last entry."""
    entries = Entries(log)
    have = entries.numbers()
    return bool(list_after(path, entries.read(have[-1])["last"] if have else "", pattern))


class _Names(InputPartition):
    def __init__(self, number: int):
        self.number = number


class NamesReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.log = Entries(options["log"])
        self.pattern = options.get("pattern", "*")
        self.max_files = int(options.get("max_files", 1000))
        self.full_every = int(options.get("full_every", 10))
        self.idle = 0

    def initialOffset(self) -> dict:
        return {"entry": -1}

    def latestOffset(self) -> dict:
        """One more entry, if there is any new name."""
        have = self.log.numbers()
        newest = self.log.read(have[-1]) if have else {"last": ""}
        number, last = (have[-1] + 1 if have else 0), newest["last"]
        found = list_after(self.root, last, self.pattern)
        self.idle = 0 if found else self.idle + 1
        if have and (number % self.full_every == 0 or self.idle >= self.full_every):
            self.idle = 0
            seen = {f[0] for n in have for f in self.log.read(n)["files"]}
            found = [f for f in list_after(self.root, "", self.pattern) if f[0] not in seen]
        found = found[:self.max_files]
        if not found:
            return {"entry": number - 1}
        self.log.add(number, {"last": max(last, found[-1][0]), "files": found})
        return {"entry": number}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Names(n) for n in range(start["entry"] + 1, end["entry"] + 1)]

    def read(self, partition: InputPartition):
        files = self.log.read(partition.number)["files"]
        utc = dt.timezone.utc
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{self.root}/{f[0]}" for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64()),
             pa.array([dt.datetime.fromtimestamp(f[2], utc) for f in files], pa.timestamp("us", "UTC"))],
            ["path", "length", "modificationTime"])

    def commit(self, end: dict) -> None:
        pass  # entries stay: a full listing needs them


class LandingNames(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return NamesReader(self.options)


def names_stream(spark, path: str, log: str, pattern: str = "*", max_files: int = 1000, full_every: int = 10):
    """``path, length, modificationTime`` of the files under ``path`` as they come."""
    spark.dataSource.register(LandingNames)
    return (spark.readStream.format(FORMAT).option("log", log).option("pattern", pattern)
            .option("max_files", int(max_files)).option("full_every", int(full_every)).load(path))
