"""A folder of landed text files as a stream with a bound on the records of a batch.

Spark's own file streams admit whole files; this one admits lines, so that "128 records or 1.5
seconds" holds for files as it does for a broker.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes looked at in one go for the ends of lines.
CHUNK = 1 << 16


class Lines(InputPartition):
    """The lines of ``name`` that begin in ``[first, last)``; ``number`` counts the lines before ``first``,
    ``batch`` the batches before the trigger and ``place`` the trigger's records before ``first``."""

    def __init__(self, name: str, first: int, last: int, number: int, batch: int, place: int):
        self.name, self.first, self.last, self.number = name, first, last, number
        self.batch, self.place = batch, place


class LandedReader(DataSourceStreamReader):
    """Offsets are ``{"name", "at", "line", "batch"}``: the file being read, a byte at which a line begins,
    the lines of this file before it, and the batches before it. Files are taken by name; a file may not
    change once landed, and new ones must sort after those that were read.

    A batch has ``max_records`` records, or what is left. A trigger takes one, or up to ``batchesPerTrigger``
    of them when more has landed; each line carries the number of its batch. The end of a trigger is found
    by looking at line ends only, no more than the trigger's records. Executors read the lines. A restart tells the reader where the last batch ended by an empty
    range, which is how it knows where to go on.
    """

    def __init__(self, options: dict):
        import pyarrow.fs as fs

        self.limit = int(options.get("maxrecordspertrigger", options.get("maxRecordsPerTrigger", "128")))
        self.batches = int(options.get("batchespertrigger", options.get("batchesPerTrigger", "1")))
        self.parts = int(options.get("partitions", "4"))
        self.path = options["path"]
        self.fs, self.root = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        self.at = self.initialOffset()

    def initialOffset(self) -> dict:
        return {"name": "", "at": 0, "line": 0, "batch": 0}

    def _files(self, since: str) -> list[tuple[str, int]]:
        """Names and sizes of the landed files from ``since`` on, in order."""
        import pyarrow.fs as fs

        found = self.fs.get_file_info(fs.FileSelector(self.root, recursive=True))
        size = {f.path[len(self.root) :].lstrip("/"): f.size for f in found if f.is_file}
        visible = (n for n in size if not any(p[:1] in ("_", ".") and "=" not in p for p in n.split("/")))
        return sorted((n, size[n]) for n in visible if n >= since)

    def _line_ends(self, name: str, at: int, limit: int) -> tuple[int, int]:
        """The byte after the ``limit``-th line from ``at`` on (or after the last), and how many lines that is."""
        seen, end = 0, at
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            size = f.size()
            while end < size and seen < limit:
                block = f.read_at(min(CHUNK, size - end), end)
                found, step = block.count(b"\n"), len(block)
                if seen + found > limit:
                    step = 0
                    for _ in range(limit - seen):
                        step = block.index(b"\n", step) + 1
                    found = limit - seen
                elif seen + found == limit:
                    step = block.rindex(b"\n") + 1 if found else step
                seen, end = seen + found, end + step
            if seen < limit and end == size and size > at and self._last_byte(f, size) != b"\n":
                seen += 1  # a last line without an end
        return end, seen

    @staticmethod
    def _last_byte(f, size: int) -> bytes:
        return f.read_at(1, size - 1)

    def latestOffset(self) -> dict:
        most = left = self.limit * self.batches
        at = dict(self.at)
        for name, size in self._files(at["name"]):
            if name != at["name"]:
                at = {"name": name, "at": 0, "line": 0}
            if at["at"] < size and left:
                end, seen = self._line_ends(name, at["at"], left)
                at = {"name": name, "at": end, "line": at["line"] + seen}
                left -= seen
            if not left:
                break
        self.at = {**at, "batch": self.at.get("batch", 0) - (left - most) // self.limit}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = end  # also on a restart, by an empty range
        found: list[InputPartition] = []
        batch, place = start.get("batch", 0), 0
        for name, size in self._files(start["name"]):
            if name > end["name"]:
                break
            first, line = (start["at"], start["line"]) if name == start["name"] else (0, 0)
            last = end["at"] if name == end["name"] else size
            if first < last:
                parts = self._split(name, first, last, line, batch, place)
                found += parts
                place = parts[-1].place + self._line_ends(name, parts[-1].first, self._step())[1]
        return found

    def _step(self) -> int:
        """Records of a partition: part of a batch, or whole batches if a trigger takes several."""
        if self.batches > 1:
            return self.limit * -(-self.batches // self.parts)
        return max(1, -(-self.limit // self.parts))

    def _split(self, name: str, first: int, last: int, line: int, batch: int, place: int) -> list[Lines]:
        """A range as a few partitions that begin with a line."""
        parts = []
        while first < last:
            end, seen = self._line_ends(name, first, self._step())
            parts.append(Lines(name, first, min(end, last), line, batch, place))
            first, line, place = end, line + seen, place + seen
        return parts

    def read(self, partition: Lines) -> Iterator[tuple]:
        with self.fs.open_input_file(f"{self.root}/{partition.name}") as f:
            data = f.read_at(partition.last - partition.first, partition.first)
        lines = data.decode("utf-8", "replace").split("\n")
        if lines and lines[-1] == "":
            lines.pop()
        for i, value in enumerate(lines):
            batch = partition.batch + (partition.place + i) // self.limit
            yield value, partition.name, partition.number + i, batch

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "fs"}

    def __setstate__(self, state):
        import pyarrow.fs as fs

        self.__dict__.update(state)
        self.fs, _ = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")


class Landed(DataSource):
    """Format ``landed``: columns ``value``, ``file``, ``line`` and ``batch``; options ``path``,
    ``maxRecordsPerTrigger`` (128), which is the records of a batch, ``batchesPerTrigger`` (1) and
    ``partitions`` per trigger (4). The folder may be local, or in a store that Arrow's file systems reach."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return "value string, file string, line bigint, batch bigint"

    def streamReader(self, schema) -> LandedReader:
        return LandedReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Landed)
