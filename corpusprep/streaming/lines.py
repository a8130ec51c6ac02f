"""A streaming source of numbered lines: files that arrive, or grow, as rows that carry their place.

An offset says for each file how many of its bytes have been read, so that a batch is a set of byte ranges:
it can be read again after a failure and gives the same rows with the same places. A place is the file and the
byte at which the line starts; sorted by it, lines are in source order, however a batch was cut into ranges
and whichever batch they came in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAME = "numbered_lines"
RANGE_BYTES = 64 << 20
#: Source order of the lines.
PLACE = ("src_file", "src_byte")
SCHEMA = "src_file string, src_byte long, value string"


def _source():
    """The source's class. It is made here so that workers get it by value, and need not have the package."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class Range(InputPartition):
        def __init__(self, file: str, start: int, end: int):
            self.file, self.start, self.end = file, start, end

    def opened(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    class Reader(DataSourceStreamReader):
        def __init__(self, path: str, suffix: str, range_bytes: int):
            self.path, self.suffix, self.range_bytes = path, suffix, range_bytes

        def initialOffset(self) -> dict:
            return {}

        def latestOffset(self) -> dict:
            """Each file with its size. Names that begin with a dot or underscore are files in the making."""
            from pyarrow import fs

            system, root = opened(self.path)
            found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
            files = [f for f in found if f.is_file and f.base_name.endswith(self.suffix) and f.base_name[0] not in "._"]
            return {f.base_name: f.size for f in sorted(files, key=lambda f: f.base_name)}

        def partitions(self, start: dict, end: dict) -> list:
            ranges = []
            for file, size in end.items():
                for at in range(start.get(file, 0), size, self.range_bytes):
                    ranges.append(Range(file, at, min(at + self.range_bytes, size)))
            return ranges

        def read(self, partition):
            """The lines that start in the range; the last of them may end beyond it."""
            import io

            import pyarrow as pa

            names = ["src_file", "src_byte", "value"]

            def batch(rows):
                files = pa.array([partition.file] * len(rows), pa.string())
                texts = [line.decode("utf-8", "replace") for _, line in rows]
                return pa.RecordBatch.from_arrays([files, pa.array([at for at, _ in rows], pa.int64()), pa.array(texts, pa.string())], names=names)

            system, root = opened(self.path)
            with io.BufferedReader(system.open_input_file(f"{root}/{partition.file}"), 1 << 20) as raw:
                at = partition.start
                if at:
                    # A line that begins before the range is that of the range before: go to the next start.
                    raw.seek(at - 1)
                    at += len(raw.readline()) - 1
                rows, size = [], 0
                while at < partition.end:
                    line = raw.readline()
                    if not line:
                        break
                    rows.append((at, line.rstrip(b"\r\n")))
                    at, size = at + len(line), size + len(line)
                    if size >= 1 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

        def commit(self, end: dict) -> None:
            pass

    class NumberedLines(DataSource):
        @classmethod
        def name(cls) -> str:
            return "numbered_lines"

        def schema(self) -> str:
            return "src_file string, src_byte long, value string"

        def streamReader(self, schema):
            options = self.options
            return Reader(options["path"].rstrip("/"), options.get("suffix", ""), int(options.get("rangeBytes", 64 << 20)))

    return NumberedLines


def numbered_lines(spark: SparkSession, path: str, suffix: str = "", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(src_file, src_byte, value): the lines of the files in a folder as they arrive, with their places.

    ``path`` is a local folder or the address of a store that Arrow reads. A file may be added at any time and
    lines may be added to one, if what was there ended with a line feed; a file must not change otherwise. Names
    that begin with a dot or underscore are left out until they are renamed.
    """
    spark.dataSource.register(_source())
    return spark.readStream.format(NAME).option("path", path).option("suffix", suffix).option("rangeBytes", str(range_bytes)).load()
