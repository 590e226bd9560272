"""A sink with a file for each record: rows (name, content) become <folder>/<name>.

Every task writes a record under a name of its own attempt and then moves it to its place, so a reader never meets half a
file, and a task that runs again leaves the same one file a record. The driver commits a mark with the number of
records, never the files themselves; an aborted job takes away what its attempts left under way.

For exports that other programs read by file; tables belong into Parquet. Names must differ (operators.transcripts.unique_names)
and hold no separator. `pretty` content is JSON, written with indents and plain letters.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "voxloom_records"
# under way; readers of Spark skip names that begin with a dot
UNDER_WAY = ".attempt-"


def _place(path: str) -> tuple[arrow_fs.FileSystem, str]:
    uri = path.replace("s3a://", "s3://", 1)
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(uri)


@dataclass
class Written(WriterCommitMessage):
    records: int
    attempt: str


class RecordWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.pretty = options.get("pretty", "false").lower() == "true"
        self.overwrite = overwrite

    def write(self, rows: Iterator[Row]) -> Written:
        store, root = _place(self.path)
        attempt = f"{root}/{UNDER_WAY}{uuid.uuid4().hex}"
        store.create_dir(attempt, recursive=True)
        count = 0
        try:
            for name, content in rows:
                if not name or "/" in name or name.startswith((".", "_")):
                    raise ValueError(f"no name for a file: {name!r}")
                text = content or ""
                if self.pretty:
                    text = json.dumps(json.loads(text), indent=2, ensure_ascii=False)
                with store.open_output_stream(f"{attempt}/{name}") as out:
                    out.write(text.encode())
                store.move(f"{attempt}/{name}", f"{root}/{name}")
                count += 1
        finally:
            store.delete_dir(attempt)
        return Written(count, attempt)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _place(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(str(sum(m.records for m in messages if m)).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Records in their places stay, without the mark; what attempts left under way goes."""
        store, root = _place(self.path)
        for info in store.get_file_info(arrow_fs.FileSelector(root, allow_not_found=True)):
            if info.base_name.startswith(UNDER_WAY):
                store.delete_dir(info.path)


class RecordFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        if [f.name for f in schema.fields] != ["name", "content"]:
            raise ValueError("rows must be (name, content)")
        return RecordWriter(dict(self.options), overwrite)


def write_records(rows: DataFrame, path: str, pretty: bool = False) -> None:
    """Write rows (name, content) as files below path; files of other names stay."""
    rows.sparkSession.dataSource.register(RecordFiles)
    rows.select("name", "content").write.format(FORMAT).option("pretty", str(pretty).lower()).mode("append").save(path)
