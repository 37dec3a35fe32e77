"""A folder of messages as a queue: a streaming source with offsets of its own and a limit per trigger.

Every file is the body of one message, named so that later messages sort after earlier ones; files
are put in place whole (by a rename) and names that begin with ``_`` or ``.`` are not messages.
The offset is the name of the last message taken. Only names are read to plan a batch; bodies are
read in tasks. The place reached is also kept in a small file beside the checkpoint, because after
a restart the limit has to count from there; a batch that is replayed reads what it read before.
Folders are opened by Arrow, so local paths and the stores it knows will do.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_SCHEMA = "message_id string, body string, correlation_id string"
#: Messages that one task reads.
_PER_TASK = 64


class _Names(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(0)
        self.names = names


class MessageFolderReader(DataSourceStreamReader):
    def __init__(self, path: str, progress: str, limit: int):
        self.path, self.progress, self.limit = path, progress, limit
        self.at = self._reached()

    def _open(self, path: str) -> tuple[arrow_fs.FileSystem, str]:
        return arrow_fs.FileSystem.from_uri(path)

    def _reached(self) -> str | None:
        files, path = self._open(self.progress)
        if files.get_file_info(path).type != arrow_fs.FileType.File:
            # A checkpoint without any offset is a new query's.
            planned = files.get_file_info(arrow_fs.FileSelector(posixpath.join(posixpath.dirname(path), "offsets"), allow_not_found=True))
            return None if any(f.base_name.isdigit() for f in planned) else ""
        with files.open_input_stream(path) as file:
            return json.loads(file.read())["after"]

    def _keep(self, after: str) -> None:
        files, path = self._open(self.progress)
        files.create_dir(posixpath.dirname(path), recursive=True)
        with files.open_output_stream(path + ".new") as file:
            file.write(json.dumps({"after": after}).encode())
        files.move(path + ".new", path)

    def _messages(self, after: str) -> list[str]:
        files, path = self._open(self.path)
        found = files.get_file_info(arrow_fs.FileSelector(path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file and f.base_name[:1] not in "_." and f.base_name > after)

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        # Without a place reached nothing is known of the checkpoint: all there is, which is never less.
        names = self._messages(self.at or "")
        taken = names if self.at is None else names[: self.limit]
        return {"after": taken[-1] if taken else self.at or ""}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = end["after"]
        self._keep(self.at)
        names = [n for n in self._messages(start["after"]) if n <= end["after"]]
        return [_Names(names[i : i + _PER_TASK]) for i in range(0, len(names), _PER_TASK)]

    def read(self, partition: _Names) -> Iterator[pa.RecordBatch]:
        files, path = self._open(self.path)
        for name in partition.names:
            with files.open_input_stream(posixpath.join(path, name)) as file:
                body = file.read().decode("utf-8", "replace")
            columns = [pa.array([name]), pa.array([body]), pa.array([None], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["message_id", "body", "correlation_id"])


class MessageFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_folder"

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema) -> MessageFolderReader:
        return MessageFolderReader(self.options["path"], self.options["progress"], int(self.options.get("messagesPerTrigger", "1000")))


def stream_message_folder(spark: SparkSession, path: str, checkpoint: str, per_trigger: int = 1000) -> DataFrame:
    """Stream of (message_id, body, correlation_id), at most ``per_trigger`` messages a batch.

    ``checkpoint`` is the folder of the query's checkpoint; the place reached is kept in it.
    """
    spark.dataSource.register(MessageFolder)
    options = {"path": path, "progress": f"{checkpoint.rstrip('/')}/message_folder.json", "messagesPerTrigger": str(per_trigger)}
    return spark.readStream.format("message_folder").options(**options).load()
