"""A message topic for tests: a folder of files, read and written with the topic options.

It lets the real topic code run where the connector is missing: another format name, the
same options, same binary `value` column.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import (
    DataSource,
    DataSourceWriter,
    SimpleDataSourceStreamReader,
    WriterCommitMessage,
)


def topic_folder(options, key):
    return os.path.join(options["kafka.bootstrap.servers"], options[key])


def messages_in(folder):
    found = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), "rb") as file:
            found.extend(file.read().split(b"\x00")[:-1])
    return found


class TopicReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.folder = topic_folder(options, "subscribe")
        self.per_trigger = int(options["maxOffsetsPerTrigger"])
        assert options["startingOffsets"] == "earliest"
        assert options["failOnDataLoss"] == "false"

    def initialOffset(self):
        return {"next": 0}

    def read(self, start):
        first = start["next"]
        batch = messages_in(self.folder)[first : first + self.per_trigger]
        rows = [(b"key", message, "topic", 0) for message in batch]
        return iter(rows), {"next": first + len(rows)}

    def readBetweenOffsets(self, start, end):
        batch = messages_in(self.folder)[start["next"] : end["next"]]
        return iter([(b"key", message, "topic", 0) for message in batch])

    def commit(self, end):
        pass


@dataclass
class Written(WriterCommitMessage):
    count: int


class TopicWriter(DataSourceWriter):
    def __init__(self, options):
        self.folder = topic_folder(options, "topic")
        assert options["kafka.compression.type"] == "gzip"

    def write(self, rows):
        count = 0
        with open(os.path.join(self.folder, uuid.uuid4().hex), "wb") as file:
            for row in rows:
                file.write(bytes(row.value) + b"\x00")
                count += 1
        return Written(count)

    def commit(self, messages):
        pass

    def abort(self, messages):
        pass


class FolderTopic(DataSource):
    @classmethod
    def name(cls):
        return "folder_topic"

    def schema(self):
        return "key binary, value binary, topic string, partition int"

    def simpleStreamReader(self, schema):
        return TopicReader(self.options)

    def writer(self, schema, overwrite):
        return TopicWriter(self.options)
