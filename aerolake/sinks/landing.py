"""K1: land response documents, one object each under its landing key, or many as JSON Lines.

Objects are written by a Python data source (Arrow batches, one Python call for each object, as an object-store client
would put it): Spark's own writers name files themselves and end every document with a newline. A task writes an
object under a temporary name and moves it to its key, so a retried task replaces it by the same bytes and no
reader sees half an object. Two documents of one key with different bytes raise instead of one of them being lost.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from aerolake.functions.timefmt import landing_key, landing_partitions

SINK = "landed_documents"
#: Objects on their way; "_": Spark's scans do not see the folder.
DRAFTS = "_landing_"
CODE_KEY_CLASH = "LANDING_KEY_CLASH"


@dataclass
class Landed(WriterCommitMessage):
    objects: int


def filesystem(path: str):
    """The pyarrow file system of a path or URI, and the path in it."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local.rstrip("/")
    system, inside = fs.FileSystem.from_uri(path)
    return system, inside.rstrip("/")


class LandingWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.drafts = path, DRAFTS + uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Landed:
        system, root = filesystem(self.path)
        made, n = set(), 0
        for batch in iterator:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                draft, target = f"{root}/{self.drafts}/{uuid.uuid4().hex}", f"{root}/{key}"
                for folder in (draft.rsplit("/", 1)[0], target.rsplit("/", 1)[0]):
                    if folder not in made:
                        system.create_dir(folder, recursive=True)
                        made.add(folder)
                if system.get_file_info(target).is_file:
                    with system.open_input_stream(target) as there:
                        if there.read() != (body or b""):
                            raise ValueError(f"{CODE_KEY_CLASH}: {key}")
                    n += 1
                    continue
                with system.open_output_stream(draft) as out:
                    out.write(body or b"")
                system.move(draft, target)
                n += 1
        return Landed(n)

    def _clear(self) -> None:
        from pyarrow import fs

        system, root = filesystem(self.path)
        if system.get_file_info(f"{root}/{self.drafts}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.drafts}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()


class LandingSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return SINK

    def schema(self) -> str:
        return "landing_key string, body binary"

    def writer(self, schema, overwrite: bool) -> LandingWriter:
        return LandingWriter(self.options["path"])


def land_documents(docs: DataFrame, base_path: str, ingestion_ts: Column, body: Column) -> None:
    """Write each document's bytes unchanged to ``base_path/<landing key of its ingestion time>``."""
    spark = docs.sparkSession
    spark.dataSource.register(LandingSink)
    out = docs.select(landing_key(ingestion_ts).alias("landing_key"), body.cast("binary").alias("body"))
    out.write.format(SINK).mode("append").save(base_path)


def land_json_lines(docs: DataFrame, base_path: str, ingestion_ts: Column, body: Column) -> None:
    """Many documents a file, one a line, under the same hour folders (read with ``multiline=False``)."""
    parts = landing_partitions(ingestion_ts)
    out = docs.select(body.cast("string").alias("value"), *[c.alias(n) for n, c in parts.items()])
    out.write.mode("append").partitionBy(*parts).text(base_path)
