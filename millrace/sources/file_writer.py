"""Base of the Python data sources that write files."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage


def file_system(path: str):
    """pyarrow's file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def local_file():
    """A file without a name on a disk that Spark gives this task for its temporary data."""
    folders = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")
    return tempfile.TemporaryFile(dir=next(filter(os.path.isdir, folders), None))


def slices(batch: pa.RecordBatch, most_bytes: int, most_rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded size; one without rows has none."""
    step = max(1, most_bytes * batch.num_rows // max(1, batch.nbytes))
    step = min(step, most_rows or step)
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


class _Files(WriterCommitMessage):
    def __init__(self, names):
        self.names = names


class FileWriter(DataSourceArrowWriter):
    """Writes each partition as files below ``path``; subclasses turn batches into file contents.

    A file's content comes in chunks that are written one by one, so no task holds a whole file.

    Tasks write under names of their own attempt into a folder beside the target. An overwriting
    commit clears that folder of other attempts' files and switches the two folders by renaming, so
    the old files are there until the new ones are complete; an appending one moves its files over.
    """

    suffix = ""

    def __init__(self, options, schema, overwrite=False):
        self.path = options["path"].rstrip("/")
        self.schema = schema
        self.overwrite = overwrite
        self._id = uuid.uuid4().hex

    def contents(self, batches) -> Iterator[Iterable[bytes]]:
        """The chunks of each file; they are taken before the next file is asked for."""
        raise NotImplementedError

    def _folders(self):
        system, root = file_system(self.path)
        return system, root, f"{root}.staging-{self._id}"

    def write(self, iterator):
        system, _, staging = self._folders()
        system.create_dir(staging, recursive=True)
        names = []
        for chunks in self.contents(iterator):
            name = f"part-{uuid.uuid4().hex}{self.suffix}"
            with system.open_output_stream(f"{staging}/{name}") as out:
                for chunk in chunks:
                    out.write(chunk)
            names.append(name)
        return _Files(names)

    def commit(self, messages):
        from pyarrow import fs

        system, root, staging = self._folders()
        system.create_dir(staging, recursive=True)
        done = {name for message in messages if message for name in message.names}
        for found in system.get_file_info(fs.FileSelector(staging)):
            if found.base_name not in done:  # of an attempt that failed or ran twice
                system.delete_file(found.path)
        present = system.get_file_info(root).type != fs.FileType.NotFound
        if self.overwrite or not present:
            with system.open_output_stream(f"{staging}/_SUCCESS"):
                pass
            self._switch(system, root, staging, present)
            return
        for name in done:
            system.move(f"{staging}/{name}", f"{root}/{name}")
        system.delete_dir(staging)
        with system.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def _switch(self, system, root, staging, present):
        old = f"{root}.old-{self._id}"
        if present:
            system.move(root, old)
        try:
            system.move(staging, root)
        except Exception:
            if present:
                system.move(old, root)
            raise
        if present:
            from pyarrow import fs

            if system.get_file_info(old).type == fs.FileType.Directory:
                system.delete_dir(old)
            else:
                system.delete_file(old)

    def abort(self, messages):
        from pyarrow import fs

        system, _, staging = self._folders()
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)
