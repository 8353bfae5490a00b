"""Writing and reading files of the shared folder from tasks."""
import uuid

from pyspark import TaskContext


def open_folder(uri):
    """(file system, path) of a folder on any store that Arrow reaches."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def new_file(prefix, suffix):
    """A name that no other task, nor another attempt at this one, uses."""
    return f"{prefix}-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"
