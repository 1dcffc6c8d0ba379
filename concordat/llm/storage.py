"""Files in the shared folder, from inside tasks: written under a temporary name, then renamed."""

from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from concordat.session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh place under the folder that the cluster names for checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def writing(uri: str, attempt: str):
    """A stream whose bytes appear under the uri only once all are written; a later attempt replaces an earlier one."""
    place, path = _open(uri)
    folder, _, name = path.rpartition("/")
    place.create_dir(folder, recursive=True)
    temporary = f"{folder}/_temporary-{name}-{attempt}"
    stream = place.open_output_stream(temporary)
    try:
        yield stream
    except BaseException:
        stream.close()
        place.delete_file(temporary)
        raise
    stream.close()
    place.move(temporary, path)


def reading(uri: str):
    place, path = _open(uri)
    return place.open_input_file(path)
