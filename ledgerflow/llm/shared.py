"""The folder that driver and executors share, and tables and files kept there.

Lineage is cut by writing a Parquet table below `spark.checkpoint.dir`; lost executors then cost
only their running tasks. Nothing is written to a machine's own folder, except a temporary file
without a name (for mapping a file of a remote store), which vanishes with its last user.
"""

from __future__ import annotations

import gc
import mmap
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()
_KEPT: list = []
_STAGE: list[int] = [-1]


def kept(most: int) -> Callable[[Callable], Callable]:
    """`lru_cache` for what a worker keeps from task to task of one stage (see `new_stage`)."""

    def wrap(f: Callable) -> Callable:
        _KEPT.append(lru_cache(maxsize=most)(f))
        return _KEPT[-1]

    return wrap


def new_stage() -> None:
    """Called by a task as it begins: workers outlive stages, so what they kept for another stage
    goes when the first task of a stage comes."""
    task = TaskContext.get()
    if task is not None and task.stageId() != _STAGE[0]:
        _STAGE[0] = task.stageId()
        for cache in _KEPT:
            cache.cache_clear()
        gc.collect()
#: Rows of an Arrow batch, where the session keeps Spark's default of 10,000: whole texts are long.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application, so that tasks can import
    them wherever the driver found them; and take smaller batches of texts to Python."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
    app, root = spark.sparkContext.applicationId, Path(__file__).resolve().parents[1]
    if app in _SHIPPED or not root.is_dir():
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="modules-"), f"{root.name}-modules.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def bucket_count(spark: SparkSession) -> int:
    """Buckets of keys that are dealt out as arrays: the session's shuffle partitions, rounded up to a
    power of two, and at least 128. Results do not depend on it."""
    return max(128, 1 << (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name below `spark.checkpoint.dir`. Where that is unset, local mode (tests)
    chooses a temporary folder; a cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str, by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back. `by`: column of
    sub-folders; `codec`: of the files, where Spark's own would not do."""
    spark = df.sparkSession
    path = shared_folder(spark, what)
    writer = df.write.partitionBy(by) if by else df.write
    writer = writer.option("compression", codec) if codec else writer
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _place(uri: str) -> str | None:
    """The path of a file:// URI or plain path; None for any other store."""
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def put_file(uri: str, *pieces: bytes) -> None:
    """Write a file whole: under a name of its own first, then renamed, so a second attempt of a
    task replaces it by equal bytes and no reader sees half a file."""
    spare = f"{uri}.{uuid.uuid4().hex}"
    if (path := _place(uri)) is not None:
        spare = _place(spare)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(spare, "wb") as f:
            f.writelines(pieces)
        os.replace(spare, path)
        return
    store, path = pafs.FileSystem.from_uri(uri)
    spare = path + spare[len(uri):]
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(spare) as f:
        for piece in pieces:
            f.write(piece)
    if store.get_file_info(path).type != pafs.FileType.NotFound:
        store.delete_file(path)
    store.move(spare, path)


@kept(4096)
def mapped_file(uri: str) -> np.ndarray:
    """The bytes of a shared file, memory-mapped: pages are read when touched, and workers of one
    machine share them."""
    if (path := _place(uri)) is not None:
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    store, path = pafs.FileSystem.from_uri(uri)
    with store.open_input_stream(path) as source, tempfile.TemporaryFile() as f:
        while block := source.read(1 << 22):
            f.write(block)
        f.flush()
        size = f.tell()
        return np.frombuffer(mmap.mmap(f.fileno(), size, prot=mmap.PROT_READ), np.uint8) if size else np.zeros(0, np.uint8)


def read_range(uri: str, start: int, size: int) -> bytes:
    """Bytes [start, start + size) of a shared file, without reading the rest."""
    if (path := _place(uri)) is not None:
        with open(path, "rb") as f:
            f.seek(start)
            return f.read(size)
    store, path = pafs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        return f.read_at(size, start)


def file_size(uri: str) -> int | None:
    """Bytes of a shared file; None if it is not there."""
    if (path := _place(uri)) is not None:
        return os.path.getsize(path) if os.path.exists(path) else None
    store, path = pafs.FileSystem.from_uri(uri)
    return store.get_file_info(path).size


def drop_files(folder: str) -> None:
    """Remove the files in a shared folder; it need not be there."""
    if (path := _place(folder)) is not None:
        for x in Path(path).glob("*") if os.path.isdir(path) else ():
            if x.is_file():
                x.unlink()
        return
    store, path = pafs.FileSystem.from_uri(folder)
    for x in store.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        if x.type == pafs.FileType.File:
            store.delete_file(x.path)
