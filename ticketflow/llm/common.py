"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text handled by one round of array operations inside a task.
CHUNK_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder under the session's shared checkpoint folder.

    Only a local session without ``spark.checkpoint.dir`` gets one of its own;
    a cluster must name the shared folder.
    """
    sc = spark.sparkContext
    if not (sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)) \
            and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files: cuts
    the lineage, and a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = shared_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str, mod: int, remainder: int = 2) -> F.Column:
    """crc32(doc_id as text) mod ``mod`` is ``remainder``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % F.lit(mod)) == F.lit(remainder)


def strings(col) -> pa.Array:
    """A string column with nulls as empty texts, as one plain array."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    return pc.fill_null(col, "")


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after the other, offsets of n + 1) without copying the texts."""
    arr = strings(col)
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    offsets = np.frombuffer(offs, np.int64, n + 1, arr.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return raw[lo:hi], offsets - lo


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges (a, b) of rows with about ``limit`` bytes each; a longer text is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def partition_path(folder: str) -> str:
    """The folder as a path this machine can open, for folders on a shared mount."""
    return folder[len("file://"):] if folder.startswith("file://") else (
        folder[len("file:"):] if folder.startswith("file:") else folder)


def _filesystem(folder: str):
    from pyarrow import fs

    if folder.startswith("/") or folder.startswith("file:"):
        return fs.LocalFileSystem(), partition_path(folder)
    return fs.FileSystem.from_uri(folder)


def put_file(folder: str, name: str, parts: list) -> None:
    """Write a file of the shared folder whole or not at all: attempts of the same
    task write under names of their own and the rename decides."""
    filesystem, root = _filesystem(folder)
    filesystem.create_dir(root, recursive=True)
    tmp = f"{root}/.{name}-{uuid.uuid4().hex}"
    with filesystem.open_output_stream(tmp) as out:
        for p in parts:
            out.write(memoryview(np.ascontiguousarray(p)).cast("B") if isinstance(p, np.ndarray) and p.size
                      else (b"" if isinstance(p, np.ndarray) else p))
    filesystem.move(tmp, f"{root}/{name}")


def map_file(folder: str, name: str) -> np.ndarray:
    """A file of the shared folder as memory-mapped bytes (empty if there is none).

    A shared mount is mapped where it lies; from another store the file is
    copied to the task's own temp folder, mapped, and unlinked at once, so
    nothing stays behind.
    """
    from pyarrow import fs

    filesystem, root = _filesystem(folder)
    info = filesystem.get_file_info(f"{root}/{name}")
    if info.type == fs.FileType.NotFound or info.size == 0:
        return np.zeros(0, np.uint8)
    if isinstance(filesystem, fs.LocalFileSystem):
        return np.memmap(f"{root}/{name}", np.uint8, "r")
    import shutil
    import tempfile

    with tempfile.NamedTemporaryFile(delete=False) as own, filesystem.open_input_stream(f"{root}/{name}") as src:
        shutil.copyfileobj(src, own)
    out = np.memmap(own.name, np.uint8, "r")
    os.unlink(own.name)
    return out
