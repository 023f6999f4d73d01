"""Files of arrays in the shared folder, and sets of rows kept as such files.

A file appears whole or not at all, so a task that runs again writes the same one again.
"""

from __future__ import annotations

import io
import mmap
import os
import tempfile
import uuid
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import work_dir

#: Rows of a file whose bits are kept together: 128 KB.
ROW_BITS = 20


def _local(path: str) -> str | None:
    u = urlparse(path)
    return unquote(u.path) if u.scheme in ("", "file") else None


def write_arrays(path: str, groups: list[list[np.ndarray]]) -> None:
    """Arrays in groups, 8-byte aligned, behind a header; the file appears whole or not at all."""
    flat = [np.ascontiguousarray(a) for g in groups for a in g]
    sizes = [-(-a.nbytes // 8) * 8 for a in flat]
    head = np.array([len(groups), *(len(g) for g in groups), *(x for a in flat for x in (np.dtype(a.dtype).num, len(a)))], np.int64)
    out = io.BytesIO()
    out.write(np.array([len(head)], np.int64).tobytes() + head.tobytes())
    for a, n in zip(flat, sizes, strict=True):
        out.write(a.tobytes().ljust(n, b"\0"))
    local = _local(path)
    if local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        own = f"{local}.{uuid.uuid4().hex}"
        with open(own, "wb") as f:
            f.write(out.getbuffer())
        os.replace(own, local)
    else:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path)
        system.create_dir(os.path.dirname(at), recursive=True)
        with system.open_output_stream(at) as f:
            f.write(out.getbuffer())


def map_arrays(path: str) -> list[list[np.ndarray]]:
    local = _local(path)
    if local:
        with open(local, "rb") as f:
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path)
        with tempfile.TemporaryFile() as own, system.open_input_stream(at) as f:
            while piece := f.read(1 << 22):
                own.write(piece)
            own.flush()
            view = mmap.mmap(own.fileno(), 0, access=mmap.ACCESS_READ)
    kinds = {np.dtype(t).num: np.dtype(t) for t in (np.int64, np.uint64, np.uint16, np.uint8)}
    n = int(np.frombuffer(view, np.int64, 1)[0])
    head = np.frombuffer(view, np.int64, n, 8).tolist()
    counts, rest = head[1 : 1 + head[0]], head[1 + head[0] :]
    at, k, groups = 8 + 8 * n, 0, []
    for c in counts:
        group = []
        for _ in range(c):
            kind, size = kinds[rest[2 * k]], rest[2 * k + 1]
            group.append(np.frombuffer(view, kind, size, at) if size else np.zeros(0, kind))
            at += -(-size * kind.itemsize // 8) * 8
            k += 1
        groups.append(group)
    return groups


@lru_cache(maxsize=64)
def _bits(path: str) -> np.ndarray | None:
    try:
        return map_arrays(path)[0][0]
    except FileNotFoundError:
        return None


def row_set(rows: DataFrame, file: str, row: str):
    """A function of two columns, as of shared.numbered, that tells whether a row is one of `rows`.

    The rows are written as bitmaps, one for each ROW_BITS rows of a file, so neither they nor the rows asked about are joined: a task maps
    the bitmaps of the files that it reads. A bitmap that isn't there holds no row.
    """
    path = work_dir(rows.sparkSession, "rows")

    def write(key: tuple, table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << ROW_BITS, bool)
        bits[table["bit"].to_numpy()] = True
        write_arrays(f"{path}/{key[0].as_py()}/{key[1].as_py()}", [[np.packbits(bits)]])
        return pa.table({"n": [table.num_rows]})

    place = rows.select(F.col(file).alias("file"), F.shiftright(row, ROW_BITS).alias("part"), (F.col(row).bitwiseAND((1 << ROW_BITS) - 1)).cast("int").alias("bit"))
    place.groupBy("file", "part").applyInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()

    @F.arrow_udf("boolean")
    def held(files: pa.Array, numbers: pa.Array) -> pa.Array:
        f, n = files.to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False)
        out = np.zeros(len(f), bool)
        places, of = np.unique(np.stack([f, n >> ROW_BITS], 1), axis=0, return_inverse=True)
        for k, (name, part) in enumerate(places.tolist()):
            bits = _bits(f"{path}/{name}/{part}")
            if bits is not None:
                at = np.flatnonzero(of.reshape(-1) == k)
                bit = n[at] & ((1 << ROW_BITS) - 1)
                out[at] = bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1 == 1
        return pa.array(out)

    def test(file_col: Column, row_col: Column) -> Column:
        return held(file_col, row_col)

    return test
