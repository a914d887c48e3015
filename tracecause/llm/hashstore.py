"""Sorted hash arrays in the shared folder: written by Spark tasks, memory-mapped by workers.

A store is cut into shards by the top bits of its 64-bit keys. Shards on a mounted file system are memory-mapped; on
another one they are read whole through Arrow's file systems and only the last few are held.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyarrow import fs

HELD = 4


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as byte planes of their differences, which compress in a shuffle."""
    gaps = np.diff(keys.astype(np.uint64), prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def folded(keys: np.ndarray, *values: np.ndarray):
    """Distinct keys in order, and the sums of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], *(np.add.reduceat(v[order], starts) if len(keys) else v[:0] for v in values)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of equal width over all 64-bit keys."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Write under a temporary name, then move: a repeated task replaces the file by an equal one."""
    store, root = fs.FileSystem.from_uri(folder)
    temporary = f"{root}/_temporary-{uuid.uuid4().hex}"
    with store.open_output_stream(temporary, compression=None) as out:
        out.write(np.ascontiguousarray(values).tobytes())
    store.move(temporary, f"{root}/{name}")


class Arrays:
    """Named arrays of a folder, opened when asked for."""

    def __init__(self, folder: str):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.local = isinstance(self.store, fs.LocalFileSystem)
        self.open: OrderedDict[str, np.ndarray] = OrderedDict()

    def get(self, name: str, dtype, size: int) -> np.ndarray:
        if not size:
            return np.zeros(0, dtype)
        if name in self.open:
            self.open.move_to_end(name)
        elif self.local:
            self.open[name] = np.memmap(f"{self.root}/{name}", dtype=dtype, mode="r", shape=(size,))
        else:
            with self.store.open_input_file(f"{self.root}/{name}") as f:
                self.open[name] = np.frombuffer(pa.py_buffer(f.read()), dtype=dtype)
        while len(self.open) > (4096 if self.local else HELD):
            self.open.popitem(last=False)
        return self.open[name]
