"""Short lists of numbers packed into bytes, for rows that travel between tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length with numbers below 2**32; the bytes of equal rank lie together, so that small numbers vanish."""
    values = np.stack(columns).astype("<u4")
    planes = np.ascontiguousarray(values.reshape(-1).view(np.uint8).reshape(-1, 4).T)
    return len(columns[0]).to_bytes(4, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, columns: int) -> np.ndarray:
    """One row per column."""
    length = int.from_bytes(data[:4], "little")
    size = 4 * length * columns
    planes = np.frombuffer(pa.decompress(data[4:], size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64).reshape(columns, length)


def gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=0)
