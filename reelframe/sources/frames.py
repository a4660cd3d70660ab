"""Frames of videos as a Spark data source that decodes the ranges that are asked for only.

The decoder is an adapter; the one here reads recorded features: a file of little-endian doubles, frames a second first, then brightness, share of bright pixels and
share of edges of each frame.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, fps double, total long, frame_idx long, brightness double, bright_ratio double, edge_ratio double"


class FrameDecoder(Protocol):
    """What decodes a video: opened by its address, it knows its rate and length, and gives the features of a range of frames."""

    fps: float
    total: int

    def frames(self, lo: int, hi: int) -> np.ndarray: ...


class RecordedFrames:
    """Recorded features in place of a video; a range is read by its place in the file, nothing before it."""

    def __init__(self, uri: str) -> None:
        self._fs, self._path = pafs.FileSystem.from_uri(uri)
        size = self._fs.get_file_info(self._path).size
        self.total = max(0, (size - 8) // 24)
        self.fps = float(np.frombuffer(self._read(0, 8), "<f8")[0]) if size >= 8 else 0.0

    def _read(self, at: int, n: int) -> bytes:
        with self._fs.open_input_file(self._path) as f:
            f.seek(at)
            return f.read(n)

    def frames(self, lo: int, hi: int) -> np.ndarray:
        return np.frombuffer(self._read(8 + 24 * lo, 24 * max(0, hi - lo)), "<f8").reshape(-1, 3)


def encoded(fps: float, rows: np.ndarray) -> bytes:
    """The file that RecordedFrames reads."""
    return np.concatenate(([fps], np.asarray(rows, "<f8").ravel())).astype("<f8").tobytes()


#: Partitions that videos are dealt over at least, and videos and bytes to be read that one partition holds, about.
LEAST_PARTITIONS, VIDEOS, BYTES = 32, 256, 64 << 20


@dataclass
class _Videos(InputPartition):
    uris: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self._path, self._suffix = options["path"], options.get("suffix", "")
        self._seconds = float(options["seconds"]) if "seconds" in options else None
        self._decoder: type = RecordedFrames
        self._frames = options.get("frames", "true").lower() == "true"

    def partitions(self) -> list[_Videos]:
        fs, base = pafs.FileSystem.from_uri(self._path)
        head = self._path[: len(self._path) - len(base)] if self._path.endswith(base) else ""
        files = fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        files = sorted((f for f in files if f.is_file and f.path.endswith(self._suffix) and not f.base_name.startswith((".", "_"))), key=lambda f: f.path)
        whole = sum(f.size or 0 for f in files) if self._frames and self._seconds is None else 0
        n = min(len(files), max(LEAST_PARTITIONS, -(-len(files) // VIDEOS), -(-whole // BYTES)))
        return [_Videos([head + f.path for f in files[i::n]]) for i in range(n)]

    def read(self, videos: _Videos) -> Iterator[tuple]:
        for uri in videos.uris:
            yield from self._video(uri)

    def _video(self, uri: str) -> Iterator[tuple]:
        try:
            v = self._decoder(uri)
        except (OSError, ValueError):  # S7: a video that cannot be probed has no length
            v = None
        if v is None or not v.total or v.fps <= 0 or not self._frames:
            yield (uri, v.fps if v else 0.0, v.total if v else 0, None, None, None, None)
            return
        n = v.total if self._seconds is None else min(v.total, int(v.fps * self._seconds))
        for lo, hi in [(0, n), (max(n, v.total - n), v.total)]:
            for i, (a, b, c) in enumerate(v.frames(lo, hi).tolist(), lo):
                yield (uri, v.fps, v.total, i, a, b, c)


class FrameSource(DataSource):
    """Format ``frames``. Options: path (a folder), suffix, seconds (the first and the last so many only; all where it is not given), frames (false: a row a video with its rate and length, no frame is read).

    Videos are dealt over partitions, so that many short ones are not a task each. A file without frames, or one that cannot be read, gives one row of null frame_idx.
    """

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))


def read_frames(spark: SparkSession, path: str, **options: str):  # noqa: ANN201
    """The frames below a folder; see FrameSource."""
    spark.dataSource.register(FrameSource)
    return spark.read.format("frames").options(path=path, **options).load()
