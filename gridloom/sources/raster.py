"""Rasters that executors can read by window. Codecs plug in by ``read``; .npy and binary PPM need none."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import numpy as np

from ..operators.imaging import read_window


@dataclass(frozen=True)
class NpyRaster:
    """A (height, width, 3) uint8 array in a .npy file that all executors can open, read through a memory map."""

    path: str
    transform: tuple[float, float, float, float, float, float] = (1, 0, 0, 0, 1, 0)
    crs: str | None = None

    def _data(self) -> np.ndarray:
        return np.load(self.path, mmap_mode="r")

    @property
    def size(self) -> tuple[int, int]:
        height, width = self._data().shape[:2]
        return width, height

    def read(self, row_off: int, col_off: int, width: int, height: int, most: int | None = None) -> np.ndarray:
        return np.ascontiguousarray(read_window(self._data(), row_off, col_off, width, height, most))


def write_ppm(path: str | Path, image: np.ndarray) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    h, w = image.shape[:2]
    Path(path).write_bytes(b"P6 %d %d 255\n" % (w, h) + np.ascontiguousarray(image, np.uint8).tobytes())


def ppm_bytes(image: np.ndarray) -> bytes:
    h, w = image.shape[:2]
    return b"P6 %d %d 255\n" % (w, h) + np.ascontiguousarray(image, np.uint8).tobytes()


def read_ppm(path: str | Path) -> np.ndarray:
    data = Path(path).read_bytes()
    head, body = data.split(b"\n", 1)
    w, h = map(int, head.split()[1:3])
    return np.frombuffer(body, np.uint8).reshape(h, w, 3)
