"""Readers of microscope and HDF5 files, for clusters that have the packages which know these formats.

A file's planes are dealt to the tasks; every task opens the file for itself and reads its
planes only. Without the package a reader says which one is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack
from importlib import import_module

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tessera.sources.blocks import SCHEMA, block_row

#: An opened volume: number of planes, and the plane at an index.
Opened = tuple[int, Callable[[int], np.ndarray]]


def _whole(array: np.ndarray) -> Opened:
    from tessera.sources.discover import coerce_rank

    volume = coerce_rank(np.asarray(array))
    return len(volume), lambda z: volume[z]


def first_dataset(group, kind: type):
    """The first dataset of an HDF5 group, going down before going on; none where there is none."""
    for value in group.values():
        found = value if isinstance(value, kind) else first_dataset(value, kind) if hasattr(value, "values") else None
        if found is not None:
            return found
    return None


def _open_hdf5(package, path: str, stack: ExitStack) -> Opened:
    data = first_dataset(stack.enter_context(package.File(path, "r")), package.Dataset)
    if data is None:
        raise ValueError(f"{path} holds no dataset")
    return (data.shape[0], lambda z: data[z]) if len(data.shape) == 3 and 1 not in data.shape else _whole(data[()])


def _open_nd2(package, path: str, stack: ExitStack) -> Opened:
    return _whole(stack.enter_context(package.ND2File(path)).asarray())


def _open_czi(package, path: str, stack: ExitStack) -> Opened:
    return _whole(package.AICSImage(path).get_image_data("ZYX", T=0, C=0))


def _open_lif(package, path: str, stack: ExitStack) -> Opened:
    image = next(iter(package.LifFile(path).get_iter_image()), None)
    if image is None:
        raise ValueError(f"{path} holds no image")
    return max(1, int(getattr(image.dims, "z", 1) or 1)), lambda z: np.asarray(image.get_frame(z=z, t=0, c=0))


#: By kind: the package's module, and how it opens a file.
OPENERS = {"czi": ("aicsimageio", _open_czi), "nd2": ("nd2", _open_nd2), "lif": ("readlif.reader", _open_lif), "hdf5": ("h5py", _open_hdf5)}


def opened(kind: str, path: str, stack: ExitStack) -> Opened:
    module, opener = OPENERS[kind]
    try:
        package = import_module(module)
    except ImportError as error:
        raise RuntimeError(f"reading {kind} files needs the optional package {module.split('.')[0]!r}") from error
    return opener(package, path, stack)


def planes_of(kind: str, path: str, wanted: list[int]) -> Iterator[dict]:
    with ExitStack() as stack:
        _, plane = opened(kind, path, stack)
        for z in wanted:
            yield block_row(np.asarray(plane(z))[None], (z, 0, 0))


def read(kind: str, spark: SparkSession, path: str) -> DataFrame:
    """Planes in block form; ``path`` is on a folder that driver and executors mount."""
    with ExitStack() as stack:
        count = opened(kind, path, stack)[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in planes_of(kind, path, batch.id.tolist()):
                yield pd.DataFrame([row])

    return spark.range(0, count, 1, max(1, min(count // 16, 1000))).mapInPandas(run, SCHEMA)
