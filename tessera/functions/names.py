"""Names of inputs and outputs as column expressions: kinds, stems, patterns, output paths."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of readable files.
TIFF_SUFFIXES = ("tif", "tiff")
READERS = {"tif": "tiff", "tiff": "tiff", "czi": "czi", "nd2": "nd2", "lif": "lif", "h5": "hdf5", "hdf5": "hdf5"}
ZARR_SUFFIX = ".ome.zarr"
ARCHIVE_SUFFIX = "ozx"
#: Folder of resampled volumes, and the merged export's name.
OUTPUT_FOLDER = "Top_shear"
MERGED_NAME = "deskewed_merged.tif"
#: Contract of the batch workflow for input names.
INPUT_PATTERN = r"(?i)\.(tif|tiff|czi|nd2|lif|h5|hdf5|ozx|ome\.zarr)$"
CHANNEL_PATTERN = r"^CH(\d+)_(\d+)(?:_registered_consistent)?\.tiff?$"


def is_zarr(name: Column) -> Column:
    return F.lower(name).endswith(ZARR_SUFFIX)


def suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))


def stem(name: Column) -> Column:
    """Without ``.ome.zarr`` or else the last suffix."""
    return F.when(is_zarr(name), F.regexp_replace(name, r"(?i)\.ome\.zarr$", "")).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


def kind(name: Column, is_dir: Column) -> Column:
    """Reader of an input by its suffix; null where none reads it."""
    found = F.when(is_zarr(name) & is_dir, F.lit("zarr")).when(is_dir, F.lit(None))
    found = found.when(suffix(name) == ARCHIVE_SUFFIX, F.lit("archive"))
    for s, reader in READERS.items():
        found = found.when(suffix(name) == s, F.lit(reader))
    return found


def output_name(name: Column, geometry: Column) -> Column:
    """``.ome.zarr`` for a Zarr input or the affine geometry, else ``.tif``."""
    return F.concat(stem(name), F.when(is_zarr(name) | (geometry == "affine"), F.lit(ZARR_SUFFIX)).otherwise(F.lit(".tif")))


def input_patterns(text: Column) -> Column:
    """List of patterns from list text: outer brackets go, commas split, brackets and quotes around a part go, blanks drop."""
    bare = F.regexp_replace(F.trim(text), r"^\[(.*)\]$", "$1")
    parts = F.transform(F.split(bare, r"\s*,\s*"), lambda p: F.regexp_replace(F.regexp_replace(F.trim(p), "^[\\['\"\\s]+", ""), "[\\]'\"\\s]+$", ""))
    return F.filter(parts, lambda p: p != "")


def channel(name: Column) -> Column:
    return F.regexp_extract(name, CHANNEL_PATTERN, 1)


def derived_output(inputs: Column, image_path: Column, output_dir: Column) -> Column:
    """``<output_dir>/<folder>/<stem><suffix>`` of the first input, else of the image path.

    Given inputs make Zarr; an image path keeps its own suffix, and without one makes Zarr, too.
    """
    first = F.coalesce(F.get(inputs, F.lit(0)), image_path)
    base = F.regexp_extract(first, r"([^/]*)/*$", 1)
    own = F.regexp_extract(base, r".(\.[^.]*)$", 1)
    end = F.when(inputs.isNotNull() | (own == ""), F.lit(ZARR_SUFFIX)).otherwise(own)
    return F.concat(output_dir, F.lit(f"/{OUTPUT_FOLDER}/"), stem(base), end)


def split_patterns(text: str) -> list[str]:
    """Patterns in one argument: brackets and quotes go, commas separate, blanks are dropped."""
    return [p for p in (part.strip("[]'\" \t") for part in text.split(",")) if p]


def recovered_text(text: str, command_line: str) -> str:
    """A bracketed list that a shell has cut short, whole again from the command line that holds it."""
    if text.count("[") == text.count("]"):
        return text
    start = command_line.find(text)
    end = command_line.find("]", start)
    return command_line[start : end + 1] if start >= 0 and end >= 0 else text


def given_patterns(inputs: list[str]) -> list[str]:
    """Patterns of a command's arguments; a bracketed list that the shell cut at its blanks is put together first."""
    out: list[str] = []
    while inputs:
        text = recovered_text(inputs[0], " ".join(inputs))
        used = next((n for n in range(1, len(inputs) + 1) if len(" ".join(inputs[:n])) >= len(text)), len(inputs))
        out += split_patterns(text)
        inputs = inputs[used:]
    return out


def resolved(pattern: str, package: str = ".") -> str:
    """The pattern itself where it is absolute or exists, else below the package's folder where that exists."""
    inside = Path(package, pattern)
    return pattern if Path(pattern).is_absolute() or Path(pattern).exists() or not inside.exists() else str(inside)


def is_plain_folder(path: str) -> bool:
    return Path(path).is_dir() and not path.lower().endswith(ZARR_SUFFIX)
