"""Batch pipeline over image volumes: stage, resample, export, compare; and its command line."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry, names
from tessera.functions.params import EXPORT_FORMATS, RunParams, index_triple
from tessera.operators import block_resample, compare
from tessera.session import ship
from tessera.sinks import archive, publish, tiff
from tessera.sinks import zarr as zarr_sink
from tessera.sources import blocks, discover
from tessera.sources import zarr as zarr_source


def stage(spark: SparkSession, source: str, folder: str, overwrite: bool = False) -> str:
    """Normalise one input of any kind to a Zarr group in ``folder``; returns its path.

    A Zarr input is copied file by file, its levels and chunks as they are; an archive keeps
    its inner name. A name that is already there is an error unless ``overwrite``.
    """
    ship(spark)
    Path(folder).mkdir(parents=True, exist_ok=True)
    if discover.kind_of(source) == "archive":
        return discover.unpack_archive(source, folder)
    name = Path(source).name
    stem = name[:-9] if name.lower().endswith(".ome.zarr") else Path(name).stem
    target = Path(folder) / f"{stem}.ome.zarr"
    if target.exists() and not overwrite:
        raise FileExistsError(f"{target} exists; two inputs share the stem {stem!r}, or overwrite it")
    if discover.kind_of(source) == "zarr":
        return discover.copy_group(spark, source, str(target))
    volume = discover.read(spark, source)
    dtype = volume.select("dtype").first()[0]
    zarr_sink.write_zarr(volume, str(target), discover.shape(spark, source), dtype, stem)
    return str(target)


def resample(spark: SparkSession, source: str, folder: str, params: RunParams) -> str:
    """Resample one volume with the geometry of ``params``; returns the output path.

    The output is Zarr for a Zarr input or the affine geometry, else TIFF. Chunks of nothing but zeros, the
    fill value, aren't stored: most of a deep volume's frame is empty.
    """
    ship(spark)
    volume = discover.read(spark, source)
    shape = discover.shape(spark, source)
    name = Path(source).name
    is_zarr = name.lower().endswith(".ome.zarr")
    stem = name[:-9] if is_zarr else Path(name).stem
    record, dtype = None, "<u2"
    if params.geometry == "affine":
        record = geometry.affine(shape, params.dx, params.dz, params.angle, params.flip, params.affine_rotate)
        slabs = block_resample.affine_blocks(volume, record, params.output_type)
        out, size = slabs, record.shape
        dtype = "<f4" if params.output_type == "float32" else "<u2"
    else:
        planes = blocks.planes(volume, shape)
        view = geometry.top_view(shape, params.dx, params.dz, params.angle, params.flip)
        out, size = block_resample.top_view_planes(planes, view, params.rounding, params.arithmetic).drop("k"), view.shape
    Path(folder).mkdir(parents=True, exist_ok=True)
    if is_zarr or record is not None:
        target = str(Path(folder) / f"{stem}.ome.zarr")
        zarr_sink.write_zarr(out, target, size, dtype, stem, params.pyramid_max, geometry=record, empty="skip")
    else:
        target = str(Path(folder) / f"{stem}.tif")
        tiff.write_tiff(out, target)
    (Path(folder) / "note.txt").write_text(f"{name}: {shape} to {size} (z, y, x)\n" + json.dumps(asdict(params)) + "\n")
    return target


def merge(spark: SparkSession, sources: list[str], target: str) -> int:
    """Volumes stacked along z in name order as one BigTIFF; (y, x) must agree."""
    ship(spark)
    stacked, first, plane = None, 0, None
    for source in sorted(sources, key=lambda s: Path(s).name):
        volume = discover.read(spark, source)
        shape = discover.shape(spark, source)
        if plane not in (None, shape[1:]):
            raise ValueError(f"volumes with planes {plane} and {shape[1:]} can't be stacked")
        plane = shape[1:]
        part = blocks.planes(volume, shape).withColumn("z0", F.col("z0") + first)
        stacked = part if stacked is None else stacked.unionByName(part)
        first += shape[0]
    if stacked is None:
        raise FileNotFoundError("there are no volumes to merge")
    return tiff.write_tiff(stacked, target)


def export(spark: SparkSession, folder: str, target: str, formats: tuple[str, ...]) -> list[str]:
    """Archives of the folder's Zarr groups, whatever the formats; with ``tiff`` also one merged TIFF.

    Formats may be in upper case; an unknown one, or none, is an error and nothing is written.
    """
    asked = {f.lower() for f in formats}
    if not asked or asked - set(EXPORT_FORMATS):
        raise ValueError(f"formats are {', '.join(EXPORT_FORMATS)}, not {', '.join(sorted(asked)) or 'none'}")
    volumes = discover.volumes_in(spark, folder)
    out = archive.export_archives(volumes, target)
    if "tiff" in asked:
        merged = str(Path(target) / names.MERGED_NAME)
        merge(spark, volumes, merged)
        out.append(merged)
    return out


def run_folder(spark: SparkSession, image_path: str, folder: str, params: RunParams, cell_name: str | None = None, keep_staged: bool = True) -> list[str]:
    """``run`` over the volumes of a folder, or of its sub-folder ``cell_name``, in name order."""
    return run(spark, discover.volumes_in(spark, str(Path(image_path, cell_name or ""))), folder, params, keep_staged)


def run(spark: SparkSession, sources: list[str], folder: str, params: RunParams, keep_staged: bool = True) -> list[str]:
    """Stage, resample and export inputs; the staged name map is kept as a table.

    All is made in a draft and published at the end with a manifest, so a run that breaks off leaves
    the folder as it was. Returns the exported files; without ``keep_staged`` the staged groups go.
    """
    if not sources:
        raise FileNotFoundError("there is no input")
    with publish.draft_of(folder) as draft:
        staged = [stage(spark, s, f"{draft}/staged") for s in sources]
        lines = ["staged_name\toriginal_name", *[f"{Path(t).name}\t{Path(s).name}" for s, t in zip(sources, staged, strict=True)]]
        (draft / "name_map.tsv").write_text("\n".join(lines) + "\n")
        for path in staged:
            resample(spark, path, f"{draft}/resampled", params)
        exported = export(spark, f"{draft}/resampled", f"{draft}/exported", params.export_formats)
        about = {"inputs": [Path(s).name for s in sources], "params": asdict(params)}
        publish.publish(draft, folder, (*(["staged"] if keep_staged else []), "resampled", "exported", "name_map.tsv"), about)
    return [str(Path(folder, "exported", Path(p).name)) for p in exported]


def compare_files(spark: SparkSession, reference: str, candidate: str, level: str = "0", component: str | None = None, tpc: tuple[int, int, int] = (0, 0, 0), report: str | None = None, **options) -> dict:
    """Comparison report of two volumes; written as JSON where ``report`` names a file."""
    ship(spark)

    def volume(path: str) -> DataFrame:
        if discover.kind_of(path) == "zarr":
            return zarr_source.read_zarr(spark, path, component or level, tpc if component else None)
        return discover.read(spark, path)

    def shape(path: str) -> tuple[int, int, int]:
        if discover.kind_of(path) == "zarr":
            return zarr_source.volume_shape(spark, path, component or level, tpc if component else None)
        return discover.shape(spark, path)

    both = [volume(p) for p in (reference, candidate)]
    shapes = [shape(p) for p in (reference, candidate)]
    if shapes[0] != shapes[1]:
        raise ValueError(f"the volumes' shapes differ: {shapes[0]} and {shapes[1]}")
    found = compare.compare(*[blocks.to_voxels(v) for v in both], shapes[0], **options)
    summary = found.summary.first().asDict(recursive=True)
    out = {
        "shape": list(shapes[0]), "summary": summary,
        "metadata": {n: {"path": p, **(zarr_source.reported(zarr_source.attributes(spark, f"{p}/{component}" if component else p)) if discover.kind_of(p) == "zarr" else {})} for n, p in (("reference", reference), ("candidate", candidate))},
        "pages": [r.asDict() for r in found.pages.orderBy("z").collect()], "line_profiles": [r.asDict() for r in found.lines.orderBy("z", "axis").collect()],
    }
    if report:
        archive.write_report(out, report)
    return compare.json_safe(out)


def load_params(path: str) -> dict:
    import yaml

    found = yaml.safe_load(Path(path).read_text()) or {}
    if not isinstance(found, dict):
        raise ValueError(f"{path} must hold a mapping")
    return found


def output_of(params: dict) -> str:
    """Where a run with these parameters puts its resampled volume."""
    given = params.get("input", params.get("image_path"))
    first = (given[0] if given else None) if isinstance(given, list) else given
    if not first or not str(first).strip() or not params.get("output_dir"):
        raise ValueError("parameters need input or image_path, and output_dir")
    name = Path(str(first)).name
    is_zarr = name.lower().endswith(".ome.zarr")
    suffix = ".ome.zarr" if "input" in params or is_zarr else Path(name).suffix or ".ome.zarr"
    return str(Path(str(params["output_dir"])) / names.OUTPUT_FOLDER / ((name[:-9] if is_zarr else Path(name).stem) + suffix))


def comparison_of(first: str, second: str) -> dict:
    """Paths and pixel size of a comparison from two parameter files."""
    a, b = load_params(first), load_params(second)
    return {"reference": output_of(a), "candidate": output_of(b), "pixel": float(a.get("dx", b.get("dx", 1.0)))}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parts = parser.add_subparsers(dest="command", required=True)
    runs = parts.add_parser("run", help="stage, resample and export")
    runs.add_argument("inputs", nargs="+")
    runs.add_argument("--output", required=True)
    for name, kind in (("dx", float), ("dz", float), ("angle", float), ("flip", int)):
        runs.add_argument(f"--{name}", type=kind, required=True)
    runs.add_argument("--geometry", default="top_view")
    runs.add_argument("--backend", default="cpu_blocked")
    runs.add_argument("--output-type", default="uint16")
    runs.add_argument("--affine-rotate", default="true")
    runs.add_argument("--pyramid-max", type=int, default=16)
    runs.add_argument("--formats", default="ozx")
    runs.add_argument("--arithmetic", default="float64")
    runs.add_argument("--drop-staged", action="store_true", help="delete the staged groups once the results are published")
    runs.add_argument("--cell-name", help="sub-folder of the one input, a folder")
    normal = parts.add_parser("normalise", help="bring everything a reader takes in a folder to Zarr groups")
    merged = parts.add_parser("export", help="archives and a merged TIFF of a folder's volumes")
    merged.add_argument("--formats", default="ozx")
    for part in (normal, merged):
        part.add_argument("folder")
        part.add_argument("--output", required=True)
    both = parts.add_parser("compare", help="compare two volumes")
    for name in ("reference", "candidate", "params-a", "params-b", "component", "report"):
        both.add_argument(f"--{name}")
    both.add_argument("--tpc", default="0,0,0")
    both.add_argument("--trim", default="0,0,0")
    both.add_argument("--level", default="0")
    both.add_argument("--axis", default="z", choices=("z", "y", "x"))
    both.add_argument("--samples", type=int, default=32)
    both.add_argument("--pixel", type=float)
    both.add_argument("--ignore-zero", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    try:
        if args.command == "run":
            params = RunParams(args.dx, args.dz, args.angle, args.flip, args.geometry, args.backend, args.output_type, args.affine_rotate, args.pyramid_max, tuple(args.formats.split(",")), args.arithmetic)
            if args.cell_name or len(args.inputs) == 1 and names.is_plain_folder(args.inputs[0]):
                found = run_folder(spark, args.inputs[0], args.output, params, args.cell_name, not args.drop_staged)
            else:
                found = run(spark, [names.resolved(p) for p in names.given_patterns(args.inputs)], args.output, params, not args.drop_staged)
            print("\n".join(found))
        elif args.command == "normalise":
            print("\n".join(stage(spark, p, args.output) for p in discover.supported_inputs(spark, args.folder)))
        elif args.command == "export":
            print("\n".join(export(spark, args.folder, args.output, tuple(args.formats.split(",")))))
        else:
            direct, files = (args.reference, args.candidate), (args.params_a, args.params_b)
            if bool(all(direct)) == bool(all(files)) or any(direct) and any(files):
                raise ValueError("give either two volumes or two parameter files")
            chosen = comparison_of(*files) if all(files) else {"reference": direct[0], "candidate": direct[1], "pixel": 1.0}
            report = compare_files(
                spark, chosen["reference"], chosen["candidate"], args.level, args.component, index_triple(args.tpc), args.report, axis=args.axis, samples=args.samples,
                trim=index_triple(args.trim, non_negative=True), ignore_zero=args.ignore_zero, pixel=args.pixel or chosen["pixel"],
            )
            print(json.dumps(report, separators=(",", ":")))
    except (ValueError, OSError, RuntimeError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
