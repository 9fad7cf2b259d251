import contextlib
import json
import math
import os
import struct
import sys
import types
import zipfile
import zlib
from pathlib import Path

import numpy as np
import pytest
import yaml
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions import names
from tessera.functions.params import RunParams
from tessera.operators import block_resample
from tessera.plans import pipeline
from tessera.sinks import archive, tiff
from tessera.sinks import zarr as zarr_sink
from tessera.sources import blocks, codec, datasource, discover, optional, store, zarr
from tessera.sources import tiff as tiff_source
from tessera.streaming import landing


def cube(df, shape):
    out = np.full(shape, np.nan)
    for r in blocks.to_voxels(df).collect():
        out[r["z"], r["y"], r["x"]] = r["v"]
    return out


def classic_tiff(arrays, order="<", description=b""):
    """A small classic TIFF; with a description one directory holds the whole stack."""
    out = bytearray({"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, 0))
    link, stack = 4, bool(description)
    for a in [np.concatenate([x[None] for x in arrays])] if stack else arrays:
        a = a.astype(a.dtype.newbyteorder(order))
        at = len(out)
        out += a.tobytes()
        text = len(out)
        out += description + b"\0"
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        height, width = a.shape[-2:]
        tags = [(256, 4, 1, width), (257, 4, 1, height), (258, 4, 1, 8 * a.itemsize), (259, 4, 1, 1), (270, 2, len(description) + 1, text), (273, 4, 1, at), (277, 4, 1, 1), (279, 4, 1, height * width * a.itemsize), (339, 4, 1, {"u": 1, "i": 2, "f": 3}[a.dtype.kind])]
        tags = [t for t in tags if t[0] != 270 or description]
        out += struct.pack(order + "H", len(tags)) + b"".join(struct.pack(order + "HHII", *t) for t in tags)
        link = len(out)
        out += struct.pack(order + "I", 0)
    return bytes(out)


@pytest.mark.parametrize("dtype", ["u1", "u2", "i2", "u4", "f4", "f8"])
@pytest.mark.parametrize("order", ["<", ">"])
def test_tiff_pages_of_either_order(dtype, order):
    arrays = [np.arange(12, dtype=dtype).reshape(3, 4) + k for k in range(2)]
    data = classic_tiff(arrays, order)
    assert all((tiff_source.page_array(data, p) == a).all() for p, a in zip(tiff_source.pages(data), arrays, strict=True))
    stack = classic_tiff(arrays, order, b"ImageJ=1.0\nimages=2\nslices=2")
    assert [tiff_source.page_array(stack, p).tolist() for p in tiff_source.pages(stack)] == [a.tolist() for a in arrays]


def packed_tiff(array, compression, predictor=1, rows=None, tile=None):
    """One classic page of compressed strips or tiles."""
    height, width, samples = array.shape if array.ndim == 3 else (*array.shape, 1)
    whole = array.reshape(height, width, samples)
    rows = rows or height
    parts = [(whole[y : y + rows], None) for y in range(0, height, rows)]
    if tile:
        padded = np.zeros((-(-height // tile[0]) * tile[0], -(-width // tile[1]) * tile[1], samples), array.dtype)
        padded[:height, :width] = whole
        parts = [(padded[y : y + tile[0], x : x + tile[1]], None) for y in range(0, height, tile[0]) for x in range(0, width, tile[1])]
    pack = {1: bytes, 5: pack_lzw, 8: zlib.compress, 32773: lambda b: b"".join(bytes((len(b[i : i + 128]) - 1,)) + b[i : i + 128] for i in range(0, len(b), 128)), 50000: zstandard.ZstdCompressor().compress}[compression]
    body = [pack((np.diff(p, axis=1, prepend=p[:, :1] * 0) if predictor == 2 else p).astype(array.dtype).tobytes()) for p, _ in parts]
    at = 8 + np.cumsum([0, *map(len, body)])
    end = int(at[-1])
    lists = struct.pack(f"<{2 * len(body)}I", *at[:-1].tolist(), *map(len, body))
    several = len(body) > 1
    spot = lambda k: end + 4 * len(body) * k if several else [int(at[0]), len(body[0])][k]
    first, second = (324, 325) if tile else (273, 279)
    tags = [(256, width), (257, height), (258, 8 * array.itemsize), (259, compression), (277, samples), (278, rows), (317, predictor), (339, {"u": 1, "i": 2, "f": 3}[array.dtype.kind])]
    tags += [(322, tile[1]), (323, tile[0])] if tile else []
    rows_of = [struct.pack("<HHII", t, 4, 1, v) for t, v in tags] + [struct.pack("<HHII", t, 4, len(body), spot(k)) for k, t in enumerate((first, second))]
    return b"II" + struct.pack("<HI", 42, end + len(lists)) + b"".join(body) + lists + struct.pack("<H", len(rows_of)) + b"".join(sorted(rows_of)) + struct.pack("<I", 0)


def pack_lzw(data):
    bits, table, word, width = "", {bytes((i,)): i for i in range(256)}, b"", 9
    bits += format(256, "09b")
    count = 258
    for byte in data:
        longer = word + bytes((byte,))
        if longer in table:
            word = longer
            continue
        bits += format(table[word], f"0{width}b")
        table[longer] = count
        count, word = count + 1, bytes((byte,))
        width = max(9, count.bit_length())
        if count >= 4094:
            bits += format(256, f"0{width}b")
            table, count, width = {bytes((i,)): i for i in range(256)}, 258, 9
    if word:
        bits += format(table[word], f"0{width}b")
        width = max(9, (count + 1).bit_length())
    bits += format(257, f"0{width}b")
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


@pytest.mark.parametrize("compression", [1, 5, 8, 32773, 50000])
@pytest.mark.parametrize(("predictor", "rows", "tile"), [(1, None, None), (2, 5, None), (2, None, (16, 16)), (1, 7, None)])
def test_compressed_tiff_pages(compression, predictor, rows, tile):
    draw = np.random.default_rng(compression)
    for array in (draw.integers(0, 40, (23, 37)).astype("<u2"), draw.integers(0, 9, (40, 61)).astype("u1"), draw.integers(0, 255, (9, 11, 3)).astype("u1"), draw.integers(0, 60000, (70, 90)).astype("<u2")):
        data = packed_tiff(array, compression, predictor, rows, tile)
        assert (tiff_source.page_array(data, tiff_source.pages(data)[0]) == array).all()


def test_distributed_tiff_round_trip(spark, tmp_path):
    """Planes written and read by the tasks; a page with samples is a volume, a stack of such pages is not."""
    shape, path = (37, 5, 7), str(tmp_path / "v.tif")
    planes = blocks.synthetic_planes(spark, shape, 4)
    assert tiff.write_tiff(planes, path) == 37
    assert (cube(tiff_source.read_tiff(spark, path).drop("path"), shape) == cube(planes, shape)).all()
    with pytest.raises(ValueError, match="gaps"):
        tiff.write_tiff(planes.where("z0 != 3"), path)
    (tmp_path / "rgb.tif").write_bytes(packed_tiff(np.arange(60, dtype="u1").reshape(4, 5, 3), 8))
    assert (cube(discover.read(spark, str(tmp_path / "rgb.tif")), (4, 5, 3)) == np.arange(60).reshape(4, 5, 3)).all()
    assert tiff.write_tiff(planes.where("z0 < 0"), path) == 0 and tiff_source.pages((tmp_path / "v.tif").read_bytes()) == []


def test_tiff_refuses_what_it_cannot_read():
    for bad in (b"xx", b"II" + struct.pack("<HI", 41, 8)):
        with pytest.raises(ValueError, match="TIFF"):
            tiff_source.pages(bad)


def test_codecs_round_trip():
    draw = np.random.default_rng(0)
    for size, raw in ((2, draw.integers(0, 300, 999, dtype="u2").tobytes()), (4, np.linspace(-1.5, 2.5, 40, dtype="f4").tobytes()), (2, draw.bytes(64)), (2, b"ab")):
        for c in (None, {"id": "zlib"}, {"id": "zstd"}, {"id": "blosc"}):
            assert codec.decode(codec.encode(raw, c, size), c, len(raw)) == raw
        assert codec.unshuffle_bits(codec.shuffle_bits(raw, size), size) == raw
    big = np.array([[1, 256], [512, 1024]], ">u2")
    assert codec.native(big).dtype == np.dtype("u2") and (codec.native(big) == big).all()


@pytest.mark.parametrize("compressor", [None, zarr_sink.COMPRESSOR, {"id": "zstd", "level": 3}])
def test_zarr_pyramid_round_trip(spark, tmp_path, compressor):
    shape, path = (18, 20, 30), str(tmp_path / "v.ome.zarr")
    planes = blocks.synthetic_planes(spark, shape, 3)
    zarr_sink.write_zarr(planes, path, shape, "<u2", "v", 4, compressor)
    base = cube(planes, shape)
    for level, f in enumerate((1, 2, 4)):
        want = base[:, ::f, ::f]
        assert (cube(zarr.read_zarr(spark, path, str(level)), want.shape) == want).all()
    attrs = zarr.attributes(spark, path)
    assert [d["coordinateTransformations"][0]["scale"] for d in attrs["multiscales"][0]["datasets"]] == [[1, 1, 1], [1, 2, 2], [1, 4, 4]]
    assert zarr.axis_names(attrs) == ["z", "y", "x"] and zarr.axis_names({}) == ["z", "y", "x"]
    with pytest.raises(FileNotFoundError):
        zarr.read_zarr(spark, str(tmp_path / "none.ome.zarr"))


def test_six_axis_component(spark, tmp_path):
    root = tmp_path / "c.ome.zarr" / "data"
    root.mkdir(parents=True)
    info = {"zarr_format": 2, "shape": [1, 2, 1, 2, 3, 3], "chunks": [1, 1, 1, 2, 3, 3], "dtype": "<f4", "compressor": None, "fill_value": 0, "order": "C", "filters": None}
    (root / ".zarray").write_text(json.dumps(info))
    values = np.arange(36, dtype="<f4").reshape(info["shape"])
    for p in range(2):
        (root / f"0.{p}.0.0.0.0").write_bytes(values[:, p : p + 1].tobytes())
    assert (cube(zarr.read_zarr(spark, str(root.parent), "data", (0, 1, 0)), (2, 3, 3)) == values[0, 1, 0]).all()
    for bad in ((0, 2, 0), (0, 0, 1)):
        with pytest.raises(ValueError, match="outside"):
            zarr.read_zarr(spark, str(root.parent), "data", bad)


def test_archives(spark, tmp_path):
    group = tmp_path / "a.ome.zarr"
    zarr_sink.write_zarr(blocks.synthetic_planes(spark, (2, 4, 4), 1), str(group), (2, 4, 4), "<u2", "a", 1)
    (target,) = archive.export_archives([str(group)], str(tmp_path / "out"))
    with zipfile.ZipFile(target) as z:
        assert z.namelist() == sorted(z.namelist()) and all(n.startswith("a.ome.zarr/") for n in z.namelist()) and {i.compress_type for i in z.infolist()} == {0}
    assert discover.unpack_archive(target, str(tmp_path / "in")).endswith("/in/a.ome.zarr")
    with pytest.raises(ValueError, match="only Zarr"):
        archive.export_archives(["x.tif"], str(tmp_path))
    for name, members in (("evil.ozx", ["../x", "a.ome.zarr/0"]), ("two.ozx", ["a.ome.zarr/0", "b.ome.zarr/0"])):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for m in members:
                z.writestr(m, "x")
        with pytest.raises(ValueError):
            discover.unpack_archive(str(tmp_path / name), str(tmp_path / "bad"))
    assert not (tmp_path / "x").exists()


def test_discovery_and_registry(spark, tmp_path):
    for name in ("b.tif", "a.TIFF", "n.txt", "c.czi"):
        (tmp_path / name).write_bytes(b"")
    (tmp_path / "z.ome.zarr").mkdir()
    assert [p.rsplit("/", 1)[1] for p in discover.volumes_in(spark, str(tmp_path))] == ["a.TIFF", "b.tif", "z.ome.zarr"]
    assert discover.volumes_in(spark, str(tmp_path / "z.ome.zarr")) == [str(tmp_path / "z.ome.zarr")]
    assert [p.rsplit("/", 1)[1] for p in discover.supported_inputs(spark, str(tmp_path))] == ["a.TIFF", "b.tif", "c.czi", "z.ome.zarr"]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "e").mkdir()
        discover.volumes_in(spark, str(tmp_path / "e"))
    with pytest.raises(RuntimeError, match="aicsimageio"):
        discover.read(spark, str(tmp_path / "c.czi"))
    with pytest.raises(ValueError, match="reader"):
        discover.read(spark, "x.txt")
    assert discover.coerce_rank(np.zeros((1, 3, 1, 4))).shape == (1, 3, 4) and discover.coerce_rank(np.zeros((3, 1, 4)), strict=True).shape == (3, 1, 4)
    with pytest.raises(ValueError, match="axes"):
        discover.coerce_rank(np.zeros((2, 3, 4, 5)))


def test_optional_readers(spark, tmp_path, monkeypatch):
    """With stand-ins for the packages: which data they are asked for and what shape comes out."""

    class Dataset:
        def __init__(self, array):
            self.array, self.shape = array, array.shape

        def __getitem__(self, at):
            return self.array[at]

    volume = np.arange(24).reshape(2, 3, 4)
    tree = {"meta": {}, "a": {"b": Dataset(volume)}, "c": Dataset(volume + 1)}

    class File(dict):
        def __init__(self, path, mode):
            super().__init__(tree)

        __enter__, __exit__ = (lambda self: self), (lambda self, *a: None)

    image = types.SimpleNamespace(dims=types.SimpleNamespace(z=2), get_frame=lambda z, t, c: volume[z])
    stand_ins = {
        "h5py": types.SimpleNamespace(File=File, Dataset=Dataset),
        "nd2": types.SimpleNamespace(ND2File=lambda path: contextlib.nullcontext(types.SimpleNamespace(asarray=lambda: volume[None]))),
        "aicsimageio": types.SimpleNamespace(AICSImage=lambda path: types.SimpleNamespace(get_image_data=lambda order, T, C: volume)),
        "readlif.reader": types.SimpleNamespace(LifFile=lambda path: types.SimpleNamespace(get_iter_image=lambda: [image])),
    }
    for name, module in stand_ins.items():
        monkeypatch.setitem(sys.modules, name, module)
    for kind in optional.OPENERS:
        rows = list(optional.planes_of(kind, "x", [0, 1]))
        assert [np.frombuffer(r["data"], r["dtype"]).tolist() for r in rows] == volume.reshape(2, -1).tolist()
        assert [(r["z0"], r["nz"], r["ny"], r["nx"]) for r in rows] == [(0, 1, 3, 4), (1, 1, 3, 4)]
    tree.clear()
    with pytest.raises(ValueError, match="no dataset"):
        list(optional.planes_of("hdf5", "x", [0]))


def test_patterns_from_the_command_line(tmp_path):
    assert names.split_patterns("[a.tif, 'b c.tif', ]") == ["a.tif", "b c.tif"]
    assert names.recovered_text("[a.tif,", "run --input [a.tif, b.tif] --x 1") == "[a.tif, b.tif]"
    assert names.recovered_text("[a]", "none") == "[a]" and names.recovered_text("[a", "none") == "[a"
    assert names.given_patterns(["[a.tif,", "b c.tif,", "d.tif]", "e.tif", "f.tif,g.tif"]) == ["a.tif", "b c.tif", "d.tif", "e.tif", "f.tif", "g.tif"]
    assert names.given_patterns([]) == [] and names.given_patterns(["[a", "b"]) == ["a", "b"]
    (tmp_path / "in.tif").write_bytes(b"")
    assert names.resolved("in.tif", str(tmp_path)) == str(tmp_path / "in.tif")
    assert names.resolved("/abs/x.tif", str(tmp_path)) == "/abs/x.tif" and names.resolved("no.tif", str(tmp_path)) == "no.tif"


def test_folder_mode_and_verbatim_staging(spark, tmp_path):
    cell = tmp_path / "images" / "cell1"
    cell.mkdir(parents=True)
    tiff.write_pages(str(cell / "scan.tif"), [(np.arange(20, dtype="u2") + 20 * k).reshape(5, 4) for k in range(3)])
    out = pipeline.run_folder(spark, str(tmp_path / "images"), str(tmp_path / "run"), RunParams(1, 1, 30), "cell1")
    assert [p.rsplit("/", 1)[1] for p in out] == ["scan.ozx"]
    with pytest.raises(FileNotFoundError):
        pipeline.run_folder(spark, str(tmp_path / "images"), str(tmp_path / "run2"), RunParams(1, 1, 30))
    group = tmp_path / "run" / "staged" / "scan.ome.zarr"
    (group / "extra.txt").write_text("kept")
    again = pipeline.stage(spark, str(group), str(tmp_path / "again"))
    files = lambda root: sorted((str(p.relative_to(root)), p.read_bytes()) for p in Path(root).rglob("*") if p.is_file())
    assert files(again) == files(group)


def test_merge_in_name_order(spark, tmp_path):
    for name, n, v in (("b", 1, 2), ("a", 2, 1)):
        tiff.write_pages(str(tmp_path / f"{name}.tif"), [np.full((3, 4), v, "u2")] * n)
    assert pipeline.merge(spark, [str(tmp_path / "b.tif"), str(tmp_path / "a.tif")], str(tmp_path / "m.tif")) == 3
    data = (tmp_path / "m.tif").read_bytes()
    assert [int(tiff_source.page_array(data, p)[0, 0]) for p in tiff_source.pages(data)] == [1, 1, 2]
    tiff.write_pages(str(tmp_path / "c.tif"), [np.zeros((2, 2), "u2")])
    with pytest.raises(ValueError, match="stacked"):
        pipeline.merge(spark, [str(tmp_path / f"{n}.tif") for n in "ac"], str(tmp_path / "m.tif"))


def test_pipeline_from_tiff_to_archive_and_report(spark, tmp_path):
    source = str(tmp_path / "scan.tif")
    tiff.write_pages(source, [(np.arange(20, dtype="u2") + 20 * k).reshape(5, 4) for k in range(3)])
    out = pipeline.run(spark, [source], str(tmp_path / "run"), RunParams(1, 1, 30, export_formats=("ozx", "tiff")))
    assert [p.rsplit("/", 1)[1] for p in out] == ["scan.ozx", names.MERGED_NAME]
    assert "scan.ome.zarr\tscan.tif" in (tmp_path / "run/name_map.tsv").read_text()
    resampled = str(tmp_path / "run/resampled/scan.ome.zarr")
    golden = [[0, 0, 12, 0], [10, 11, 35, 0], [10, 34, 34, 39], [32, 37, 38, 43], [36, 41, 41, 46], [0, 40, 45, 46], [0, 44, 28, 28]]
    assert cube(discover.read(spark, resampled), (1, 7, 4))[0].tolist() == golden
    affine = pipeline.resample(spark, source, str(tmp_path / "affine"), RunParams(1, 1, 30, geometry="affine", output_type="float32"))
    assert zarr.array_info(spark, affine)["dtype"] == "<f4" and {"voxel_size_um_zyx", "affine_matrix_xyz", "multiscales"} <= set(zarr.reported(zarr.attributes(spark, affine)))
    report = pipeline.compare_files(spark, resampled, resampled, report=str(tmp_path / "r.json"), samples=2)
    assert report["summary"]["ncc"]["mean"] == pytest.approx(1) and json.loads((tmp_path / "r.json").read_text())["shape"] == [1, 7, 4]
    with pytest.raises(ValueError, match="differ"):
        pipeline.compare_files(spark, resampled, affine)
    with pytest.raises(FileExistsError):
        pipeline.stage(spark, source, str(tmp_path / "run/staged"))


def test_parameter_files(tmp_path):
    a, b = tmp_path / "a.yml", tmp_path / "b.yml"
    a.write_text(yaml.safe_dump({"input": ["/d/s.tif"], "output_dir": "/o", "dx": 0.5}))
    b.write_text(yaml.safe_dump({"image_path": "/d/t.tif", "output_dir": "/p"}))
    assert pipeline.comparison_of(str(a), str(b)) == {"reference": "/o/Top_shear/s.ome.zarr", "candidate": "/p/Top_shear/t.tif", "pixel": 0.5}
    b.write_text("[1]")
    with pytest.raises(ValueError, match="mapping"):
        pipeline.load_params(str(b))
    with pytest.raises(ValueError, match="output_dir"):
        pipeline.output_of({"input": []})
    assert pipeline.main(["compare", "--reference", "x"]) == 1


def test_landing_files_are_handled_once(spark, tmp_path):
    seen: list[str] = []
    (tmp_path / "in").mkdir()
    for n in range(2):
        (tmp_path / "in" / f"f{n}.tif").write_bytes(b"x")
        landing.on_landing(spark, str(tmp_path / "in"), str(tmp_path / "state"), lambda p: seen.append(p.rsplit("/", 1)[1])).awaitTermination()
    assert seen == ["f0.tif", "f1.tif"]


def floats(shape, dtype="<f4"):
    return np.random.default_rng(1).standard_normal(shape).astype(dtype)


def planes_of(spark, array):
    return spark.createDataFrame([blocks.block_row(p[None], (z, 0, 0)) for z, p in enumerate(array)], blocks.SCHEMA).repartition(3)


@pytest.mark.parametrize("compression", ["none", "deflate", "zstd"])
@pytest.mark.parametrize(("dtype", "predictor", "bits"), [("<u2", 1, 0), ("<u2", 2, 0), ("<i4", 2, 0), ("<f4", 1, 0), ("<f4", 3, 0), ("<f8", 3, 0), ("<f2", 3, 0), ("<u1", 1, 1), ("<u1", 1, 4), ("<u2", 1, 12), ("<u2", 1, 9)])
def test_every_encoding_round_trips(tmp_path, dtype, compression, predictor, bits):
    kind = np.dtype(dtype)
    array = floats((5, 7), dtype) if kind.kind == "f" else np.random.default_rng(2).integers(0, 1 << (bits or 15), (5, 7)).astype(dtype)
    data = tiff.packed_plane(array, compression, predictor, bits)
    page = tiff_source.Page(5, 7, dtype, ((0, len(data)),), "", 1, tiff.COMPRESSIONS[compression], predictor, (5, 7), bits)
    assert (tiff_source.page_array(data, page) == array).all()


@pytest.mark.parametrize(("compression", "dtype", "predictor", "bits"), [("deflate", "<u2", 2, 0), ("zstd", "<f4", 3, 0), ("none", "<u2", 1, 12), ("zstd", "<u2", 1, 0)])
def test_compressed_bigtiff(spark, tmp_path, compression, dtype, predictor, bits):
    array = floats((23, 6, 9), dtype) if dtype == "<f4" else (np.arange(23 * 54).reshape(23, 6, 9) % 4000).astype(dtype)
    path = str(tmp_path / "v.tif")
    assert tiff.write_tiff(planes_of(spark, array), path, compression, predictor, bits) == 23
    assert (cube(tiff_source.read_tiff(spark, path).drop("path"), array.shape) == array).all()
    first = (tmp_path / "v.tif").read_bytes()
    tiff.write_tiff(planes_of(spark, array).repartition(5), path, compression, predictor, bits)  # other tasks, the same file
    assert (tmp_path / "v.tif").read_bytes() == first and [p.name for p in tmp_path.iterdir()] == ["v.tif"]
    assert tiff.write_tiff(planes_of(spark, array).where("z0 < 0"), path, compression) == 0
    with pytest.raises(ValueError):
        tiff.write_tiff(planes_of(spark, array), path, "jpeg")
    with pytest.raises(ValueError):
        tiff.write_tiff(planes_of(spark, array), path, "zstd", 5 - predictor if predictor > 1 else 3 if dtype != "<f4" else 2)


@pytest.mark.parametrize("shape", [(4, 5, 3), (4, 5, 1)])
def test_samples_in_separate_planes(spark, tmp_path, shape):
    array = np.arange(np.prod(shape), dtype="<u2").reshape(shape)
    assert tiff.write_sample_planes(planes_of(spark, array), str(tmp_path / "p.tif"), shape) == shape[2]
    (page,) = tiff_source.pages((tmp_path / "p.tif").read_bytes())
    assert page.planar == (shape[2] > 1)
    if shape[2] > 1:
        assert (cube(tiff_source.read_tiff(spark, str(tmp_path / "p.tif")).drop("path"), shape) == array).all()
        assert tiff_source.volume_shape(str(tmp_path / "p.tif")) == shape


def test_a_replaced_tiff_is_read_anew(spark, tmp_path):
    path = str(tmp_path / "v.tif")
    tiff.write_pages(path, [np.full((8, 8), k, "u2") for k in range(6)])
    assert tiff_source.read_tiff(spark, path).count() == 6
    tiff.write_pages(path, [np.full((16, 16), k + 9, "u2") for k in range(3)])
    assert (cube(tiff_source.read_tiff(spark, path).drop("path"), (3, 16, 16)) == np.arange(9, 12)[:, None, None]).all()
    assert tiff_source.volume_shape(path) == (3, 16, 16)


def test_reads_are_planned_by_bytes(tmp_path):
    tiff.write_pages(str(tmp_path / "v.tif"), [np.full((40, 40), k, "u2") for k in range(500)])
    reader = datasource.TiffReader(str(tmp_path / "v.tif"), 320_000)
    runs = reader.partitions()
    assert len(runs) == 5 and all(len(r.pages) == 100 for r in runs)
    got = [b for r in runs for b in reader.read(r)]
    assert len(got) == 500 and got[321].to_pylist()[0]["z0"] == 321
    wide = datasource.TiffReader(str(tmp_path / "v.tif"), 1)
    wide.pushFilters = None
    wide.tests = [(0, datasource.GreaterThanOrEqual, 490)]
    assert len(wide.partitions()) == 10 and all(len(r.pages) == 1 for r in wide.partitions())
    tiff.write_pages(str(tmp_path / "w.tif"), [np.arange(1100 * 600, dtype="u4").reshape(1100, 600)])
    big = datasource.TiffReader(str(tmp_path / "w.tif"), 1 << 20)
    parts = [b.to_pylist()[0] for r in big.partitions() for b in big.read(r)]
    assert [(p["y0"], p["x0"], p["ny"], p["nx"]) for p in parts] == [(0, 0, 512, 512), (0, 512, 512, 88), (512, 0, 512, 512), (512, 512, 512, 88), (1024, 0, 76, 512), (1024, 512, 76, 88)]


@pytest.mark.parametrize(("mark", "fill", "dtype"), [(".", 7, "<u2"), ("/", "NaN", "<f4"), (".", None, ">i2")])
def test_sparse_zarr(spark, tmp_path, mark, fill, dtype):
    """Chunks that were never written hold the fill value, at the edges too; stray files don't count."""
    array = np.arange(5 * 6 * 7, dtype=dtype).reshape(5, 6, 7)
    root = tmp_path / "s.ome.zarr" / "0"
    root.mkdir(parents=True)
    (root / ".zarray").write_text(json.dumps({"zarr_format": 2, "shape": [5, 6, 7], "chunks": [2, 3, 4], "dtype": dtype, "compressor": None, "fill_value": fill, "order": "C", "filters": None, "dimension_separator": mark}))
    want = np.full(array.shape, np.nan if fill == "NaN" else fill or 0, dtype)
    for z, y, x in ((0, 0, 0), (0, 1, 1), (1, 0, 1)):
        whole = np.zeros((2, 3, 4), dtype)
        part = array[2 * z : 2 * z + 2, 3 * y : 3 * y + 3, 4 * x : 4 * x + 4]
        whole[: part.shape[0], : part.shape[1], : part.shape[2]] = part
        want[2 * z : 2 * z + 2, 3 * y : 3 * y + 3, 4 * x : 4 * x + 4] = part
        to = root / mark.join(map(str, (z, y, x)))
        to.parent.mkdir(parents=True, exist_ok=True)
        to.write_bytes(whole.tobytes())
    for stray in ("9.9.9", "0.0", "1.x"):
        (root / stray).write_bytes(b"stray")
    group = str(root.parent)
    assert discover.shape(spark, group) == (5, 6, 7)
    datasource.register(spark)
    for got in (zarr.read_zarr(spark, group), spark.read.format("omezarr").option("partition_bytes", 100).load(group)):
        assert got.count() == 12
        assert np.array_equal(cube(got, (5, 6, 7)), want.astype(float), equal_nan=True)


def test_omezarr_writes_all_or_nothing(spark, tmp_path):
    datasource.register(spark)
    shape, path = (20, 30, 40), str(tmp_path / "v.ome.zarr")
    array = (np.arange(np.prod(shape)) % 60_000).reshape(shape).astype("<u2")
    zarr_sink.write_zarr(planes_of(spark, array), path, shape, "<u2", "v", 4, missing="error")
    before = sorted((p.relative_to(tmp_path), p.read_bytes()) for p in tmp_path.rglob("*") if p.is_file())
    chunked = blocks.rechunk(planes_of(spark, array + 1), shape, (16, 30, 40))
    writer = chunked.write.format("omezarr").option("shape", "20,30,40")
    with pytest.raises(Exception, match="exists"):
        writer.mode("append").save(path)

    def broken(batches):
        for n, batch in enumerate(batches):
            if batch.z0.max() >= 16:
                raise RuntimeError("lost")
            yield batch

    with pytest.raises(Exception, match="lost"):
        chunked.mapInPandas(broken, blocks.SCHEMA).write.format("omezarr").option("shape", "20,30,40").mode("overwrite").save(path)
    with pytest.raises(Exception, match="not a chunk"):
        planes_of(spark, array).write.format("omezarr").option("shape", "20,30,40").mode("overwrite").save(path)
    with pytest.raises(Exception, match="were written"):
        chunked.unionByName(chunked).write.format("omezarr").option("shape", "20,30,40").mode("overwrite").save(path)
    with pytest.raises(Exception, match="were written"):
        chunked.where("z0 = 0").write.format("omezarr").option("shape", "20,30,40").option("missing", "error").mode("overwrite").save(path)
    after = sorted((p.relative_to(tmp_path), p.read_bytes()) for p in tmp_path.rglob("*") if p.is_file())
    assert before == after  # the group is as it was, and nothing stays beside it
    chunked.where("z0 = 0").write.format("omezarr").options(shape="20,30,40", fill="5", name="w", pyramid_max="1").mode("overwrite").save(path)
    want = array + 1
    want[16:] = 5
    assert (cube(spark.read.format("omezarr").load(path), shape) == want).all()
    assert (cube(zarr.read_zarr(spark, path), shape) == want).all()
    assert zarr.attributes(spark, path)["multiscales"][0]["name"] == "w" and not (tmp_path / "v.ome.zarr" / "1").exists()


def test_empty_chunks_can_be_left_out(spark, tmp_path):
    array = np.zeros((20, 8, 8), "<u2")
    array[17, 3, 3] = 9
    zarr_sink.write_zarr(planes_of(spark, array), str(tmp_path / "e.ome.zarr"), array.shape, "<u2", "e", 1, empty="skip")
    assert sorted(p.name for p in (tmp_path / "e.ome.zarr" / "0").iterdir()) == [".zarray", "1.0.0"]
    assert (cube(zarr.read_zarr(spark, str(tmp_path / "e.ome.zarr")), array.shape) == array).all()


def test_export_formats(spark, tmp_path):
    zarr_sink.write_zarr(blocks.synthetic_planes(spark, (2, 4, 4), 1), str(tmp_path / "in" / "a.ome.zarr"), (2, 4, 4), "<u2", "a", 1)
    for wrong in (("foo",), (), ("ozx", "foo")):
        with pytest.raises(ValueError, match="formats"):
            pipeline.export(spark, str(tmp_path / "in"), str(tmp_path / "out"), wrong)
    assert not (tmp_path / "out").exists()
    got = pipeline.export(spark, str(tmp_path / "in"), str(tmp_path / "out"), ("TIFF",))
    assert [p.rsplit("/", 1)[1] for p in got] == ["a.ozx", names.MERGED_NAME]


def test_a_run_that_breaks_off_leaves_the_former_output(spark, tmp_path, monkeypatch):
    source, folder = str(tmp_path / "scan.tif"), tmp_path / "run"
    files = lambda: {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}
    tiff.write_pages(source, [(np.arange(20, dtype="u2") + 20 * k).reshape(5, 4) for k in range(3)])
    pipeline.run(spark, [source], str(folder), RunParams(1, 1, 30))
    before, manifest = files(), json.loads((folder / "manifest.json").read_text())
    assert {"staged/scan.ome.zarr", "resampled/scan.ome.zarr", "exported/scan.ozx", "name_map.tsv"} <= set(manifest["items"]) and manifest["params"]["angle"] == 30
    assert manifest["items"]["exported/scan.ozx"] == (folder / "exported/scan.ozx").stat().st_size
    tiff.write_pages(source, [np.full((5, 4), 7, "u2")] * 4)
    with monkeypatch.context() as broken:
        broken.setattr(pipeline.archive, "export_archives", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run(spark, [source], str(folder), RunParams(1, 1, 30))
    assert files() == before
    other = tmp_path / "two.tif"
    tiff.write_pages(str(other), [np.full((5, 4), 9, "u2")] * 2)
    pipeline.run(spark, [str(other)], str(folder), RunParams(1, 1, 30), keep_staged=False)
    after = files()
    assert all(after[k] == v for k, v in before.items() if "scan" in k)  # other volumes of the folder stay
    assert "exported/two.ozx" in after and not any(k.startswith("staged/two") for k in after)


def test_archives_are_packed_and_unpacked_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "TASK_BYTES", 500)
    group = tmp_path / "big.ome.zarr"
    for k in range(40):
        (group / "0" / f"é{k % 7}").mkdir(parents=True, exist_ok=True)
        (group / "0" / f"é{k % 7}" / f"{k}").write_bytes(bytes([k]) * (k * 11))
    archive.write_archive(str(group), str(tmp_path / "big.ozx"))
    archive.write_archive(str(group), str(tmp_path / "big.ozx"))
    with zipfile.ZipFile(tmp_path / "big.ozx") as z:
        assert z.testzip() is None and z.namelist() == sorted(z.namelist()) and len(z.namelist()) == 40
        assert z.read("big.ome.zarr/0/é3/38") == bytes([38]) * 418
    assert not list(tmp_path.glob("*.writing-*"))
    out = discover.unpack_archive(str(tmp_path / "big.ozx"), str(tmp_path / "out"))
    files = lambda root: sorted((str(p.relative_to(root)), p.read_bytes()) for p in Path(root).rglob("*") if p.is_file())
    assert files(out) == files(group)


def test_large_archives_are_marked_as_such(tmp_path):
    """Sizes and places beyond 32 bits, in a sparse file."""
    name, size = b"a.ome.zarr/0/0.0.0", 5 << 30
    small = b"a.ome.zarr/1"
    path = tmp_path / "large.zip"
    head = archive._header(name, size, 0)
    second = len(head) + size
    end = second + len(archive._header(small, 3, zlib.crc32(b"abc"))) + 3
    entries = archive._entry(name, size, 0, 0) + archive._entry(small, 3, zlib.crc32(b"abc"), second)
    with open(path, "wb") as out:
        out.write(head)
        out.seek(second)
        out.write(archive._header(small, 3, zlib.crc32(b"abc")) + b"abc")
        assert out.tell() == end
        out.write(entries + archive._end(2, end, len(entries)))
    with zipfile.ZipFile(path) as z:
        assert [i.file_size for i in z.infolist()] == [size, 3] and z.read(small.decode()) == b"abc"
    path.unlink()


def test_stores_without_renames_of_folders(tmp_path, monkeypatch):
    """The other branch of ``store``, with a file system that isn't the local one."""
    other = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    monkeypatch.setattr(store, "locate", lambda path: (other, path.removeprefix("other://")))
    for name, data in (("a/0/x", b"new"), ("a/.zattrs", b"{}"), ("b/0/x", b"old"), ("b/0/y", b"gone")):
        store.write_bytes(f"other://{name}", data, "other://parts")
    store.replace("other://a", "other://b")
    assert store.read_bytes("other://b/0/x") == b"new" and store.read_bytes("other://b/.zattrs") == b"{}" and store.read_bytes("other://b/0/y") is None
    assert not store.exists("other://a") and sorted(p.name for p in tmp_path.iterdir()) == ["b"]
    store.delete("other://b")
    store.delete("other://none")
    assert not store.exists("other://b")


def test_sheared_stack_takes_no_disk_for_zeros_and_no_shuffle_of_voxels(spark, tmp_path):
    """a deep stack is mostly the frame's zeros; they are neither shuffled nor written."""
    view = g.top_view((400, 3, 64), 0.168, 0.2, 45.0)
    planes = blocks.synthetic_planes(spark, (view.z, view.y, view.x))
    moved = block_resample.sheared_planes(planes, view)
    assert "Exchange" not in moved._jdf.queryExecution().executedPlan().toString()
    path = str(tmp_path / "shear.tif")
    assert tiff.write_tiff(moved, path) == view.z
    assert os.stat(path).st_blocks * 512 < os.stat(path).st_size / 2
    got, base = cube(tiff_source.read_tiff(spark, path), (view.z, view.shear_y, view.x)), cube(planes, (view.z, view.y, view.x))
    want = np.zeros(got.shape)
    for z, o in enumerate(view.offsets):
        want[z, o + view.margin : o + view.margin + view.y] = base[z]
    assert (got == want).all()


def test_pages_of_one_file_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """the pages' places are small rows, which Spark put together into one task."""
    monkeypatch.setattr(tiff_source, "RUN_BYTES", 100)
    path = str(tmp_path / "v.tif")
    tiff.write_tiff(blocks.synthetic_planes(spark, (40, 5, 6)), path)
    assert tiff_source.read_tiff(spark, path).select(F.spark_partition_id()).distinct().count() > 4


def test_deep_top_view_tiff_takes_no_disk_for_zeros(spark, tmp_path):
    """nearly all of a deep volume's top view is empty, and every page was written in full."""
    planes, params = blocks.synthetic_planes(spark, (400, 3, 64)), RunParams(dx=0.168, dz=0.2, angle=45.0)
    tiff.write_tiff(planes, str(tmp_path / "v.tif"))
    out = pipeline.resample(spark, str(tmp_path / "v.tif"), str(tmp_path / "out"), params)
    assert os.stat(out).st_blocks * 512 < os.stat(out).st_size / 2
    view = g.top_view((400, 3, 64), 0.168, 0.2, 45.0)
    want = blocks.to_voxels(block_resample.top_view_planes(planes, view).drop("k")).where("v > 0")
    got = blocks.to_voxels(tiff_source.read_tiff(spark, out))
    assert got.count() == math.prod(view.shape) and got.where("v > 0").count() == want.count() > 0 and got.where("v > 0").exceptAll(want).isEmpty()


def test_top_view_planes_are_made_by_many_tasks(spark):
    """the source planes are few bytes, so Spark put all output planes into few tasks."""
    view = g.top_view((60, 3, 16), 0.168, 0.2, 45.0)
    out = block_resample.top_view_planes(blocks.synthetic_planes(spark, (60, 3, 16)), view, arithmetic="float32")
    assert out.select(F.spark_partition_id()).distinct().count() > 4


def test_deep_top_view_zarr_has_no_files_of_zeros(spark, tmp_path):
    """chunks of the empty frame were shuffled, written in all levels and read again."""
    planes, shape, params = blocks.synthetic_planes(spark, (120, 3, 16)), (120, 3, 16), RunParams(dx=0.168, dz=0.2, angle=45.0)
    zarr_sink.write_zarr(planes, str(tmp_path / "v.ome.zarr"), shape, "<u2", "v", 1)
    out = pipeline.resample(spark, str(tmp_path / "v.ome.zarr"), str(tmp_path / "out"), params)
    view = g.top_view(shape, 0.168, 0.2, 45.0)
    assert 0 < len(list(Path(out, "0").glob("[0-9]*"))) < -(-view.shape[0] // 16)
    assert (cube(zarr.read_zarr(spark, out), view.shape) == cube(block_resample.top_view_planes(planes, view).drop("k"), view.shape)).all()
