import numpy as np
import pytest

from tessera import volume
from tessera.functions import sql
from tessera.functions.params import RunParams
from tessera.sinks import tiff
from tessera.sinks import zarr as zarr_sink
from tessera.sources import blocks, datasource, tables

SHAPE = (5, 7, 6)


def cube(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["z"], r["y"], r["x"]] = r["v"]
    return out


@pytest.fixture(scope="module")
def base(spark):
    return cube(tables.synthetic_volume(spark, SHAPE), SHAPE)


def test_chained_operations(spark, base, tmp_path):
    v = volume.Volume(tables.synthetic_volume(spark, SHAPE), SHAPE)
    p = RunParams(1, 1, 30)
    t = v.trim((1, 2, 0))
    assert t.shape == (3, 3, 6) and (cube(t.voxels, t.shape) == base[1:4, 2:5]).all()
    s = v.stride(2)
    assert (cube(s.voxels, s.shape) == base[:, ::2, ::2]).all()
    assert (cube(v.average_adjacent().voxels, SHAPE)[:-1] == (base[:-1] + base[1:]) / 2).all()
    two = v.concat(v)
    assert two.shape[0] == 10 and (cube(two.voxels, two.shape)[5:] == base).all()
    assert {(r["y"], r["x"]): r["v"] for r in v.mip().collect()}[3, 4] == base[:, 3, 4].max()
    assert v.slice("z", 2).count() == 42 and v.pyramid(2).where("level = 1").count() == 5 * 4 * 3
    assert v.shear(p).count() == base.size
    top, flat = v.top_view(p), v.affine(RunParams(1, 1, 0, geometry="affine"))
    assert top.voxels.count() == np.prod(top.shape) and (cube(flat.voxels, flat.shape) == base).all()
    assert v.compare(v, samples=2, fits=False).summary.first()["ncc"]["min"] == pytest.approx(1)
    for wrong in (lambda: v.compare(s), lambda: v.concat(s)):
        with pytest.raises(ValueError):
            wrong()
    for name in ("o.ome.zarr", "o.tif"):
        v.write(str(tmp_path / name))
        again = volume.read(spark, str(tmp_path / name))
        assert again.shape == SHAPE and (cube(again.voxels, SHAPE) == base).all()


def test_data_sources_prune(spark, base, tmp_path):
    datasource.register(spark)
    tiff.write_pages(str(tmp_path / "v.tif"), list(base.astype("u2")))
    pages = spark.read.format("voltiff").load(str(tmp_path / "v.tif"))
    assert (cube(blocks.to_voxels(pages), SHAPE) == base).all()
    one = pages.where("z0 = 3")
    assert one.count() == 1 and one.rdd.getNumPartitions() == 1
    path = str(tmp_path / "v.ome.zarr")
    zarr_sink.write_zarr(blocks.synthetic_planes(spark, (20, 7, 6), 2), path, (20, 7, 6), "<u2", "v", 2)
    deep = spark.read.format("omezarr").option("level", "1").load(path)
    assert (cube(blocks.to_voxels(deep), (20, 4, 3)) == cube(tables.synthetic_volume(spark, (20, 7, 6)), (20, 7, 6))[:, ::2, ::2]).all()
    assert deep.where("z0 >= 16").count() == 2 and deep.where("z0 > 99").count() == 0


def test_sql_functions(spark, base):
    sql.register(spark)
    blocks.synthetic_planes(spark, SHAPE, 2).createOrReplaceTempView("planes")
    rows = spark.sql("SELECT v.* FROM planes p, LATERAL voxels(p.z0, p.y0, p.x0, p.nz, p.ny, p.nx, p.dtype, p.data) v")
    assert (cube(rows, SHAPE) == base).all()
    assert spark.sql("SELECT volume_fwhm(2.0D) AS f").first()["f"] == pytest.approx(4.709640, abs=1e-5)
    line = spark.sql("SELECT fit_profile(transform(sequence(0, 20), x -> 10 * exp(-power(x - 9, 2) / 8) + 3)) AS f").first()["f"]
    assert abs(line["sigma"]) == pytest.approx(2, abs=1e-5) and line["x_offset"] == pytest.approx(9, abs=1e-5)
