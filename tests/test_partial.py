"""Queries over tables whose vectors don't fill the last plane, or are missing within, against their SQL."""

import duckdb
import pytest

from tessera.plans import file_queries  # noqa: F401
from tessera.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def gaps(tmp_path_factory):
    """490 vectors, the last plane with 15 rows, and 4 more missing; DuckDB and the folder."""
    folder = tmp_path_factory.mktemp("gaps")
    duck = duckdb.connect()
    duck.sql(f"COPY (SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet' WHERE vec_id < 490 AND vec_id NOT IN (0, 130, 131, 260)) TO '{folder}/embeddings.parquet' (FORMAT parquet)")
    duck.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    return duck, str(folder)


def same(spark, gaps, name):
    duck, folder = gaps
    want = duck.sql(ORACLES[name])
    got = QUERIES[name](spark, folder).select(*want.columns).collect()
    return sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", ["adjacent_mean_saturated", "adjacent_slice_mean"])
def test_means_at_the_end_of_a_partial_plane(spark, gaps, name):
    """the voxels above the last plane's missing rows are the deepest of their places."""
    assert same(spark, gaps, name)


FILES = ["archive_round_trip", "stage_tiff_input", "stage_zarr_verbatim", "tiff_round_trip", "tiff_sample_planes", "tiff_12_bits", "zarr_pyramid_level", "zarr_round_trip", "voltiff_pruned", "comparison_open", "float_byte_order", "merge_to_tiff", "omezarr_absent_chunks", "omezarr_round_trip"]


@pytest.mark.parametrize("name", FILES)
def test_files_give_back_the_voxels_that_the_table_has(spark, gaps, name):
    """F9, F10, F12 to F15 and their like: a file is dense, so missing rows came back as zeros."""
    assert same(spark, gaps, name)


def test_depth_needs_both_planes(spark, gaps):
    """a voxel with one of its two source voxels absent had the other's share as its value."""
    assert same(spark, gaps, "depth_resample")


def test_affine_from_a_file_takes_no_support_from_missing_rows(spark, gaps):
    """F8: a file held missing voxels as zeros, which darkened those beside them."""
    assert same(spark, gaps, "affine_zarr_to_zarr")


@pytest.mark.parametrize("name", ["affine_flip", "affine_resample_f32", "affine_resample_u16", "affine_shear_only"])
def test_affine_with_missing_rows(spark, gaps, name):
    """F4 to F7: right before as well, at a depth that the SQL lists."""
    assert same(spark, gaps, name)
