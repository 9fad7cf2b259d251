import math

import numpy as np
import pytest

from tessera.functions import geometry as g
from tessera.functions.params import RunParams, as_bool, backend, index_triple, supplied


def test_affine_shapes_and_matrices():
    a = g.affine((500, 2024, 128), 0.168, 0.2, 45.0)
    assert a.shape == (1305, 2148, 128) and a.rotation == -45.0
    assert a.matrix[1][2] == pytest.approx(1.20710678) and a.shear == pytest.approx(0.70710678)
    b = g.affine((500, 2024, 128), 0.168, 0.2, 45.0, rotate=False)
    assert b.shape == (500, 2444, 128) and b.matrix[1][2] == pytest.approx(0.70710678)
    assert g.affine((7, 10, 16), 0.108, 0.3, 40.0, -1).shape == (5, 26, 15)
    assert g.affine((7, 10, 16), 0.108, 0.3, 40.0, -1, exact_extent=True).shape[2] == 16
    assert g.affine((4, 6, 5), 1.0, 1.0, 0.0).shape == (4, 6, 5)
    assert np.allclose(np.array(a.matrix) @ np.array(a.inverse), np.eye(3))


def test_top_view_sizes():
    v = g.top_view((3, 5, 4), 1.0, 1.0, 30.0)
    assert v.offsets == (-1, 0, 1) and v.margin == 1 and v.shape == (1, 7, 4)
    assert g.top_view((8, 16, 12), 0.168, 0.2, 45.0).shape == (7, 22, 12)
    assert g.top_view((9, 14, 10), 0.108, 0.3, 40.0, -1).shape == (16, 32, 10)
    assert all(math.isclose(sum(c for k, _, _, c in v.taps() if k == z), 1.0) for z in range(v.scaled_z))


def test_tiles_levels_and_samples():
    assert [g.tile_halo(a, b, 3584) for a, b in ((0, 256), (256, 512), (3328, 3584))] == [(0, 257), (255, 513), (3327, 3584)]
    with pytest.raises(ValueError, match="outside"):
        g.tile_halo(40, 50, 10)
    assert g.pyramid_factors(4) == [1, 2, 4] and g.pyramid_factors(0) == [1]
    assert g.level_size(9, 4) == 3 and g.level_chunk(3, 8, 5) == 1
    assert g.sample_indices(10, 4) == [0, 3, 6, 9] and g.sample_indices(0, 3) == [] and g.sample_indices(5, 1) == [0]
    assert g.read_chunks((600, 700)) == (512, 512) and g.default_chunks((3, 300, 9)) == (3, 256, 9)


def test_parameters():
    assert [as_bool(x) for x in ("Yes", "off", "", "maybe", 0, True)] == [True, False, False, True, False, True]
    assert [backend(x) for x in ("", "GPU", "cuda", "cpu-blocked", None)] == ["cpu_blocked", "gpu", "gpu", "cpu_blocked", "cpu_blocked"]
    with pytest.raises(ValueError, match="backend"):
        backend("tpu")
    assert [supplied(x) for x in (None, " ", -1, "-1.0", 0, "x")] == [False, False, False, False, True, True]
    assert index_triple("32,0,1") == (32, 0, 1) and index_triple(None) == (0, 0, 0)
    for bad in ("32,0", "-1,0,0"):
        with pytest.raises(ValueError, match="three"):
            index_triple(bad, non_negative=True)
    assert RunParams(1, 1).rounding == "half_even" and RunParams(1, 1, backend="gpu").rounding == "half_up"
    for wrong in ({"dx": -1}, {"dx": 0}, {"geometry": "x"}, {"output_type": "float32"}, {"pyramid_max": 3}, {"export_formats": ("png",)}, {"output_type": "uint8"}):
        with pytest.raises(ValueError):
            RunParams(**{"dx": 1, "dz": 1} | wrong)
