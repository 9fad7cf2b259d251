import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import geometry as g
from tessera.operators.compare import fit_profile, gaussian
from tessera.sources import codec

shapes = st.tuples(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40))
spacing = st.floats(0.05, 2.0)


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=3000), st.sampled_from([1, 2, 4, 8]), st.sampled_from([None, {"id": "blosc"}, {"id": "zstd"}, {"id": "zlib"}]))
def test_codecs_are_lossless(raw, size, compressor):
    assert codec.decode(codec.encode(raw, compressor, size), compressor, len(raw)) == raw


@settings(max_examples=150, deadline=None)
@given(shapes, spacing, spacing, st.floats(1, 89), st.sampled_from([-1, 1]))
def test_top_view_taps_are_means_of_near_planes(shape, dx, dz, angle, flip):
    v = g.top_view(shape, dx, dz, angle, flip)
    assert v.shear_y == shape[1] + 2 * v.margin and abs(v.offsets[shape[0] // 2]) == 0
    by: dict = {}
    for k, p, shift, c in v.taps():
        assert 0 <= p < shape[0] and 0 <= shift <= 2 * v.margin and c > 0
        by.setdefault(k, []).append((p, c))
    for k, taps in by.items():
        assert len(taps) <= 3 and abs(sum(c for _, c in taps) - 1) < 1e-9
        assert max(p for p, _ in taps) - min(p for p, _ in taps) <= 2
    assert sorted(by) == list(range(v.scaled_z))


@settings(max_examples=150, deadline=None)
@given(shapes, spacing, spacing, st.floats(-80, 80), st.sampled_from([-1, 1]), st.booleans())
def test_affine_inverse_leads_back(shape, dx, dz, angle, flip, rotate):
    a = g.affine(shape, dx, dz, angle, flip, rotate)
    point = np.array([1.3, -0.7, 2.1])
    moved = np.array(a.matrix) @ point + np.array(a.offset)
    assert np.allclose(np.array(a.inverse) @ moved + np.array(a.inverse_offset), point)
    assert a.shape[2] in (shape[2], shape[2] - 1) and min(a.shape) >= 1


@given(st.integers(0, 500), st.integers(1, 60))
def test_samples_are_ascending_with_both_ends(size, count):
    found = g.sample_indices(size, count)
    assert found == sorted(set(found)) and len(found) == min(size, count)
    if size and count > 1:
        assert found[0] == 0 and found[-1] == size - 1


@settings(max_examples=60, deadline=None)
@given(st.floats(5, 200), st.floats(6, 14), st.floats(1.0, 4.0), st.floats(-5, 50))
def test_fit_recovers_noiseless_lines(amplitude, centre, sigma, base):
    x = np.arange(21.0)
    found = fit_profile(x, gaussian(x, np.array([amplitude, centre, sigma, base])))
    assert abs(abs(found["sigma"]) - sigma) < 1e-4 and abs(found["x_offset"] - centre) < 1e-4 and found["r2"] > 0.999999
