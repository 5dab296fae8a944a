"""Volumes in pieces: statistics against numpy over the whole, gzip in odd forms, memory of a large volume."""

import gzip
import os
import subprocess
import sys

import numpy as np
import pytest

from cartulary.sources import nifti
from tests.test_tools import header


def volume(values, code=16, end="<", version=1, **told) -> bytes:
    size = {1: 348, 2: 540}[version]
    head = header(version, dim=(3, len(values), 1, 1, 1, 1, 1, 1), datatype=(code,), **told)[: size + 4]
    assert end == "<"
    return head + np.asarray(values, end + nifti.TYPES[code]).tobytes()


def cut(data: bytes, sizes) -> list:
    out, at, k = [], 0, 0
    while at < len(data):
        n = sizes[k % len(sizes)]
        out.append(data[at : at + n])
        at, k = at + n, k + 1
    return out


@pytest.mark.parametrize("code", sorted(nifti.TYPES))
@pytest.mark.parametrize("sizes", [(1,), (7, 64), (350,), (1 << 20,)])
def test_statistics_of_pieces(code, sizes):
    r = np.random.default_rng(code)
    values = r.integers(0, 100, 3001).astype(nifti.TYPES[code])
    for scale in ({}, {"slope": (0.5,), "inter": (-7.0,)}):
        data = volume(values, code, version=1 + code % 3 % 2, **scale)
        want = values.astype(float) * (0.5 if scale else 1) - (7 if scale else 0)
        for packed in (data, gzip.compress(data)):
            got = nifti.scan_volume(cut(packed, sizes))
            assert (got["vmin"], got["vmax"], got["nonzero"]) == (want.min(), want.max(), np.count_nonzero(want)) and np.isclose(got["vmean"], want.mean(), rtol=1e-12)
            assert got["shape"] == [3001, 1, 1]


def test_nan_and_no_voxels():
    got = nifti.parse_volume(volume([1.0, np.nan, 3.0]))
    assert np.isnan([got["vmin"], got["vmax"], got["vmean"]]).all() and got["nonzero"] == 3
    assert nifti.parse_volume(volume([np.inf, 1.0]))["vmean"] == np.inf
    none = nifti.parse_volume(volume([]))
    assert (none["vmin"], none["vmean"], none["nonzero"]) == (None, None, 0)


def test_gzip_in_odd_forms():
    data = volume(range(500), 4)
    members = gzip.compress(data[:100]) + gzip.compress(b"") + gzip.compress(data[100:]) + b"\0" * 50
    for sizes in ((1,), (3, 200), (10**6,)):
        assert nifti.scan_volume(cut(members, sizes))["vmax"] == 499
        with pytest.raises(EOFError):
            nifti.scan_volume(cut(gzip.compress(data)[:-100], sizes))
    for bad in (data[:-1], data[:340], b"", b"x", b"\x1f\x8b", gzip.compress(data[:-1]), b"\x1f\x8bnonsense" * 9):
        assert nifti.told_of("p", cut(bad, (13,)))["load_error"]


def test_extension_before_the_voxels():
    plain = volume(range(300), 4)
    moved = bytearray(plain[:352] + b"\7" * 5000 + plain[352:])
    moved[108:112] = np.float32(5352).tobytes()
    for sizes in ((100,), (4096,), (10**6,)):
        assert nifti.scan_volume(cut(bytes(moved), sizes))["vmean"] == 149.5


def test_files_by_path_and_by_content(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "x.nii.gz").write_bytes(gzip.compress(volume(range(9), 8)))
    (tmp_path / "y.nii").write_bytes(volume(range(5), 64)[:-3])
    (tmp_path / "z.txt").write_bytes(b"no")
    for whole in (False, True):
        got = {r.path.rsplit("/", 1)[1]: (r.vmax, (r.load_error or "")[:9]) for r in nifti.read_headers(spark, f"file://{tmp_path}", whole).collect()}
        assert got == {"x.nii.gz": (8.0, ""), "y.nii": (None, "cut short")}


BIG = """
import gzip, resource, sys
import numpy as np
from cartulary.sources import nifti
from tests.test_nifti import volume
block = (np.arange(8 << 20) % 1000).astype("<i2").tobytes()
head = bytearray(volume([], 4))
head[40:56] = np.array([3, 512, 512, 2048, 1, 1, 1, 1], "<i2").tobytes()
member = gzip.compress(block, 1)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
def pieces():
    yield gzip.compress(bytes(head))
    for _ in range(64):
        yield from (member[k:k + nifti.PIECE] for k in range(0, len(member), nifti.PIECE))
got = nifti.scan_volume(pieces())
grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
assert (got["vmin"], got["vmax"]) == (0, 999) and got["shape"] == [512, 512, 2048], got
print(grown)
"""


def test_a_volume_of_a_gigabyte_takes_little_memory():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", BIG], env=os.environ | {"PYTHONPATH": root}, cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-800:]
    assert float(out.stdout.split()[-1]) < 100
