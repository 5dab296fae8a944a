"""NIfTI-1 and NIfTI-2 volumes as a table of headers and voxel statistics.

A task opens each of its files and reads it once, piece by piece: compressed bytes are inflated ``PIECE`` bytes at a
time, the header is taken from the first, and the least, the largest, the sum and the number of voxels that
aren't zero are carried on.  No volume is ever whole in memory, however large it is or becomes when inflated.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cartulary.sources.listing import binary_files, dealt, found_files
from cartulary.sources.stores import opened_by_tasks, store_of

#: Bytes that are read, inflated and counted at once.
PIECE = 1 << 20

SCHEMA = (
    "path string, ndim int, shape array<int>, zooms array<float>, qfac double, xyzt_units int, sform_code int, qform_code int, intent_code int,"
    " datatype int, affine array<double>, orientation string, vmin double, vmax double, vmean double, nonzero bigint, load_error string"
)

#: Fixed values of the format: number types by code.
TYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8"}
#: Fixed values of the format: bytes of a header by version, and where its fields are (format of ``struct``, place).
HEADERS = {
    348: {"dim": ("8h", 40), "intent": ("h", 68), "datatype": ("h", 70), "pixdim": ("8f", 76), "offset": ("f", 108), "slope": ("f", 112), "inter": ("f", 116), "units": ("B", 123), "qform": ("h", 252), "sform": ("h", 254), "quatern": ("3f", 256), "qoffset": ("3f", 268), "srow": ("12f", 280)},
    540: {"dim": ("8q", 16), "intent": ("i", 504), "datatype": ("h", 12), "pixdim": ("8d", 104), "offset": ("q", 168), "slope": ("d", 176), "inter": ("d", 184), "units": ("i", 500), "qform": ("i", 344), "sform": ("i", 348), "quatern": ("3d", 352), "qoffset": ("3d", 376), "srow": ("12d", 400)},
}
MAGIC = {348: (344, (b"n+1", b"ni1")), 540: (4, (b"n+2", b"ni2"))}


def read_header(data: bytes) -> tuple[dict[str, tuple], str]:
    """(fields, byte order); ``ValueError`` if it isn't a header."""
    if len(data) < 348:
        raise ValueError("too short for a header")
    for end in "<>":
        size = struct.unpack(f"{end}i", data[:4])[0]
        if size in HEADERS:
            at, magic = MAGIC[size]
            if len(data) < size or data[at : at + 3] not in magic:
                break
            return {k: struct.unpack_from(end + f, data, p) for k, (f, p) in HEADERS[size].items()}, end
    raise ValueError("not a NIfTI header")


def affine_of(h: dict[str, tuple]) -> np.ndarray:
    """Voxel to space: the sform, else the qform (a rotation as a quaternion, voxel sizes, an offset), else the sizes around the centre with x turned."""
    zooms = np.array(h["pixdim"][1:4], dtype=float)
    out = np.eye(4)
    if h["sform"][0] > 0:
        out[:3] = np.array(h["srow"], dtype=float).reshape(3, 4)
    elif h["qform"][0] > 0:
        b, c, d = (float(x) for x in h["quatern"])
        a = np.sqrt(max(0.0, 1.0 - (b * b + c * c + d * d)))
        turn = np.array([
            [a * a + b * b - c * c - d * d, 2 * (b * c - a * d), 2 * (b * d + a * c)],
            [2 * (b * c + a * d), a * a + c * c - b * b - d * d, 2 * (c * d - a * b)],
            [2 * (b * d - a * c), 2 * (c * d + a * b), a * a + d * d - b * b - c * c],
        ])
        out[:3, :3] = turn * zooms * np.array([1.0, 1.0, -1.0 if h["pixdim"][0] < 0 else 1.0])
        out[:3, 3] = h["qoffset"]
    else:
        sizes = zooms * np.array([-1.0, 1.0, 1.0])
        shape = np.array([*h["dim"][1 : 1 + max(0, min(3, h["dim"][0]))], 1, 1, 1][:3], dtype=float)
        out[:3, :3] = np.diag(sizes)
        out[:3, 3] = -(shape - 1) / 2 * sizes
    return out


def axis_codes(affine: np.ndarray) -> str:
    """Which way each voxel axis points, by the largest entry of its column."""
    out = ["?"] * 3
    for column in np.argsort(-np.abs(affine[:3, :3]).max(axis=0)):
        row = int(np.abs(affine[:3, column]).argmax())
        out[column] = ("RL", "AP", "SI")[row][int(affine[row, column] < 0)]
    return "".join(out)


def inflated(pieces: Iterable[bytes], most: int = PIECE) -> Iterator[bytes]:
    """The bytes of ``pieces``, unpacked if they are gzip (members one after the other, zeros after the last); ``EOFError`` if they end early."""
    pieces = iter(pieces)
    first = b""
    for p in pieces:
        first += p
        if len(first) >= 2:
            break
    if first[:2] != b"\x1f\x8b":
        yield first
        yield from pieces
        return
    member, begun = zlib.decompressobj(31), False
    held: bytes | None = first
    while held is not None:
        while held:
            if not begun:
                held = held.lstrip(b"\0") if member is None else held
                if not held:
                    break
                member, begun = zlib.decompressobj(31), True
            yield member.decompress(held, most)
            held = member.unconsumed_tail
            if member.eof:
                held, member, begun = member.unused_data, None, False
        held = next(pieces, None)
    if begun:
        yield member.flush()
        if not member.eof:
            raise EOFError("the compressed file ends early")


class Voxels:
    """Statistics of a run of voxels that arrives in pieces; NaN voxels make the least, the largest and the mean NaN."""

    def __init__(self, kind: np.dtype, n: int, scale: float, shift: float):
        self.kind, self.left, self.n, self.scale, self.shift = kind, n, n, scale, shift
        self.low, self.high, self.sums, self.nonzero, self.rest = math.inf, -math.inf, [], 0, b""

    def add(self, data: bytes) -> None:
        data = self.rest + data if self.rest else data
        k = min(len(data) // self.kind.itemsize, self.left)
        self.rest = bytes(data[k * self.kind.itemsize :]) if k < self.left else b""
        if k:
            values = np.frombuffer(data, self.kind, k).astype(np.float64)
            if self.scale != 1.0 or self.shift:
                values = values * self.scale + self.shift
            self.left -= k
            self.low, self.high = float(np.minimum(self.low, values.min())), float(np.maximum(self.high, values.max()))
            self.sums.append(float(values.sum()))
            self.nonzero += int(np.count_nonzero(values))
            if len(self.sums) > 1000:
                self.sums = [math.fsum(self.sums)] if all(map(math.isfinite, self.sums)) else [sum(self.sums)]

    def told(self) -> dict:
        if self.left:
            raise ValueError(f"cut short: {self.left} of {self.n} voxels are missing")
        total = math.fsum(self.sums) if all(map(math.isfinite, self.sums)) else sum(self.sums)
        return {"vmin": self.low if self.n else None, "vmax": self.high if self.n else None, "vmean": total / self.n if self.n else None, "nonzero": self.nonzero}


def scan_volume(pieces: Iterable[bytes]) -> dict:
    """The columns of ``SCHEMA`` but path and load_error, of a file's bytes piece by piece; ``ValueError`` if it isn't a volume."""
    told, voxels, head, at = {}, None, b"", 0
    for data in inflated(pieces):
        if voxels is None:
            head += data
            if len(head) < max(HEADERS):
                continue
            told, voxels, at = open_volume(head)
            data = head[at:]
            at = max(0, at - len(head))
        elif at:
            data, at = data[at:], max(0, at - len(data))
        voxels.add(data)
        if not voxels.left:
            break
    if voxels is None:
        told, voxels, at = open_volume(head)
        voxels.add(head[at:])
    return told | voxels.told()


def open_volume(head: bytes) -> tuple[dict, Voxels, int]:
    """(header columns, statistics to be filled, where the voxels begin) from a file's beginning."""
    h, end = read_header(head)
    dim, pixdim, datatype, offset = h["dim"], h["pixdim"], h["datatype"][0], h["offset"][0]
    slope, inter, affine = h["slope"][0], h["inter"][0], affine_of(h)
    if datatype not in TYPES:
        raise ValueError(f"number type {datatype} isn't read")
    shape = [int(d) for d in dim[1 : 1 + dim[0]]]
    if any(d < 0 for d in shape) or not math.isfinite(offset) or offset < 0:
        raise ValueError("a size or an offset is negative")
    scale = slope if np.isfinite(slope) and slope != 0 else 1.0
    shift = inter if np.isfinite(inter) and slope != 0 else 0.0
    told = {
        "ndim": dim[0], "shape": shape, "zooms": [float(z) for z in pixdim[1 : 1 + dim[0]]], "qfac": float(pixdim[0]), "xyzt_units": h["units"][0],
        "sform_code": h["sform"][0], "qform_code": h["qform"][0], "intent_code": h["intent"][0], "datatype": datatype, "affine": affine.ravel().tolist(), "orientation": axis_codes(affine),
    }
    return told, Voxels(np.dtype(end + TYPES[datatype]), math.prod(shape) if shape else 0, scale, shift), int(offset)


def parse_volume(data: bytes) -> dict:
    """``scan_volume`` of a file that is in memory."""
    whole = memoryview(data)
    return scan_volume(bytes(whole[k : k + PIECE]) for k in range(0, len(whole), PIECE))


def told_of(path: str, pieces: Iterable[bytes]) -> dict:
    """A row of ``SCHEMA``; of a file that can't be read, the path and the reason."""
    try:
        return scan_volume(pieces) | {"path": path, "load_error": None}
    except (ValueError, OSError, EOFError, struct.error, zlib.error, OverflowError) as e:
        return {"path": path, "load_error": str(e)}


def pieces_of(uri: str) -> Iterator[bytes]:
    """A file's bytes, ``PIECE`` at a time, from any store that Arrow reads; names may hold any character, as Spark gives them."""
    store, path = store_of(uri)
    with store.open_input_stream(path, compression=None) as f:
        while data := f.read(PIECE):
            yield data


def table_of(rows: list[dict]) -> pd.DataFrame:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names)


def parse_files(files: DataFrame) -> DataFrame:
    """Headers and statistics of ``files(path, content)``, contents of a store that only Spark reads; one that can't be read has only path and load_error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                whole = memoryview(content)
                yield table_of([told_of(path, (bytes(whole[k : k + PIECE]) for k in range(0, len(whole), PIECE)))])

    return files.select("path", "content").mapInPandas(read, SCHEMA)


def scan_files(files: DataFrame) -> DataFrame:
    """The same of ``files(path)``: each task opens its files and reads them piece by piece."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield table_of([told_of(path, pieces_of(path)) for path in batch["path"]])

    return files.select("path").mapInPandas(read, SCHEMA)


def read_headers(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Headers and statistics of every .nii and .nii.gz below ``path``.  Tasks list the files, which are dealt out by number and size; ``whole``, and in a store that Arrow doesn't read: Spark lists them and hands over their contents."""
    glob = "*.{nii,nii.gz}"
    if whole or not opened_by_tasks(path):
        return parse_files(binary_files(spark, path, glob))
    return scan_files(dealt(found_files(spark, path, glob)))
