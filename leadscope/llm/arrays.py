"""Sorted arrays in files of a shared folder, memory-mapped by the workers."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections import OrderedDict
from urllib.parse import unquote, urlparse

import numpy as np

#: Files a worker keeps mapped, the last used ones; a mapping lives on while its arrays are in use.
MOST_MAPPED = 1024
_MAPPED: OrderedDict[str, dict[str, np.ndarray]] = OrderedDict()


def local_path(uri: str) -> str | None:
    """The path of a file: URI or a plain path; None for other stores."""
    parsed = urlparse(uri)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays to one file.  The file appears whole or not at all, so a repeated task may write it again."""
    at, head = 0, []
    for name, a in arrays.items():
        head.append((name, a.dtype.str, len(a), at))
        at += -(-a.nbytes // 8) * 8
    header = json.dumps(head).encode()
    header += b" " * (-len(header) % 8)
    parts = [np.int64(len(header)).tobytes(), header]
    for a in arrays.values():
        parts += [np.ascontiguousarray(a).tobytes(), b"\0" * (-a.nbytes % 8)]
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        draft = f"{path}.{uuid.uuid4().hex}"
        with open(draft, "wb") as f:
            f.writelines(parts)
        os.replace(draft, path)
        return
    from pyarrow import fs
    store, place = fs.FileSystem.from_uri(uri)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    draft = f"{place}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        for p in parts:
            out.write(p)
    store.move(draft, place)


def map_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped; a worker keeps the ``MOST_MAPPED`` last used files mapped.  From a
    store without local paths the file is copied to an unnamed temporary file first."""
    if uri in _MAPPED:
        _MAPPED.move_to_end(uri)
        return _MAPPED[uri]
    path = local_path(uri)
    if path is not None:
        raw = np.memmap(path, np.uint8, "r")
    else:
        from pyarrow import fs
        store, place = fs.FileSystem.from_uri(uri)
        with tempfile.TemporaryFile() as copy, store.open_input_stream(place) as source:
            while chunk := source.read(1 << 24):
                copy.write(chunk)
            copy.flush()
            raw = np.memmap(copy, np.uint8, "r")         # the mapping outlives the unnamed file
    size = int(raw[:8].view(np.int64)[0])
    base = 8 + size
    out = {}
    for name, kind, n, at in json.loads(raw[8:base].tobytes()):
        dtype = np.dtype(kind)
        out[name] = raw[base + at:base + at + n * dtype.itemsize].view(dtype)
    _MAPPED[uri] = out
    while len(_MAPPED) > MOST_MAPPED:
        _MAPPED.popitem(last=False)
    return out
