"""Array files in the shared folder: written by one task, memory-mapped by all."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np

from tickframe.llm.workers import worker_cache

HELD_BYTES = 128 << 20


def local_path(uri: str) -> str | None:
    """The path of a file: address or a plain path; None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") else None


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of named arrays. It appears whole under its name, so a repeated task may race."""
    header, at, blobs = {}, 0, []
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        header[name] = (a.dtype.str, len(a), at)
        blobs.append(a.tobytes() + b"\0" * (-a.nbytes % 8))
        at += len(blobs[-1])
    text = json.dumps(header).encode()
    text += b" " * (-len(text) % 8)
    data = b"".join([np.array([len(text)], "<u8").tobytes(), text, *blobs])
    path = local_path(uri)
    if path is None:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(uri)
        store.create_dir(os.path.dirname(name), recursive=True)
        with store.open_output_stream(name) as out:
            out.write(data)
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(data)
    os.replace(own, path)


def read_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped where the folder is mounted, else read into memory.

    Of what was read, a worker keeps HELD_BYTES at most, the files used last.
    """
    if local_path(uri) is not None:
        return _mapped(uri)
    found = _held.pop(uri, None)
    if found is None:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(uri)
        with store.open_input_file(name) as f:
            data = np.frombuffer(f.read(), np.uint8)
        found = (_arrays(data), len(data))
        while _held and sum(n for _, n in _held.values()) + len(data) > HELD_BYTES:
            del _held[next(iter(_held))]
    _held[uri] = found  # to the end, as the one used last
    return found[0]


_held: dict[str, tuple[dict[str, np.ndarray], int]] = {}


@worker_cache(1024)
def _mapped(uri: str) -> dict[str, np.ndarray]:
    return _arrays(np.memmap(local_path(uri), np.uint8, "r").view(np.ndarray))  # plain arrays are read faster


def _arrays(data: np.ndarray) -> dict[str, np.ndarray]:
    size = int(data[:8].view("<u8")[0])
    header = json.loads(data[8 : 8 + size].tobytes())
    body = data[8 + size :]
    return {
        name: body[at : at + np.dtype(kind).itemsize * n].view(kind) if n else np.zeros(0, kind)
        for name, (kind, n, at) in header.items()
    }
