"""Downloads of listed files: a bounded number at a time, hashed on the way, moved in place when complete."""

from __future__ import annotations

import hashlib
import os
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from urllib.request import urlopen

CHUNK = 8 << 20


def fetch(url: str, to: Path, expected: int = 0, timeout: float = 300.0) -> dict:
    """A ledger row; status is ``done`` or ``failed``."""
    part, digest, size = to.with_suffix(".part"), hashlib.sha256(), 0
    row = {"file_key": url, "local_path": str(to), "size_bytes": expected, "sha256": "", "status": "failed"}
    to.parent.mkdir(parents=True, exist_ok=True)
    try:
        with urlopen(url, timeout=timeout) as source, part.open("wb") as out:
            while block := source.read(CHUNK):
                out.write(block)
                digest.update(block)
                size += len(block)
        if expected and size != expected:
            part.unlink()
            return row
        os.replace(part, to)
    except OSError:
        part.unlink(missing_ok=True)
        return row
    return row | {"size_bytes": size, "sha256": digest.hexdigest(), "status": "done"}


def fetch_all(files: list[tuple[str, str, int]], workers: int = 4) -> list[dict]:
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(lambda f: fetch(f[0], Path(f[1]), f[2]), files))
