"""Helpers that several test modules import (a name of their own, so that no other conftest shadows them)."""

from __future__ import annotations

import os

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def write_file(path: str, body: bytes | str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(body.encode("utf-8") if isinstance(body, str) else body)
    return path
