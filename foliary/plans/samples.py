"""Smallest files of some kinds, as bytes: what queries and tests put before the contents that they derive."""

from __future__ import annotations

import io
import struct
import zipfile


def compound_file(names: list[str], sector: int = 512) -> bytes:
    """A compound file whose root has streams of these names, empty: header, allocation table, directory."""
    entry = lambda name, kind, left, right, child: name.encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBBIII", 2 * len(name) + 2, kind, 1, left, right, child) + b"\0" * 48
    none = 0xFFFFFFFF
    # a chain to the right under the root is a tree too
    entries = [entry("Root Entry", 5, none, none, 1 if names else none)]
    entries += [entry(n, 2, none, i + 2 if i + 1 < len(names) else none, none) for i, n in enumerate(names)]
    directory = b"".join(entries)
    directory = directory.ljust(-(-len(directory) // sector) * sector, b"\0")
    sectors = len(directory) // sector
    table = [0xFFFFFFFD, *range(2, sectors + 1), 0xFFFFFFFE]
    table += [none] * (sector // 4 - len(table))
    shift = sector.bit_length() - 1
    header = bytes.fromhex("D0CF11E0A1B11AE1") + b"\0" * 16 + struct.pack("<HHHHH", 62, 3 if shift == 9 else 4, 0xFFFE, shift, 6) + b"\0" * 6
    header += struct.pack("<IIIIIIIII", 0, 1, 1, 0, 4096, none - 1, 0, none - 1, 0) + struct.pack("<109I", 0, *[none] * 108)
    return header.ljust(sector, b"\0") + struct.pack(f"<{sector // 4}I", *table) + directory


def zip_file(names: list[str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n in names:
            z.writestr(zipfile.ZipInfo(n), "x")
    return out.getvalue()
