"""Helpers that write small dump files for tests."""

import gzip
import json
import os


def line(kind_type: str, key: str, rec, revision: int = 1, last_modified: str = "2024-01-01T00:00:00") -> str:
    text = rec if isinstance(rec, str) else json.dumps(rec)
    return f"{kind_type}\t{key}\t{revision}\t{last_modified}\t{text}"


def write_dump(directory: str, kind: str, lines, name: str = "latest", members: int = 1) -> str:
    """Write a (multi-member) gzip dump file with CRLF line ends."""
    os.makedirs(directory, exist_ok=True)
    path = os.path.join(directory, f"ol_dump_{kind}_{name}.txt.gz")
    lines = list(lines)
    chunk = max(1, (len(lines) + members - 1) // members)
    with open(path, "wb") as f:
        for i in range(0, max(len(lines), 1), chunk):
            body = "".join(f"{ln}\r\n" for ln in lines[i:i + chunk])
            f.write(gzip.compress(body.encode("utf-8")))
    return path


def author(key, **rec):
    return line("/type/author", f"/authors/{key}", rec)


def work(key, **rec):
    return line("/type/work", f"/works/{key}", rec)


def edition(key, **rec):
    return line("/type/edition", f"/books/{key}", rec)
