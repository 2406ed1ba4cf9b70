"""What Spark's own readers can't say: repeated JSON keys, byte ranges of lines, members of archives."""

from __future__ import annotations

import hashlib
import io
import json
import posixpath
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def _findings(text: str | None) -> list[str]:
    found = set()

    def pairs(items):
        if len({k for k, _ in items}) < len(items):
            found.add("parse.duplicate_key")
        return dict(items)

    def constant(_):
        found.add("parse.non_finite_number")

    try:
        json.loads(text or "", object_pairs_hook=pairs, parse_constant=constant)
    except (ValueError, RecursionError):
        found.add("parse.malformed_json")
    return sorted(found)


def json_findings(raw: DataFrame, column: str = "text") -> DataFrame:
    """raw with findings: malformed JSON, repeated keys, NaN or infinite numbers."""
    schema = StructType([*raw.schema.fields, StructField("findings", ArrayType(StringType()))])

    def run(batches):
        for b in batches:
            yield b.append_column("findings", pa.array([_findings(t) for t in b.column(column).to_pylist()], pa.list_(pa.string())))

    return raw.mapInArrow(run, schema)


def line_ranges(files: DataFrame) -> DataFrame:
    """files(path, content binary): path, line, start, end (bytes, end exclusive) and text of each line that isn't blank."""

    def run(batches):
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                at, rows = 0, []
                for i, line in enumerate((content or b"").split(b"\n")):
                    if line.strip():
                        rows.append((path, i, at, at + len(line.rstrip(b"\r")), line.rstrip(b"\r").decode("utf-8", "replace")))
                    at += len(line) + 1
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["path", "line", "start", "end", "text"])

    return files.select("path", "content").mapInArrow(run, "path string, line long, start long, end long, text string")


def unsafe_name(name: str) -> bool:
    return name.startswith("/") or "\\" in name or ":" in name or ".." in name.split("/") or posixpath.normpath(name) != name.rstrip("/")


def archive_members(files: DataFrame, most_bytes: int = 2 << 30, most_ratio: float = 200.0) -> DataFrame:
    """files(path, content binary): path, member, bytes, sha256 and finding_code of each member of zip archives; unsafe, repeated, oversized and over-compressed ones aren't read."""

    def inspect(path, content):
        try:
            z = zipfile.ZipFile(io.BytesIO(content))
        except zipfile.BadZipFile:
            return [(path, None, None, None, "integrity.archive_unreadable")]
        rows, seen = [], set()
        for m in z.infolist():
            code = (
                "integrity.archive_path_unsafe" if unsafe_name(m.filename) or (m.external_attr >> 28) == 0xA
                else "integrity.archive_member_repeated" if m.filename in seen
                else "integrity.archive_member_too_large" if m.file_size > most_bytes
                else "integrity.archive_ratio_exceeded" if m.file_size > most_ratio * max(m.compress_size, 1) else None
            )
            seen.add(m.filename)
            digest = None
            if code is None and not m.is_dir():
                h = hashlib.sha256()
                with z.open(m) as f:
                    while chunk := f.read(1 << 20):
                        h.update(chunk)
                digest = h.hexdigest()
            rows.append((path, m.filename, m.file_size, digest, code))
        return rows

    def run(batches):
        for b in batches:
            rows = [r for p, c in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True) for r in inspect(p, c or b"")]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["path", "member", "bytes", "sha256", "finding_code"])

    return files.select("path", "content").mapInArrow(run, "path string, member string, bytes long, sha256 string, finding_code string")


def mask_json(column, markers: tuple[str, ...] = ("email", "discord", "phone", "attendee", "staff")):
    """JSON text with the values of keys that name personal data replaced, at any depth; unreadable text becomes null."""

    def clean(x):
        if isinstance(x, dict):
            return {k: "[EXCLUDED]" if any(m in "".join(c for c in k.casefold() if c.isalnum()) for m in markers) else clean(v) for k, v in x.items()}
        return [clean(v) for v in x] if isinstance(x, list) else x

    def one(t):
        try:
            return None if t is None else json.dumps(clean(json.loads(t)), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except ValueError:
            return None

    @F.pandas_udf(StringType())
    def masked(s: pd.Series) -> pd.Series:
        return s.map(one)

    return masked(column)
