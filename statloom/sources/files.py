"""Files: patterns, grouping, configuration of tables, and record files."""

from __future__ import annotations

import gzip
import io
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

ARCHIVES = (".zip", ".tar", ".tar.gz", ".tgz")


def pattern_regex(pattern: str) -> str:
    """Regular expression of a pattern with ``*`` (within a folder), ``**`` (over folders, not in the name) and
    ``{a,b}``."""
    if "**" in pattern.rsplit("/", 1)[-1]:
        raise ValueError(f"** in a file's name: {pattern}")
    out, i, depth = "", 0, 0
    while i < len(pattern):
        rest = pattern[i:]
        if rest.startswith("/**"):
            out, i = out + "(?:/.*)?", i + 3
        elif rest.startswith("**/"):
            out, i = out + "(?:.*/)?", i + 3
        elif rest.startswith("**"):
            out, i = out + ".*", i + 2
        elif rest[0] == "*":
            alone = (i == 0 or pattern[i - 1] == "/") and (i + 1 == len(pattern) or pattern[i + 1] == "/")
            out, i = out + ("[^/]+" if alone else "[^/]*"), i + 1
        elif rest[0] == "{" and "}" in rest:
            out, i, depth = out + "(?:", i + 1, depth + 1
        elif rest[0] == "}" and depth:
            out, i, depth = out + ")", i + 1, depth - 1
        elif rest[0] == "," and depth:
            out, i = out + "|", i + 1
        else:
            out, i = out + re.escape(rest[0]), i + 1
    return out


def matches(path: str, pattern: str) -> bool:
    """A pattern with a protocol, or that begins with a slash, is for the whole path, another one for its end."""
    protocol, bare = path.split("://", 1) if "://" in path else (None, path)
    if "://" in pattern:
        wanted, body = pattern.split("://", 1)
        return protocol is not None and re.fullmatch(pattern_regex(wanted), protocol) is not None and re.fullmatch(pattern_regex(body), bare) is not None
    if pattern.startswith("/"):
        return re.fullmatch(pattern_regex("/" + pattern.lstrip("/")), "/" + bare.lstrip("/")) is not None
    return re.search(f"^(?:.*?/)?(?:{pattern_regex(pattern)})$", "/" + bare.lstrip("/")) is not None


def discovered(paths: list[str], patterns: list[str], special: dict[str, str] | None = None) -> dict[str, str]:
    """path -> the first pattern it matches; archives and files with a special use are left out."""
    out = {}
    for path in sorted(paths):
        if path.endswith(ARCHIVES) or any(matches(path, s) for s in (special or {}).values()):
            continue
        if found := next((p for p in patterns if matches(path, p)), None):
            out[path] = found
    return out


def listed(spark: SparkSession, folder: str) -> list[str]:
    """All files below a folder of any file system that the session knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    it, out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True), []
    while it.hasNext():
        out.append(it.next().getPath().toString())
    return sorted(out)


def grouped(paths: list[str], delimiter: str | None = None) -> dict:
    """Files of a run by kind, and the delimiter of its tables; CSV and TSV together are an error, and so is an ending
    that nobody reads."""
    kinds: dict[str, list[str]] = {k: [] for k in ("mcf", "tmcf", "csv", "tsv", "jsonld")}
    for p in paths:
        end = p.rsplit(".", 1)[-1].lower()
        end = "jsonld" if end == "json" else end
        if end not in kinds:
            raise ValueError(f"nobody reads {p}")
        kinds[end].append(p)
    if kinds["csv"] and kinds["tsv"]:
        raise ValueError("both CSV and TSV files")
    if kinds["jsonld"] and any(v for k, v in kinds.items() if k != "jsonld"):
        raise ValueError("JSON-LD files go by themselves")
    tables = kinds.pop("csv") + kinds.pop("tsv")
    return kinds | {"tables": tables, "delimiter": delimiter or ("\t" if tables and tables[0].endswith(".tsv") else ",")}


class Config:
    """Configuration of tables: settings of a file are those of the first pattern that it matches."""

    DEFAULTS = {
        "importType": "observations", "format": "variablePerRow", "columnMappings": {}, "computedVariables": [], "eventType": "", "idColumn": "", "entityType": "", "ignoreColumns": [], "provenance": "", "rowEntityType": "",
        "entityColumns": [], "observationProperties": {}, "naValues": [],
    }

    def __init__(self, data: dict) -> None:
        files = data.get("inputFiles", {})
        self.data = data
        self.files: list[tuple[str, dict]] = list(files.items()) if isinstance(files, dict) else [(f.get("pattern") or f["path"], f) for f in files]

    def of(self, path: str, name: str):
        mine = next((c for p, c in self.files if matches(path, p)), {})
        return mine.get(name, self.DEFAULTS.get(name))

    def variable(self, name: str) -> dict:
        given = self.data.get("variables", {}).get(name, {})
        return {"name": given.get("name", name), "description": given.get("description", ""), "group": given.get("group", ""), "searchDescriptions": given.get("searchDescriptions", []), "properties": given.get("properties", {}), "aggregation": given.get("aggregation", {"period": "MONTH", "method": "COUNT"})}

    def flag(self, name: str) -> bool:
        v = self.data.get(name, False)
        return v.lower() in ("true", "1", "yes") if isinstance(v, str) else bool(v)

    def namespace(self) -> str:
        return (self.data.get("customIdNamespace") or "custom").rstrip("/")

    def group_prefix(self) -> str:
        return self.data.get("customSvgPrefix") or f"{self.namespace()}/g/"


# record files
def _masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


_TABLE: list[int] = []


def crc32c(data: bytes) -> int:
    if not _TABLE:
        for i in range(256):
            c = i
            for _ in range(8):
                c = c >> 1 ^ (0x82F63B78 if c & 1 else 0)
            _TABLE.append(c)
    crc = 0xFFFFFFFF
    for b in data:
        crc = _TABLE[(crc ^ b) & 255] ^ crc >> 8
    return crc ^ 0xFFFFFFFF


def frame(record: bytes) -> bytes:
    """A record with its length and check sums."""
    size = struct.pack("<Q", len(record))
    return size + struct.pack("<I", _masked(crc32c(size))) + record + struct.pack("<I", _masked(crc32c(record)))


def frames(data: bytes, check: bool = True) -> Iterator[bytes]:
    """Records of a file of framed records; a wrong sum or a cut end fails."""
    stream = io.BytesIO(data)
    while head := stream.read(12):
        if len(head) < 12:
            raise ValueError("cut in a length")
        size = struct.unpack("<Q", head[:8])[0]
        body, tail = stream.read(size), stream.read(4)
        if len(body) < size or len(tail) < 4 or check and (struct.unpack("<I", head[8:])[0] != _masked(crc32c(head[:8])) or struct.unpack("<I", tail)[0] != _masked(crc32c(body))):
            raise ValueError("damaged record")
        yield body


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol message: whole numbers, 4 or 8 bytes, or bytes."""
    i = 0

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            b = data[i]
            i += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while i < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[i : i + n]
            i += n


_KEYS = {1: "observation_about", 2: "variable_measured", 3: "measurement_method", 4: "observation_period", 5: "scaling_factor", 6: "unit", 7: "provenance_url"}
SERIES = "observation_about string, variable_measured string, measurement_method string, observation_period string, scaling_factor string, unit string, provenance_url string, observations array<struct<date:string,number:double,text:string,dcid:string,local_id:string>>"


def decoded_series(record: bytes) -> dict | None:
    """A record of an optimised graph as a row of ``SERIES``; null where it has no series."""
    series = next((v for n, v in fields(record) if n == 1), None)
    if series is None:
        return None
    row: dict = {k: None for k in _KEYS.values()} | {"observations": []}
    for n, v in fields(series):
        if n == 1:
            row |= {_KEYS[k]: x.decode() for k, x in fields(v) if k in _KEYS}
        elif n == 2:
            o = dict(fields(v))
            text = lambda k: o[k].decode() if k in o else None  # noqa: B023, E731
            row["observations"].append({"date": text(1), "number": struct.unpack("<d", o[2])[0] if 2 in o else None, "text": text(3), "dcid": text(5), "local_id": text(6)})
    return row


def read_records(spark: SparkSession, path: str, packed: bool = True) -> DataFrame:
    """Rows of ``SERIES`` of record files of optimised graphs; a file is read by one task, as its packing demands."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            for content in f["content"]:
                held = []
                for record in frames(gzip.decompress(content) if packed else content):
                    if (row := decoded_series(record)) is not None:
                        held.append(row)
                    if len(held) >= 2000:
                        yield pd.DataFrame(held)
                        held = []
                if held:
                    yield pd.DataFrame(held)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, SERIES)


def series_points(series: DataFrame) -> DataFrame:
    """The observations of optimised series, a row each, numbers without needless digits."""
    from statloom.functions.numbers import format_number

    keys = list(_KEYS.values())
    return series.select(*keys, F.explode("observations").alias("o")).select(*keys, "o.date", F.coalesce(format_number("o.number"), "o.text").alias("value"), "o.dcid")
