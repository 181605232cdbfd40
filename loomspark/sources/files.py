"""Files in and out: JSON lines, documents, repository trees, transport tables, and written datasets with a manifest."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_BYTES = 1 << 20


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows, and the lines that are no JSON (a torn last line is reported, not fatal)."""
    lines = _lines(spark, path, schema)
    fields = [f.name for f in T._parse_datatype_string(schema).fields]
    return lines.filter("r._corrupt is null").select(*[f"r.{c}" for c in fields]), lines.filter("r._corrupt is not null").select("r._corrupt")


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    whole = T.StructType([*T._parse_datatype_string(schema).fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return spark.read.text(path).filter("trim(value) <> ''").select(parsed.alias("r"), F.struct(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n")).alias("o"))


def read_unique(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The first line of each key, in the order of files and lines."""
    fields = [f.name for f in T._parse_datatype_string(schema).fields]
    good = _lines(spark, path, schema).filter("r._corrupt is null")
    return good.groupBy(F.col(f"r.{key}").alias("_k")).agg(F.min_by("r", "o").alias("r")).select(*[f"r.{c}" for c in fields])


def append_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def capture(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """path, text, skipped (too_large, not_text, reserved) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    reason = F.when(F.col("path").rlike(r"/\.git/"), "reserved").when(F.col("length") > MOST_BYTES, "too_large").when(text.isNull() | F.contains(text, F.lit("\x00")), "not_text")
    return files.select("path", F.when(reason.isNull(), text).alias("text"), reason.alias("skipped"))


def import_all_or_nothing(rows: DataFrame, valid: dict[str, object], known: DataFrame, key: str) -> DataFrame:
    """New rows only, and only if every row is valid; else an error that counts each broken rule."""
    checks = rows.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in valid.items()]).first().asDict()
    broken = {k: v for k, v in checks.items() if v}
    if broken:
        raise ValueError(f"nothing was imported: {broken}")
    return rows.join(known.select(key), key, "left_anti")


def write_dataset(rows: DataFrame, path: str, objective: str) -> dict[str, object]:
    """Write rows once (an existing dataset is never replaced) with a manifest: objective, rows, digest, schema."""
    if rows.isEmpty():
        raise ValueError("an empty dataset is refused")
    rows.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/rows")
    back = rows.sparkSession.read.parquet(f"{path}/rows")
    n, digest = back.agg(F.count(F.lit(1)), F.sum(F.xxhash64(F.to_json(F.struct(*sorted(back.columns)))).cast("decimal(38,0)"))).first()
    manifest = {"objective": objective, "rows": n, "digest": str(digest), "schema": back.schema.simpleString()}
    back.sparkSession.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/manifest")
    return manifest


def ibm_double(raw: bytes) -> float | None:
    """A base-16 floating-point number of up to eight bytes; a missing mark (first byte . _ or A to Z, rest zero) is None."""
    raw = raw.ljust(8, b"\0")
    if raw[1:] == b"\0" * 7 and (raw[0] in b"._" or 65 <= raw[0] <= 90):
        return None
    bits = struct.unpack(">Q", raw)[0]
    fraction = bits & ((1 << 56) - 1)
    return 0.0 if not fraction else (-1.0 if bits >> 63 else 1.0) * fraction / 2.0**56 * 16.0 ** ((bits >> 56 & 0x7F) - 64)


def parse_transport(content: bytes) -> tuple[list[tuple[str, bool, int, int]], list[list[object]]]:
    """Variables (name, numeric, position, length) and rows of the first member of a version 5 transport file: cards of 80
    bytes, a name record of 140 bytes for each variable, then observations padded with blanks."""
    names = content.index(b"HEADER RECORD*******NAMESTR HEADER RECORD")
    count = int(content[names + 54 : names + 58])
    at, variables = names + 80, []
    for k in range(count):
        field = content[at + 140 * k : at + 140 * (k + 1)]
        kind, _, length = struct.unpack(">hhh", field[:6])
        variables.append((field[8:16].decode("ascii").strip(), kind == 1, struct.unpack(">i", field[84:88])[0], length))
    start = content.index(b"HEADER RECORD*******OBS", at) + 80
    width = sum(v[3] for v in variables)
    body = content[start:]
    rows = []
    for k in range(len(body) // width if width else 0):
        row = body[k * width : (k + 1) * width]
        if not row.strip(b" ") and not body[k * width :].strip(b" "):
            break
        rows.append([ibm_double(row[p : p + n]) if numeric else row[p : p + n].decode("latin-1").rstrip() for _, numeric, p, n in variables])
    return variables, rows


def read_transport(spark: SparkSession, path: str) -> DataFrame:
    """path, row, variable, number, text of every cell of the transport files; files are read whole, one in a task."""
    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                variables, rows = parse_transport(content)
                out = [(name, k, v[0], x if v[1] else None, None if v[1] else x) for k, row in enumerate(rows) for v, x in zip(variables, row)]
                yield pd.DataFrame(out, columns=["path", "row", "variable", "number", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(cells, "path string, row bigint, variable string, number double, text string")
