"""File sources and sinks.

Readers take explicit schemas -- no schema inference pass over the data --
and return lazy DataFrames; dates are read as text and parsed by
:func:`claimsight.operators.features.parse_dates`.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight import config as K

CLAIMS_SCHEMA = T.StructType([
    T.StructField("Policy_ID", T.StringType()),
    T.StructField("Customer_ID", T.StringType()),
    T.StructField("Claim_ID", T.StringType()),
    T.StructField("Accident_Date", T.StringType()),
    T.StructField("FNOL_Date", T.StringType()),
    T.StructField("Settlement_Date", T.StringType()),
    T.StructField("Estimated_Claim_Amount", T.DoubleType()),
    T.StructField("Ultimate_Claim_Amount", T.DoubleType()),
    T.StructField("Traffic_Condition", T.StringType()),
    T.StructField("Weather_Condition", T.StringType()),
    T.StructField("Claim_Type", T.StringType()),
])

POLICIES_SCHEMA = T.StructType([
    T.StructField("Policy_ID", T.StringType()),
    T.StructField("Customer_ID", T.StringType()),
    T.StructField("Date_of_Birth", T.StringType()),
    T.StructField("Full_License_Issue_Date", T.StringType()),
    T.StructField("Vehicle_Year", T.IntegerType()),
    T.StructField("Vehicle_Type", T.StringType()),
])

# Columns an upload may carry, with their types (all others stay text).
UPLOAD_TYPES = {
    "Estimated_Claim_Amount": T.DoubleType(), "Ultimate_Claim_Amount": T.DoubleType(),
    "Driver_Age": T.DoubleType(), "License_Age": T.DoubleType(), "Vehicle_Age": T.DoubleType(),
    "FNOL_Delay": T.DoubleType(), "Vehicle_Year": T.IntegerType(),
}


#: Quotes in quoted fields are doubled, and quoted fields may hold line breaks, as spreadsheets write them.
_QUOTED = {"quote": '"', "escape": '"', "lineSep": "\n"}


def _csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE", multi_line: bool = True) -> DataFrame:
    """Header CSV matched to ``schema`` by column *name* (any order).

    Every column is read as text (no inference pass), then cast; text that is
    not a number becomes NULL (:func:`lost_numbers` counts it).  Columns the schema lacks are kept as text;
    schema columns missing from the file are absent from the result.  The files
    of a folder may order their columns differently: files with the same
    header are read together, and the parts are united by name.

    Fields may hold line breaks, so a file is read as one stream by one task (a record at a time): large
    tables come in many files.  ``multi_line=False`` reads large files in splits, for fields without line breaks.
    """
    types = {f.name: f.dataType for f in schema.fields}
    parts = []
    for (header, crlf), files in _headers(spark, path).items():
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        # enforceSchema=false makes Spark check every file's header against the names.
        raw = (spark.read.schema(text).options(**_QUOTED).option("header", True).option("enforceSchema", False)
               .option("multiLine", multi_line).option("mode", mode).csv(files))
        out = []
        for c in header:
            name, value = c.rstrip("\r"), F.col(f"`{c}`")
            if crlf and c == header[-1]:
                value = F.regexp_replace(value, "\r$", "")
            t = types.get(name)
            out.append((value if t is None or isinstance(t, T.StringType) else F.trim(value).try_cast(t)).alias(name))
        parts.append(raw.select(*out))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole


#: Files whose headers one job reads, and most lines of a header (names may hold line breaks).
_HEADER_FILES, _HEADER_LINES = 64, 16


def _headers(spark: SparkSession, path: str) -> dict[tuple[tuple[str, ...], bool], list[str]]:
    """Header, and whether lines end in ``\\r\\n``, -> files under ``path``.

    A task per file reads its first lines and stops; these few lines per file reach the driver.
    """
    files = sorted(spark.read.schema("line string").csv(path).inputFiles())
    groups: dict[str, list[str]] = {}
    for i in range(0, len(files), _HEADER_FILES):
        # Neither separator nor quotes: a line is one field.  Multi-line files are not split, so the limit ends the read at once.
        firsts = [spark.read.schema("line string").options(multiLine=True, sep="\x01", quote="", lineSep="\n")
                  .csv(f).limit(_HEADER_LINES).select(F.lit(k).alias("file"), "line") for k, f in enumerate(files[i:i + _HEADER_FILES])]
        found: dict[int, str] = {}
        for r in functools.reduce(DataFrame.union, firsts).collect():
            if r["file"] not in found:
                found[r["file"]] = r["line"] or ""
            elif found[r["file"]].count('"') % 2:  # a name goes on in this line
                found[r["file"]] += "\n" + (r["line"] or "")
        for k, header in found.items():
            groups.setdefault(header, []).append(files[i + k])
    out: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for header, some in groups.items():
        names = spark.read.options(**_QUOTED, header=True, multiLine=True).csv(some[0]).columns
        out.setdefault((tuple(names), header.endswith("\r")), []).extend(some)
    if not out:
        raise FileNotFoundError(f"no CSV header under {path}")
    return out


def lost_numbers(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row: per numeric column of ``schema`` in the files, how many non-blank values the reader makes NULL."""
    raw = _csv(spark, path, T.StructType([]))
    kinds = {f.name: f.dataType for f in schema.fields if f.name in raw.columns and not isinstance(f.dataType, T.StringType)}
    text = {c: F.trim(F.col(f"`{c}`")) for c in kinds}
    return raw.agg(*[F.count_if((text[c] != "") & text[c].try_cast(t).isNull()).alias(c) for c, t in kinds.items()])


#: Columns of a record that reach Python one by one; those beyond go as an array, only if one of them has a value.
_NEAR_COLUMNS = 16


def csv_stream(spark: SparkSession, in_dir: str, columns: Sequence[str], max_files_per_trigger: int | None = None,
               most_columns: int = 256) -> DataFrame:
    """Arriving header CSV files as a stream of text ``columns``, found by name in the header of each file.

    Fields may be quoted and hold line breaks, so a file is one task's stream; its first record is the header.  Other
    columns are left out.  A file without one of the columns, or with more than ``most_columns``, stops the stream.
    """
    width = most_columns + 1
    # With a column more than is read, the parser fills short records up; otherwise each column that a record lacks costs an exception.
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width + 1)])
    reader = spark.readStream.schema(wide).options(**_QUOTED).option("header", False).option("multiLine", True).option("columnPruning", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    near = min(_NEAR_COLUMNS, width)
    far = [F.col(f"c{i}") for i in range(near, width)]
    rest = F.when(F.coalesce(*far).isNotNull(), F.array(*far)) if far else F.lit(None).cast("array<string>")
    raw = reader.csv(in_dir).select(*[f"c{i}" for i in range(near)], rest.alias("rest"), F.col("_metadata.file_path").alias("file"))
    columns = list(columns)

    def column(batch: pa.RecordBatch, i: int) -> pa.Array:
        return batch.column(i) if i < near else pc.list_element(batch.column(near), i - near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, places, crlf = None, [], -1
        for batch in batches:
            files = batch.column(near + 1).to_pylist()
            at = 0
            while at < len(files):
                end = at + 1
                while end < len(files) and files[end] == files[at]:
                    end += 1
                if files[at] != now:
                    now = files[at]
                    header = [batch.column(i)[at].as_py() for i in range(near)]
                    header += batch.column(near)[at].as_py() or [None] * (width - near)
                    names = [(c or "").removeprefix("\ufeff").strip() for c in header]
                    missing = [c for c in columns if c not in names]
                    if missing or header[most_columns] is not None:
                        raise ValueError(f"{now}: " + (f"no column {', '.join(missing)}" if missing else f"over {most_columns} columns"))
                    places = [names.index(c) for c in columns]
                    last = max(i for i, c in enumerate(header) if c is not None)
                    crlf = last if header[last].endswith("\r") else -1
                    at += 1
                values = [column(batch, i).slice(at, end - at) for i in places]
                yield pa.RecordBatch.from_arrays([pc.utf8_rtrim(v, "\r") if i == crlf else v for i, v in zip(places, values)], names=columns)
                at = end

    return raw.mapInArrow(run, T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def typed_or_rejected(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast by ``schema`` (dates zone-free); ``Rejected`` lists the columns whose text can't be cast, NULL for good rows."""
    typed, bad = {}, []
    for f in schema.fields:
        kind = T.TimestampNTZType() if f.name in K.DATE_COLUMNS else f.dataType
        if not isinstance(kind, T.StringType):
            value = F.trim(F.col(f.name))
            typed[f.name] = value.try_cast(kind)
            bad.append(F.when((value != "") & typed[f.name].isNull(), F.lit(f.name)))
    rejected = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return raw.withColumns(typed | {"Rejected": F.when(F.size(rejected) > 0, F.array_join(rejected, ","))})


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    """Claims CSV with header (S1); columns matched by header name."""
    return _csv(spark, path, CLAIMS_SCHEMA)


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    """Policyholders CSV with header."""
    return _csv(spark, path, POLICIES_SCHEMA)


class UploadError(ValueError):
    """The whole upload is rejected (malformed dates or numbers)."""


def read_upload(spark: SparkSession, path: str, header_schema: T.StructType | None = None) -> DataFrame:
    """Bulk upload CSV (S2): known numeric columns typed, five dates parsed.

    Any malformed date or number rejects the whole upload, like the
    reference.  The check is one aggregate pass counting unparseable values;
    the returned DataFrame is lazy.  ``header_schema`` lists the upload's
    columns as text (defaults to the headers of the files).
    """
    wanted = header_schema.fields if header_schema is not None else []
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    raw = _csv(spark, path, text, mode="FAILFAST")
    casts = {}
    for c in raw.columns:
        if c in K.DATE_COLUMNS:
            casts[c] = (F.trim(F.col(c)).try_cast(T.TimestampNTZType()), T.TimestampNTZType())
        elif c in UPLOAD_TYPES:
            casts[c] = (F.trim(F.col(c)).try_cast(UPLOAD_TYPES[c]), UPLOAD_TYPES[c])
    if casts:
        bad = raw.agg(*[F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & expr.isNull()).alias(c)
                        for c, (expr, _) in casts.items()]).first()
        problems = {c: bad[c] for c in casts if bad[c]}
        if problems:
            raise UploadError("Error loading file: unparseable values " +
                              ", ".join(f"{c}={n}" for c, n in problems.items()))
    return raw.withColumns({c: expr for c, (expr, _) in casts.items()})


#: Most rows of a written CSV file.
_FILE_ROWS = 100_000


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored rows to CSV with a header, no index.

    Written in parallel, at least one file per partition (a file with line breaks is read by one task, so none gets
    over ``_FILE_ROWS`` rows); timestamps as text.  Fields with quotes, commas or line breaks are
    quoted and their quotes doubled; white space stays as it is.  NULL is an empty field, which reads back as NULL, as does empty text.
    """
    out = df.select(*[F.col(f.name).cast("string").alias(f.name)
                      if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType,
                                                 T.ArrayType, T.MapType, T.StructType))
                      else F.col(f.name) for f in df.schema.fields])
    (out.write.mode(mode).options(**_QUOTED).option("header", True).option("maxRecordsPerFile", _FILE_ROWS)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def append_prediction_log(df: DataFrame, path: str) -> None:
    """Append scored claims with a ``scored_at`` timestamp to the history table.

    A job run again appends again; :func:`claimsight.sources.history.append_batch` writes a batch once.
    """
    df.withColumn("scored_at", F.localtimestamp()).write.mode("append").parquet(path)
