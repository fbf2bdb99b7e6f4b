"""Incremental file ingest (CSV, JSON, Parquet, ORC, text) with schema inference, hints,
evolution and a rescued-data column.

Spark's CSV stream needs one fixed schema and matches columns by position, so the
stream here carries the *file list* (``binaryFile`` with its content pruned: only path,
modification time and length are read); the throttles, ``maxFileAge``, ``pathGlobFilter`` and
``includeExistingFiles`` act on that list.

Schema.  Before the stream starts, a run looks at all files that are new since the last one: on the first
run every column gets the narrowest type that all its values convert to, over all of them; later, in
``addNewColumns`` mode, columns that the saved schema lacks are added likewise.  So types do not depend on how
files are dealt to micro-batches.  Hints override; the schema is saved at ``schema_location``.

Each micro-batch then, in executors:

1. reads the first line of each CSV file (only its first bytes), or the schema in the footer of each
   Parquet and ORC file, and groups files by it; only file names and these strings reach the driver;
2. reads each group with Spark's reader: CSV under an all-string schema in the header's order, JSON as a
   map from field to text, Parquet and ORC under their own types; names are matched without regard to case;
3. converts with ``try_cast`` (ANSI ``cast`` would abort the job on one bad value); values that do not
   convert, columns the schema does not know, fields of a row beyond its header, and lines that are not
   JSON go to ``_rescued_data`` as a JSON object (NULL for clean rows).  Without a rescue column they
   fail the batch;
4. writes the rows to the bronze table partitioned by ``__batch_id`` and ``__batch_part`` with dynamic
   overwrite, so a replayed batch replaces its own output instead of duplicating it.  A micro-batch has
   more than one part only if both throttles are set: the stream takes the file count, and its
   files, by modification time, are cut into parts within the byte limit (one file at least).

A name that a header repeats gets ``_<position>`` appended; an empty name is ``_c<position>``.
"""

from __future__ import annotations

import csv
import functools
import io
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from levain.session import settings

FILE_LIST_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
EVOLUTION_MODES = ("addNewColumns", "rescue", "failOnNewColumns")
DEFAULT_MAX_FILES_PER_TRIGGER = 1000
#: Files whose first line or footer one task reads.
PROBE_FILES = 64
#: Tasks that list the files of a batch (Spark takes one for each file, if there are under 10,000).
LIST_TASKS = 64
#: What the ingest adds to bronze beside the data and the file's name and time.
BATCH_COLUMNS = ("__batch_id", "__batch_part")
ENTRIES = "array<struct<key:string,value:string>>"
#: Formats that have neither columns nor types to evolve.
PLAIN_FORMATS = ("text", "binaryFile")


class NewColumnsError(RuntimeError):
    """Raised in ``failOnNewColumns`` mode when files bring columns the schema lacks."""


def parse_size(v) -> int:
    """'10g' / '512m' / '1024' -> bytes."""
    if v is None:
        return None
    if isinstance(v, int):
        return v
    m = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", str(v).lower())
    if not m:
        raise ValueError(f"cannot parse size {v!r}")
    return int(m.group(1)) * 1024 ** "_kmgtp".index(m.group(2) or "_")


def parse_age(v) -> str | None:
    """'365 days' / '12 hours' / '7d' -> Spark's compact duration ('365d')."""
    if v is None:
        return None
    m = re.fullmatch(r"\s*(\d+)\s*(d|day|days|h|hour|hours|m|min|minutes|s|sec|seconds)?\s*", str(v).lower())
    if not m:
        raise ValueError(f"cannot parse age {v!r}")
    unit = {"d": "d", "day": "d", "days": "d", "h": "h", "hour": "h", "hours": "h", "m": "m", "min": "m",
            "minutes": "m", "s": "s", "sec": "s", "seconds": "s", None: "d"}[m.group(2)]
    return f"{m.group(1)}{unit}"


def header_columns(line: str, delimiter: str = ",", quote: str = '"', escape: str = "\\") -> list[str]:
    """Split one header line with the file's dialect."""
    reader = csv.reader(io.StringIO(line), delimiter=delimiter, quotechar=quote or '"',
                        escapechar=escape if escape and escape != quote else None)
    row = next(reader, [])
    return [c.strip() for c in row]


def _first_line(path: str, encoding: str = "UTF-8", sep: str = "\n") -> str:
    """The first line of a file, reading only as many bytes as it takes."""
    import pyarrow.fs as pafs
    fs, inner = pafs.FileSystem.from_uri(path)
    buf = b""
    with fs.open_input_stream(inner) as f:
        while True:
            chunk = f.read(65536)
            buf += chunk
            text = buf.decode(encoding, errors="ignore")
            if sep in text or not chunk:
                break
    line = text.split(sep, 1)[0]
    return line[:-1] if sep == "\n" and line.endswith("\r") else line


def _footer(path: str, fmt: str) -> str:
    """The schema in a Parquet or ORC file's footer, as text."""
    import pyarrow.fs as pafs
    fs, inner = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(inner) as f:
        if fmt == "parquet":
            import pyarrow.parquet as pq
            return pq.read_schema(f).remove_metadata().to_string()
        from pyarrow import orc
        return orc.ORCFile(f).schema.remove_metadata().to_string()


def column_names(header: list[str]) -> list[str]:
    """Names of a header's columns: empty and repeated ones (without regard to case) are told apart by position."""
    out, seen = [], set()
    for n, c in enumerate(header):
        name = c or f"_c{n}"
        if name.lower() in seen:
            name = f"{name}_{n}"
        seen.add(name.lower())
        out.append(name)
    return out


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider number, else text."""
    order = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()]
    a, b = (T.DoubleType() if isinstance(t, T.FloatType) and a != b else t for t in (a, b))
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    return order[max(order.index(a), order.index(b))] if a in order and b in order else T.StringType()


def _ddl_hints(spark: SparkSession, hints: str) -> T.StructType:
    return spark.createDataFrame([], hints).schema


@dataclass
class FileIngest:
    """One incremental file source feeding one bronze table.

    ``path`` may be a glob (``.../suppliers_*.csv``).  ``options`` are reader options for the
    format.  ``schema`` fixes the schema (no inference, no header scan for CSV without
    evolution); otherwise types are inferred when ``infer_column_types`` else strings.
    """

    spark: SparkSession
    path: str
    target: str
    checkpoint: str
    schema_location: str
    format: str = "csv"
    options: dict = field(default_factory=dict)
    schema: T.StructType | None = None
    infer_column_types: bool = True
    schema_hints: str | None = None
    evolution_mode: str = "addNewColumns"
    rescued_data_column: str | None = "_rescued_data"
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | str | None = None
    max_file_age: str | None = None
    include_existing_files: bool = True
    path_glob_filter: str | None = None
    file_metadata: bool = True

    def __post_init__(self):
        self._looked: frozenset[str] = frozenset()  # files that the run has looked at, with the fields found in them
        self._looked_found = None
        if self.evolution_mode not in EVOLUTION_MODES:
            raise ValueError(f"evolution_mode must be one of {EVOLUTION_MODES}")
        if self.evolution_mode == "rescue" and not self.rescued_data_column:
            raise ValueError("evolution_mode 'rescue' needs a rescued_data_column")

    # ---------------------------------------------------------------- schema persistence
    def _schema_file(self) -> str:
        return f"{self.schema_location.rstrip('/')}/_schemas"

    def saved_schema(self) -> T.StructType | None:
        try:
            rows = self.spark.read.text(self._schema_file()).collect()  # one small JSON line per revision
        except AnalysisException:
            return None
        if not rows:
            return None
        latest = max(rows, key=lambda r: json.loads(r.value)["revision"])
        return T.StructType.fromJson(json.loads(latest.value)["schema"])

    def _save_schema(self, schema: T.StructType) -> None:
        prev = self.saved_schema()
        rev = 0
        if prev is not None:
            rev = len(self.spark.read.text(self._schema_file()).collect())
        line = json.dumps({"revision": rev, "schema": schema.jsonValue()})
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(self._schema_file())

    # ---------------------------------------------------------------- the stream
    def file_stream(self) -> DataFrame:
        r = self.spark.readStream.format("binaryFile").schema(FILE_LIST_SCHEMA)
        if self.path_glob_filter:
            r = r.option("pathGlobFilter", self.path_glob_filter)
        if self.max_files_per_trigger is None and self.max_bytes_per_trigger is not None:
            r = r.option("maxBytesPerTrigger", parse_size(self.max_bytes_per_trigger))
        else:  # Spark takes one throttle (``_parts`` applies the other); the default bounds the names a batch brings to the driver
            r = r.option("maxFilesPerTrigger", int(self.max_files_per_trigger or DEFAULT_MAX_FILES_PER_TRIGGER))
        if self.max_file_age is not None:
            r = r.option("maxFileAge", parse_age(self.max_file_age))
        return self._eligible(r.load(self.path))

    def _eligible(self, files: DataFrame) -> DataFrame:
        files = files.select("path", "modificationTime", "length")
        if not self.include_existing_files:  # files older than the first start are seen by the stream but never ingested
            files = files.filter(F.unix_micros("modificationTime") > F.lit(self._first_start_time()))
        return files

    def _first_start_time(self) -> int:
        """Microseconds since 1970, recorded beside the checkpoint on the first run; files older than it are skipped."""
        p = f"{self.checkpoint.rstrip('/')}_first_start"
        now = self._note(p)
        if now is None:
            import time
            now = time.time_ns() // 1000
            self._put_note(p, now)
        return now

    def _note(self, path: str) -> int | None:
        try:
            row = self.spark.read.text(path).first()
        except AnalysisException:
            return None
        return int(row.value) if row else None

    def _put_note(self, path: str, value: int) -> None:
        self.spark.createDataFrame([(str(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    def run(self, on_batch=None):
        """Process everything new (availableNow), then stop.  Returns the finished query."""
        key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
        with settings(self.spark, {key: str(min(LIST_TASKS, int(self.spark.conf.get(key))))}):
            return self._run(on_batch)

    def _run(self, on_batch):
        self._looked, self._looked_found = frozenset(), None
        self._look_ahead()

        def fb(files: DataFrame, batch_id: int):
            for part, paths in enumerate(self._parts(files)):
                rows = self.ingest_part(paths, batch_id, part)
                if on_batch is not None:
                    on_batch(batch_id, rows)
        q = (self.file_stream().writeStream.foreachBatch(fb).option("checkpointLocation", self.checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    def _look_ahead(self) -> None:
        """Settle the schema over all files that are new since the last run, before any of them is ingested."""
        first = self.saved_schema() is None
        if self.schema is not None or self.format in PLAIN_FORMATS or not (first or self.evolution_mode == "addNewColumns"):
            return
        if self.format == "csv" and self._opts()["header"] != "true":
            return
        seen = f"{self.schema_location.rstrip('/')}/_seen"
        r = self.spark.read.format("binaryFile")
        if self.path_glob_filter:
            r = r.option("pathGlobFilter", self.path_glob_filter)
        try:
            files = self._eligible(r.load(self.path))
        except AnalysisException:  # nothing there yet
            return
        files = files.withColumn("at", F.unix_millis("modificationTime"))
        if self.max_file_age is not None:  # as the stream does: counted from the newest file
            newest = files.agg(F.max("modificationTime")).first()[0]
            if newest is not None:
                unit = {"d": "DAY", "h": "HOUR", "m": "MINUTE", "s": "SECOND"}
                age = parse_age(self.max_file_age)
                files = files.filter(F.col("modificationTime") >= F.lit(newest) - F.expr(f"INTERVAL {age[:-1]} {unit[age[-1]]}"))
        upto = self._note(seen)
        if upto is not None and not first:
            files = files.filter(F.col("at") >= upto)
        found = files.select("path", "at").collect()  # names of the new files, as Spark's own reader lists them
        if found:
            groups = self._groups([f.path for f in found])
            self._target_schema(groups)
            if self.format == "json":
                self._looked, self._looked_found = frozenset(f.path for f in found), self._json_found
            self._put_note(seen, max(f.at for f in found))

    def _parts(self, files: DataFrame) -> list[list[str]]:
        """The batch's files in one part, or in parts within the byte limit if both throttles are set."""
        found = sorted(files.select("modificationTime", "path", "length").distinct().collect())  # the batch's file names
        if not found:
            return []
        limit = parse_size(self.max_bytes_per_trigger) if self.max_files_per_trigger is not None else None
        parts, held = [[]], 0
        for f in found:
            if limit is not None and parts[-1] and held + f.length > limit:
                parts.append([])
                held = 0
            parts[-1].append(f.path)
            held += f.length
        return parts

    def bronze_schema(self) -> T.StructType | None:
        """Schema of the bronze table, from the saved one; None if nothing has been ingested."""
        data = T.StructType([T.StructField("value", T.StringType())]) if self.format == "text" else self.schema or self.saved_schema()
        if data is None:
            return None
        out = [T.StructField(f.name, f.dataType, True) for f in data.fields]
        if self.rescued_data_column and self.format not in PLAIN_FORMATS:
            out.append(T.StructField(self.rescued_data_column, T.StringType()))
        if self.file_metadata:
            out += [T.StructField("file_name", T.StringType()), T.StructField("file_timestamp", T.TimestampType())]
        return T.StructType([*out, *(T.StructField(c, T.IntegerType()) for c in BATCH_COLUMNS)])

    def read(self) -> DataFrame:
        """The bronze table under the saved schema (files written before a column was added have NULLs)."""
        schema = self.bronze_schema()
        return (self.spark.read if schema is None or self.format == "binaryFile" else self.spark.read.schema(schema)).parquet(self.target)

    # ---------------------------------------------------------------- one micro-batch
    def ingest_part(self, paths: list[str], batch_id: int, part: int = 0) -> DataFrame:
        if self.format in PLAIN_FORMATS:
            rows = self._with_meta(self.spark.read.options(**self._opts()).format(self.format).load(paths))
            rows = self._finish(rows, [F.col(c) for c in rows.columns if not c.startswith("__file_")])
        else:
            groups = self._groups(paths)
            schema = self._target_schema(groups)
            rows = functools.reduce(DataFrame.unionByName, (self._typed(g, schema) for g in groups))
        rows = rows.withColumn("__batch_id", F.lit(int(batch_id))).withColumn("__batch_part", F.lit(part))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*BATCH_COLUMNS).parquet(self.target))
        return rows

    def _opts(self) -> dict:
        o = {"header": "true"} if self.format == "csv" else {}
        o.update({k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in self.options.items()})
        return o

    def _by_probe(self, paths: list[str], probe) -> dict[str, list[str]]:
        """What ``probe`` says of a file -> files, in tasks that open a share of the files each."""
        def run(batches):
            import pyarrow as pa
            for x in batches:
                files = x.column(0).to_pylist()
                yield pa.record_batch([x.column(0), pa.array([probe(p) for p in files], pa.string())], ["p", "h"])
        files = self.spark.createDataFrame([(p,) for p in paths], "p string").repartition(-(-len(paths) // PROBE_FILES))
        return self._grouped(files.mapInArrow(run, "p string, h string"))

    @staticmethod
    def _grouped(probed: DataFrame) -> dict[str, list[str]]:
        groups: dict[str, list[str]] = {}
        for r in probed.collect():  # one row for each file
            groups.setdefault(r.h or "", []).append(r.p)
        return {h: sorted(groups[h]) for h in sorted(groups)}

    def _headers(self, paths: list[str]) -> dict[str, list[str]]:
        """header line -> files having it; by a text scan where Arrow does not know the paths' scheme."""
        import pyarrow as pa
        import pyarrow.fs as pafs
        opts = self._opts()
        encoding, sep = opts.get("encoding", opts.get("charset", "UTF-8")), opts.get("lineSep", "\n")
        try:
            pafs.FileSystem.from_uri(paths[0])
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
            return self._grouped(self._first_lines_scan(paths, opts))
        return self._by_probe(paths, lambda p: _first_line(p, encoding, sep))

    def _first_lines_scan(self, paths: list[str], opts: dict) -> DataFrame:
        reader = self.spark.read
        if "lineSep" in opts:
            reader = reader.option("lineSep", opts["lineSep"])
        t = reader.option("encoding", opts.get("encoding", "UTF-8")).text(paths)
        return (t.select("value", F.col("_metadata.file_path").alias("p"),
                         F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
                .filter(F.col("b") == 0).groupBy("p").agg(F.min_by("value", "i").alias("h")))

    def _groups(self, paths: list[str]) -> list[DataFrame]:
        """The files as DataFrames, one for each header or footer schema: the data columns, ``__extra`` (array of
        (key, value) that belongs to no column), ``__file_path`` and ``__file_time``."""
        return {"csv": self._csv_groups, "json": self._json_groups}.get(self.format, self._columnar_groups)(paths)

    def _csv_groups(self, paths: list[str]) -> list[DataFrame]:
        opts = self._opts()
        delim, quote, esc = opts.get("delimiter", opts.get("sep", ",")), opts.get("quote", '"'), opts.get("escape", "\\")
        if opts["header"] == "true":
            named = [(column_names(header_columns(h.lstrip("\ufeff"), delim, quote, esc)), files) for h, files in self._headers(paths).items()]
        else:
            base = self.schema or self.saved_schema()
            if base is None:
                raise ValueError("CSV without header needs an explicit schema")
            named = [(base.fieldNames(), paths)]
        q, e, d = (re.escape(x) for x in (quote, esc, delim))
        inside = f"[^{q}]|{q}{q}" if esc in ("", quote) else f"[^{q}{e}]|{e}.|{q}{q}"
        one_field = (rf"{q}(?:{inside})*+{q}|" if quote else "") + rf"(?:(?!{d}).)*"
        out = []
        for cols, files in named:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cols, "__record"]])
            df = self.spark.read.options(**{**opts, "enforceSchema": "true", "columnNameOfCorruptRecord": "__record"}).schema(schema).csv(files)
            # a record of another length than its header comes back as text, too: keep the fields beyond it
            fields = F.regexp_extract_all(F.concat(F.lit(delim), F.col("__record")), F.lit(rf"(?s){d}\s*({one_field})"), F.lit(1))
            beyond = F.slice(fields, len(cols) + 1, 2**31 - 1 - len(cols))
            unquoted = F.transform(beyond, lambda x: F.regexp_replace(F.trim(x), rf"(?s)^{q}(.*){q}$", "$1") if quote else F.trim(x))
            extra = F.transform(unquoted, lambda x, i: F.struct(F.concat(F.lit("_c"), (i + len(cols)).cast("string")).alias("key"), x.alias("value")))
            extra = F.filter(F.coalesce(extra, F.array().cast(ENTRIES)), lambda x: x["value"] != "")
            out.append(self._with_meta(df.withColumn("__extra", extra).drop("__record")))
        return out

    def _json_groups(self, paths: list[str]) -> list[DataFrame]:
        opts = self._opts()
        lines = self.spark.read.text(paths, wholetext=opts.get("multiLine", "false") == "true")
        # a top-level array is a row for each of its elements, as Spark's reader has it
        records = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<map<string,string>>", opts)).otherwise(F.array(F.from_json("value", "map<string,string>", opts)))
        lines = self._with_meta(lines).withColumn("__record", F.explode(F.coalesce(records, F.array(F.lit(None).cast("map<string,string>")))))
        lines = lines.withColumn("__entries", F.map_entries("__record")).withColumn("__keys", F.transform("__entries", lambda e: F.lower(e["key"])))
        known: dict[str, str] = {}
        # of files that were looked at the fields are known; those that a batch lacks are NULL in it
        self._json_found = self._looked_found if self._looked.issuperset(paths) else self._json_schema(paths)
        for f in self._json_found.fields:
            known.setdefault(f.name.lower(), f.name)

        def value(low: str) -> Column:  # of fields that differ in case only the first is the column's
            at = F.array_position("__keys", F.lit(low))
            return F.when(at > 0, F.get("__entries", (at - 1).cast("int"))["value"])

        again = F.transform("__entries", lambda e, i: F.when(F.array_position("__keys", F.lower(e["key"])) <= i, F.struct(
            F.concat(e["key"], F.lit("#"), i.cast("string")).alias("key"), e["value"].alias("value"))))
        text = F.trim("value")
        broken = F.array(F.struct(F.lit("_corrupt_record").alias("key"), F.col("value").alias("value")))
        extra = F.when(F.col("__entries").isNotNull() & ((F.size("__entries") > 0) | text.rlike(r"^\{\s*\}$")), F.filter(again, lambda x: x.isNotNull() & x["value"].isNotNull())).otherwise(broken)
        return [lines.filter(text != "").select(*(value(low).alias(name) for low, name in known.items()), extra.cast(ENTRIES).alias("__extra"), "__file_path", "__file_time")]

    def _json_schema(self, paths: list[str]) -> T.StructType:
        """Names and types in JSON files; fields that differ in case only are one."""
        key = "spark.sql.caseSensitive"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "true")  # the reader refuses names that differ in case only
        try:
            found = self.spark.read.options(**{**self._opts(), "columnNameOfCorruptRecord": "__record"}).json(paths).schema
        finally:
            self.spark.conf.set(key, before)
        return self._merged([found])

    def _columnar_groups(self, paths: list[str]) -> list[DataFrame]:
        fmt, opts = self.format, self._opts()
        groups = self._by_probe(paths, lambda p: _footer(p, fmt))
        return [self._with_meta(self.spark.read.options(**opts).format(fmt).load(files)).withColumn("__extra", F.array().cast(ENTRIES)) for files in groups.values()]

    @staticmethod
    def _data_fields(df: DataFrame) -> list[T.StructField]:
        return [f for f in df.schema.fields if f.name not in ("__extra", "__file_path", "__file_time")]

    @staticmethod
    def _merged(schemas: list[T.StructType]) -> T.StructType:
        out: dict[str, T.StructField] = {}
        for f in (f for s in schemas for f in s.fields if f.name != "__record"):
            old = out.get(f.name.lower())
            out[f.name.lower()] = T.StructField(old.name, wider(old.dataType, f.dataType)) if old else T.StructField(f.name, f.dataType)
        return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in out.values()])

    def _found(self, groups: list[DataFrame], only: set[str] | None = None) -> T.StructType:
        """Names and narrowest types of the groups' columns (of those in ``only``, in lower case, if given)."""
        merged = self._merged([T.StructType(self._data_fields(g)) for g in groups])
        names = [f.name for f in merged.fields if only is None or f.name.lower() in only]
        if self.format in ("parquet", "orc"):
            return T.StructType([merged[n] for n in names])
        if not self.infer_column_types:
            return T.StructType([T.StructField(n, T.StringType()) for n in names])
        if self.format == "json":
            return T.StructType([f for f in self._json_found.fields if only is None or f.name.lower() in only])
        low = {n.lower(): n for n in names}
        parts = [g.select(*(F.col(f"`{f.name}`").alias(low[f.name.lower()]) for f in self._data_fields(g) if f.name.lower() in low)) for g in groups]
        return self._infer(functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), names)

    def _with_meta(self, df: DataFrame) -> DataFrame:
        return df.select("*", F.col("_metadata.file_path").alias("__file_path"),
                         F.col("_metadata.file_modification_time").alias("__file_time"))

    def _infer(self, raw: DataFrame, cols: list[str]) -> T.StructType:
        """Narrowest type per column that every non-NULL value converts to (one aggregate)."""
        opts = self._opts()
        ts_fmt = opts.get("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        date_fmt = opts.get("dateFormat", "yyyy-MM-dd")
        candidates = [
            ("int", lambda c: F.expr(f"try_cast(`{c}` AS INT)")),
            ("bigint", lambda c: F.expr(f"try_cast(`{c}` AS BIGINT)")),
            ("double", lambda c: F.expr(f"try_cast(`{c}` AS DOUBLE)")),
            # only the words true / false (try_cast would also take y, n, 1, 0)
            ("boolean", lambda c: F.when(F.lower(F.trim(F.col(f"`{c}`"))).isin("true", "false"),
                                         F.expr(f"try_cast(`{c}` AS BOOLEAN)"))),
            ("date", lambda c: F.to_date(F.expr(f"try_to_timestamp(`{c}`, '{date_fmt}')"))),
            ("timestamp_ntz", lambda c: F.expr(f"try_to_timestamp(`{c}`, '{ts_fmt}')")),
        ]
        aggs = [F.count_if(F.col(f"`{c}`").isNotNull()).alias(f"n::{c}") for c in cols]
        for c in cols:
            for name, conv in candidates:
                aggs.append(F.count_if(F.col(f"`{c}`").isNotNull() & conv(c).isNull()).alias(f"{name}::{c}"))
        stats = raw.agg(*aggs).first().asDict()  # one row of counters
        fields = []
        for c in cols:
            chosen = "string"
            if stats[f"n::{c}"] > 0:
                for name, _ in candidates:
                    if stats[f"{name}::{c}"] == 0:
                        chosen = name
                        break
            fields.append(T.StructField(c, T._parse_datatype_string(chosen), True))
        return T.StructType(fields)

    def _convert(self, text: Column, dtype: T.DataType) -> Column:
        """``text`` as ``dtype``; NULL where it does not convert."""
        opts = self._opts()
        if isinstance(dtype, T.StringType):
            return text
        if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(text, dtype, {"mode": "PERMISSIVE"})
        if self.format not in ("csv", "json"):
            return text.try_cast(dtype)
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            # text without a zone is a local date-time: parse in the session zone, keep the wall clock
            return F.try_to_timestamp(text, F.lit(opts.get("timestampFormat", "yyyy-MM-dd HH:mm:ss"))).cast(dtype)
        if isinstance(dtype, T.DateType):
            return F.to_date(F.try_to_timestamp(text, F.lit(opts.get("dateFormat", "yyyy-MM-dd"))))
        return text.try_cast(dtype)

    def _target_schema(self, groups: list[DataFrame]) -> T.StructType:
        """The schema that holds for these files; a first or widened one is saved."""
        if self.schema is not None:
            return self.schema
        saved = self.saved_schema()
        hints = {f.name.lower(): f.dataType for f in _ddl_hints(self.spark, self.schema_hints).fields} if self.schema_hints else {}

        def hinted(s: T.StructType) -> T.StructType:
            return T.StructType([T.StructField(f.name, hints.get(f.name.lower(), f.dataType), True) for f in s.fields])

        if saved is None:
            schema = hinted(self._found(groups))
            self._save_schema(schema)
            return schema
        known = {f.name.lower() for f in saved.fields}
        new = {f.name.lower(): f.name for g in groups for f in self._data_fields(g) if f.name.lower() not in known}
        if not new or self.evolution_mode == "rescue":
            return saved
        if self.evolution_mode == "failOnNewColumns":
            raise NewColumnsError(f"new columns {sorted(new.values())} in {self.path}; schema at {self.schema_location}")
        schema = T.StructType([*saved.fields, *hinted(self._found(groups, set(new))).fields])
        self._save_schema(schema)
        return schema

    def _typed(self, raw: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows of one group under ``schema``, with what does not fit in the rescue column."""
        have = {f.name.lower(): f for f in self._data_fields(raw)}
        typed, entries = [], []

        def entry(name: str, value: Column) -> Column:
            return F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))

        def as_text(f: T.StructField) -> Column:
            nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
            return F.to_json(F.col(f"`{f.name}`")) if nested else F.col(f"`{f.name}`").cast("string")

        for f in schema.fields:
            src = have.pop(f.name.lower(), None)
            if src is None:
                typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            elif src.dataType == f.dataType:
                typed.append(F.col(f"`{src.name}`").alias(f.name))
            else:
                value = self._convert(as_text(src), f.dataType)
                typed.append(value.alias(f.name))
                entries.append(F.when(F.col(f"`{src.name}`").isNotNull() & value.isNull(), entry(src.name, as_text(src))))
        entries += [F.when(F.col(f"`{f.name}`").isNotNull(), entry(f.name, as_text(f))) for f in have.values()]
        rescued = F.filter(F.concat(F.array(*entries).cast(ENTRIES), F.col("__extra")) if entries else F.col("__extra"), lambda x: x.isNotNull())
        lost = F.when(F.size(rescued) > 0, F.to_json(F.map_from_entries(rescued)))
        if self.rescued_data_column:
            return self._finish(raw, [*typed, lost.alias(self.rescued_data_column)])
        # no place for what does not fit: the batch fails
        fits = F.when(lost.isNotNull(), F.raise_error(F.concat(F.lit("values that do not fit the schema: "), lost)).cast("boolean")).otherwise(F.lit(True))
        return self._finish(raw.filter(fits), typed)

    def _finish(self, rows: DataFrame, cols: list[Column]) -> DataFrame:
        meta = [F.col("__file_path").alias("file_name"), F.col("__file_time").alias("file_timestamp")] if self.file_metadata else []
        return rows.select(*cols, *meta)
