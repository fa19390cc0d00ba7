"""File readers, batch and streaming, from one source description."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strataflow.plans.config import Source
from strataflow.sources.rescue import CORRUPT, rescued_csv, rescued_json
from strataflow.sources.schema import apply_hints, conformed, from_ddl, merge, read_as, surely_fits, widest

# Discovery options, which a document may write with a dotted prefix.
DISCOVERY_OPTIONS = (
    "schemaHints", "inferColumnTypes", "schemaEvolutionMode", "schemaLocation", "rescuedDataColumn"
)
#: Where values go that do not fit, unless the source names a column for them.
RESCUED = "_rescued_data"

LISTING_OPTIONS = (
    "maxFilesPerTrigger", "maxBytesPerTrigger", "maxFileAge", "recursiveFileLookup", "pathGlobFilter"
)

FILES_PER_BATCH = 10_000

# Spark's file source forgets, and then ignores, files a week older than the newest one.
# A file that arrives with an old timestamp must not be lost.
KEEP_OLD_FILES = {"maxFileAge": "36500d"}

_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def discovery_option(source: Source, name: str, default: str | None = None) -> str | None:
    for key, value in source.options.items():
        if key.rsplit(".", 1)[-1] == name:
            return value
    return default


def reader_options(source: Source) -> dict[str, str]:
    """Options for Spark's readers; those of the document come last and win."""
    options = {"multiLine": str(source.multi_line).lower()}
    own = {k: v for k, v in source.options.items() if k.rsplit(".", 1)[-1] not in DISCOVERY_OPTIONS}
    return {**options, **own}


def has_header(source: Source) -> bool:
    """Whether the files name their columns in a first line."""
    header = str(reader_options(source).get("header", "false")).lower()
    return source.format.lower() == "csv" and header == "true"


def same_name(spark: SparkSession) -> Callable[[str], str]:
    """What tells one column name from another, by the session's rule."""
    sensitive = str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
    return str if sensitive else str.lower


def typed_reader(spark: SparkSession, source: Source, drop_empty: bool = False):
    """A reader that infers types, unless ``inferColumnTypes`` is false. ``drop_empty``: leave out
    JSON fields that are NULL throughout; else they look like text."""
    reader = spark.read.format(source.format).options(**reader_options(source))
    kind = source.format.lower()
    typed = str(discovery_option(source, "inferColumnTypes", "true")).lower() == "true"
    if kind == "csv":
        return reader.option("inferSchema", str(typed).lower())
    if kind == "json":
        return reader.option("primitivesAsString", str(not typed).lower()).option("dropFieldIfAllNull", str(drop_empty).lower())
    return reader


@dataclass(frozen=True)
class Part:
    """Files that are read alike: one CSV header, or one Parquet layout, and what it looks like."""

    files: list[str]
    found: StructType


def first_header(spark: SparkSession, source: Source, paths: Sequence[str]) -> list[str]:
    """Column names that the reader sees in the first file that has any."""
    return spark.read.format(source.format).options(**reader_options(source)).load(list(paths)).columns


def by_header(spark: SparkSession, source: Source, paths: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """Column names and files, for each different header line among the files.

    First lines are found in one distributed read; what comes back is a line for each
    file. Lines that the CSV reader skips, blank ones and comments, are skipped here.
    """
    options = {k.lower(): v for k, v in reader_options(source).items()}
    reader = spark.read
    if "linesep" in options:
        reader = reader.option("lineSep", options["linesep"])
    if "recursivefilelookup" in options:
        reader = reader.option("recursiveFileLookup", options["recursivefilelookup"])
    if "pathglobfilter" in options:
        reader = reader.option("pathGlobFilter", options["pathglobfilter"])
    lines = reader.text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"),
    )
    is_header = F.trim("value") != ""
    if options.get("comment"):
        is_header &= ~F.startswith("value", F.lit(options["comment"]))
    first = lines.where((F.col("start") == 0) & is_header).groupBy("path").agg(F.min_by("value", "nth").alias("header"))
    files: dict[str, list[str]] = {}
    for row in first.orderBy("path").collect():
        files.setdefault(row["header"], []).append(literal_path(unquote(row["path"])))
    return [(first_header(spark, source, names[:1]), names) for names in files.values()]


def by_layout(spark: SparkSession, source: Source, paths: Sequence[str]) -> list[Part]:
    """Files whose Parquet or ORC schemas merge, together; the others apart.

    One distributed look at the footers where all merge; else the list is halved, and
    halves of one schema join again.
    """
    reader = spark.read.format(source.format).options(**reader_options(source)).option("mergeSchema", "true")

    def looked(files: list[str]) -> list[Part]:
        try:
            return [Part(files, reader.load(files).schema)]
        except Exception as error:  # noqa: BLE001 - the reader has no type of its own for this
            if "MERGE" not in str(error).upper():
                raise
        if len(files) == 1:
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(files[0])
            inner = [literal_path(r["path"]) for r in listed.select("path").orderBy("path").collect()]
            return looked(inner)
        middle = len(files) // 2
        return [*looked(files[:middle]), *looked(files[middle:])]

    joined: dict[str, Part] = {}
    for part in looked(list(paths)):
        known = joined.get(part.found.json())
        joined[part.found.json()] = Part([*known.files, *part.files], part.found) if known else part
    return list(joined.values())


def parts_of(
    spark: SparkSession, source: Source, paths: Sequence[str], uniform: bool = False, drop_empty: bool = False
) -> list[Part]:
    """The files in parts that are read alike, with inferred types.

    ``uniform``: take the first CSV header for that of all files; the read itself checks it.
    """
    kind = source.format.lower()
    if kind in ("parquet", "orc"):
        return by_layout(spark, source, paths)
    reader = typed_reader(spark, source, drop_empty)
    if kind == "json":
        return [Part(list(paths), _json_fields(spark, reader, paths))]
    if not has_header(source) or uniform:
        return [Part(list(paths), reader.load(list(paths)).schema)]
    return [Part(files, reader.load(files).schema) for _, files in by_header(spark, source, paths)]


def _json_fields(spark: SparkSession, reader: DataFrameReader, paths: Sequence[str]) -> StructType:
    """Fields and types in JSON files; a field that is spelled in two ways is there twice."""
    try:
        return reader.load(list(paths)).schema
    except AnalysisException as error:
        if "COLUMN_ALREADY_EXISTS" not in str(error):
            raise
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        return reader.load(list(paths)).schema
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def without_empty(spark: SparkSession, source: Source, part: Part, kept: StructType) -> StructType:
    """What a part looks like, without text columns that hold nothing and that are of another
    type in ``kept``: a column that is NULL throughout looks like text, and says nothing."""
    types = {f.name: f.dataType for f in kept}
    doubtful = [f.name for f in part.found if isinstance(f.dataType, StringType) and not surely_fits(f.dataType, types.get(f.name, f.dataType))]
    if not doubtful:
        return part.found
    reader = spark.read.format(source.format).options(**reader_options(source)).schema(part.found)
    filled = reader.load(part.files).agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in doubtful]).first()
    return StructType([f for f in part.found if f.name not in doubtful or filled[f.name]])


def looks_like(spark: SparkSession, source: Source, parts: Sequence[Part]) -> StructType:
    """Types from all rows of the parts, before hints. A column that is NULL throughout is text."""
    return widest([known_columns(p.found) for p in parts], same_name(spark))


def known_columns(found: StructType) -> StructType:
    """What was inferred, without the reader's own column for broken records."""
    return StructType([f for f in found if f.name != CORRUPT])


def infer_schema(spark: SparkSession, source: Source, paths: Sequence[str]) -> StructType:
    """Types from all rows of the given files, then the hints.

    A column that is NULL throughout is kept as text. With ``inferColumnTypes`` set to
    false every column of a JSON or CSV file is.
    """
    found = looks_like(spark, source, parts_of(spark, source, paths))
    return apply_hints(found, discovery_option(source, "schemaHints"), same_name(spark))


def declared_schema(source: Source) -> StructType | None:
    """The schema that a source states, with the column for rescued values if it names one."""
    if not source.schema:
        return None
    schema = from_ddl(source.schema)
    rescued = discovery_option(source, "rescuedDataColumn")
    return StructType([*schema, StructField(rescued, StringType())]) if rescued else schema


def planned_schema(
    source: Source,
    kept: StructType | None,
    founds: Sequence[StructType],
    together: StructType,
    fold: Callable[[str], str] = str,
) -> StructType:
    """What a batch is read as, after ``kept``; its parts look like ``founds``.

    Kept types widen where a type holds the old values and the new ones. Where hints or
    kept types cannot hold a column surely, a column for what does not fit is added.
    """
    hints = discovery_option(source, "schemaHints")
    mode = discovery_option(source, "schemaEvolutionMode", "addNewColumns")
    rescued = discovery_option(source, "rescuedDataColumn")
    schema = apply_hints(together, hints, fold) if kept is None else kept
    if kept is not None and mode == "addNewColumns":
        for found in founds:
            schema = merge(schema, apply_hints(widest([found], fold), hints, fold), fold)
    names = schema.fieldNames()
    if rescued and rescued not in names:
        return StructType([*schema, StructField(rescued, StringType())])
    sure = all(surely_fits(found, schema, fold) for found in founds)
    if source.format.lower() == "json":
        sure &= not any(_other_spelling(found, schema) for found in founds)
    if mode == "addNewColumns" and RESCUED not in names and not rescued and not sure:
        return StructType([*schema, StructField(RESCUED, StringType())])
    return schema


def _other_spelling(found: StructType, schema: StructType) -> bool:
    """JSON fields are read by their exact names, so another spelling of a column is not read as it."""
    return not set(found.fieldNames()) <= set(schema.fieldNames())


def rescued_column(source: Source, schema: StructType) -> str | None:
    """The column for values that do not fit, if the schema has it."""
    name = discovery_option(source, "rescuedDataColumn", RESCUED)
    return name if name in schema.fieldNames() else None


def read_batch(
    spark: SparkSession,
    source: Source,
    schema: StructType | None = None,
    paths: Sequence[str] | None = None,
    parts: Sequence[Part] | None = None,
) -> DataFrame:
    """All files of a source, or the given ones. Columns are bound by name.

    Where the schema has a column for rescued values, whatever does not fit its column is
    NULL there and kept as text here: JSON text of an object with the fields concerned, or
    with the whole line where that is broken.
    """
    paths = list(paths or source.paths)
    schema = schema or declared_schema(source) or infer_schema(spark, source, paths)
    kind = source.format.lower()
    rescued = rescued_column(source, schema)
    if kind in ("parquet", "orc"):
        return _read_layouts(spark, source, schema, rescued, parts or by_layout(spark, source, paths))
    if kind == "json":
        unknown = bool(source.schema) or any(_other_spelling(known_columns(p.found), schema) for p in parts or ())
        return _read_json(spark, source, schema, rescued, paths, unknown)
    if not has_header(source):
        return _read_csv(spark, source, schema, rescued, paths, [f.name for f in schema if f.name != rescued])
    groups = [(p.found.fieldNames(), p.files) for p in parts] if parts else by_header(spark, source, paths)
    rows = spark.createDataFrame([], schema)
    for names, files in groups:
        rows = rows.unionByName(_read_csv(spark, source, schema, rescued, files, names), allowMissingColumns=True)
    return rows.select(*schema.names)


def read_uniform_csv(spark: SparkSession, source: Source, schema: StructType, paths: Sequence[str], names: list[str]) -> DataFrame:
    """Files that are said to have one header. Each file's header is checked by the read itself,
    which fails (see :func:`is_other_header`) rather than take one column for another."""
    rescued = rescued_column(source, schema)
    checked = source.with_options(enforceSchema="false")
    return read_as(_read_csv(spark, checked, schema, rescued, paths, names), schema)


def is_other_header(error: Exception) -> bool:
    return "CSV header" in str(error)


def _read_csv(
    spark: SparkSession, source: Source, schema: StructType, rescued: str | None, paths: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Files with columns ``names``, in this order; those that the schema does not know are left out."""
    fold = same_name(spark)
    known = {fold(f.name): f for f in schema if f.name != rescued}
    # What the schema does not know is read as text: nothing of it is parsed.
    fields = [known.get(fold(name), StructField(name, StringType())) for name in names]
    reader = spark.read.format(source.format).options(**reader_options(source))
    wanted = [f.name for f in fields if fold(f.name) in known]
    if not rescued:
        return reader.schema(StructType(fields)).load(list(paths)).select(*[f"`{n}`" for n in wanted])
    flagged = StructType([*fields, StructField(CORRUPT, StringType())])
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(flagged).load(list(paths))
    declared = bool(source.schema)
    extra = [f.name for f in fields if fold(f.name) not in known] if declared else []
    text = rescued_csv(fields, extra, reader_options(source))
    return rows.select(*[f"`{n}`" for n in wanted], text.alias(rescued))


def _whole_files(options: dict[str, str]) -> bool:
    return str(options.get("multiLine", "false")).lower() == "true"


def json_records(spark: SparkSession, options: dict[str, str], paths: Sequence[str]) -> DataFrame:
    """``_line``: the text of each record, of lines or of the objects and arrays of whole files."""
    reader = spark.read.options(**{k: v for k, v in options.items() if k in (*LISTING_OPTIONS, "lineSep", "encoding")})
    if not _whole_files(options):
        return reader.text(list(paths)).where(F.trim("value") != "").select(F.col("value").alias("_line"))
    is_array = F.startswith(F.ltrim("value", F.lit(" \t\r\n")), F.lit("["))
    several = F.transform(F.from_json("value", "array<variant>"), lambda v: F.to_json(v))
    records = F.when(is_array, F.coalesce(several, F.array("value"))).otherwise(F.array("value"))
    return reader.text(list(paths), wholetext=True).select(F.explode(records).alias("_line"))


def read_flagged_csv(
    spark: SparkSession, source: Source, schema: StructType, paths: Sequence[str], parts: Sequence[Part]
) -> DataFrame:
    """Rows with the reader's own column for what it could not read, which the source's options name."""
    groups = [(p.found.fieldNames(), p.files) for p in parts] if has_header(source) else [(schema.fieldNames(), list(paths))]
    fold, reader = same_name(spark), spark.read.format(source.format).options(**reader_options(source))
    known = {fold(f.name): f for f in schema}
    rows = None
    for names, files in groups:
        fields = [known.get(fold(n), StructField(n, StringType())) for n in names]
        part = reader.schema(StructType([*fields, StructField(CORRUPT, StringType())])).load(files)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows


def _read_json(
    spark: SparkSession, source: Source, schema: StructType, rescued: str | None, paths: Sequence[str], unknown: bool
) -> DataFrame:
    """``unknown``: there may be fields that the schema does not have, and they are to be rescued."""
    options = reader_options(source)
    reader = spark.read.format(source.format).options(**options)
    if not rescued:
        return reader.schema(schema).load(list(paths))
    fields = [f for f in schema if f.name != rescued]
    flagged = StructType([*fields, StructField(CORRUPT, StringType())])
    careful = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    line = F.col(CORRUPT)
    if unknown or _whole_files(options):
        # In whole-file mode the reader hands on the file, not the record.
        rows = json_records(spark, options, paths).select(F.from_json("_line", flagged, careful).alias("of"), "_line").select("of.*", "_line")
        line = F.col("_line")
    else:
        rows = reader.options(**careful).schema(flagged).load(list(paths))
    text = rescued_json(fields, F.col(CORRUPT), line, unknown)
    return rows.select(*[f"`{f.name}`" for f in fields], text.alias(rescued))


def _read_layouts(
    spark: SparkSession, source: Source, schema: StructType, rescued: str | None, parts: Sequence[Part]
) -> DataFrame:
    """Parquet or ORC files, each layout as it is and then as the schema."""
    fold = same_name(spark)
    rows = spark.createDataFrame([], schema)
    reader = spark.read.format(source.format).options(**reader_options(source))
    for part in parts:
        have = {fold(f.name): f for f in part.found}
        own, left = [], []
        for field in schema:
            if field.name == rescued:
                continue
            known = have.get(fold(field.name))
            if known is None:
                own.append(F.lit(None).cast(field.dataType).alias(field.name))
                continue
            value = F.col(f"`{known.name}`")
            typed = conformed(value, known.dataType, field.dataType)
            if not surely_fits(known.dataType, field.dataType):
                # A value fits if it comes back from the other type as it was.
                fits = conformed(typed, field.dataType, known.dataType).eqNullSafe(value)
                left.append(F.when(~fits, F.struct(F.lit(field.name).alias("key"), value.cast("string").alias("value"))))
                typed = F.when(fits, typed)
            own.append(typed.alias(field.name))
        if rescued:
            entries = F.map_from_entries(F.array_compact(F.array(*left))) if left else None
            text = F.when(F.size(entries) > 0, F.to_json(entries)) if left else F.lit(None).cast("string")
            own.append(text.alias(rescued))
        rows = rows.unionByName(reader.schema(part.found).load(part.files).select(*own))
    return rows.select(*[f"`{n}`" for n in schema.names])


def read_stream(spark: SparkSession, source: Source, path: str, schema: StructType) -> DataFrame:
    """New files under one path."""
    reader = spark.readStream.format(source.format).schema(schema).options(**KEEP_OLD_FILES)
    return reader.options(**reader_options(source)).load(path)


def discover_stream(spark: SparkSession, source: Source, path: str) -> DataFrame:
    """Names of new files under one path; their content is not read."""
    own = {k.rsplit(".", 1)[-1]: v for k, v in source.options.items()}
    options = {**KEEP_OLD_FILES, **{k: own[k] for k in LISTING_OPTIONS if k in own}}
    if "maxFilesPerTrigger" not in own and "maxBytesPerTrigger" not in own:
        # The names of one batch pass through the driver, so their number has a limit.
        options["maxFilesPerTrigger"] = str(FILES_PER_BATCH)
    reader = spark.readStream.format("binaryFile").schema(_LISTING).options(**options)
    return reader.load(path).select("path")


def literal_path(path: str) -> str:
    """A path Spark does not take for a glob."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
