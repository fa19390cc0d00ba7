"""Source schemas: hints, merging by name, and versions kept on storage."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from strataflow.storage import VersionLog

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_FRACTIONAL = (FloatType, DoubleType)
#: Decimal digits that hold any value of a whole type.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_MOST_DIGITS = 38
_TIMES = (TimestampType, TimestampNTZType)


def from_ddl(ddl: str) -> StructType:
    schema = StructType.fromDDL(ddl)
    return StructType([StructField(f.name, f.dataType, True) for f in schema])


def apply_hints(inferred: StructType, hints: str | None, same_name: Callable[[str], str] = str) -> StructType:
    """Types named in the hints win over inferred ones; unseen columns are appended."""
    if not hints:
        return inferred
    wanted = {same_name(f.name): f for f in from_ddl(hints)}
    kept = [wanted.pop(same_name(f.name), f) for f in inferred]
    return StructType([*kept, *wanted.values()])


def surely_fits(found: DataType, kept: DataType, same_name: Callable[[str], str] = str) -> bool:
    """Whether each value of files whose values look like ``found`` can be read as ``kept``."""
    if found == kept or isinstance(found, NullType) or isinstance(kept, StringType):
        return True
    if isinstance(found, StructType) and isinstance(kept, StructType):
        known = {same_name(f.name): f.dataType for f in kept}
        return all(same_name(f.name) not in known or surely_fits(f.dataType, known[same_name(f.name)]) for f in found)
    if isinstance(found, ArrayType) and isinstance(kept, ArrayType):
        return surely_fits(found.elementType, kept.elementType)
    return _wider(found, kept) == kept


def _wider(a: DataType, b: DataType) -> DataType | None:
    """The least type that holds all values of both; None where there is none but text.

    Whole numbers beyond 2^53 have no exact DOUBLE: who turns stored ones into DOUBLE tests them.
    """
    kinds = {type(a), type(b)}
    if a == b:
        return a
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, *_FRACTIONAL}:
        return DoubleType()
    if DecimalType in kinds and kinds <= {*_WHOLE, DecimalType}:
        x, y = (t if isinstance(t, DecimalType) else DecimalType(_DIGITS[type(t)], 0) for t in (a, b))
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return DecimalType(digits, scale) if digits <= _MOST_DIGITS else None
    if DateType in kinds and any(k in kinds for k in _TIMES):
        return b if isinstance(a, DateType) else a
    return None


def widen(kept: DataType, found: DataType) -> DataType:
    """The kept type, widened so that it holds what was found, in structs and arrays alike.

    A kept text stays text. Where nothing holds both, the kept type stays: single values
    that do not fit it are for the reader to rescue.
    """
    if isinstance(kept, NullType):
        return found
    if isinstance(found, NullType) or isinstance(kept, StringType):
        return kept
    if isinstance(kept, StructType) and isinstance(found, StructType):
        return merge(kept, found)
    if isinstance(kept, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(widen(kept.elementType, found.elementType), True)
    return _wider(kept, found) or kept


def merge(kept: StructType, found: StructType, same_name: Callable[[str], str] = str) -> StructType:
    """Kept columns with their types widened, then new columns at the end."""
    by_name = {same_name(f.name): f for f in found}
    fields = []
    for field in kept:
        new = by_name.pop(same_name(field.name), None)
        fields.append(StructField(field.name, field.dataType if new is None else widen(field.dataType, new.dataType), True))
    return StructType([*fields, *(StructField(f.name, f.dataType, True) for f in by_name.values())])


def widest(schemas: list[StructType], same_name: Callable[[str], str] = str) -> StructType:
    """All columns of files read together; where no type but text holds all values, text.

    ``same_name`` tells which names are one column; the first spelling stays.
    """
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for field in schema:
            known = fields.setdefault(same_name(field.name), StructField(field.name, field.dataType, True))
            if known.dataType != field.dataType:
                wide = widen(known.dataType, field.dataType)
                if not surely_fits(field.dataType, wide):
                    wide = StringType()
                fields[same_name(field.name)] = StructField(known.name, wide, True)
    return StructType(list(fields.values()))


def union_schema(schemas: list[StructType]) -> StructType:
    """One table's columns over all its inputs. Types that differ are widened; where no
    type holds both, that is an error, since neither input could be read as the other."""
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for field in schema:
            known = fields.setdefault(field.name, StructField(field.name, field.dataType, True))
            wide = widen(known.dataType, field.dataType)
            if not surely_fits(field.dataType, wide) or (isinstance(wide, StringType) and known.dataType != field.dataType):
                raise ValueError(
                    f"column {field.name!r} is {known.dataType.simpleString()} in one input and "
                    f"{field.dataType.simpleString()} in another"
                )
            fields[field.name] = StructField(known.name, wide, True)
    return StructType(list(fields.values()))


def conformed(value: Column, found: DataType, wanted: DataType) -> Column:
    """A value as a wider type: fields by name, those that it lacks NULL."""
    if found == wanted:
        return value
    if isinstance(found, StructType) and isinstance(wanted, StructType):
        have = {f.name: f.dataType for f in found}
        parts = [
            (conformed(value[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(found, ArrayType) and isinstance(wanted, ArrayType):
        return F.transform(value, lambda x: conformed(x, found.elementType, wanted.elementType))
    return value.try_cast(wanted)


def read_as(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows as a schema that is as wide as theirs or wider."""
    have = {f.name: f.dataType for f in rows.schema}
    return rows.select(*[
        (conformed(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


class SchemaStore:
    """Versions of one schema under a ``schema_location``."""

    def __init__(self, spark: SparkSession, path: str):
        self.log = VersionLog(spark, path)

    def load(self) -> StructType | None:
        document = self.log.latest()
        return StructType.fromJson(document) if document else None

    def versions(self) -> dict[int, StructType]:
        return {n: StructType.fromJson(self.log.read(n)) for n in self.log.versions()}

    def number_of(self, schema: StructType) -> int:
        """Number of the version that holds this schema, or that will."""
        numbers = self.log.versions()
        if not numbers:
            return 0
        return numbers[-1] if self.load() == schema else numbers[-1] + 1

    def save(self, schema: StructType) -> None:
        if self.load() != schema:
            self.log.append(json.loads(schema.json()))
