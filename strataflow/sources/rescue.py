"""Values that do not fit their column, kept as text.

The reader flags a record in which something does not fit, and hands on its text. Only
for flagged records is the text taken apart, and each field compared with its typed
value: a field that has a text but no value is rescued. The result is the JSON text of an
object from field names to texts, exactly as they were written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

#: The reader's column for the text of a record that it could not read as a whole.
CORRUPT = "_corrupt_record"

_FORMAT_OPTIONS = {
    "sep", "delimiter", "quote", "escape", "chartoescapequoteescaping", "nullvalue", "emptyvalue", "comment",
    "ignoreleadingwhitespace", "ignoretrailingwhitespace", "unescapedquotehandling", "maxcolumns", "maxcharspercolumn",
}


def _as_text(entries: Column) -> Column:
    return F.when(F.size(entries) > 0, F.to_json(entries))


def _broken(line: Column) -> Column:
    return F.to_json(F.create_map(F.lit(CORRUPT), line))


def _is_nested(kind: DataType) -> bool:
    return isinstance(kind, (StructType, ArrayType, MapType))


def rescued_json(fields: Sequence[StructField], flag: Column, line: Column, unknown: bool) -> Column:
    """Text of the fields of a JSON record that did not fit, or of the whole record if it is broken.

    ``flag``: not NULL where the reader could not read all. ``unknown``: rescue fields
    that the schema does not have as well; ``line`` then is there for every record.
    """
    texts = F.from_json(line, "map<string,string>")

    def lost(field: StructField) -> Column:
        text, typed = texts[field.name], F.col(f"`{field.name}`")
        if not _is_nested(field.dataType):
            return text.isNotNull() & typed.isNull()
        # A nested value may have been read in part: read it alone and see whether it is flagged.
        alone = StructType([StructField("x", field.dataType), StructField(CORRUPT, StringType())])
        again = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), alone, {"columnNameOfCorruptRecord": CORRUPT})
        return text.isNotNull() & again[CORRUPT].isNotNull()

    none = F.array().cast("array<string>")
    names = F.array_compact(F.array(*[F.when(lost(f), F.lit(f.name)) for f in fields])) if fields else none
    misfits = F.map_filter(texts, lambda key, _: F.array_contains(names, key))
    found = F.when(flag.isNotNull(), F.when(F.try_parse_json(line).isNull(), _broken(line)).otherwise(_as_text(misfits)))
    if not unknown:
        return found
    known = F.array(*[F.lit(f.name) for f in fields])
    others = F.map_filter(texts, lambda key, text: text.isNotNull() & (~F.array_contains(known, key) | F.array_contains(names, key)))
    return F.when(F.try_parse_json(line).isNull(), _broken(line)).otherwise(_as_text(others))


def rescued_csv(fields: Sequence[StructField], extra: Sequence[str], options: Mapping[str, str]) -> Column:
    """Text of the fields of a CSV record that did not fit; of the whole record if its number of
    fields is another than the header's. ``extra``: columns that are rescued whatever they hold."""
    names = [f.name for f in fields]
    plain = StructType([*(StructField(f"_{i}", StringType()) for i in range(len(names))), StructField(CORRUPT, StringType())])
    own = {k: v for k, v in options.items() if k.lower() in _FORMAT_OPTIONS}
    line = F.col(CORRUPT)
    texts = F.from_csv(line, plain.toDDL(), {**own, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    entry = lambda name, text: F.struct(F.lit(name).alias("key"), text.alias("value"))
    left = [
        F.when(texts[f"_{i}"].isNotNull() & F.col(f"`{name}`").isNull(), entry(name, texts[f"_{i}"]))
        for i, name in enumerate(names) if name not in extra
    ]
    others = [F.when(F.col(f"`{name}`").isNotNull(), entry(name, F.col(f"`{name}`"))) for name in extra]
    flagged = F.map_from_entries(F.array_compact(F.array(*left, *others)))
    found = F.when(line.isNotNull(), F.when(texts[CORRUPT].isNotNull(), _broken(line)).otherwise(_as_text(flagged)))
    if not extra:
        return found
    return F.coalesce(found, _as_text(F.map_from_entries(F.array_compact(F.array(*others)))))
