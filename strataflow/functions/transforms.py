"""Derived columns: ``{target_col, type, params}`` items to one ``withColumns`` map."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AES_KEY_CONF = "spark.strataflow.aes.secretKey"


WHOLE_NUMBER_TYPES = {
    "tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"
}
WHOLE_NUMBER = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"


def _aes_key(key: str | None) -> Column:
    if key is None:
        spark = SparkSession.getActiveSession()
        key = spark.conf.get(AES_KEY_CONF, None) if spark else None
    if not key:
        raise ValueError(f"no AES key: set {AES_KEY_CONF} or pass aes_key")
    return F.lit(key)


# The transformation types a document may name.
TRANSFORMATION_TYPES = (
    "sql_expr",
    "current_timestamp",
    "to_date",
    "cast",
    "literal",
    "hash_sha256",
    "hash_md5",
    "aes_encrypt",
    "aes_decrypt",
)


def _literal(value: Any) -> Column:
    if isinstance(value, Mapping):
        raise ValueError("a literal must be a string, number, boolean, list or null")
    # An untyped NULL column cannot be stored everywhere, so it becomes a string.
    return F.lit(None).cast("string") if value is None else F.lit(value)


def _lenient_cast(source: Column, target: str) -> Column:
    """``try_cast``, without its cost on text that is no whole number.

    For such text Spark raises and catches an error per row, so rows are looked at with
    a pattern first. The type test is a constant that the optimizer folds.
    """
    if target.strip().lower() not in WHOLE_NUMBER_TYPES:
        return source.try_cast(target)
    is_text = F.typeof(source) == "string"
    return F.when(~is_text | source.cast("string").rlike(WHOLE_NUMBER), source.try_cast(target))


def transformation(
    kind: str, params: Any, on_error: str = "fail", aes_key: str | None = None
) -> Column:
    """The expression of one item.

    Bad input to a cast, a date or a decryption fails the job under ANSI rules;
    ``on_error="null"`` gives NULL for it instead.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    lenient = on_error == "null"
    match kind:
        case "sql_expr":
            return F.expr(params)
        case "current_timestamp":
            return F.current_timestamp()
        case "literal":
            return _literal(params)
        case "cast":
            source = F.col(params["col"])
            target = params["type"]
            return _lenient_cast(source, target) if lenient else source.cast(target)
        case "to_date":
            return F.col(params).try_cast("date") if lenient else F.to_date(F.col(params))
        case "hash_md5":
            return F.md5(F.col(params))
        case "hash_sha256":
            return F.sha2(F.col(params), 256)
        case "aes_encrypt":
            return F.aes_encrypt(F.col(params), _aes_key(aes_key))
        case "aes_decrypt":
            decrypt = F.try_aes_decrypt if lenient else F.aes_decrypt
            return decrypt(F.col(params), _aes_key(aes_key)).cast("string")
    raise ValueError(f"unknown transformation {kind!r}; known: {list(TRANSFORMATION_TYPES)}")


def transformation_map(
    items: Iterable[Mapping[str, Any]] | None, aes_key: str | None = None
) -> dict[str, Column]:
    """Target column to expression; of two items with one target the later wins."""
    return {
        item["target_col"]: transformation(
            item["type"], item.get("params"), item.get("on_error", "fail"), aes_key
        )
        for item in items or ()
    }


def transform(
    df: DataFrame, items: Iterable[Mapping[str, Any]] | None, aes_key: str | None = None
) -> DataFrame:
    """All derived columns in one projection."""
    columns = transformation_map(items, aes_key)
    return df.withColumns(columns) if columns else df
