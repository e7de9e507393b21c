"""Manifest documents: strict JSON text to a nested struct, with a verdict instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schema
from landfall.functions.once import once

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _is_absent_or_text(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value) | _is_text(value)


def _passenger_ok(passenger: Column) -> Column:
    verdict = passenger.isNotNull()
    for key in schema.REQUIRED_PASSENGER_KEYS:
        verdict = verdict & _is_text(passenger[key])
    for key in schema.OPTIONAL_PASSENGER_KEYS:
        verdict = verdict & _is_absent_or_text(passenger[key])
    return verdict


def _document_ok(document: Column) -> Column:
    verdict = document[schema.PASSENGER_LIST].isNotNull()
    for key in schema.VOYAGE_KEYS:
        verdict = verdict & _is_text(document[key])
    return verdict & F.forall(document[schema.PASSENGER_LIST], _passenger_ok)


def _as_text(document: Column) -> Column:
    def passenger(p: Column) -> Column:
        return F.struct(*[p[key].cast("string").alias(key) for key in schema.PASSENGER_KEYS])

    return F.struct(
        *[document[key].cast("string").alias(key) for key in schema.VOYAGE_KEYS],
        F.transform(document[schema.PASSENGER_LIST], passenger).alias(schema.PASSENGER_LIST),
    )


@once
def _parsing() -> dict[str, Column]:
    documents = F.from_json(
        F.concat(F.lit("["), F.col("content"), F.lit("]")), T.ArrayType(schema.RAW_DOCUMENT), STRICT
    )
    return {
        "_documents": documents,
        "_closed": F.endswith(F.rtrim(F.col("content"), F.lit(" \t\r\n")), F.lit("}")),
        "parse_ok": F.coalesce(
            F.col("_closed") & (F.size("_documents") == 1) & _document_ok(F.col("_document")),
            F.lit(False),
        ),
        "manifest": F.when(F.col("parse_ok"), _as_text(F.col("_document"))),
    }


def parse(entries: DataFrame) -> DataFrame:
    """Replace `content` by `manifest` (null where the document is unusable) and `parse_ok`.

    The text is read as the only element of an array, so that anything after the document's end is
    an error rather than ignored.
    """
    parsing = _parsing()
    return (
        entries.withColumns({name: parsing[name] for name in ("_documents", "_closed")})
        .drop("content")
        .withColumn("_document", F.get("_documents", F.lit(0)))
        .withColumn("parse_ok", parsing["parse_ok"])
        .withColumn("manifest", parsing["manifest"])
        .drop("_documents", "_closed", "_document")
    )
