"""Type tests and fall-backs on VARIANT fields of schemaless records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusvec.functions import text as T


def field(record: Column, name: str) -> Column:
    """A field as VARIANT; SQL NULL if the key is missing."""
    return F.variant_get(record, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_missing(value: Column) -> Column:
    return value.isNull()


def is_null(value: Column) -> Column:
    """Present, but a JSON null."""
    return F.coalesce(F.is_variant_null(value), F.lit(False))


def is_string(value: Column) -> Column:
    return F.coalesce(kind(value) == "STRING", F.lit(False))


def is_list(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("ARRAY"), F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))


def text_of(value: Column) -> Column:
    """The string value; NULL for any other type."""
    return F.when(is_string(value), F.try_variant_get(value, "$", "string"))


def items_of(value: Column) -> Column:
    """The list's elements as VARIANTs; NULL for any other type."""
    return F.when(is_list(value), F.try_variant_get(value, "$", "array<variant>"))


def is_truthy(value: Column) -> Column:
    """False for missing, null, false, zero, and empty strings, bytes, lists and objects."""

    def test(x: Column, shape: Column) -> Column:
        return (
            F.when(shape == "VOID", F.lit(False))
            .when(shape == "STRING", F.try_variant_get(x, "$", "string") != "")
            .when(
                shape.startswith("ARRAY"),
                F.size(F.try_variant_get(x, "$", "array<variant>")) > 0,
            )
            .when(shape.startswith("OBJECT"), F.to_json(x) != "{}")
            .when(shape == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
            .when(shape.isin("DATE", "TIMESTAMP", "TIMESTAMP_NTZ"), F.lit(True))
            .when(shape == "BINARY", F.octet_length(F.try_variant_get(x, "$", "binary")) > 0)
            .otherwise(F.try_variant_get(x, "$", "double") != 0)
        )

    # Lambda bodies name no outer column: Spark could take it for an alias of
    # the same select list.
    tested = T.bind(value, lambda x: T.bind(kind(x), lambda shape: test(x, shape)))
    return F.coalesce(tested, F.lit(False))


def first_truthy(record: Column, *names: str) -> Column:
    """The first truthy field among aliases; NULL if there is none."""
    return F.coalesce(
        *(T.bind(field(record, n), lambda f: F.when(is_truthy(f), f)) for n in names)
    )


def display(value: Column) -> Column:
    """How a scalar prints in a joined list; nested values print as JSON."""
    return (
        F.when(is_string(value), F.try_variant_get(value, "$", "string"))
        .when(kind(value) == "BOOLEAN", F.initcap(F.to_json(value)))
        .otherwise(F.to_json(value))
    )


def display_list(value: Column) -> Column:
    """Printed truthy elements of a list; NULL for any other type."""
    return F.transform(F.filter(items_of(value), is_truthy), display)
