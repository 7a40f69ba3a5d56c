"""Readers for the model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pledgeline.sources.schemas import SCHEMAS


def parquet_tables(spark: SparkSession, location: str) -> dict[str, DataFrame]:
    """Model tables stored as ``<location>/<name>``, read with their declared schema."""
    return {
        name: spark.read.schema(ddl).parquet(f"{location}/{name}") for name, ddl in SCHEMAS.items()
    }


def catalog_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    """Model tables from catalog tables or views, given as model name -> catalog name.

    They have the declared columns in order; others are left out. A missing column, or one of another
    type, is an error that names all of them.
    """
    tables, wrong = {}, []
    for name, catalog_name in names.items():
        if name not in SCHEMAS:
            raise ValueError(f"there is no model table {name!r}")
        table = spark.table(catalog_name)
        found = {f.name: f.dataType for f in table.schema.fields}
        declared = T.StructType.fromDDL(SCHEMAS[name]).fields
        for field in declared:
            kind = found.get(field.name)
            if kind != field.dataType:
                has = "is missing" if kind is None else f"is {kind.simpleString()}"
                wrong.append(
                    f"{catalog_name}.{field.name} {has}, not {field.dataType.simpleString()}"
                )
        tables[name] = table.select(*[f.name for f in declared if f.name in found])
    if wrong:
        raise ValueError("; ".join(wrong))
    return tables
