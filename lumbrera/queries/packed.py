"""Queries of the field splitter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumbrera.operators.packed import split_packed
from lumbrera.queries import table


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = split_packed(table(spark, folder, "base7_kaggle_clean"), ["asesores_limpios_v2", "autores_limpios_v2"], "thesis_id")
    return rows.where("n >= 2").select("thesis_id", "campo", "posicion", "valor").distinct()


QUERIES = {"p4_found": (p4_found, None)}
