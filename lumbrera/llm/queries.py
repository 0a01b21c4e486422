"""Queries of the training-data operators: name -> (function, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbrera.llm import canon, garbled, groups, neighbours, packing, people, quality, tokens, truncated
from lumbrera.operators.packed import split_packed
from lumbrera.plans.lineage import cut, drop, settled, spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.pairs(neighbours.most_similar(table(spark, folder, "sample_50k_embeddings"), k=5, floor=0.8))


def p1_similar(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.most_similar(table(spark, folder, "sample_50k_embeddings"), k=10)


def p1_recall(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.recall(table(spark, folder, "sample_50k_embeddings"), k=5, floor=0.8)


NAMES = ["asesores_limpios_v2", "autor_limpio_v2"]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return garbled.find_garbled(table(spark, folder, "base7_kaggle_clean"), NAMES, "thesis_id").select("thesis_id", "campo").distinct()


def p2_restored(spark: SparkSession, folder: str) -> DataFrame:
    return garbled.find_garbled(table(spark, folder, "base7_kaggle_clean"), NAMES, "thesis_id")


def _spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Every name of the person fields; records whose advisors are garbled or cut give only their authors."""
    base = table(spark, folder, "base7_kaggle_clean")
    garbled_ = settled(lambda: p2_found(spark, folder).where("campo = 'asesores_limpios_v2'").select("thesis_id"), "garbled")
    damaged = settled(lambda: garbled_.unionByName(p6_found(spark, folder)).distinct(), "damaged")
    split = settled(lambda: split_packed(base, ["asesores_limpios_v2", "autores_limpios_v2"], "thesis_id").select("thesis_id", "campo", F.col("valor").alias("name")), "split")
    authors = split.where("campo = 'autores_limpios_v2'").select("name")
    advisors = split.where("campo = 'asesores_limpios_v2'").join(damaged, "thesis_id", "left_anti").select("name")
    principal = base.join(damaged, "thesis_id", "left_anti").select(F.col("asesor_limpio_v2").alias("name"))
    return people.link_spellings(authors.unionByName(advisors).unionByName(principal), spent=(damaged, split))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of a person's strings, as TESTDATA.md asks; persons of very many strings are divided among tasks."""
    people_ = settled(lambda: _spellings(spark, folder), "people")
    parts = people_.groupBy("person").agg(F.ceil(F.count("*") / 256).cast("int").alias("parts"), F.count("*").alias("n")).where("n > 1").select("person", "parts")
    some = cut(people_.join(parts, "person"), "people-of-several")
    drop(people_)
    a = some.select(F.col("name").alias("nombre_a"), "person", F.pmod(F.xxhash64("name"), "parts").cast("int").alias("part"))
    b = some.select(F.col("name").alias("nombre_b"), "person", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return a.join(b, ["person", "part"]).where("nombre_a < nombre_b").select("nombre_a", "nombre_b")


def p3_people(spark: SparkSession, folder: str) -> DataFrame:
    return _spellings(spark, folder)


def _planteles(spark: SparkSession, folder: str) -> DataFrame:
    return canon.map_entries(table(spark, folder, "base7_kaggle_clean"), "thesis_id", "plantel_estandarizado", table(spark, folder, "catalogo_planteles"), "plantel_id", ["plantel_canonico", "plantel_display", "sigla"])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    canonical = table(spark, folder, "catalogo_planteles").select(F.col("plantel_canonico").alias("valor"))
    return _planteles(spark, folder).join(canonical, "valor", "left_anti").select("thesis_id", "plantel_id").distinct()


def p5_mapped(spark: SparkSession, folder: str) -> DataFrame:
    return _planteles(spark, folder)


def p5_misses(spark: SparkSession, folder: str) -> DataFrame:
    return _planteles(spark, folder).where("plantel_id = 0").groupBy("valor").agg(F.count("*").alias("n"))


def _cuts(spark: SparkSession, folder: str) -> DataFrame:
    return truncated.find_truncated(table(spark, folder, "base7_kaggle_clean"), "thesis_id", "asesores_limpios_v2", "origen", "asesores_display", "asesor_limpio_v2")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return _cuts(spark, folder).where("cut").select("thesis_id").distinct()


def p6_shares(spark: SparkSession, folder: str) -> DataFrame:
    return truncated.shares(_cuts(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    found = cut(groups.group_vectors(table(spark, folder, "sample_50k_embeddings")), "groups")
    big = found.groupBy("grupo").agg(F.count("*").alias("n")).where("n >= 5").select("grupo")
    return found.join(big, "grupo").select(F.col("id").alias("vec_id"), "grupo")


def p7_described(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "sample_50k_embeddings")
    return groups.describe(vectors, cut(groups.group_vectors(vectors), "groups"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(spread(table(spark, folder, "documents").select("doc_id", "text")))


def p9_packing(spark: SparkSession, folder: str) -> DataFrame:
    ids = tokens.encode_corpus(spread(table(spark, folder, "documents").select("doc_id", "text")))
    sizes = cut(ids.select("doc_id", F.size("ids").alias("n")), "sizes")
    return packing.pack(sizes, "n", ["doc_id"], 2048)


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_statistics(spark, folder).where("clase <> 'prosa'").select("doc_id", "clase").distinct()


def p10_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"))


QUERIES: dict[str, tuple] = {"p10_found": (p10_found, None), "p10_statistics": (p10_statistics, None), "p1_found": (p1_found, None), "p1_similar": (p1_similar, None), "p1_recall": (p1_recall, None), "p5_found": (p5_found, None), "p5_mapped": (p5_mapped, None), "p5_misses": (p5_misses, None), "p6_found": (p6_found, None), "p6_shares": (p6_shares, None), "p7_found": (p7_found, None), "p7_described": (p7_described, None), "p2_found": (p2_found, None), "p2_restored": (p2_restored, None), "p3_found": (p3_found, None), "p3_people": (p3_people, None), "p8_ids": (p8_ids, None), "p9_packing": (p9_packing, None)}
