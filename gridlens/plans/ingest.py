"""Raw files to a stored fact and dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridlens.operators.cleaning import clean, clean_counts, split_star
from gridlens.operators.quality import check_validity, validity_rate
from gridlens.roles import DEFAULT, Roles
from gridlens.session import settle
from gridlens.sinks.files import write_parquet, write_report
from gridlens.sources.csv_folder import MALFORMED, read_csv_folder


def ingest(spark: SparkSession, raw_folder: str, out: str, roles: Roles = DEFAULT, **read_options) -> dict[str, DataFrame]:
    """Read, clean, split, check and store. The raw text is parsed once and continued from columnar files."""
    read = settle(read_csv_folder(spark, raw_folder, keep_malformed=True, **read_options), "raw")
    raw = read.filter(~F.col(MALFORMED)).drop(MALFORMED)
    cleaned = settle(clean(raw, roles), "clean")
    fact, dim = split_star(cleaned, roles)
    write_parquet(fact, f"{out}/FACT_CONSUMO")
    write_parquet(dim, f"{out}/DIM_CLIENTE_UBICACION")
    fact = spark.read.parquet(f"{out}/FACT_CONSUMO")
    dim = spark.read.parquet(f"{out}/DIM_CLIENTE_UBICACION")
    quality = check_validity(validity_rate(fact, dim, raw.agg(F.count("*")).scalar(), roles))
    write_report(quality, f"{out}/reporte_calidad")
    too_long = read.agg(F.count_if(MALFORMED)).scalar().alias("filas_con_campos_de_mas")
    write_report(clean_counts(raw, roles).select("*", too_long), f"{out}/reporte_limpieza")
    return {"clean": cleaned, "fact": fact, "dim": dim, "quality": quality}
