"""In-code lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Swiss cantons as code, name, latitude, longitude.
CANTONS = [
    ("AG", "Aargau", 47.387666, 8.247164),
    ("BE", "Bern", 46.948020, 7.447433),
    ("FR", "Fribourg", 46.806467, 7.161594),
    ("GE", "Genève", 46.204391, 6.143158),
    ("GL", "Glarus", 47.040182, 9.067609),
    ("GR", "Graubünden", 46.656987, 9.578027),
    ("JU", "Jura", 47.350000, 7.350000),
    ("LU", "Luzern", 47.050000, 8.300000),
    ("NE", "Neuchâtel", 46.991789, 6.930000),
    ("SG", "St. Gallen", 47.423058, 9.377083),
    ("SH", "Schaffhausen", 47.697320, 8.634910),
    ("SZ", "Schwyz", 47.020000, 8.650000),
    ("SO", "Solothurn", 47.206667, 7.537778),
    ("TG", "Thurgau", 47.566667, 9.166667),
    ("TI", "Ticino", 46.331734, 8.800452),
    ("UR", "Uri", 46.900000, 8.633333),
    ("VS", "Valais", 46.191079, 7.737933),
    ("VD", "Vaud", 46.533333, 6.666667),
    ("ZG", "Zug", 47.166667, 8.516667),
    ("ZH", "Zürich", 47.366667, 8.550000),
    ("AR", "Appenzell Ausserrhoden", 47.366667, 9.300000),
    ("AI", "Appenzell Innerrhoden", 47.316667, 9.416667),
    ("BS", "Basel-Stadt", 47.566667, 7.600000),
    ("BL", "Basel-Landschaft", 47.450000, 7.750000),
    ("OW", "Obwalden", 46.900000, 8.250000),
    ("NW", "Nidwalden", 46.950000, 8.383333),
]


def canton_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CANTONS, "code string, name string, lat double, lon double")


def counts_with_names(df: DataFrame, code_col: str, lookup: DataFrame) -> DataFrame:
    """Rows per code with the code's full name (Q21): counted first, then
    the (26-row) lookup is broadcast; codes without a name are dropped, as
    in the source."""
    counts = df.where(F.col(code_col).isNotNull()).groupBy(code_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(lookup), counts[code_col] == lookup["code"], "inner") \
                 .select("code", "name", "n").orderBy(F.col("n").desc(), "code")
