"""File sources, uploads and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_csv(spark: SparkSession, path: str, schema: str, header: bool = True,
             date_cols: dict[str, str] | None = None) -> DataFrame:
    """Typed CSV read (explicit schema, no inference); dates parsed with a pattern."""
    df = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)
    for c, fmt in (date_cols or {}).items():
        df = df.withColumn(c, F.to_date(F.col(c).cast("string"), fmt))
    return df


def encode_payloads(df: DataFrame, group: str, line_cols: list[str], header: str) -> DataFrame:
    """Build upload payloads ('data:text/csv;base64,<csv>') - one per group value."""
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in line_cols])
    body = F.concat_ws("\n", F.lit(header), F.array_join(F.array_sort(F.collect_list(line)), "\n"))
    return (df.groupBy(F.col(group).alias("filename"))
              .agg(body.alias("_csv"))
              .select(F.col("filename").cast("string"),
                      F.concat(F.lit("data:text/csv;base64,"), F.base64(F.encode("_csv", "UTF-8"))).alias("contents")))


def ingest_payloads(payloads: DataFrame, schema: str, contents: str = "contents") -> DataFrame:
    """S6: 'type,base64' payloads -> CSV rows -> typed rows; unparsable lines land in ``_corrupt``."""
    b64 = F.element_at(F.split(F.col(contents), ",", 2), 2)
    text = F.decode(F.unbase64(b64), "UTF-8")
    lines = payloads.select("filename", F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    body = lines.where((F.col("line_no") > 0) & (F.length("line") > 0))  # drop the header line
    parsed = body.select("filename", "line", F.from_csv(
        "line", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return parsed.select("filename", "r.*")


def write_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Replace or append a result table (path or catalog name)."""
    w = df.write.mode(mode).format(fmt)
    if "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def table_exists(spark: SparkSession, name: str) -> bool:
    """S10."""
    return spark.catalog.tableExists(name)


def sample_rows(df: DataFrame, fraction: float, seed: int | None = None, key: str | None = None) -> DataFrame:
    """Sample without replacement; with ``key`` the sample is a hash of the key (reproducible)."""
    if key is not None:
        return df.where((F.abs(F.xxhash64(F.col(key), F.lit(seed or 0))) % 1_000_000) < fraction * 1_000_000)
    return df.sample(False, fraction, seed)
