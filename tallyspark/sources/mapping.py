"""The inline address -> product mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fee-collecting addresses and what they collect
# (address, fee_type, fee_source, token), in the order the project lists them.
MAPPING_ROWS = [
    ("3hVztnGsAWjBs8uKAA4eZ1PSXjun74AAp11BdmeTMgXy", "swap", "unknown", "usdc"),
    ("595S5w2SypCZ9c7ELkzp1LUQXG2sMg64d6xLLPrSiyJc", "swap", "unknown", "wsol"),
    ("E8ehoZBHw4C7CAaDi5FrLk6nzgBaMNPyW6FZsRq3Tnqc", "swap", "unknown", "weth"),
    ("BEochrdGhm5pcKVF73DURYrGo1DLzxq6bBcUBphQR64d", "swap", "okx", "sol"),
    ("AZhGu7kfjbQfcZZWfYv4PicgM5KzvLPnSYNU71azG4J6", "swap", "okx", "usdc"),
    ("9HwskvHcuTTLZd2B85F81q24Bv6E3Sk6rmZMBAJ6PpZG", "swap", "okx", "wsol"),
    ("MhjVAk6qoWp3wirworqRi6YmBh54ZffYMSoYvZwMsTT", "limit_order", "unknown", "usdc"),
    ("CrjqJupka2obZTzMuELd8ks4JqKDW7TzifrqRyBbzzjE", "limit_order", "unknown", "wsol"),
    ("GHTBuM2wLKvw7ZTsJfZiHoWfdbPsUadgM1dtVhQiQWG8", "bridge", "unknown", "usdc"),
    ("pJjzLvBrMhmyU9mu3ERn7DbMuwwizAch6HXK9wnHqk8", "bridge", "unknown", "sol"),
    ("4dNMXwbUtKYspnD7tdHLwiVnBNoVZW7QdSwbTKREXVMv", "bonfida", "unknown", "usdc"),
    ("2GVfr38GBK2XHd8wQmCMZgvRDnrV9qG9i59u7a44wBWL", "instant_unstake", "external", "sol"),
    ("5PxxoU93A4KLr23rXvYrYMFZDAw5DY8XZiyX6NsW7Hkk", "instant_unstake", "rfq", "sol"),
    ("7YEpZWGgQNWudS67wRYxC87YVXz6yDajrs6CVTVFbxQB", "nft_instant_sell", "unknown", "sol"),
    ("FejFMFmfbJr7NPnNmCb6vFGrMZnzxeeMS1g8sFksFirm", "solscout", "unknown", "sol"),
    ("6d9zMJ5j6VK9ZLjHWQswq9DrvWTnfe9YeqEempd9fzpj", "solscout", "unknown", "sol"),
    ("39LjEaG6LUaRCddeXx1NYS8Djy58VVEtVhynLQ4Q4nfz", "solscout", "unknown", "sol"),
    ("HdKmzpebfWMRCtyfWo2Fpt7PmMRR6cg5Fq3352JaHM6z", "solscout", "unknown", "sol"),
    ("AviyuP6C5ag7wGshX9vQo5VPgtrRHfSCQA5inWUu6mVd", "solscout", "unknown", "sol"),
    ("6ijs7wp1AVJHY7fA1jt2vqHRZ3u6QSce36o2hXp1Fmky", "solscout", "unknown", "sol"),
    ("GWGAtRPdEFhWZkU1Yg33GKrQcTZEME4AB5cP98K94y1T", "solscout", "unknown", "sol"),
    ("8W5zkeWVs6rWAicSaK7ixuUcDpXmjm5V4tPBPcsPPCyN", "solscout", "unknown", "sol"),
    ("DaWsHBBT7GLCQ9PmsjFroCZT7urcEiPxykByC9tuv1Ry", "solscout", "unknown", "sol"),
    ("Bjp2t7xg73yo5N7Do6zCMGKyKaKp62QnZsYmbSprrk5v", "solscout", "unknown", "sol"),
]

MAPPING_SCHEMA = T.StructType([
    T.StructField("idx", T.IntegerType(), False),
    T.StructField("address", T.StringType(), False),
    T.StructField("fee_type", T.StringType(), False),
    T.StructField("fee_source", T.StringType(), False),
    T.StructField("token", T.StringType(), False),
])


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def mapping_df(spark: SparkSession, rows=None) -> DataFrame:
    """The mapping as an inline ``VALUES`` relation (with its list position ``idx``).

    A local relation carries exact size statistics and is scanned in the JVM,
    with no Python worker and no job to ship the rows.
    """
    rows = MAPPING_ROWS if rows is None else rows
    values = ", ".join("(" + ", ".join([str(i)] + [_sql_str(v) for v in r]) + ")" for i, r in enumerate(rows))
    names = ", ".join(f.name for f in MAPPING_SCHEMA.fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS mapping({names})").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in MAPPING_SCHEMA.fields])


def mapping_size(rows=None) -> int:
    return len(MAPPING_ROWS if rows is None else rows)
