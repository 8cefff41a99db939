"""Countries, network owners and protocol names for addresses and ports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stretches(ranges: DataFrame, values: list[str]) -> DataFrame:
    """Ranges (start, end) cut at /16 blocks and at each other's ends: _block, _from, _before and the values of the narrowest range there."""
    blocks = ranges.withColumn("_block", F.explode(F.sequence(F.shiftright("start", 16), F.shiftright("end", 16))))
    first = F.shiftleft("_block", 16)
    parts = blocks.withColumn("_low", F.greatest("start", first)).withColumn("_high", F.least("end", first + 65535))
    cuts = parts.select("_block", F.col("_low").alias("_from")).union(parts.select("_block", F.col("_high") + 1)).distinct()
    between = cuts.withColumn("_before", F.lead("_from").over(Window.partitionBy("_block").orderBy("_from"))).where("_before is not null")
    met = between.join(parts, "_block").where("_from between _low and _high")
    best = met.groupBy("_block", "_from", "_before").agg(F.min_by(F.struct(*values), F.struct(F.col("end") - F.col("start"), "start")).alias("_v"))
    return best.select("_block", "_from", "_before", "_v")


def in_ranges(rows: DataFrame, ip: str, ranges: DataFrame, values: list[str], prefix: str = "", broadcast: int = 100_000) -> DataFrame:
    """Left join of an address to ranges (start, end); where ranges nest, the narrowest wins. Ranges become stretches that no other cuts, so an address meets one at most, by its /16 block. Of up to `broadcast` blocks with ranges they go to all tasks, and rows stay where they are; more are an equi-join."""
    many = ranges.agg(F.coalesce(F.sum(F.shiftright("end", 16) - F.shiftright("start", 16) + 1), F.lit(0))).first()[0]
    found = stretches(ranges, values)
    found = F.broadcast(found) if many <= broadcast else found
    inside = (F.shiftright(ip, 16) == F.col("_block")) & (F.col(ip) >= F.col("_from")) & (F.col(ip) < F.col("_before"))
    return rows.join(found, inside, "left").select(*rows.columns, *[F.col(f"_v.{v}").alias(prefix + v) for v in values])


def latest_names(names: DataFrame) -> DataFrame:
    """asn and name, the last row (ord) of an asn; rows without a number, as a header, go."""
    return names.withColumn("asn", F.col("asn").try_cast("long")).where("asn is not null").groupBy("asn").agg(F.max_by("name", "ord").alias("name"))


def with_protocol(rows: DataFrame, decode: DataFrame, port: str = "p2", kind: str = "udp.port") -> DataFrame:
    """Left join of a port to its protocol's name, five characters of it; several names of a port give the least."""
    names = decode.where(F.col("type") == kind).groupBy(F.col("port").alias(port)).agg(F.left(F.min("name"), F.lit(5)).alias("pr"))
    return rows.join(names, port, "left")


def with_asn_name(rows: DataFrame, names: DataFrame, asn: str = "asn") -> DataFrame:
    return rows.join(latest_names(names).withColumnRenamed("asn", asn), asn, "left")
