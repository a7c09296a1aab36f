"""Price marts kept up to date from what each load changes.

A histogram (neighbourhood, month, price, one bedroom) -> number of listings is a sum of
changes: a load takes a listing's old price out and puts its new one in. Exact quartiles,
means, extremes and counts come from it, for any grouping of its keys, without the listings.

A load reads its own rows and one narrow row for each listing that was ever staged, with
what the listing adds to the histogram now. It reads no earlier deliveries and no earlier
load, and it does not read the histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.operators.spool import spool
from rentlens.operators.upsert import KeyedTable

PLACE = ["neighbourhood", "month_start", "price_ksh", "one_bed"]
_PLACE_FIELDS = [
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("month_start", T.DateType()),
    T.StructField("price_ksh", T.IntegerType()),
    T.StructField("one_bed", T.BooleanType()),
]
LISTING = T.StructType(
    [
        T.StructField("property_id", T.StringType()),
        *_PLACE_FIELDS,
        T.StructField("firehose_arrival_at", T.TimestampNTZType()),
        T.StructField("load", T.LongType()),
    ]
)
CHANGE = T.StructType(
    [*_PLACE_FIELDS, T.StructField("n", T.LongType()), T.StructField("load", T.LongType())]
)


class PriceCounts:
    """The histogram under `path`. Loads are numbered upwards; a load that was applied is
    not applied again, and one that failed can be."""

    def __init__(self, spark: SparkSession, path: str, folded_after: int = 20) -> None:
        self.listings = KeyedTable(
            spark, f"{path}/listings", LISTING, ["property_id"], ["firehose_arrival_at", "load"]
        )
        self.changes = KeyedTable(spark, f"{path}/changes", CHANGE, ["load"])
        self.folded_after = folded_after

    def apply(self, staged: DataFrame, load: int) -> None:
        """`staged`: one clean row per listing of the load. A row that arrived before what
        is known of its listing changes nothing."""
        if load <= self.applied():
            return
        newer = spool(self.newer(staged, load))
        # Changes come first: if the load ends before its listings are stored, the next try
        # finds the old ones and replaces its changes.
        self.changes.upsert(self.changed(newer), load)
        self.listings.upsert(newer.select(LISTING.fieldNames()), load)
        self.listings.compact(keep=0)
        if len(self.changes.commits()) > self.folded_after:
            self.changes.compact(change=lambda rows: self._sum(rows, F.max("load").alias("load")))

    def applied(self) -> int:
        return self.listings.read().agg(F.max("load")).first()[0] or 0

    def newer(self, staged: DataFrame, load: int) -> DataFrame:
        """Rows of the load that replace what is known, next to what they replace."""
        rows = staged.select(
            "property_id", "neighbourhood", F.trunc("scraped_date", "month").alias("month_start"), "price_ksh",
            F.coalesce(F.col("bedrooms") == 1, F.lit(False)).alias("one_bed"), "firehose_arrival_at",
            F.lit(load).cast("long").alias("load"),
        )
        known = self.listings.read().select(
            "property_id", F.struct(*PLACE).alias("old"), F.struct("firehose_arrival_at").alias("old_stamp")
        )
        later = F.col("old").isNull() | (F.struct("firehose_arrival_at") >= F.col("old_stamp"))
        return rows.join(known, "property_id", "left").filter(later).drop("old_stamp")

    def changed(self, newer: DataFrame) -> DataFrame:
        """What the rows take out of the histogram and put in, without what stays."""
        put = F.struct(F.struct(*PLACE).alias("place"), F.lit(1).cast("long").alias("n"))
        taken = F.struct(F.col("old").alias("place"), F.lit(-1).cast("long").alias("n"))
        both = newer.select("load", F.explode(F.array(put, taken)).alias("c")).filter("c.place IS NOT NULL")
        return self._sum(both.select("c.place.*", "c.n", "load"), F.first("load").alias("load"))

    @staticmethod
    def _sum(rows: DataFrame, load) -> DataFrame:
        return rows.groupBy(*PLACE).agg(F.sum("n").alias("n"), load).filter("n <> 0").select(CHANGE.fieldNames())

    def counts(self) -> DataFrame:
        """The histogram as it is now."""
        return self.changes.read().groupBy(*PLACE).agg(F.sum("n").alias("n")).filter("n <> 0")

    def mart(self, *keys: str) -> DataFrame:
        """Counts, means, extremes and quartiles of rent by some of the histogram's keys,
        those that are not null. Each distinct price of a group is read once."""
        rows = self.counts().dropna(subset=[*keys, "price_ksh"])
        price, n, one = F.col("price_ksh"), F.col("n"), F.col("one_bed")

        def mean(weight):
            return F.round(F.sum(price.cast("double") * weight) / F.nullif(F.sum(weight), F.lit(0)))

        found = rows.groupBy(*keys).agg(
            F.sum("n").alias("total_listings"),
            mean(n).alias("avg_rent_ksh"),
            F.min("price_ksh").alias("min_rent_ksh"),
            F.max("price_ksh").alias("max_rent_ksh"),
            F.percentile("price_ksh", [0.25, 0.5, 0.75], n).alias("p"),
            mean(F.when(one, n).otherwise(0)).alias("avg_1br_rent_ksh"),
            F.sum(F.when(one, n).otherwise(0)).alias("listings_1br"),
        )
        rounded = [F.round(F.col("p")[i]) for i in range(3)]
        return found.select(
            *keys, "total_listings", "avg_rent_ksh", "min_rent_ksh", "max_rent_ksh", rounded[0].alias("p25_rent_ksh"),
            rounded[1].alias("median_rent_ksh"), rounded[2].alias("p75_rent_ksh"),
            (rounded[2] - rounded[0]).alias("iqr_rent_ksh"), "avg_1br_rent_ksh", "listings_1br",
        )
