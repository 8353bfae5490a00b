"""The stored tail of the bar table: what live documents look back on, kept up to date batch by batch.

A live document needs the last N bars of each timeframe and, for the exponential means, the HORIZON bars before them;
nothing older has any weight. The tail holds these bars per series, with the running totals (on-balance volume) that
started before them. A batch is merged into the newest version and gives the next one, so the work of a batch follows
the size of the tail and of the batch, not of the history.
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import FULL_LIMITS, INDICATOR_COLUMNS
from tickloom.operators.asof import last_per_timeframe
from tickloom.operators.ewm import HORIZON
from tickloom.operators.indicators import on_balance_volume, stored_indicators
from tickloom.operators.sequence import SERIES
from tickloom.plans.documents import RANGE_BARS
from tickloom.sources.sinks import BAR_KEY


class BarTail:
    """Versions of the tail under ``path``; ``limits`` are the bars per timeframe that documents show."""

    def __init__(self, path, limits=FULL_LIMITS):
        self.path = path
        self.rows = {tf: max(n, RANGE_BARS if tf == "M1" else 0) + HORIZON for tf, n in limits.items()}

    def _fs(self, spark, path):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder

    def versions(self, spark):
        """Numbers of the complete versions, ascending; that of the seed is -1."""
        fs, folder = self._fs(spark, self.path)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and fs.exists(self._fs(spark, f"{self.path}/{n}/_SUCCESS")[1]))

    def _write(self, rows, version):
        cut = last_per_timeframe(rows, self.rows)
        cut.repartition(*SERIES).write.mode("overwrite").parquet(f"{self.path}/v={version}")

    def seed(self, bars):
        """Begin from a stored table of all bars."""
        self._write(on_balance_volume(bars), -1)

    def read(self, spark, version=None):
        """Bars of a version (the newest one by default) with ``obv``; None if there is none."""
        found = self.versions(spark) if version is None else [version]
        return spark.read.parquet(f"{self.path}/v={found[-1]}") if found else None

    def advance(self, batch, batch_id):
        """Merge the bars of a batch and return the new tail. A batch that is run again starts from the version before
        it. A bar that comes twice counts as it came last; bars older than a full tail change nothing any more."""
        spark = batch.sparkSession
        older = [v for v in self.versions(spark) if v < batch_id]
        new = batch.withColumn("_known", F.lit(None).cast("double"))
        if older:
            old = self.read(spark, older[-1]).withColumnRenamed("obv", "_known")
            first = old.groupBy(*SERIES).agg(F.min("open_time").alias("_first"), F.count(F.lit(1)).alias("_n"))
            full = F.col("_n") >= F.create_map(*[F.lit(x) for kv in self.rows.items() for x in kv])[F.col("timeframe")]
            new = new.join(first, SERIES, "left").where(~F.coalesce(full & (F.col("open_time") < F.col("_first")), F.lit(False)))
            both = old.withColumn("_turn", F.lit(0)).unionByName(new.drop("_first", "_n").withColumn("_turn", F.lit(1)), allowMissingColumns=True)
            newest = Window.partitionBy(*BAR_KEY).orderBy(F.desc("_turn"))
            both = both.withColumn("_known", F.max("_known").over(Window.partitionBy(*BAR_KEY)))
            new = both.withColumn("_k", F.row_number().over(newest)).where("_k = 1").drop("_k", "_turn")
        rows = on_balance_volume(new)
        # the running total of the tail starts at its first bar: shift it to what that bar had
        at_first = rows.where("_known is not null").groupBy(*SERIES).agg(F.min_by(F.col("_known") - F.col("obv"), "open_time").alias("_shift"))
        rows = rows.join(at_first, SERIES, "left").withColumn("obv", F.col("obv") + F.coalesce("_shift", F.lit(0.0)))
        self._write(rows.drop("_shift", "_known"), batch_id)
        for v in older[:-1]:
            fs, folder = self._fs(spark, f"{self.path}/v={v}")
            fs.delete(folder, True)
        return self.read(spark, batch_id)

    def with_indicators(self, tail):
        """The tail with all stored indicators, equal to those of the whole history for the bars that documents show."""
        made = stored_indicators(tail.drop("obv"), [c for c in INDICATOR_COLUMNS if c != "obv"])
        return made.join(tail.select(*BAR_KEY, "obv"), BAR_KEY)
