"""The seen ledger, bucketed by hash of the key.

An entry lies in the folder ``bucket=<hash of its key>``; a lookup opens the buckets
of its own keys only. Entries are sorted by id within a file and carry a Parquet
Bloom filter on it, so a small batch (whose ids are pushed to the scan) skips the row
groups that hold none of them. A bucket of more than ``FILES`` files is merged into
one. So a micro-batch opens at most ``FILES`` + 1 files for each bucket it
touches and reads the row groups that may hold one of its ids, however
long the history.

An entry names the micro-batch that recorded it (``by``). A replay of that batch does
not see its own entries and so computes the same new rows again, which lets
sinks overwrite what the first attempt wrote.

There is one writer at a time. Merging commits the merged file first and deletes
the old ones after; a crash in between leaves entries twice, which changes no lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators.dedup import LEDGER_KEYS
from pulse.sources import folders

#: folders by hash of the key; for a long history about one for ten million keys
BUCKETS = 16
#: files of a bucket before they are merged
FILES = 8
#: ids that are pushed to the scan (Parquet tests them in a nested OR); a larger batch reads its buckets whole
IDS_PUSHED = 200

_IN_LIST = "spark.sql.parquet.pushdown.inFilterThreshold"


def _one_of(column: str, values: set) -> str:
    """SQL test for membership, parsed in one go (a literal each would be a call each)."""
    def literal(v) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)
    some = ", ".join(sorted(literal(v) for v in values if v is not None))
    tests = ([f"`{column}` IN ({some})"] if some else []) + ([f"`{column}` IS NULL"] if None in values else [])
    return " OR ".join(tests) or "false"


class Ledger:
    """Keys that were seen, at ``path``. ``keys`` ends with the id column."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.keys = spark, path, list(keys or LEDGER_KEYS)
        self.id = self.keys[-1]
        made = [n for n in folders.names(spark, path) if n.startswith("_buckets-")]
        # the number of buckets is fixed when the ledger is made
        self.buckets = int(made[0].split("-")[1]) if made else buckets
        self._new = not made
        if int(spark.conf.get(_IN_LIST)) < IDS_PUSHED:
            spark.conf.set(_IN_LIST, str(IDS_PUSHED))

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def lookup(self, rows: DataFrame, by: str | None = None) -> Lookup:
        """The entries that may have a key of ``rows`` (cache them: they are read twice)."""
        bucket = self._bucket().alias("b")
        some = rows.select(bucket, F.col(self.id).alias("i")).distinct().limit(IDS_PUSHED + 1).collect()
        if len(some) <= IDS_PUSHED:
            return Lookup(self, rows, sorted({r.b for r in some}), {r.i for r in some}, by)
        return Lookup(self, rows, sorted(r.b for r in rows.select(bucket).distinct().collect()), None, by)

    def read_buckets(self, buckets: list[int], rows: DataFrame) -> DataFrame | None:
        """Entries of some buckets, with the key types of ``rows``; None if there are none."""
        made = set(folders.names(self.spark, self.path))
        paths = [f"{self.path}/bucket={b}" for b in buckets if f"bucket={b}" in made]
        if not paths:
            return None
        types = dict(rows.dtypes)
        schema = ", ".join(f"`{k}` {types[k]}" for k in self.keys) + ", by string"
        return self.spark.read.schema(schema).parquet(*paths)

    def unseen(self, rows: DataFrame, by: str | None = None) -> DataFrame:
        """``rows`` whose key was not recorded, other than by ``by`` itself."""
        return self.lookup(rows, by).unseen()

    def record(self, rows: DataFrame, by: str, buckets: list[int] | None = None) -> None:
        """Add the keys of ``rows`` (which lie in ``buckets``, where that is known).

        A replay adds its entries once more; merging takes repeated entries out.
        """
        self._append(rows.select(*self.keys).distinct().withColumn("by", F.lit(by)))
        if self._new:
            folders.claim(self.spark, f"{self.path}/_buckets-{self.buckets}")
            self._new = False
        self.merge(range(self.buckets) if buckets is None else buckets)

    def _append(self, entries: DataFrame) -> None:
        bloom = f"parquet.bloom.filter.enabled#{self.id}"
        (entries.withColumn("bucket", self._bucket()).repartition("bucket").sortWithinPartitions("bucket", self.id)
         .write.mode("append").option(bloom, "true").option(f"parquet.bloom.filter.adaptive.enabled#{self.id}", "true")
         .option("parquet.block.size", str(8 << 20)).partitionBy("bucket").parquet(self.path))

    def merge(self, buckets) -> None:
        """Make one file of each of ``buckets`` that has more than ``FILES``."""
        old = [files for b in buckets if len(files := folders.data_files(self.spark, f"{self.path}/bucket={b}")) > FILES]
        if old:
            paths = [f for files in old for f in files]
            self._append(self.spark.read.parquet(*paths).select(*self.keys, "by").distinct())
            for f in paths:
                folders.delete(self.spark, f)

    def read(self) -> DataFrame | None:
        """All keys, each once; None if the ledger is empty."""
        if not any(n.startswith("bucket=") for n in folders.names(self.spark, self.path)):
            return None
        return self.spark.read.parquet(self.path).select(*self.keys).distinct()


class Lookup:
    """The part of a ledger that a frame's keys may be in."""

    def __init__(self, ledger: Ledger, rows: DataFrame, buckets: list[int], ids: set | None, by: str | None):
        self.ledger, self.rows, self.buckets, self.ids, self.by = ledger, rows, buckets, ids, by

    def entries(self) -> DataFrame | None:
        """Entries of the buckets; of a small frame only those with one of its ids."""
        found = self.ledger.read_buckets(self.buckets, self.rows)
        if found is None or self.ids is None:
            return found
        return found.where(_one_of(self.ledger.id, self.ids))

    def unseen(self) -> DataFrame:
        known = self.entries()
        if known is None:
            return self.rows
        if self.by is not None:
            known = known.where(F.col("by") != self.by)
        known = known.select(*[F.col(k).alias(f"_seen_{k}") for k in self.ledger.keys])
        # null-safe: a null key part matches its recorded copy
        return self.rows.join(known, [self.rows[k].eqNullSafe(known[f"_seen_{k}"]) for k in self.ledger.keys], "left_anti")

    def record(self, fresh: DataFrame) -> None:
        """Add the keys of ``fresh``, some of the frame's rows."""
        self.ledger.record(fresh, self.by, self.buckets)
