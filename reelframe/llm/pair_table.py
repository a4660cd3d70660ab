"""Items that appear together: an incremental table of pair counts with association scores."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.session import scratch_path

#: A bucket is rewritten once the rows added to it since make up this share of it; up to then batches lie beside it and are added up on reading.
MERGE_SHARE = 0.25

_ROW = "a string, b string, d long"


def signed_deltas(changes: DataFrame, before: str, after: str) -> DataFrame:
    """Signed deltas of changed baskets: (a, b, d) with b null for the count of one item, both null for the baskets.

    ``before`` and ``after`` are arrays of strings, the basket as counted so far and as it is now (null or empty:
    none). Nulls and repeated items within a basket do not count. A basket becomes a row an item first, and each of these is paired with the
    items behind it, so that no row holds the pairs of a whole basket. What is in both versions gives nothing.
    """

    def clean(c: str):  # noqa: ANN202
        return F.array_distinct(F.array_compact(F.coalesce(F.col(f"`{c}`"), F.array().cast("array<string>"))))

    rows = changes.select(clean(before).alias("o"), clean(after).alias("n"))
    # array_sort orders by UTF-8 bytes, which is code point order.
    rows = rows.withColumn("u", F.array_sort(F.array_union("o", "n"))).where("size(u) > 0")
    flag = lambda c: F.col(c).cast("long")
    items = F.transform("u", lambda x: F.struct(x.alias("x"), F.array_contains("o", x).cast("long").alias("o"), F.array_contains("n", x).cast("long").alias("n")))
    rows = rows.select(items.alias("u"), ((F.size("n") > 0).cast("long") - (F.size("o") > 0).cast("long")).alias("whole"))
    rows = rows.where(F.exists("u", lambda x: x["o"] != x["n"]))
    ones = rows.select("whole", "u", F.posexplode("u").alias("i", "e"))
    ones = ones.select(F.when(F.col("i") == 0, F.col("whole")).otherwise(0).alias("whole"), F.col("e.x").alias("a"), F.col("e.o").alias("ao"), F.col("e.n").alias("an"), F.expr("slice(u, i + 2, size(u))").alias("rest"))
    pair = lambda y: F.struct(F.col("a").alias("a"), y["x"].alias("b"), (F.col("an") * y["n"] - F.col("ao") * y["o"]).alias("d"))
    none = F.lit(None).cast("string")
    own = F.array(F.struct(none.alias("a"), none.alias("b"), flag("whole").alias("d")), F.struct(F.col("a").alias("a"), none.alias("b"), (flag("an") - flag("ao")).alias("d")))
    got = ones.select(F.explode(F.concat(own, F.transform("rest", pair))).alias("x")).select("x.*").where("d <> 0")
    return got.groupBy("a", "b").agg(F.sum("d").alias("d")).where("d <> 0")


class PairTable:
    """Persistent counts of items and pairs in hash buckets, brought up to date by changed baskets.

    The table lies below ``path`` (default: a fresh folder in the cluster's shared one); a PairTable of the same path goes on where the last one
    stopped. Rows are (a, b, d): b is null for an item. Their bucket is a hash of the whole key, so that an item in a third of all pairs fills no bucket of
    its own; the number of ``buckets`` is fixed when the table is created and should grow with the pairs expected.

    ``apply`` writes a batch's deltas to a folder of its own, split by bucket. A bucket to which much has been added is merged into a new folder,
    the others keep their folders and take the batch's beside them: the cost of a batch follows its deltas, not the table. Last of all
    the manifest of the new version is put in place by a rename: it names the folders of each bucket and the number of baskets. A batch that fails before
    that leaves no trace and can be tried again; a second writer of the same version fails at the rename.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64) -> None:
        self.spark, self.path = spark, path or scratch_path(spark, "pairs")
        self._state = self._latest() or {"version": 0, "n": 0, "buckets": buckets, "parts": {}, "delta": None, "batch": None}

    @property
    def version(self) -> int:
        return self._state["version"]

    @property
    def n(self) -> int:
        """Baskets that hold anything."""
        return self._state["n"]

    def _hadoop(self, name: str):  # noqa: ANN202
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _latest(self) -> dict | None:
        folder, fs = self._hadoop("manifest")
        if not fs.exists(folder):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        done = sorted(x for x in names if x.endswith(".json"))
        if not done:
            return None
        return json.loads(self.spark.read.text(f"{self.path}/manifest/{done[-1]}", wholetext=True).first()[0])

    def _publish(self, state: dict) -> None:
        name = f"manifest/{state['version']:012d}"
        final, fs = self._hadoop(f"{name}.json")
        draft, _ = self._hadoop(f"{name}-{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        out.writeBytes(json.dumps(state))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"version {state['version']} of {self.path} was written by another")
        self._state = state

    def _rows(self, buckets: list[int] | None = None) -> DataFrame:
        """a, b, d and bucket of all buckets or of those given; a key may come in several rows."""
        by: dict[str, list[int]] = {}
        for k, part in self._state["parts"].items():
            for p in part["folders"]:
                if buckets is None or int(k) in buckets:
                    by.setdefault(p, []).append(int(k))
        out = self.spark.createDataFrame([], f"{_ROW}, bucket int")
        for p, ks in by.items():
            out = out.unionByName(self.spark.read.schema(f"{_ROW}, bucket int").parquet(f"{self.path}/{p}").where(F.col("bucket").isin(ks)))
        return out

    def _counts(self, kind: str) -> DataFrame:
        """Keys with their counts; buckets that lie in one folder need no adding up."""
        many = [int(k) for k, p in self._state["parts"].items() if len(p["folders"]) > 1]
        one = [int(k) for k, p in self._state["parts"].items() if len(p["folders"]) == 1]
        out = self._rows(one).where(kind).select("a", "b", "d") if one else self.spark.createDataFrame([], _ROW)
        if many:
            out = out.unionByName(self._rows(many).where(kind).groupBy("a", "b").agg(F.sum("d").alias("d")).where("d <> 0"))
        return out

    def pairs(self) -> DataFrame:
        """a, b, n_ab of the pairs."""
        return self._counts("b IS NOT NULL").select("a", "b", F.col("d").alias("n_ab"))

    def items(self) -> DataFrame:
        """a, n_a of the single items."""
        return self._counts("b IS NULL").select("a", F.col("d").alias("n_a"))

    def apply(self, changes: DataFrame, before: str, after: str, batch: str | None = None) -> None:
        """Count a batch of changed baskets in. An empty batch changes nothing.

        ``batch`` names it: a batch of the name that was applied last counts no second time (its first try may have been cut off after the rename).
        """
        state = self._state
        if batch is not None and batch == state["batch"]:
            return
        own = f"v{state['version'] + 1}-{uuid.uuid4().hex}"
        bucket = F.when(F.col("a").isNull(), -1).otherwise(F.pmod(F.xxhash64("a", "b"), F.lit(state["buckets"]))).cast("int")
        deltas = signed_deltas(changes, before, after).withColumn("bucket", bucket)
        deltas.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{own}/delta")
        delta = self.spark.read.schema(f"{_ROW}, bucket int").parquet(f"{self.path}/{own}/delta")
        got = {r["bucket"]: (r["k"], r["s"]) for r in delta.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.sum("d").alias("s")).collect()}  # a row a bucket
        n = state["n"] + (got.pop(-1)[1] if -1 in got else 0)
        parts = dict(state["parts"])
        merge = []
        for k, (rows, _) in got.items():
            old = parts.get(str(k), {"rows": 0, "added": 0, "folders": []})
            if old["folders"] and old["added"] + rows > MERGE_SHARE * old["rows"]:
                merge.append(k)
                parts[str(k)] = {"rows": old["rows"] + old["added"] + rows, "added": 0, "folders": [f"{own}/merged"]}
            elif old["folders"]:
                parts[str(k)] = {"rows": old["rows"], "added": old["added"] + rows, "folders": [*old["folders"], f"{own}/delta"]}
            else:
                parts[str(k)] = {"rows": rows, "added": 0, "folders": [f"{own}/delta"]}
        if merge:
            both = self._rows(merge).unionByName(delta.where(F.col("bucket").isin(merge)))
            both = both.groupBy("bucket", "a", "b").agg(F.sum("d").alias("d")).where("d <> 0")
            both.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{own}/merged")
        self._publish({**state, "version": state["version"] + 1, "n": n, "parts": parts, "delta": f"{own}/delta", "batch": batch})

    def scores(self, changed: DataFrame | None = None) -> DataFrame:
        """a, b, n, n_a, n_b, n_ab and lift = n_ab * n / (n_a * n_b).

        With ``changed`` (a column a of items whose count or pairs changed), the pairs that hold such an item only.
        """
        pairs = self.pairs()
        if changed is not None:
            hit = changed.select(F.col("a").alias("x")).distinct()
            first, second = F.col("a") == F.col("x"), F.col("b") == F.col("x")
            pairs = pairs.join(hit, first, "left_semi").unionByName(pairs.join(hit, first, "left_anti").join(hit, second, "left_semi"))
        n = F.lit(self.n).cast("long")
        items = self.items()
        out = pairs.join(items, "a").join(items.select(F.col("a").alias("b"), F.col("n_a").alias("n_b")), "b")
        return out.select("a", "b", n.alias("n"), "n_a", "n_b", "n_ab", (F.col("n_ab") / F.col("n_a") * n / F.col("n_b")).alias("lift"))

    def changed_items(self) -> DataFrame:
        """The items that the last batch touched."""
        if not self._state["delta"]:
            return self.spark.createDataFrame([], "a string")
        d = self.spark.read.schema(f"{_ROW}, bucket int").parquet(f"{self.path}/{self._state['delta']}").where("a IS NOT NULL")
        return d.select("a").unionByName(d.where("b IS NOT NULL").select(F.col("b").alias("a"))).distinct()
