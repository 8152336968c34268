"""Table maintenance on plain Parquet: merge, append, replace a partition, load status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlake.sources.landing import new_folder


def merge_upsert(target: DataFrame, batch: DataFrame, keys: list[str], updates: list[str], id_column: str | None = "id") -> DataFrame:
    """Rows of the target, with ``updates`` taken from the batch where a key matches, and the batch's new rows.

    Of a key that the batch has several times, the last row counts by ``position`` if the batch has that column, else
    the largest.  Columns that aren't in ``updates`` keep their old value.  New rows get the id that their key hashes
    to, unless they bring one.  Both sides meet on the key once; rows of the batch with a null in the key are left out.
    """
    keyed = batch.na.drop(subset=keys)
    last = keyed.groupBy(*keys).agg(_last(batch, keys).alias("r")).select(*keys, "r.*")
    side = last.select(*(F.col(c).alias(f"__{c}") for c in last.columns), F.lit(True).alias("__in"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys]
    joined = target.withColumn("__old", F.lit(True)).join(side, on, "full")
    return _merged(joined, target.schema, last.columns, keys, updates, id_column)


def merge_grouped(target: DataFrame, batch: DataFrame, keys: list[str], updates: list[str], groups: dict[str, Column], id_column: str | None = "id") -> DataFrame:
    """The rows of ``merge_upsert`` and the columns ``groups``, which follow from the key, for a target with each key once and no null in it.

    Rows of both sides go through one exchange, by the groups alone, and so are in the task of their group when they are stored.
    """
    rest, own = [c for c in batch.columns if c not in keys], [c for c in target.columns if c not in keys]
    typed = batch.na.drop(subset=keys).withColumns({k: F.col(k).cast(target.schema[k].dataType) for k in keys})
    new = typed.select(*keys, F.struct(*rest).alias("__n"), F.lit(None).cast(target.select(F.struct(*own)).schema[0].dataType).alias("__o"))
    old = target.select(*keys, F.lit(None).cast(new.schema["__n"].dataType).alias("__n"), F.struct(*own).alias("__o"))
    rows = new.unionByName(old).withColumns(groups).repartition(*groups)
    last = _last(batch, keys, lambda c: F.col("__n")[c], F.col("__n"))
    one = rows.groupBy(*groups, *keys).agg(last.alias("__n"), F.first("__o", ignorenulls=True).alias("__o"))
    values = [c for c in rest if c != "position"]
    there, here = F.col("__o").isNotNull(), F.col("__n").isNotNull()
    joined = one.select(
        *groups, *(F.when(there, F.col(k)).alias(k) for k in keys), *(F.col("__o")[c].alias(c) for c in own), there.alias("__old"),
        *(F.when(here, F.col(k)).alias(f"__{k}") for k in keys), *(F.col("__n")[c].alias(f"__{c}") for c in values), here.alias("__in"),
    )
    return _merged(joined, target.schema, [*keys, *values], keys, updates, id_column, list(groups))


def _last(batch: DataFrame, keys: list[str], at: Callable[[str], Column] = F.col, whole: Column | None = None) -> Column:
    """Aggregate: the columns of the row of a key that counts, without position."""
    rest = [c for c in batch.columns if c not in keys]
    if "position" not in rest:
        return F.max(F.struct(*rest) if whole is None else whole)
    return F.max_by(F.struct(*(at(c).alias(c) for c in rest if c != "position")), at("position"))


def _merged(joined: DataFrame, schema: T.StructType, last: list[str], keys: list[str], updates: list[str], id_column: str | None, more: list[str] | None = None) -> DataFrame:
    """The merged rows of pairs: columns of the old row, of the new one behind '__', and which of the two are there."""
    given = [c for c in updates if c in last]
    old = F.coalesce(F.col("__old"), F.lit(False))

    def value(c: str):
        kind = schema[c].dataType
        new = F.col(f"__{c}").cast(kind) if c in last else F.lit(None).cast(kind)
        if c == id_column:
            new = F.coalesce(new, F.xxhash64(*(F.col(f"__{k}") for k in keys)))
        if c in given:
            return F.when(F.coalesce(F.col("__in"), F.lit(False)), new).otherwise(F.col(c)).alias(c)
        return F.when(old, F.col(c)).otherwise(new).alias(c)

    return joined.select(*(more or []), *(value(c) for c in schema.names))


def update_load_status(status: DataFrame, batch: DataFrame) -> DataFrame:
    """Load status by id; last_success moves only with a load that was ok."""
    side = batch.select(*(F.col(c).alias(f"__{c}") for c in batch.columns))
    joined = status.join(side, F.col("id") == F.col("__id"), "full")
    ok = F.col("__status") == "ok"
    pick = lambda c: F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if f"__{c}" in joined.columns else F.col(c)
    success = F.when(ok, F.col("__last_fetch")).otherwise(F.col("last_success")).alias("last_success")
    error = F.when(F.col("__id").isNotNull(), F.col("__error_message")).otherwise(F.col("error_message")).alias("error_message")
    return joined.select(*(success if c == "last_success" else error if c == "error_message" else pick(c) for c in status.columns))


def append_with_ids(target: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """Both tables; the batch's rows get ids that go on after the target's largest, without gaps, in an order.

    The batch is stored in ranges of the order before it is numbered: sizes and rows then come from the same ranges,
    while a second run of a range exchange would sample other borders.  Rows are numbered inside their range and the
    ranges' sizes (one number each) are added up, so no task sees all rows.  Rows that the order doesn't tell apart are
    spread by a hash of their columns.
    """
    spark = batch.sparkSession
    top = target.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    rest = [c for c, kind in batch.dtypes if c not in order and "map<" not in kind]
    keys = [*map(F.col, order), *([F.xxhash64(*rest)] if rest else [])]
    path = new_folder(spark, "ranges")
    batch.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    before, offsets = 0, []
    for r in ranged.groupBy("__range").count().orderBy("__range").collect():
        offsets.append((r["__range"], top + before))
        before += r["count"]
    if not offsets:
        return target
    own = Window.partitionBy("__range").orderBy(*keys)
    numbered = ranged.withColumn("__n", F.row_number().over(own)).join(F.broadcast(spark.createDataFrame(offsets, "__range int, __before long")), "__range")
    rows = numbered.withColumn("id", F.col("__before") + F.col("__n"))
    return target.unionByName(rows.drop("__range", "__before", "__n"), allowMissingColumns=True)


def replace_source(df: DataFrame, path: str) -> None:
    """Write rows so that they replace the partitions of their sources alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, change, field, old_value, new_value): new and gone rows, and each changed field."""
    a = old.select(*keys, *(F.col(c).cast("string").alias(f"__a_{c}") for c in columns), F.lit(True).alias("__a"))
    b = new.select(*keys, *(F.col(c).cast("string").alias(f"__b_{c}") for c in columns), F.lit(True).alias("__b"))
    joined = a.join(b, keys, "full")
    change = F.when(F.col("__a").isNull(), "new").when(F.col("__b").isNull(), "closed").otherwise("updated")
    fields = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"__a_{c}").alias("old_value"), F.col(f"__b_{c}").alias("new_value")) for c in columns))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("old_value"), F.lit(None).cast("string").alias("new_value")))
    differing = F.filter(fields, lambda f: ~f["old_value"].eqNullSafe(f["new_value"]))
    rows = joined.select(*keys, change.alias("change"), F.explode(F.when(change == "updated", differing).otherwise(whole)).alias("f"))
    return rows.select(*keys, "change", "f.*")
