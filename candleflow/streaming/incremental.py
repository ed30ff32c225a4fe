"""Incremental features (T2 and T3) and stream scoring (T4).

Row-offset windows are not allowed on a stream, so the features of a stream
are kept up to date in ``foreachBatch``.  Every micro-batch is merged with the
stored silver rows: a candle that is new, or newer than the stored copy (see
``operators.clean.newest_candles``), is stored, whatever its time, so lagging
symbols, backfills and revised candles are all taken in.  A changed candle
touches the features of the 10 rows before it (label) to the 9 rows after it
(trailing frames); those rows are recomputed from the stored rows around them
and written as a new version.  :func:`read_features` gives the newest version
of every row.

State is kept by time: stored rows lie in folders ``batch_id=N/bucket=B``, a
bucket being a stretch of time, and a small table of counts says how many
candles each symbol has in each bucket and which batches hold rows of it.  The
counts tell which buckets reach within 19 rows of a change, and a micro-batch
reads those folders only, however long the history is.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.clean import newest_candles, present
from ..operators.features import add_features
from ..operators.score import score, to_predictions
from ..session import delete_paths, materialize, scratch_scope
from ..sinks.versions import PREFIX, new_version, numbered, published

BEFORE, AFTER = schemas.LABEL_LEAD_ROWS, max(schemas.PREV_LAG_ROWS, schemas.MA_LONG_ROWS - 1)
REACH = BEFORE + AFTER
VERSION, BUCKET = "batch_id", "bucket"
#: Seconds of a bucket: a day.
BUCKET_SECONDS = 86_400
_KEYS = (schemas.SYMBOL, schemas.OPEN_TIME)
_COUNTS = T.StructType([T.StructField(schemas.SYMBOL, T.StringType()), T.StructField(BUCKET, T.LongType()), T.StructField("n", T.LongType())])
_BATCH = f"{VERSION}="


class MissingStateError(RuntimeError):
    """The stored rows of an earlier micro-batch are gone."""


class CompactedBatchError(RuntimeError):
    """A micro-batch at or below the low-water version was started again."""


class StoredRows:
    """The rows of finished micro-batches under ``path``.

    ``batch_id=N/bucket=B`` holds the rows that batch N changed,
    ``_counts/batch_id=N`` how many of them were new, by symbol and bucket.
    ``_base/version=W`` is what :func:`compact_state` made of the batches up
    to W, its low-water version: ``rows/bucket=B`` and ``counts``, which name
    the version that holds each bucket.
    """

    def __init__(self, spark: SparkSession, path: str, before: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        done = published(spark, f"{self.path}/_base")
        self.low_water = done[-1] if done else -1
        self.batches = [k for k in numbered(spark, self.path, _BATCH) if k > self.low_water and (before is None or k < before)]
        if before is not None:
            if before <= self.low_water:
                raise CompactedBatchError(f"micro-batch {before} lies below the low-water version {self.low_water}")
            gone = sorted(set(range(self.low_water + 1, before)) - set(self.batches))
            if gone:
                raise MissingStateError(f"micro-batch {before} needs {self.path}/{_BATCH}{gone[0]}")

    def counts(self) -> DataFrame:
        """symbol, bucket, n, batch_id: one row per symbol, bucket and batch
        that changed rows there."""
        schema = T.StructType([*_COUNTS.fields, T.StructField(VERSION, T.LongType())])
        out = self.spark.createDataFrame([], schema)
        if self.low_water >= 0:
            out = self.spark.read.schema(schema).parquet(f"{self.path}/_base/{PREFIX}{self.low_water}/counts")
        if self.batches:
            folders = [f"{self.path}/_counts/{_BATCH}{k}" for k in self.batches]
            out = out.unionByName(self.spark.read.schema(schema).option("basePath", f"{self.path}/_counts").parquet(*folders))
        return out

    def folders(self, counts: DataFrame) -> list[tuple[int, str]]:
        """(version, folder) of the rows that ``counts`` tells of.  As many
        numbers reach the driver as there are folders to read."""
        found = counts.select(VERSION, BUCKET).distinct().collect()
        return sorted((r[VERSION], f"{self.path}/_base/{PREFIX}{r[VERSION]}/rows/{BUCKET}={r[BUCKET]}" if r[VERSION] <= self.low_water
                       else f"{self.path}/{_BATCH}{r[VERSION]}/{BUCKET}={r[BUCKET]}") for r in found)

    def rows(self, folders: Iterable[tuple[int, str]], schema: T.StructType) -> DataFrame:
        """The rows in ``folders`` with their bucket and version."""
        full = T.StructType([*schema.fields, T.StructField(BUCKET, T.LongType())])
        out = self.spark.createDataFrame([], T.StructType([*full.fields, T.StructField(VERSION, T.LongType())]))
        by_version: dict[int, list[str]] = {}
        for version, folder in folders:
            by_version.setdefault(version, []).append(folder)
        if old := [v for v in by_version if v <= self.low_water]:
            for v in old:
                base = self.spark.read.schema(full).option("basePath", f"{self.path}/_base/{PREFIX}{v}/rows").parquet(*by_version[v])
                out = out.unionByName(base.withColumn(VERSION, F.lit(v).cast("long")))
        if new := [f for v, fs in by_version.items() if v > self.low_water for f in fs]:
            both = T.StructType([*full.fields, T.StructField(VERSION, T.LongType())])
            out = out.unionByName(self.spark.read.schema(both).option("basePath", self.path).parquet(*new))
        return out

    def write(self, changed: DataFrame, added: DataFrame, batch_id: int) -> None:
        _write_buckets(changed, f"{self.path}/{_BATCH}{batch_id}")
        # One small file: a row per symbol and bucket of the batch.
        added.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_counts/{_BATCH}{batch_id}")


def _write_buckets(rows: DataFrame, path: str) -> None:
    """Rows in folders ``bucket=B``, few files each, sorted so that their
    statistics tell symbols and times apart."""
    laid = rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *_KEYS)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path)


def _newest(rows: DataFrame, keys: Sequence[str] = _KEYS) -> DataFrame:
    """The newest version of every row; its version stays in ``batch_id``."""
    rest = [c for c in rows.columns if c not in (*keys, VERSION)]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), VERSION).alias("_cf_row"), F.max(VERSION).alias(VERSION))
    return best.select(*keys, *[F.col(f"_cf_row.{c}").alias(c) for c in rest], VERSION)


class IncrementalFeatures:
    """``foreachBatch`` function that keeps a feature table up to date.

    ``state_path`` gets the silver rows that each micro-batch changed (see
    :class:`StoredRows`), ``out_path`` the feature rows it touched, in folders
    named by the batch that a retry overwrites, so the result is exactly-once.
    A touched row that the null policy leaves out (no label yet, say) is
    written with ``live = false``.  The scratch tables of a micro-batch are
    deleted when it ends.  If an earlier batch's state is missing the batch
    fails with :class:`MissingStateError`, if it was compacted already with
    :class:`CompactedBatchError`; wrong features are never written.

    A micro-batch reads the counts, and the stored rows of the buckets that
    reach within ``REACH`` rows of one of its candles; ``folders_read`` names
    the folders of the last one.  Candles that lie far apart (a backfill and
    the newest candle) read nothing in between.
    """

    def __init__(
        self,
        out_path: str,
        state_path: str,
        null_policy: str = schemas.DEFAULT_NULL_POLICY,
        columns: Sequence[str] = schemas.SILVER_COLUMNS,
        bucket_seconds: int = BUCKET_SECONDS,
    ):
        self.out_path = out_path
        self.state_path = state_path
        self.null_policy = null_policy
        self.columns = list(columns)
        self.bucket_seconds = int(bucket_seconds)
        self.folders_read: list[str] = []

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark):
            rows = batch.select(*self.columns).dropna(how="any")
            schema = rows.schema
            bucket = F.floor(F.unix_seconds(F.col(schemas.OPEN_TIME).cast("timestamp")) / F.lit(self.bucket_seconds)).cast("long")
            new = materialize(newest_candles(rows).withColumn(BUCKET, bucket), "new-candles")
            stored = StoredRows(spark, self.state_path, batch_id)
            counts = stored.counts()
            needed = materialize(self._needed(counts, new), "needed-buckets") if batch_id > 0 else counts
            folders = stored.folders(needed) if batch_id > 0 else []
            self.folders_read = [f for _, f in folders]
            near = stored.rows(folders, schema).join(needed.select(schemas.SYMBOL, BUCKET).distinct(), [schemas.SYMBOL, BUCKET], "left_semi")
            changed = materialize(self._changed(new, near, batch_id), "changed-candles")
            stored.write(changed.drop("_cf_new"), changed.groupBy(schemas.SYMBOL, BUCKET).agg(F.count_if("_cf_new").alias("n")), batch_id)
            region = near.unionByName(changed.drop("_cf_new").withColumn(VERSION, F.lit(batch_id).cast("long")))
            touched = self._touched(materialize(_newest(region), "region"), batch_id)
            _write_buckets(touched, f"{self.out_path}/{_BATCH}{batch_id}")

    def _changed(self, new: DataFrame, stored: DataFrame, batch_id: int) -> DataFrame:
        """The candles of the batch that aren't stored (``_cf_new``) or are
        newer than the stored copy.  Of equal trade counts the later poll wins
        if it differs."""
        hits = stored.join(new.select(*_KEYS), list(_KEYS), "left_semi")
        both = hits.unionByName(new.withColumn(VERSION, F.lit(batch_id).cast("long")))
        rest = [c for c in self.columns if c not in (*_KEYS, "number_of_trades")]
        order = F.struct("number_of_trades", VERSION, *rest, BUCKET)
        best = both.groupBy(*_KEYS).agg(F.max(order).alias("best"), F.max(F.when(F.col(VERSION) < batch_id, order)).alias("old"))

        def content(row: str) -> Column:
            return F.struct(*[F.col(f"{row}.{c}") for c in ("number_of_trades", *rest)])

        differs = F.col("old").isNull() | ~content("best").eqNullSafe(content("old"))
        won = best.where((F.col(f"best.{VERSION}") == batch_id) & differs)
        return won.select(*[F.col(c) if c in _KEYS else F.col(f"best.{c}").alias(c) for c in (*self.columns, BUCKET)], F.col("old").isNull().alias("_cf_new"))

    def _needed(self, counts: DataFrame, new: DataFrame) -> DataFrame:
        """The counts of the buckets that hold candles of the batch or lie
        within ``REACH`` rows of one that does.  The window runs over one row
        per bucket, not per candle."""
        hot = new.groupBy(schemas.SYMBOL, BUCKET).agg(F.lit(0).cast("long").alias("n"), F.lit(True).alias("hot"))
        mine = counts.join(new.select(schemas.SYMBOL).distinct(), schemas.SYMBOL, "left_semi")
        per = mine.select(schemas.SYMBOL, BUCKET, "n", F.lit(False).alias("hot")).unionByName(hot).groupBy(schemas.SYMBOL, BUCKET).agg(
            F.sum("n").alias("n"), F.max("hot").alias("hot"))
        order = Window.partitionBy(schemas.SYMBOL).orderBy(BUCKET)
        sums = per.withColumn("through", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.col("through") - F.col("n"))
        ahead = F.min(F.when(F.col("hot"), F.col("before"))).over(order.rowsBetween(1, Window.unboundedFollowing))
        behind = F.max(F.when(F.col("hot"), F.col("through"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        reach = sums.withColumn("ahead", ahead - F.col("through")).withColumn("behind", F.col("before") - behind)
        wanted = reach.where(F.col("hot") | (F.col("ahead") < REACH) | (F.col("behind") < REACH)).select(schemas.SYMBOL, BUCKET)
        return mine.join(wanted, [schemas.SYMBOL, BUCKET], "left_semi")

    def _touched(self, region: DataFrame, batch_id: int) -> DataFrame:
        """Feature rows within ``BEFORE`` rows ahead of a changed candle to
        ``AFTER`` rows behind one.  Between two stretches of the region lie
        ``REACH`` rows of context at least, so what is kept sees its own."""
        def near_change(w):
            return {"_cf_near": F.max(F.col(VERSION) == batch_id).over(w.rowsBetween(-AFTER, BEFORE))}

        feats = add_features(region, extra=near_change)
        columns = [c for c in schemas.FEATURE_COLUMNS if c in feats.columns]
        return feats.where("_cf_near").select(*columns, BUCKET, present(feats.drop(VERSION, BUCKET, "_cf_near"), self.null_policy).alias("live"))


def _feature_versions(spark: SparkSession, out_path: str) -> DataFrame:
    """All stored versions of the feature rows: of the batches, and of the
    compacted buckets."""
    out_path = out_path.rstrip("/")
    row = T.StructType([*schemas.FEATURES.fields, T.StructField("live", T.BooleanType()), T.StructField(BUCKET, T.LongType())])
    rows = spark.read.schema(T.StructType([*row.fields, T.StructField(VERSION, T.LongType())])).parquet(out_path)
    for v in published(spark, f"{out_path}/_base"):
        base = spark.read.schema(row).parquet(f"{out_path}/_base/{PREFIX}{v}")
        rows = rows.unionByName(base.withColumn(VERSION, F.lit(v).cast("long")))
    return rows


def read_features(spark: SparkSession, out_path: str) -> DataFrame:
    """The feature table that :class:`IncrementalFeatures` keeps: the newest
    version of every row, without those that the null policy leaves out."""
    return _newest(_feature_versions(spark, out_path)).where("live").drop("live", VERSION, BUCKET)


def compact_state(spark: SparkSession, out_path: str, state_path: str) -> int:
    """Merge the micro-batches of a feature stream; returns the low-water
    version, up to which batches are merged.  Run it between two runs of the
    stream.

    The newest batch is left as it is, since the stream may have to repeat it.
    Buckets that the merged batches touched are rewritten with the newest
    version of their rows; the others stay where they are, so the work grows
    with what was written since the last time, not with the history.  Base
    versions count once they are complete (see ``sinks.versions``); only then
    are the folders they replace deleted.  A job lost in between leaves
    folders that the next compaction deletes and readers see through, as an
    older version of a row never wins.
    """
    out_path, state_path = out_path.rstrip("/"), state_path.rstrip("/")
    stored = StoredRows(spark, state_path)
    merged = stored.batches[:-1]
    _forget(spark, out_path, state_path, stored.low_water)
    if not merged:
        return stored.low_water
    through = merged[-1]
    with scratch_scope(spark):
        counts = stored.counts().where(F.col(VERSION) <= through)
        touched = counts.where(F.col(VERSION) > stored.low_water).select(BUCKET).distinct()
        version = F.coalesce(F.when(F.col("_cf_touched"), F.lit(through)).cast("long"), F.col(VERSION))
        marked = counts.join(touched.withColumn("_cf_touched", F.lit(True)), BUCKET, "left")
        total = materialize(marked.withColumn(VERSION, version).groupBy(schemas.SYMBOL, BUCKET, VERSION).agg(F.sum("n").alias("n")), "compact-counts")
        folders = stored.folders(counts.join(touched, BUCKET, "left_semi"))
        # The features first: they need no low-water version of their own.
        feature_rows = _feature_versions(spark, out_path).where(F.col(VERSION) <= through)
        done = published(spark, f"{out_path}/_base")
        if not done or done[-1] < through:
            fresh = _newest(feature_rows.join(feature_rows.where(F.col(VERSION) > stored.low_water).select(BUCKET).distinct(), BUCKET, "left_semi"))
            with new_version(spark, f"{out_path}/_base", through) as path:
                _write_buckets(fresh.drop(VERSION), path)
        with new_version(spark, f"{state_path}/_base", through) as path:
            if folders:
                schema = T.StructType([f for f in spark.read.parquet(folders[-1][1]).schema.fields if f.name != BUCKET])
                _write_buckets(_newest(stored.rows(folders, schema)).drop(VERSION), f"{path}/rows")
            total.write.mode("overwrite").parquet(f"{path}/counts")
    _forget(spark, out_path, state_path, through)
    return through


def _forget(spark: SparkSession, out_path: str, state_path: str, low_water: int) -> None:
    """Delete the batches that are part of the base, and buckets of older base
    versions that a newer one holds."""
    if low_water < 0:
        return
    gone = [f"{root}/{_BATCH}{k}" for root in (out_path, state_path, f"{state_path}/_counts") for k in numbered(spark, root, _BATCH) if k <= low_water]
    for root, inner in ((f"{out_path}/_base", ""), (f"{state_path}/_base", "/rows")):
        newer: set[int] = set()
        complete = published(spark, root)
        for v in reversed(complete):
            buckets = set(numbered(spark, f"{root}/{PREFIX}{v}{inner}", f"{BUCKET}="))
            if buckets <= newer and v != complete[-1]:
                gone.append(f"{root}/{PREFIX}{v}")
            else:
                gone += [f"{root}/{PREFIX}{v}{inner}/{BUCKET}={b}" for b in sorted(buckets & newer)]
            newer |= buckets
        gone += [f"{root}/{PREFIX}{v}" for v in numbered(spark, root) if v not in complete]
    delete_paths(spark, gone)


def start_incremental_features(
    bronze_stream: DataFrame,
    out_path: str,
    checkpoint: str,
    null_policy: str = schemas.DEFAULT_NULL_POLICY,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep ``out_path`` up to date with :class:`IncrementalFeatures`.  State
    lives under ``checkpoint`` (the stream checkpoint and the silver rows).
    No watermark stands in front of the merge: nothing is too late for it."""
    fn = IncrementalFeatures(out_path, f"{checkpoint}/silver", null_policy)
    writer = bronze_stream.writeStream.foreachBatch(fn).option("checkpointLocation", f"{checkpoint}/stream")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


class ScoreBatches:
    """``foreachBatch`` function that scores every micro-batch once (T4).

    The records of batch N are the folder ``batch_id=N`` of the table, which a
    retry overwrites, so a batch that is repeated after a failure adds
    nothing.  Every record names the ``model_version`` that scored it: the
    version is the caller's, and belongs to the batch that was scored with it.
    A batch without rows leaves an empty folder."""

    def __init__(self, model: Transformer, out_path: str, model_version: str = ""):
        self.model, self.out_path, self.model_version = model, out_path.rstrip("/"), model_version

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        records = to_predictions(score(batch, self.model, handle_invalid="keep"))
        records.withColumn("model_version", F.lit(self.model_version)).write.mode("overwrite").parquet(f"{self.out_path}/{_BATCH}{batch_id}")


def read_scores(spark: SparkSession, out_path: str) -> DataFrame:
    """The records that :class:`ScoreBatches` keeps, with their batch."""
    fields = [T.StructField("id", T.StringType()), T.StructField(schemas.SYMBOL, T.StringType()), *schemas.PREDICTION.fields[1:],
              T.StructField("model_version", T.StringType()), T.StructField(VERSION, T.LongType())]
    return spark.read.schema(T.StructType(fields)).parquet(out_path)


def start_scoring(
    feature_stream: DataFrame,
    model: Transformer,
    out_path: str,
    checkpoint: str,
    available_now: bool = True,
    model_version: str = "",
) -> StreamingQuery:
    """T4: score a stream of feature rows into prediction records
    ``(id, symbol, market_time, predicted_price, created_at, model_version)``
    with :class:`ScoreBatches`; :func:`read_scores` reads them."""
    fn = ScoreBatches(model, out_path, model_version)
    writer = feature_stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
