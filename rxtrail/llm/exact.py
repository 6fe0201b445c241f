"""Exact duplicates by a stream with keyed state on disk.

Every document becomes an arrival: the digest of its normalised text (A-Z lower-cased), its
id, and where its content lies (file and row). A stream folds arrivals into state keyed by
digest, kept by RocksDB and saved in the shared folder; there is no watermark, so nothing
expires. A digest's state is the arrival that stays so far (largest id, then last place) and
the number of arrivals. State read back with over one arrival is a hit: its documents are
compared, byte for byte, with the content at the place that the state names, and documents
that differ in spite of equal digests are grouped again by their whole texts.

Hits with more than one in ``LARGE_HITS`` of all rows, of which there are fewer than that number,
are broadcast, so their documents stay where they are and are compared in parts; those of other
hits meet by a shuffle, in which none is large. So a group that holds a third of all rows is
compared in many tasks, at any size.

``DedupStore`` goes on from batch to batch: state, arrivals and content stay in a folder, and a
batch costs its own documents, what the state changed by it, and the content of earlier batches
that its hits name.

Defined results: null texts count as empty and equal each other; of rows that share text and
id the last by place stays; null ids rank lowest; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtrail.llm.shared import LOWER, UPPER, text_or_empty
from rxtrail.sources.staging import Staging

#: Hits with over one in so many of all rows are broadcast; all are compared in parts of so many.
LARGE_HITS, PART = 10_000, 1024
STATE = "spark.sql.streaming.stateStore"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    return F.translate(text_or_empty(text), UPPER, LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(docs: DataFrame, staging: Staging) -> DataFrame:
    """``doc`` (the columns of ``docs``) and ``place`` (file and row); unstored frames are stored."""
    place = F.struct("_metadata.file_path", "_metadata.row_index").alias("place")
    try:
        return docs.select(F.struct("*").alias("doc"), place)
    except AnalysisException:
        stored = staging.write(docs.select(F.struct("*").alias("doc")), "content")
        return stored.select("doc", place)


def _numbers(n: str | Column) -> Column:
    """0 to n - 1."""
    n = (F.col(n) if isinstance(n, str) else n).cast("long")
    return F.sequence(F.lit(0).cast("long"), n - 1)


def _run_stream(spark: SparkSession, schema, path: str, checkpoint: str) -> list[int]:
    """Fold arrivals that the state has not met yet; the numbers of the batches this took."""
    session = spark.newSession()
    session.conf.set(f"{STATE}.providerClass", ROCKSDB)
    session.conf.set(f"{STATE}.unloadOnCommit", "true")
    session.conf.set(f"{STATE}.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    stream = session.readStream.schema(schema).parquet(path)
    state = stream.groupBy("digest").agg(F.max(F.struct("doc_id", "place")).alias("keeper"), F.count("*").alias("n"))
    run = (
        state.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return [p.batchId for p in run.recentProgress if p.numInputRows]


def _state(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """digest, keeper (id and place) and n from the state or, by ``options``, its changes."""
    stored = spark.read.format("statestore").options(**options).load(checkpoint)
    keeper, n = stored.schema["value"].dataType.names
    return stored.select("key.digest", F.col("value")[keeper].alias("keeper"), F.col("value")[n].alias("n"))


def fold(arrivals: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run the stream over all stored arrivals; digest, keeper (id and place) and n from its state."""
    _run_stream(arrivals.sparkSession, arrivals.schema, path, checkpoint)
    return _state(arrivals.sparkSession, checkpoint)


def _with_hits(rows: DataFrame, hits: DataFrame, n_rows: int, how: str = "inner") -> DataFrame:
    """``rows`` with the hit of their digest as ``of``."""
    of = hits.select(F.struct("*").alias("of"))
    same = F.col("digest") == F.col("of.digest")
    is_large = F.col("of.n") * LARGE_HITS > n_rows
    large = F.broadcast(of.where(is_large))
    # Merge joins at every size: hits are as many as the corpus has copies.
    others = rows.join(large, same, "left_anti").join(of.where(~is_large).hint("merge"), same, how)
    return rows.join(large, same).unionByName(others)


def _in_hits(texts: DataFrame, hits: DataFrame, n_rows: int) -> DataFrame:
    """Documents of hits with their texts, dealt over the parts of their hit."""
    parts = F.ceil(F.col("of.n") / PART)
    return _with_hits(texts, hits, n_rows).select(
        "digest", "place", "doc_id", "text", (F.col("place") == F.col("of.keeper.place")).alias("stays"),
        parts.alias("parts"), F.pmod(F.xxhash64("place"), parts).alias("part"),
    )


def _apart(others: DataFrame, kept: DataFrame) -> DataFrame:
    """Digests under which some document's bytes differ from those at the keeper's place: the
    content, repeated for each part, against each other document of the hit."""
    content = kept.select(
        F.col("digest").alias("hit"), F.col("text").alias("content"), F.explode(_numbers("parts")).alias("of_part")
    )
    compared = others.join(content, (F.col("digest") == F.col("hit")) & (F.col("part") == F.col("of_part")))
    return compared.where("text <> content").select("digest").distinct()


def _decided(arrivals: DataFrame, hits: DataFrame, n_rows: int) -> DataFrame:
    """place, doc_id, digest, keep_id, group_size and kept of every arrival, by digests alone."""
    return _with_hits(arrivals, hits, n_rows, "left").select(
        "place", "doc_id", "digest",
        F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.col("of.keeper.doc_id")).alias("keep_id"),
        F.coalesce("of.n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("place") == F.col("of.keeper.place"), F.lit(True)).alias("kept"),
    )


def groups(docs: DataFrame, staging: Staging, digest=sha256) -> DataFrame:
    """place, doc_id, digest, keep_id, group_size and kept for every document."""
    rows = located(docs, staging)
    text = normalised(F.col("doc.text"))
    path = staging.store(rows.select(digest(text).alias("digest"), "doc.doc_id", "place"), "arrivals")
    arrivals = docs.sparkSession.read.parquet(path)
    state, n_rows = fold(arrivals, path, staging.new_path("state")), arrivals.count()
    hits = staging.write(state.where("n > 1"), "hits")
    texts = rows.select("place", "doc.doc_id", text.alias("text"), digest(text).alias("digest"))
    in_hits = staging.write(_in_hits(texts, hits, n_rows), "in_hits")
    apart = staging.write(_apart(in_hits.where("NOT stays"), in_hits.where("stays")), "apart")
    joined = _decided(arrivals, hits, n_rows)
    if apart.isEmpty():
        return joined
    return _regrouped(joined, in_hits.join(apart, "digest", "left_semi"))


class DedupStore:
    """Deduplication that goes on over batches, in a folder that all executors can reach.

    ``content/batch=<name>`` holds the documents, ``arrivals/<name>`` their digests, ids and places,
    ``state`` the stream's checkpoint, ``apart`` digests that stand for several texts. A batch
    appears by the rename of its arrivals, and the stream meets each file once, so ``add`` may be
    called again with the same name after any failure. One caller at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, digest=sha256):
        self.spark, self.folder, self.digest = spark, folder.rstrip("/"), digest

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _texts(self) -> DataFrame:
        """batch, place, doc_id, text and digest of all stored documents."""
        place = F.struct("batch", "_metadata.file_name", "_metadata.row_index").alias("place")
        stored = self.spark.read.schema(self._schema).parquet(f"{self.folder}/content")
        text = normalised(F.col("doc.text"))
        return stored.select("batch", place, "doc.doc_id", text.alias("text"), self.digest(text).alias("digest"))

    def _store(self, docs: DataFrame, name: str) -> None:
        files = self._files()
        if files.exists(self._path("arrivals", name)):
            return
        docs.select(F.struct("*").alias("doc")).write.mode("overwrite").parquet(f"{self.folder}/content/batch={name}")
        found = self._texts().where(F.col("batch") == name).select("digest", "doc_id", "place")
        found.write.mode("overwrite").parquet(f"{self.folder}/arriving/{name}")
        files.mkdirs(self._path("arrivals"))
        if not files.rename(self._path("arriving", name), self._path("arrivals", name)):
            raise OSError(f"could not rename the arrivals of {name}")

    def add(self, docs: DataFrame, name: str, staging: Staging) -> DataFrame:
        """place, doc_id, digest, keep_id, group_size and kept of the batch's documents, as things
        stand with all batches so far. ``name`` is to be of letters, digits, _ and -, and starts
        with a letter; all batches have columns of the same types."""
        if not (name.isascii() and name[:1].isalpha() and name.replace("_", "").replace("-", "").isalnum()):
            raise ValueError(f"no name for a batch: {name!r}")
        self._schema = docs.select(F.struct("*").alias("doc")).schema.add("batch", "string")
        self._store(docs, name)
        arrivals = self.spark.read.parquet(f"{self.folder}/arrivals/{name}")
        checkpoint = f"{self.folder}/state"
        batches = _run_stream(self.spark, arrivals.schema, f"{self.folder}/arrivals/*", checkpoint)
        if batches:  # what has changed holds every digest of the batch
            changes = {"readChangeFeed": "true", "changeStartBatchId": min(batches), "changeEndBatchId": max(batches)}
            state = _state(self.spark, checkpoint, **changes)
            state = state.groupBy("digest").agg(F.max_by(F.struct("keeper", "n"), "n").alias("s")).select("digest", "s.*")
        else:
            state = _state(self.spark, checkpoint)
        of_batch = arrivals.select(F.col("digest").alias("d")).distinct()
        hits = staging.write(state.where("n > 1").join(of_batch, F.col("digest") == F.col("d"), "left_semi"), "hits")
        n_rows = arrivals.count()
        texts = self._texts()
        mine = staging.write(_in_hits(texts.where(F.col("batch") == name).drop("batch"), hits, n_rows), "in_hits")
        keepers = hits.select(
            F.col("keeper.place").alias("at"), F.col("keeper.place.batch").alias("in_batch"), "n"
        )
        # At most a name for each call of add.
        named = [r.in_batch for r in keepers.select("in_batch").distinct().collect()]
        kept = texts.where(F.col("batch").isin(named)).join(keepers, F.col("place") == F.col("at")).select(
            "digest", "text", F.ceil(F.col("n") / PART).alias("parts")
        )
        _apart(mine.where("NOT stays"), kept).write.mode("append").parquet(f"{self.folder}/apart")
        apart = self.spark.read.parquet(f"{self.folder}/apart").distinct()
        joined = _decided(arrivals, hits, n_rows)
        unequal = hits.join(apart, "digest", "left_semi").select("digest")
        if unequal.isEmpty():
            return joined
        return _regrouped(joined, texts.drop("batch").join(unequal, "digest", "left_semi"))

    def groups(self) -> DataFrame:
        """place, doc_id, digest and, by digests alone, keep_id, group_size and kept of all documents."""
        arrivals = self.spark.read.parquet(f"{self.folder}/arrivals/*")
        hits = _state(self.spark, f"{self.folder}/state").where("n > 1")
        return _decided(arrivals, hits, arrivals.count())


def _regrouped(joined: DataFrame, unequal: DataFrame) -> DataFrame:
    """Documents of digests that stand for several texts, grouped by whole text instead."""
    by_text = unequal.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "place")).alias("keeper"), F.count("*").alias("n")
    )
    again = unequal.join(by_text, ["digest", "text"]).select(
        F.col("place").alias("again"), F.struct(
            F.col("keeper.doc_id").alias("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("place") == F.col("keeper.place")).alias("kept"),
        ).alias("new")
    )
    rows = joined.join(again, F.col("place") == F.col("again"), "left")
    new = [
        F.when(F.col("again").isNull(), F.col(c)).otherwise(F.col("new")[c]).alias(c)
        for c in ("keep_id", "group_size", "kept")
    ]
    return rows.select("place", "doc_id", "digest", *new)


def report(docs: DataFrame, staging: Staging) -> DataFrame:
    found = groups(docs.select("doc_id", "text"), staging)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def kept(docs: DataFrame, staging: Staging) -> DataFrame:
    """The documents that stay, in the columns of ``docs``."""
    rows = located(docs, staging)
    dropped = staging.write(
        groups(docs, staging).where("NOT kept").select(F.col("place").alias("dropped")), "dropped"
    )
    return rows.join(dropped, F.col("place") == F.col("dropped"), "left_anti").select("doc.*")


SQL_REPORT = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
