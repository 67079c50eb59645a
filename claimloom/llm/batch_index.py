"""The index of everything accepted so far, kept in a shared folder, to which batches are added.

Tables of the folder, one part a load (an add() call with one batch or several):
  held       doc_id, batch_no of every document
  firsts     h, h2, doc_id: the first document with each key (hash, URL, DOI, text)
  tokens     word hashes and line keys of the texts, in parts of PART ids
  counts     mergeable counts of word pairs and lines
  routed     signature and route values of each different text, one row a text
  search     the graphs of the index shards (small_world), merged by a fixed schedule, and the pairs they gave
  groups     doc_id, first: the last row of a document counts
  hot        the route values that are split
meta.json names the loads that count; it is replaced as the last step of add(), so a load that broke off
leaves nothing behind and is simply run again (parts are overwritten).

add() tokenises the new texts only, searches them in the stored graphs, reads the tokens of those parts of the history that hold
candidates, and closes the new links over the groups they touch. Which word pairs are common and which
lines are a site's own is fixed for an epoch; lines found in a later load are added to it. A new epoch begins when the texts have doubled
or a new load has a hot value of its own: counts are merged, shards are dealt anew and the graphs built again
from the stored signatures, without a text being read. Signatures stay as they were computed.

Defined results: as in new_batches; a document delivered again (same doc_id) in a later load keeps its first batch and counts as held; an
empty load changes nothing; batches may come in any number of loads, and the groups are the same as in one.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import new_batches as nb
from claimloom.session import checkpoint, shared_folder

PART, MAX_LOADS = 1 << 16, 64


def _pack(a: np.ndarray) -> str:
    return base64.b64encode(zlib.compress(np.ascontiguousarray(a, np.int64).tobytes())).decode()


def _unpack(s: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(base64.b64decode(s)), np.int64)


class BatchIndex:
    def __init__(self, spark: SparkSession, folder: str | None = None):
        """folder: where the index lies (any file system Spark writes to); by default a new one in the session's shared folder."""
        self.spark = spark
        self.folder = (folder or f"{shared_folder(spark)}/batch-index-{uuid.uuid4().hex}").rstrip("/")
        path = self._path("meta.json")
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.meta = json.loads(self._read(path)) if self._fs.exists(path) else {"loads": 0, "texts": 0, "rows": 0, "epoch": 0, "shards": 0, "epoch_texts": 0, "epoch_load": 0, "levels": 0, "common": None, "own": None, "segments": [], "schemas": {}}

    # ------------------------------------------------------------ storage
    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _read(self, path) -> str:
        stream = self._fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _save_meta(self) -> None:
        new, path = self._path("meta.json.new"), self._path("meta.json")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps(self.meta).encode()))
        out.close()
        if self._fs.exists(path):
            self._fs.delete(path, False)
        self._fs.rename(new, path)

    def _write(self, df: DataFrame, table: str, load: int | str, *by: str) -> DataFrame:
        place = f"{self.folder}/{table}/load={load}"
        w = df.write.mode("overwrite")
        (w.partitionBy(*by) if by else w).parquet(place)
        self.meta["schemas"][table] = df.schema.json()
        return self._parts(table, [load])

    def _parts(self, table: str, loads) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = self.meta["schemas"].get(table)
        places = [f"{self.folder}/{table}/load={n}" for n in loads]
        if not places or schema is None:
            raise ValueError(f"nothing stored of {table}")
        # parts lie under one base folder, so that load is a column
        return self.spark.read.schema(StructType.fromJson(json.loads(schema)).add("load", "string")).option("basePath", f"{self.folder}/{table}").parquet(*places)

    def _all(self, table: str, upto: int) -> DataFrame:
        return self._parts(table, range(upto))

    # ------------------------------------------------------------ adding
    def add(self, docs: DataFrame) -> None:
        """docs: doc_id, batch_no, text, content_hash, canonical_url, doi, source_domain: one arriving batch, or several."""
        n = self.meta["loads"]
        no = F.coalesce("batch_no", F.lit(2**31 - 1)).cast("int").alias("batch_no")
        held = docs.select("doc_id", no).groupBy("doc_id").agg(F.min("batch_no").alias("batch_no"))
        if n:
            held = held.join(self._all("held", n).select("doc_id"), "doc_id", "left_anti")
        self._write(held, "held", n)
        tokens = self._write(nb.prepared(docs).withColumn("part", F.expr(f"doc_id div {PART}")), "tokens", n, "part")
        links, fresh = self._exact(docs, tokens, n)
        counts = self._write(nb.token_counts(tokens), "counts", n)
        common, own, epoch = self._flags(counts, tokens, n)
        first = fresh.where("is_text").groupBy("doc_id").agg(F.lit(1).alias("one")).select("doc_id")
        routed = self._write(nb.signature_rows(tokens, common, own).join(first, "doc_id", "left_semi"), "routed", n)
        rows = nb.ROUTES * routed.count()
        self.meta["rows"] += rows
        if rows:
            near = self._near(routed, n, own, epoch)
            links = links.unionByName(near)
        self._close(links, n)
        self.meta["loads"] = n + 1
        self._save_meta()

    def _exact(self, docs: DataFrame, tokens: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
        """(links of equal keys, the keys not held before with their first document)."""
        keys = nb.document_keys(docs).withColumn("is_text", F.lit(False)).unionByName(tokens.select("doc_id", F.col("t1").alias("h"), F.col("t2").alias("h2"), F.lit(True).alias("is_text")))
        keys = checkpoint(keys)
        rows = keys.count()
        least = keys.groupBy("h", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"), F.max("is_text").alias("is_text"))
        if n:
            known = self._all("firsts", n).select("h", "h2", F.col("doc_id").alias("before"))
            least = checkpoint(least.join(known, ["h", "h2"], "left"))
            links = nb.split_join(keys.drop("is_text"), least.where("n > 1 or before is not null").select("h", "h2", F.coalesce("before", "first").alias("first"), "n"), ["h", "h2"], rows)
            least = least.where("before is null")
        else:
            links = nb.split_join(keys.drop("is_text"), least.where("n > 1").select("h", "h2", "first", "n"), ["h", "h2"], rows)
        fresh = self._write(least.select("h", "h2", F.col("first").alias("doc_id"), "is_text"), "firsts", n)
        return links.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct(), fresh

    def _flags(self, counts: DataFrame, tokens: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """(common pairs, lines of sites, whether a new epoch begins)."""
        texts = counts.where("kind = 'n'").agg(F.sum("n")).first()[0] or 0
        self.meta["texts"] += texts
        epoch = self.meta["common"] is None or self.meta["texts"] >= 2 * self.meta["epoch_texts"] or n - self.meta["epoch_load"] >= MAX_LOADS
        merged = self._all("counts", n + 1).groupBy("kind", "site", "key").agg(F.sum("n").alias("n")) if n else counts
        common, lines, _ = nb.flags(checkpoint(merged) if n else merged, tokens)
        own = lines if self.meta["own"] is None else np.union1d(_unpack(self.meta["own"]), lines)
        if epoch:
            self.meta.update(epoch_texts=self.meta["texts"], epoch_load=n, common=_pack(common))
        self.meta["own"] = _pack(own)
        return _unpack(self.meta["common"]), own, epoch

    def _near(self, routed: DataFrame, n: int, own: np.ndarray, epoch: bool) -> DataFrame:
        loads, routed = range(n + 1), nb.by_route(routed)
        levels: list[DataFrame] | None = None
        if not epoch:
            levels = [self._parts("hot", [f"{self.meta['epoch']}-{k}"]).drop("load") for k in range(self.meta["levels"])]
            now = nb.hot_levels(nb.placed(routed, levels).drop("salts")) if len(levels) < 5 else []
            epoch = bool(now)  # a value that is hot within this load alone
        current = routed.drop("load").withColumn("old", F.lit(False))
        stored = None
        if epoch:
            everything = nb.by_route(self._parts("routed", loads))
            levels = nb.hot_levels(everything)
            self.meta.update(epoch=self.meta["epoch"] + 1, shards=nb.shards_of(self.meta["rows"]), levels=len(levels), segments=[])
            for k, hot in enumerate(levels):
                self._write(hot, "hot", f"{self.meta['epoch']}-{k}")
            if n:
                current = everything.withColumn("old", F.col("load").cast("int") < n).drop("load")
        elif self.meta["segments"]:
            touched = nb._split_hot(routed.drop("load"), levels).select(F.pmod(F.xxhash64("value", "route", "salt"), F.lit(self.meta["shards"])).cast("int").alias("shard")).distinct()
            stored = self._parts("search", self.meta["segments"]).where("graph").drop("graph", "load").join(F.broadcast(touched), "shard", "left_semi")  # at most one number a shard
        found = nb.search_index(nb._split_hot(current, levels), self.meta["shards"], stored)
        # pairs and segments are written by one job, then read apart
        place = self._write(found.withColumn("graph", F.expr("kind = 's'")), "search", n, "graph")
        self.meta["segments"] = [*self.meta["segments"], n]
        pairs = place.where("not graph").select("kind", "a", "b")
        everything = nb.by_route(self._parts("routed", loads))
        return nb.found_links(nb.asked_of_salts(pairs, routed, levels), nb.keyed_rows(everything, levels), self._tokens_of(loads), own)

    def _tokens_of(self, loads) -> Callable[[DataFrame], DataFrame]:
        """The tokens of the texts of pairs, read from the parts that hold one."""

        def of(pairs: DataFrame) -> DataFrame:
            tokens = self._parts("tokens", loads)
            if len(loads) == 1:
                return tokens
            ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
            parts = [r[0] for r in ids.select(F.expr(f"doc_id div {PART}").alias("part")).distinct().collect()]  # one number a part of PART ids
            return tokens.where(F.col("part").isin(parts))

        return of

    def _close(self, links: DataFrame, n: int) -> None:
        """Closes the new links over the groups they touch and writes the changed rows of groups."""
        if n:
            old = self.groups(n)
            ends = {s: old.select(F.col("doc_id").alias(s), F.col("first").alias(f"first_{s}")) for s in "ab"}
            links = links.join(ends["a"], "a", "left").join(ends["b"], "b", "left").select(F.coalesce("first_a", "a").alias("a"), F.coalesce("first_b", "b").alias("b"))
        closed = nb.closed_groups(links)
        if n:
            moved = old.join(closed.select(F.col("doc_id").alias("first"), F.col("first").alias("now")), "first").select("doc_id", F.col("now").alias("first"))
            closed = closed.unionByName(moved)
        self._write(closed, "groups", n)

    def groups(self, upto: int | None = None) -> DataFrame:
        """(doc_id, first) of every linked document."""
        upto = self.meta["loads"] if upto is None else upto
        rows = self._all("groups", upto)
        return rows.drop("load") if upto == 1 else rows.groupBy("doc_id").agg(F.max_by("first", F.col("load").cast("int")).alias("first"))

    def held_before(self) -> DataFrame:
        """(first_doc_id, doc_id) of documents whose group was first held in an earlier batch."""
        if not self.meta["loads"]:
            return self.spark.createDataFrame([], "first_doc_id bigint, doc_id bigint")
        held = self._all("held", self.meta["loads"]).select("doc_id", "batch_no")
        g = self.groups().join(held.withColumnRenamed("batch_no", "here"), "doc_id").join(held.select(F.col("doc_id").alias("first"), F.col("batch_no").alias("there")), "first")
        return g.where("there < here").select(F.col("first").alias("first_doc_id"), "doc_id")

    # ------------------------------------------------------------ housekeeping
    def drop(self) -> None:
        self._fs.delete(self._path(""), True)
