"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.llm import decontamination, mixing, near_dedup, sharding, toxicity
from delaylake.llm.shared import col, shared_folder

N_SHARDS = 8


def give_back(spark: SparkSession) -> None:
    """Before a stage, let go of what the driver no longer needs from the stages before it.

    Spark removes shuffles, broadcasts and checkpoints of dropped frames only when the driver's collector finds them. What compilers
    and codecs of the JVM have freed stays with its native allocator until that is told to trim; JVMs without that command are left as they are.
    """
    gc.collect()
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    jvm.java.lang.System.gc()
    name, command = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    beans = jvm.java.lang.Class.forName("javax.management.MBeanServer")

    def call(method: str, types: list[str], values: list):
        kinds, args = array(jvm.java.lang.Class, len(types)), array(jvm.java.lang.Object, len(values))
        for k, (kind, value) in enumerate(zip(types, values, strict=True)):
            kinds[k], args[k] = jvm.java.lang.Class.forName(kind), value
        return beans.getMethod(method, kinds).invoke(server, args)

    if call("isRegistered", ["javax.management.ObjectName"], [name]):
        known = call("getMBeanInfo", ["javax.management.ObjectName"], [name]).getOperations()
        if command in [o.getName() for o in known]:
            call("invoke", ["javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"], [name, command, None, None])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language; the classifier learns from the labels of sf_dir.

    Without labels of both classes all stay; null and empty texts are judged like others; rows without id can't be labelled but are judged.
    """
    give_back(spark)
    model = toxicity.fit(toxicity.labelled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.reject(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document with the smallest id.

    Null, empty and blank texts are copies of nothing and stay, as do rows without id; rows that repeat an id are one document.
    """
    give_back(spark)
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    give_back(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice. A null source is a source; texts without words have size 0."""
    give_back(spark)
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")), n_shards=N_SHARDS)
    return mixing.drawn_rows(mixed, [col(c) for c in docs.columns]).select([col(c) for c in docs.columns])


def shuffle_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, repeated ones and those without id or text included, with shard and slot."""
    give_back(spark)
    return sharding.shard(docs, N_SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shuffle_into_shards),
]

# Training a classifier and edit distances have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; stages meet in Parquet under the shared folder, and what is read no more is removed."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            place = spark._jvm.org.apache.hadoop.fs.Path(before)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        before = path
    return docs
