"""A stored inverted index: postings by word, and search that reads only its words.

A batch of documents becomes one generation of three tables under the index's folder:

* ``postings``: a row for each word, session and block of at most ``BLOCK`` documents,
  with the first seq, every one's distance from it, counts and lengths; dealt to
  ``buckets`` folders by the word's hash.  A frequent word is spread over many rows, and
  over as many files as tasks wrote its bucket;
* ``words``: in how many documents each word of the batch stands, in the same buckets;
* ``totals``: documents and words of the batch.

Generations add up, so an append rewrites nothing.  One that is written again under its
number replaces itself, which makes a retried batch harmless.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators.search import B, K1, tokens, token_table

BLOCK, BUCKETS = 512, 64


def bucket_of(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def query_words(query: str) -> list[str]:
    """The distinct words of a query, as ``tokens`` splits texts."""
    wanted = sorted({w for w in "".join(c.lower() if c.isalnum() else " " for c in query).split()})
    if not wanted:
        raise ValueError("a search needs a word")
    return wanted


def postings(documents: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, token, session_id, block, first_seq, steps (distances from it), counts and lengths."""
    table = token_table(documents).withColumn("block", F.floor(F.col("seq") / BLOCK).cast("long"))
    entry = F.struct("seq", F.col("n").cast("int").alias("n"), F.col("length").cast("int").alias("length"))
    rows = table.groupBy("token", "session_id", "block").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    first = F.get("e", F.lit(0))["seq"]
    return rows.select(
        bucket_of(F.col("token"), buckets).alias("bucket"), "token", "session_id", "block", first.alias("first_seq"),
        F.transform("e", lambda x: (x["seq"] - first).cast("int")).alias("steps"), F.transform("e", lambda x: x["n"]).alias("counts"), F.transform("e", lambda x: x["length"]).alias("lengths"),
    )


def append(documents: DataFrame, folder: str, generation: int, buckets: int = BUCKETS) -> None:
    """Add ``documents`` (session_id, seq, text; none of them indexed before) as one generation.

    Null and wordless texts count as documents, as search by scanning counts them.
    """
    at = f"generation={generation}"
    listed = postings(documents, buckets)
    # a bucket's rows go to several tasks by session, so that no word is one file
    spread = listed.repartition("bucket", F.pmod(F.xxhash64("session_id"), F.lit(8))).sortWithinPartitions("bucket", "token")
    spread.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings/{at}")
    stored = documents.sparkSession.read.parquet(f"{folder}/postings/{at}")
    df = stored.groupBy("bucket", "token").agg(F.sum(F.size("steps")).cast("long").alias("documents"))
    df.repartition("bucket").sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/words/{at}")
    size = F.size(tokens(F.col("text"))).cast("long")
    documents.agg(F.count(F.lit(1)).alias("documents"), F.count("text").alias("texts"), F.sum(F.when(F.col("text").isNotNull(), size)).alias("words")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/totals/{at}")


def read_postings(spark: SparkSession, folder: str, words: list[str], buckets: int = BUCKETS) -> DataFrame:
    """session_id, seq, token, n and length of the given words; other buckets aren't listed for reading."""
    held = spark.read.parquet(f"{folder}/postings").filter(_chosen(words, buckets))
    rows = held.select("session_id", "token", "first_seq", F.inline(F.arrays_zip("steps", "counts", "lengths")))
    return rows.select("session_id", (F.col("first_seq") + F.col("steps")).alias("seq"), "token", F.col("counts").alias("n"), F.col("lengths").alias("length"))


def _chosen(words: list[str], buckets: int) -> Column:
    """Buckets of the words as literals, which prunes folders, and the words themselves."""
    token = F.col("token").isin(*words)
    numbers = reduce(lambda a, b: a | b, (F.col("bucket") == bucket_of(F.lit(w), buckets) for w in words))
    return numbers & token


def search_index(spark: SparkSession, folder: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """session_id, seq and score (BM25) of documents that hold every word of ``query``.

    Reads the postings and counts of the query's words alone, and the totals.
    """
    words = query_words(query)
    df = spark.read.parquet(f"{folder}/words").filter(_chosen(words, buckets)).groupBy("token").agg(F.sum("documents").alias("df"))
    totals = spark.read.parquet(f"{folder}/totals").agg(F.sum("documents").alias("docs"), (F.sum("words") / F.sum("texts")).alias("mean"))
    # as many rows as the query has words, and one
    weights = df.join(F.broadcast(totals)).select("token", "mean", F.log1p((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    hits = read_postings(spark, folder, words, buckets).join(F.broadcast(weights), "token")
    n = F.col("n")
    score = F.col("idf") * n * (K1 + 1) / (n + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    found = hits.groupBy("session_id", "seq").agg(F.count(F.lit(1)).alias("met"), F.sum(score).alias("score"))
    return found.filter(F.col("met") == len(words)).select("session_id", "seq", F.round("score", 6).alias("score"))
