"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A document holds an item if at least ``containment`` of the item's distinct word shingles stand in it.  Classic
signatures of both sides can't find a forty-word item in a text of twenty thousand words (their resemblance is about
0.001), so the search is one-sided: items are partitioned by the size of their shingle set, and an item's signature is its
``k`` smallest shingle hashes, ``k = u - ceil(containment * u) + 1`` for the largest size ``u`` of its partition.  A document that holds
the item misses at most ``u - ceil(containment * u)`` of its shingles, so it holds at least one of the signature: no
item is lost, whatever the document's length.  Documents probe with all their shingles; pairs found are verified on
the shingles' words.

DataFrame functions only.  The signature side is broadcast when it has at most ``BROADCAST_ROWS`` rows (counted), else it is an
ordinary join that AQE plans.

Words are runs of letters and digits, lower-cased.  Defined results: an item with fewer than ``words`` words is one
shingle of all its words; null, empty or wordless items are in no document; null or empty documents hold nothing; rows with the same id and text are
found alike; several items with one id count as one item with all their shingles; extra columns are ignored (``clean`` keeps
them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.llm.common import keep, read

#: Signature rows (24 bytes each) up to which the small side is sent to all executors.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """Array of the words of a text; null for null."""
    return F.filter(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def shingles(df: DataFrame, words: str, n: int) -> DataFrame:
    """One row per place: ``words`` replaced by ``h``, the hash of ``n`` words, and ``at``, the first one's number.

    ``explode_outer`` keeps the generator, the split array and the hash in one code-generated stage; the array
    is only pointed into, never copied per place.
    """
    rest = [c for c in df.columns if c != words]
    last = F.size(words) - F.lit(n)
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    out = df.select(*rest, words, F.explode_outer(places).alias("at")).where("at is not null")
    return out.select(*rest, "at", F.xxhash64(*[F.col(words)[F.col("at") + k] for k in range(n)]).alias("h"), words)


def spelled(words: str, n: int) -> Column:
    return F.concat_ws(" ", *[F.col(words)[F.col("at") + k] for k in range(n)])


def item_shingles(items: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """``(item, n_words, shingle, h)``: distinct shingles of each item; short items are one shingle of all their words."""
    w = items.select(F.col(key).cast("long").alias("item"), words_of(F.col(text).cast("string")).alias("w")).where("item is not null and size(w) > 0")
    parts = []
    for size in range(1, n + 1):
        own = w.where(F.size("w") == size) if size < n else w.where(F.size("w") >= n)
        s = shingles(own, "w", size)
        parts.append(s.select("item", F.lit(size).alias("n_words"), spelled("w", size).alias("shingle"), "h"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def signatures(rows: DataFrame, containment: float) -> DataFrame:
    """``(item, n_words, h)``: the smallest hashes of each item, as many as its size partition asks for."""
    size = F.count("*").over(_window("item"))
    # partitions of doubling size: 1, 2-3, 4-7, ...; u is the largest size of the item's own
    u = (F.pow(F.lit(2), F.floor(F.log2(size)) + 1) - 1).cast("long")
    k = u - F.ceil(u * F.lit(containment) - F.lit(1e-9)) + 1
    rank = F.row_number().over(_window("item").orderBy("h", "shingle"))
    return rows.withColumn("k", k).withColumn("rank", rank).where("rank <= k").select("item", "n_words", "h").distinct()


def _window(*cols):
    from pyspark.sql import Window
    return Window.partitionBy(*cols)  # an item is one benchmark text: bounded


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (kept before), marked for broadcast if it has at most so many rows."""
    return F.broadcast(df) if df.count() <= rows else df


def find(docs: DataFrame, items: DataFrame, words: int = 5, containment: float = 0.8, doc_key: str = "doc_id", doc_text: str = "text",
         item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, item_id, n_common, containment)`` of every document and item that it holds."""
    spark = docs.sparkSession
    rows = keep(item_shingles(items, item_key, item_text, words))
    sizes = rows.groupBy("item").agg(F.count("*").alias("size"))
    sig = keep(signatures(rows, containment))
    src = docs.select(F.col(doc_key).cast("long").alias("doc"), F.col(doc_text).cast("string").alias("t"))
    src = src.where("t is not null").select("doc", F.xxhash64("t").alias("th"), words_of(F.col("t")).alias("w"))
    lengths = [r.n_words for r in sig.select("n_words").distinct().collect()]  # at most ``words`` values
    found = None
    for n in lengths:
        probe = small(keep(sig.where(F.col("n_words") == n).select("item", "h")))
        one = shingles(src, "w", n).select("doc", "th", "h").join(probe, "h").select("doc", "th", "item").distinct()
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "doc_id long, text_hash long, item_id long, n_common long, containment double")
    found = keep(found)
    # Verification, over the documents found only: distinct shingles of the item, word by word, that stand in the document.
    seen = small(found.select(F.col("doc").alias("_d"), F.col("th").alias("_t")).distinct())
    again = src.join(seen, (F.col("th") == F.col("_t")) & F.col("doc").eqNullSafe(F.col("_d")), "left_semi")
    hits = None
    for n in lengths:
        known = rows.where(F.col("n_words") == n).select("item", "h", "shingle")
        places = shingles(again, "w", n).select("doc", "th", "h", spelled("w", n).alias("shingle"))
        one = places.join(small(keep(known)), ["h", "shingle"]).select("doc", "th", "item", "shingle").distinct()
        hits = one if hits is None else hits.unionByName(one)
    common = hits.groupBy("doc", "th", "item").agg(F.count("*").alias("n_common")).join(sizes, "item")
    share = F.col("n_common") / F.col("size")
    return common.where(share >= containment - 1e-9).select(F.col("doc").alias("doc_id"), F.col("th").alias("text_hash"),
                                                           F.col("item").alias("item_id"), "n_common", share.alias("containment"))


def per_document(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_items, item_ids (ascending), max_containment, kept (holds no item)."""
    hits = find(docs, items, **options).groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("item_ids"), F.max("containment").alias("best"))
    hits = small(keep(hits.withColumnRenamed("doc_id", "d")))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    out = src.join(hits, (src["th"] == hits["text_hash"]) & src["doc_id"].eqNullSafe(hits["d"]), "left")
    return out.select("doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
                      F.coalesce("best", F.lit(0.0)).alias("max_containment"), F.col("n_items").isNull().alias("kept"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no item."""
    hits = small(keep(find(docs, items, **options).select(F.col("doc_id").alias("_d"), "text_hash").distinct()))
    th = F.xxhash64(docs["text"].cast("string"))
    return docs.join(hits, (th == hits["text_hash"]) & docs["doc_id"].cast("long").eqNullSafe(hits["_d"]), "left_anti")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against all ``benchmark`` items."""
    out = per_document(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_items", F.concat_ws(",", F.transform("item_ids", lambda x: x.cast("string"))).alias("item_ids"),
                      F.round("max_containment", 6).alias("max_containment"), "kept")


QUERIES = {"op6_decontaminate": op6_decontaminate}

ORACLE = {"op6_decontaminate": r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') FROM benchmark),
items AS (
  SELECT DISTINCT id AS item_id, least(len(w), 5) AS n, array_to_string(w[p : p + least(len(w), 5) - 1], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM w WHERE side = 'i' AND len(w) > 0)),
places AS (
  SELECT DISTINCT id AS doc_id, n, array_to_string(w[p : p + n - 1], ' ') AS s
  FROM (SELECT id, n, w, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS p FROM w, (SELECT DISTINCT n FROM items) WHERE side = 'd' AND len(w) >= n)),
size AS (SELECT item_id, count(*) AS size FROM items GROUP BY 1),
hits AS (
  SELECT doc_id, item_id, count(*) / any_value(size) AS c
  FROM places JOIN items USING (n, s) JOIN size USING (item_id) GROUP BY 1, 2 HAVING count(*) / any_value(size) >= 0.8 - 1e-9)
SELECT d.doc_id, count(h.item_id) AS n_items, coalesce(string_agg(CAST(h.item_id AS VARCHAR), ',' ORDER BY h.item_id), '') AS item_ids,
       round(coalesce(max(h.c), 0), 6) AS max_containment, count(h.item_id) = 0 AS kept
FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id
"""}
