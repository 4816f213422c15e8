"""Token-id shards with a minimal perfect hash index.

``write`` range-partitions the rows by key, encodes them and writes, per partition, one payload of raw ids
(little-endian unsigned, 16-bit where every id of the vocabulary fits, else 32-bit; nothing else) and one index.  The index maps a key to its slot by a minimal
perfect hash (levels of bit arrays; a key lands on the first level where its bit is its own; the slot is the rank of
that bit).  A slot stores the key's 32-bit fingerprint, its first row and its row count; a row table stores where each row's
ids begin.  So a keyed read costs a few array reads whatever the shard's size, and a key that isn't there is
refused by its fingerprint.

Defined results: null text is empty and holds the end id alone; rows with a null key come first, as one
key of their own; repeated keys share a slot with a row count, ordered by the text's hash; an empty table
gives no shard.  A hot key's rows may span shards: ``read_back`` asks every shard whose key range holds the key.

Files go to the folder that ``spark.checkpoint.dir`` names, through ``pyarrow.fs`` (local, HDFS, S3, GCS URIs).  Each task
attempt writes under a name of its own and only the attempt that Spark commits is listed in the manifest, so lost
executors and repeated tasks leave the result whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.llm.chunks import ChunkMemory, text_slices
from tabscore.llm.common import read
from tabscore.session import work_path

END_ID = 2
#: Bytes of one ranged read of a payload.
READ_BYTES = 8_000_000
NULL_LOW = -(2 ** 63)


# ---- minimal perfect hash ------------------------------------------------------------------------------------------

def mix(keys, seed: int):
    """64-bit hash of int64 keys (numpy), different for each seed."""
    import numpy as np
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2 ** 64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def build_index(keys, room: float = 1.7) -> list:
    """Bit arrays (as bool arrays) of the levels for distinct int64 ``keys``."""
    import numpy as np
    levels, left = [], keys
    while len(left):
        size = max(64, int(len(left) * room))
        at = (mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
        if len(levels) > 200:
            raise ValueError("keys are not distinct")
    return levels


class Lookup:
    """Slots of keys in the levels of an index."""

    def __init__(self, levels: list):
        import numpy as np
        self.levels, self.ranks, before = levels, [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits) - bits + before)
            before += int(bits.sum())

    def slots(self, keys):
        """Slot of each key, -1 where no level has a bit for it."""
        import numpy as np
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for n, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            at = (mix(keys[open_], n) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return out


def pack_shard(keys: list, starts, width: int = 4) -> bytes:
    """Index file: a JSON header line, then the arrays it names.  ``keys``: per row, ascending, None first; ``width``:
    bytes of an id in the payload."""
    import numpy as np
    nulls = sum(1 for k in keys if k is None)
    own = np.array(keys[nulls:], np.int64)
    distinct, first, count = np.unique(own, return_index=True, return_counts=True)
    levels = build_index(distinct)
    slot = Lookup(levels).slots(distinct)
    table = np.zeros((len(distinct), 3), "<u4")
    table[slot, 0] = (mix(distinct, 999) >> np.uint64(32)).astype(np.uint32)
    table[slot, 1] = first + nulls
    table[slot, 2] = count
    parts = [np.packbits(x).tobytes() for x in levels] + [table.tobytes(), np.asarray(starts, "<u8").tobytes()]
    head = {"nulls": nulls, "levels": [len(x) for x in levels], "keys": len(distinct), "rows": len(keys), "width": width}
    return json.dumps(head).encode() + b"\n" + b"".join(parts)


class Shard:
    """Keyed reads from one shard."""

    def __init__(self, path: str):
        import numpy as np
        fs, at = filesystem(path)
        with fs.open_input_file(f"{at}.idx") as f:
            data = f.read()
        head, _, rest = data.partition(b"\n")
        self.head = json.loads(head)
        levels, at_byte = [], 0
        for n in self.head["levels"]:
            size = (n + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(rest, np.uint8, size, at_byte), count=n).astype(bool))
            at_byte += size
        self.lookup = Lookup(levels)
        self.table = np.frombuffer(rest, "<u4", self.head["keys"] * 3, at_byte).reshape(-1, 3)
        self.starts = np.frombuffer(rest, "<u8", self.head["rows"] + 1, at_byte + self.table.nbytes).astype(np.int64)
        self.payload = fs.open_input_file(f"{at}.ids")

    def rows(self, keys: list):
        """``(position in keys, row)`` of every row stored under the keys."""
        import numpy as np
        real = [i for i, k in enumerate(keys) if k is not None]
        own = np.array([keys[i] for i in real], np.int64)
        slot = self.lookup.slots(own)
        mark = (mix(own, 999) >> np.uint64(32)).astype(np.uint32)
        for i, s, m in zip(real, slot.tolist(), mark):
            if s >= 0 and self.table[s, 0] == m:
                first = int(self.table[s, 1])
                yield from ((i, r) for r in range(first, first + int(self.table[s, 2])))
        for i in (i for i, k in enumerate(keys) if k is None):
            yield from ((i, r) for r in range(self.head["nulls"]))

    def ids(self, row: int) -> bytes:
        """Ids of a row as little-endian unsigned 32-bit integers."""
        return next(self.runs([row]))[1]

    def runs(self, rows: list[int], most: int = READ_BYTES):
        """``(row, ids)`` of ascending rows; neighbouring rows come from one ranged read of about ``most`` bytes."""
        import numpy as np
        width, at = self.head["width"], 0
        while at < len(rows):
            last, first = at, int(self.starts[rows[at]])
            while last + 1 < len(rows) and rows[last + 1] <= rows[last] + 1 and (int(self.starts[rows[last + 1] + 1]) - first) * width <= most:
                last += 1
            data = self.payload.read_at((int(self.starts[rows[last] + 1]) - first) * width, first * width)
            data = data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()
            for row in rows[at:last + 1]:
                yield row, data[4 * (int(self.starts[row]) - first):4 * (int(self.starts[row + 1]) - first)]
            at = last + 1


def filesystem(uri: str):
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


# ---- encoding ------------------------------------------------------------------------------------------------------

#: A full stop or comma that ends a word of Latin letters: the pre-tokenizer parts it from the word anyway.
TAIL = re.compile(rb"[.,](?=[ \n]|\Z)(?:(?<=[a-z].)|(?<=\xc3[\xa0-\xb6\xb8-\xbf].))")


class WordEncoder:
    """Ids of whole texts through a tokenizers file whose pre-tokenizer drops white space.

    The file's normaliser (NFC, lower case) and pre-tokenizer never look across white space, so a text's ids
    are those of its white-space separated chunks in a row.  Other files are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = json.dumps(spec.get("pre_tokenizer") or {})
        normal = json.dumps(spec.get("normalizer") or {})
        self.chunked = '"Removed"' in pre and "\\\\s\\\\p{L}\\\\p{N}" in pre and "Lowercase" in normal
        self.largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.memory = ChunkMemory(self._encode_new)

    def _encode_new(self, chunks: list) -> list[list[int]]:
        texts = [c.decode() if isinstance(c, bytes) else c for c in chunks]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list) -> list[bytes]:
        """Ids of texts (as text, or as bytes in UTF-8)."""
        texts = [x.encode() if isinstance(x, str) else x for x in texts]
        if self.chunked:
            return self.memory.pack([TAIL.sub(rb" \g<0>", x.lower()).split() for x in texts])
        return self.memory.pack([[x] if x else [] for x in texts])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    # tasks fill an executor's cores already; the library's own threads cost a fifth more CPU time here
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


# ---- writing and reading -------------------------------------------------------------------------------------------

def write(df: DataFrame, folder: str, tokenizer_path: str, key: str = "doc_id", text: str = "text",
          end_id: int = END_ID) -> list[dict]:
    """Write the shards below ``folder``; returns the manifest, one entry per shard in key order: path, lo, hi (key
    range; None: null), n_docs, n_ids, base (ids in the shards before it)."""
    import pyarrow as pa
    shape = pa.schema([("path", pa.string()), ("has_null", pa.bool_()), ("lo", pa.int64()), ("hi", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches):
        yield from written(encoder(tokenizer_path), batches)

    def written(own, batches):
        import numpy as np
        keys, counts, out, path = [], [], None, ""
        width = 2 if max(own.largest, end_id) < 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for _, _, texts in text_slices(batch, "_text", raw=True):
                packed = own.encode(texts)
                if out is None:
                    path = f"{folder}/shard-{uuid.uuid4().hex}"
                    fs, at = filesystem(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(f"{at}.ids")
                joined = b"".join(x for p in packed for x in (p, end))
                out.write(joined if width == 4 else np.frombuffer(joined, "<u4").astype("<u2").tobytes())
                counts += [len(p) // 4 + 1 for p in packed]
            keys += [None if n else k for k, n in zip(batch.column("_key").to_pylist(), batch.column("_null").to_pylist())]
        if out is None:
            return
        out.close()
        starts = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
        with fs.open_output_stream(f"{at}.idx") as f:
            f.write(pack_shard(keys, starts, width))
        real = [k for k in keys if k is not None]
        yield pa.RecordBatch.from_pylist([{"path": path, "has_null": keys[0] is None, "lo": real[0] if real else None, "hi": real[-1] if real else None,
                                           "n_docs": len(keys), "n_ids": int(starts[-1])}], schema=shape)

    k = F.col(key).cast("long")
    src = df.select(F.coalesce(k, F.lit(NULL_LOW)).alias("_key"), k.isNull().alias("_null"), F.col(text).cast("string").alias("_text"))
    order = [F.col("_null").desc(), F.col("_key"), F.xxhash64("_text")]
    made = (src.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(run, "path string, has_null boolean, lo long, hi long, n_docs long, n_ids long"))
    made.write.mode("overwrite").parquet(f"{folder}/manifest")
    return manifest(df.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> list[dict]:
    """The shards in key order; as many rows as shards, so their number is the shuffle partitions' at most."""
    rows = [r.asDict() for r in spark.read.parquet(f"{folder}/manifest").collect()]
    rows.sort(key=lambda r: (not r["has_null"], r["lo"] if r["lo"] is not None else NULL_LOW, r["hi"] if r["hi"] is not None else NULL_LOW))
    base = 0
    for r in rows:
        r["base"], base = base, base + r["n_ids"]
    return rows


def read_back(keys: DataFrame, shards: list[dict], key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Look up every distinct key: one row per stored document with its start, count and checksum (and ids)."""
    import pandas as pd
    shape = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", token_ids binary" if with_ids else "")
    wanted = keys.select(F.col(key).cast("long").alias("doc_id")).distinct()

    def route(batches):
        import bisect
        spans = [(i, r["lo"], r["hi"]) for i, r in enumerate(shards) if r["lo"] is not None]
        lows = [s[1] for s in spans]
        nulls = [i for i, r in enumerate(shards) if r["has_null"]]
        for batch in batches:
            out = []
            for k in (None if n else int(k) for k, n in zip(batch["_key"], batch["_null"])):
                if k is None:
                    out += [(i, NULL_LOW, True) for i in nulls]
                    continue
                at = bisect.bisect_right(lows, k) - 1
                while at >= 0 and spans[at][2] >= k:  # a hot key spans neighbouring shards
                    out.append((spans[at][0], k, False))
                    at -= 1
            yield pd.DataFrame(out, columns=["_shard", "_key", "_null"])

    def look(batches):
        now, shard = -1, None
        for batch in batches:
            for number, part in batch.groupby("_shard", sort=False):
                if number != now:
                    now, shard = number, Shard(shards[number]["path"])
                ks = [None if n else k for k, n in zip(part["_key"].tolist(), part["_null"].tolist())]
                out, found = [], sorted((row, i) for i, row in shard.rows(ks))
                for (row, i), (_, ids) in zip(found, shard.runs([row for row, _ in found])):
                    out.append((ks[i], shards[number]["base"] + int(shard.starts[row]), len(ids) // 4, zlib.crc32(ids), ids if with_ids else None))
                if out:
                    key_, start, n, crc, ids = zip(*out)
                    made = {"doc_id": pd.array(key_, "Int64"), "start": start, "n_tokens": n, "ids_crc32": crc}
                    yield pd.DataFrame(made | ({"token_ids": ids} if with_ids else {}))

    flat = wanted.select(F.coalesce("doc_id", F.lit(NULL_LOW)).alias("_key"), F.col("doc_id").isNull().alias("_null"))
    # as many parts as shards: keys are small, and parts coalesced by their bytes would read all payloads in one task
    return (flat.mapInPandas(route, "_shard int, _key long, _null boolean").repartition(max(1, len(shards)), "_shard")
            .sortWithinPartitions("_shard", "_null", "_key").mapInPandas(look, shape))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all ``documents``, read back by key: doc_id, start, n_tokens, ids_crc32."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    shards = write(docs, work_path(spark, "op5"), default_tokenizer())
    return read_back(docs, shards)


QUERIES = {"op5_token_files": op5_token_files}
