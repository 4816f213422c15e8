"""Near-duplicate documents by SetSketch registers, verified on full shingle sets.

A document's set holds its distinct word shingles.  Each of ``REGISTERS`` registers is the smallest of its shingles'
exponentially distributed hashes, rounded to a power of ``BASE`` and truncated: ``clip(floor(1 - log_b(min)), 0, q + 1)``.
Registers merge by maximum and agree the more often the more two sets resemble each other.  Documents that agree on a band of
four registers are candidates; a joint likelihood of both sketches (equal, larger and smaller registers, with the known
set sizes) drops candidates far below the threshold; the rest is decided on the shingles themselves.

Equal sets are one vertex.  Candidates never become all pairs of a bucket: first every member of a bucket is compared with the
bucket's smallest vertex; where a bucket still holds several components, the members outside its largest component are compared
with all others of another component, in blocks of bounded size that hold the members' full sets (as 64-bit hashes of all
shingles): only links leave a block, and components it has linked are compared no further.  So each pair of candidates
is verified or already connected, and a bucket of any size is many small tasks.

Chance that two sets of resemblance 0.8 share none of 24 bands: (1 - 0.8 ** 4) ** 24 = 3e-6; that the estimate drops them: 4e-8 at most.

Words: A-Z lower-cased, parted by ASCII white space.  Defined results: with fewer words than a shingle the whole sequence is the
one shingle; without words or text the set is empty and links with nothing; rows that share an id are one
document; a null id gives a null component and is kept; other columns are ignored (``drop_copies`` keeps them).
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.llm.chunks import giving_back, slices, text_slices
from tabscore.llm.common import components, keep, read

REGISTERS, BAND = 96, 4
BASE, RATE, TOP = 1.02, 20.0, (1 << 16) - 2
#: Members of a bucket, and shingles of their sets (8 bytes each), that meet in one block, per side.
BLOCK, BLOCK_SHINGLES = 2048, 1_000_000
#: Rows of ids up to which a list of documents is sent to all executors.
BROADCAST_ROWS = 2_000_000
#: Candidates whose likelihood estimate is this far below the threshold are dropped: at most 4e-8 of the pairs at 0.8 (their 96 registers).
MARGIN = 0.24


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingle_set(text: str | None, n: int) -> set[bytes]:
    w = words_of(text)
    if len(w) <= n:
        return {b" ".join(w)} if w else set()
    return set(map(b" ".join, zip(*(w[k:] for k in range(n)))))


# ---- registers -----------------------------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def constants():
    import numpy as np
    rng = np.random.default_rng(20)
    return rng.integers(0, 2 ** 64, REGISTERS, np.uint64), rng.integers(0, 2 ** 64, REGISTERS, np.uint64) | np.uint64(1)


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as a text has needed them."""

    FACTOR = 0x9E3779B97F4A7C15

    def __init__(self):
        self.n = 0

    def upto(self, n: int):
        import numpy as np
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            back = pow(self.FACTOR, -1, 1 << 64)
            one = np.ones(1, np.uint64)
            self.up, self.down = (np.cumprod(np.concatenate([one, np.full(self.n - 1, x, np.uint64)])) for x in (self.FACTOR, back))
        return self.up[:n], self.down


POWERS = Powers()


def shingle_hashes(text: str | None, n: int):
    """Sorted distinct 64-bit hashes of a text's shingles: differences of one prefix sum over its bytes."""
    import numpy as np
    w = words_of(text)
    if not w:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" ".join(w), np.uint8)
    up, down = POWERS.upto(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)])
    gaps = np.flatnonzero(data == 32)
    first, last = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    if len(first) > n:
        first, last = first[:len(first) - n + 1], last[n - 1:]
    else:
        first, last = first[:1], last[-1:]
    x = (sums[last] - sums[first]) * down[first]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.unique(x ^ (x >> np.uint64(31)))


def registers(hashes):
    """SetSketch registers of a set of hashes (uint16); all 0 for the empty set."""
    import numpy as np
    if not len(hashes):
        return np.zeros(REGISTERS, np.uint16)
    flip, factor = constants()
    least = np.full(REGISTERS, 2 ** 64 - 1, np.uint64)
    for k in range(0, len(hashes), 4096):
        least = np.minimum(least, ((hashes[None, k:k + 4096] ^ flip[:, None]) * factor[:, None]).min(1))
    exponential = -np.log1p(-(least.astype(np.float64) + 1.0) / (2.0 ** 64 + 2.0)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merged(a, b):
    """Registers of the union."""
    import numpy as np
    return np.maximum(a, b)


def likely(n_a, n_b, above, below, grid: int = 50):
    """Resemblance of greatest joint likelihood, from the set sizes and the counts of registers where the first is above
    and below the second."""
    import numpy as np
    u = n_a / (n_a + n_b)
    v = 1 - u
    j = np.minimum(u / v, v / u)[:, None] * (np.arange(grid + 1) / grid)[None, :]

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    tiny = 1e-12
    score = above[:, None] * np.log(up + tiny) + below[:, None] * np.log(down + tiny) + (REGISTERS - above - below)[:, None] * np.log(np.maximum(1 - up - down, tiny))
    return j[np.arange(len(j)), score.argmax(1)]


def plausible(n_a, n_b, a, b, share: float):
    """Which pairs of sketches (rows of registers) may reach the share."""
    import numpy as np
    fit = np.minimum(n_a, n_b) >= share * np.maximum(n_a, n_b) - 1e-9
    out = np.zeros(len(n_a), bool)
    at = np.flatnonzero(fit)
    # Equal registers are at least about as many as the share says: far fewer need no likelihood.
    at = at[(a[at] == b[at]).sum(1) >= REGISTERS * (share - MARGIN - 0.1)]
    if len(at):
        above, below = (a[at] > b[at]).sum(1), (a[at] < b[at]).sum(1)
        out[at] = likely(n_a[at].astype(float), n_b[at].astype(float), above, below) >= share - MARGIN
    return out


def sketch(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n, digest, bands)`` of every row: set size, digest of the set, and the registers, four to a long."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch, "text"):
                rows = []
                for t in texts:
                    h = shingle_hashes(t, n)
                    rows.append((len(h), hashlib.md5(h.tobytes()).digest(), registers(h).view("<i8").tolist()))
                sizes, digests, bands = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                                                 names=["id", "n", "digest", "bands"])

    src = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(giving_back(run), "id long, n long, digest binary, bands array<long>")


# ---- links ---------------------------------------------------------------------------------------------------------

def small(df: DataFrame) -> DataFrame:
    """``df`` (kept before), marked for broadcast if its counted rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def unpack(bands):
    import numpy as np
    return np.array([np.asarray(x, "<i8") for x in bands]).view("<u2")


def estimate(pairs: DataFrame, reps: DataFrame, share: float) -> DataFrame:
    """Pairs ``(u, v)`` whose sketches make the share likely enough."""
    import pandas as pd

    def run(batches):
        for batch in batches:
            if len(batch):
                good = plausible(batch["n"].to_numpy(), batch["n2"].to_numpy(), unpack(batch["bands"]), unpack(batch["bands2"]), share)
                yield batch.loc[good, ["u", "v"]]

    one = reps.select(F.col("rep").alias("u"), "n", "bands")
    two = reps.select(F.col("rep").alias("v"), F.col("n").alias("n2"), F.col("bands").alias("bands2"))
    sized = pairs.join(one, "u").join(two, "v").where(F.least("n", "n2") >= F.greatest("n", "n2") * share - 1e-9)
    return sized.mapInPandas(giving_back(run), "u long, v long")


def verify(pairs: DataFrame, docs: DataFrame, n: int, percent: int, key: str, text: str) -> DataFrame:
    """Pairs ``(u, v)`` (kept before) whose full shingle sets reach the percentage.  Only texts of documents in a pair
    are moved: the list of their ids is counted and, if short enough, sent to the executors."""
    import pandas as pd
    ids = small(keep(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()))
    texts = (docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(ids, "id", "left_semi"))

    def run(batches):
        known, held = {}, 0

        def shingles(i, t):
            nonlocal held
            at = (i, t)
            if at not in known:
                if held > 500_000:  # bounds the worker's memory
                    known.clear()
                    held = 0
                known[at] = shingle_set(t, n)
                held += len(known[at])
            return known[at]
        for batch in batches:
            good = []
            for u, v, a, b in zip(batch["u"], batch["v"], batch["a"], batch["b"]):
                x, y = shingles(u, a), shingles(v, b)
                common = len(x & y)
                good.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[good, ["u", "v"]]

    rows = (pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("a")), "u")
            .join(texts.select(F.col("id").alias("v"), F.col("text").alias("b")), "v"))
    return rows.mapInPandas(giving_back(run), "u long, v long")


def hash_sets(docs: DataFrame, ids: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """``(digest, hashes)``: the sets of the documents with these ids (kept before), all hashes of each in ascending order."""
    import pandas as pd

    def run(batches):
        for batch in batches:
            rows = [shingle_hashes(t if isinstance(t, str) else None, n).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"digest": [hashlib.md5(h).digest() for h in rows], "hashes": rows})

    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(small(ids), "id", "left_semi")
    return texts.select("text").mapInPandas(giving_back(run), "digest binary, hashes binary").dropDuplicates(["digest"])


def share_of(x, y) -> tuple[int, int]:
    """Sizes of the intersection and the union of two ascending arrays of distinct hashes."""
    import numpy as np
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = int((y[at] == x).sum())
    return common, len(x) + len(y) - common


def cross(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that lie in different components: ``members(band, key, rep, comp, n, bands,
    digest)`` (kept before); enough of them to connect all components that have one."""
    import numpy as np
    import pandas as pd
    share = percent / 100
    per = members.groupBy("band", "key", "comp").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    chunks = lambda rows, shingles: F.ceil(F.greatest(rows / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")
    buckets = (per.groupBy("band", "key").agg(F.max(F.struct("size", "comp", "shingles")).alias("top"), F.sum("size").alias("all"), F.sum("shingles").alias("sum"))
               .where(F.col("all") > F.col("top.size"))
               .select("band", "key", F.col("top.comp").alias("main"), chunks(F.col("top.size"), F.col("top.shingles")).alias("g"),
                       chunks(F.col("all") - F.col("top.size"), F.col("sum") - F.col("top.shingles")).alias("s")))
    rows = members.join(buckets, ["band", "key"]).join(sets, "digest")
    h = F.xxhash64("rep")
    in_main = F.col("comp") == F.col("main")
    own_main, own = F.pmod(h, F.col("g")).cast("int"), F.pmod(h, F.col("s")).cast("int")
    ints = lambda n: F.sequence(F.lit(0), n - 1)
    # block (i, j) with i >= 0: chunk i of the largest component against chunk j of the others; i < 0: two chunks of the others
    to = F.when(in_main, F.transform(ints(F.col("s")), lambda j: F.struct(own_main.alias("i"), j.alias("j"), F.lit(False).alias("other")))).otherwise(
        F.concat(F.transform(ints(F.col("g")), lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(True).alias("other"))),
                 F.transform(ints(F.col("s")), lambda x: F.struct((-1 - F.least(x, own)).alias("i"), F.greatest(x, own).alias("j"), (x < own).alias("other")))))
    names = ["band", "key", "rep", "comp", "n", "bands", "hashes"]
    sent = rows.select(*names, F.explode(to).alias("to")).select(*names, "to.*")

    def block(part):
        """Links of a block's rows; a pair is looked at once, in the first of its common bands."""
        other = part["other"].to_numpy(bool)
        ids, comp, size, bands = part["rep"].to_numpy(), part["comp"].to_numpy(), part["n"].to_numpy(), np.array([np.asarray(x, "<i8") for x in part["bands"]])
        sets = [np.frombuffer(x, "<u8") for x in part["hashes"]]
        regs, band = bands.view("<u2"), int(part["band"].iloc[0])
        _, label = np.unique(comp, return_inverse=True)
        within = not other.any() or other.all()
        left = np.arange(len(part)) if within else np.flatnonzero(other)
        right = left if within else np.flatnonzero(~other)
        step = max(1, 100_000 // max(1, len(right)))  # bounds the pairs looked at together
        for k in range(0, len(left), step):
            some = left[k:k + step]
            ok = label[some][:, None] != label[right][None, :]
            if within:
                ok &= some[:, None] < right[None, :]
            low, high = np.minimum(size[some][:, None], size[right][None, :]), np.maximum(size[some][:, None], size[right][None, :])
            i, j = np.nonzero(ok & (low >= share * high - 1e-9))
            i, j = some[i], right[j]
            first = (bands[i] == bands[j]).argmax(1) == band
            i, j = i[first], j[first]
            good = plausible(size[i], size[j], regs[i], regs[j], share)
            for a, b in zip(i[good].tolist(), j[good].tolist()):
                if label[a] != label[b]:
                    common, union = share_of(sets[a], sets[b])
                    if 100 * common >= percent * union:
                        yield int(ids[a]), int(ids[b])
                        label[label == label[b]] = label[a]

    def run(batches):
        """Blocks stand in a row, sorted by their key; one block is held at a time."""
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            key = rows[["band", "key", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            held = rows.iloc[cuts[-1] if len(cuts) else 0:].reset_index(drop=True)
            out = [p for a, b in zip([0, *cuts], cuts) if b - a > 1 for p in block(rows.iloc[a:b])]
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
        if held is not None and len(held) > 1:
            yield pd.DataFrame(list(block(held)), columns=["u", "v"], dtype="int64")

    order = ["band", "key", "i", "j"]
    return sent.repartition(*order).sortWithinPartitions(*order).mapInPandas(giving_back(run), "u long, v long")


def near_documents(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, n_shingles, component_id, kept; a null id is linked with nothing, its component_id is null and it is kept."""
    share = percent / 100
    every = keep(sketch(docs, words, key, text))
    sketches = every.where("id is not null")
    reps = keep(sketches.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.min_by(F.struct("n", "bands"), "id").alias("x"))
                .select("digest", "rep", "x.n", "x.bands"))
    # A repeated id with several texts has a row for each of its sets; all its sets are one vertex.
    banded = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    hubs = banded.groupBy("band", "key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where("size > 1")
    rows = keep(banded.join(hubs.drop("size"), ["band", "key"]))  # members of buckets of two and more
    pairs = rows.where("rep != hub").select(F.col("hub").alias("u"), F.col("rep").alias("v")).distinct()
    links = keep(verify(keep(estimate(pairs, reps, share)), docs, words, percent, key, text).unionByName(_same_id(sketches, reps)))
    comp = components(links)
    known = rows.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("band", "key", "rep", F.coalesce("component_id", "rep").alias("comp"))
    mixed = (known.groupBy("band", "key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a != b").select("band", "key"))
    members = keep(known.join(mixed, ["band", "key"], "left_semi").join(reps, "rep"))
    sets = hash_sets(docs, keep(members.select(F.col("rep").alias("id")).distinct()), words, key, text)
    more = keep(cross(members, sets, percent))
    if more.take(1):
        comp = components(links.unionByName(more))
    roots = reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component_id", "rep").alias("root"))
    out = sketches.select("id", "n", "digest").join(roots, "digest", "left")
    root = F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("id"))
    out = out.select("id", "n", root.alias("root")).unionByName(every.where("id is null").select("id", "n", F.lit(None).cast("long").alias("root")))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("root").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("root"), F.lit(True)).alias("kept"))


def _same_id(sketches: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the sets of rows that share an id."""
    several = sketches.where("n > 0").groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a != b").select("id")
    own = sketches.join(several, "id", "left_semi").join(reps.select("digest", "rep"), "digest")
    return own.select(F.col("id").alias("u"), F.col("rep").alias("v")).where("u != v")


def drop_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, all columns: of each component the document with the smallest id."""
    gone = keep(near_documents(docs, words, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(small(gone), docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def op8_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` on four-word shingles: doc_id, n_shingles, component_id, kept."""
    return near_documents(read(spark, sf_dir, "documents"), words=4)


QUERIES = {"op8_near_documents": op8_near_documents}
