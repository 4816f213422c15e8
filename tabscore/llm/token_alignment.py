"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) cover the same bytes as which of a SentencePiece model (B).

Both encode the same bytes; offsets where a token of each ends cut a text into groups, and all A-B pairs of a group are
links.  For every id pair the number of documents that hold it linked is counted over the whole corpus.

Method: an identity map gives for each A id the B id of the same bytes.  A group of one A token and its map image is exact:
such links are counted in vectors of the vocabulary's length, one a task.  Only the pairs of irregular groups are
shuffled, once per slice of documents that holds them.  The way back is the same: the vectors return as two
arrays of the vocabulary's length, the pair counts by a join on the pair and a grouping by slice, so no table that grows
with the corpus is broadcast or collected.

Texts are cut before a space or line feed that follows something else than white space.  No token of A crosses such a place
(its pre-tokenizer parts there), and none of B where no piece holds one (checked when the model is read; otherwise
texts stay whole), so each distinct chunk is encoded and aligned once per worker.

Defined results: a null or empty text, and one whose joined bytes of A or B differ from space+text, has no tokens, so zeros
and an empty ``groups_sha256``; every row is a document of its own, also repeated ones; a null ``doc_id`` stays null; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.llm.chunks import give_back, text_slices
from tabscore.llm.common import keep, read
from tabscore.session import work_path

MARK = "▁"
#: Bytes of text in a slice of documents (a longer document is a slice of its own).
SLICE = 2_000_000
#: Chunks and bytes of their records that a worker remembers at most; a forgotten chunk is aligned again.
REMEMBERED, REMEMBERED_BYTES = 150_000, 60_000_000
#: A pair's number is ``a << B_BITS | b``.
B_BITS = 15

CHUNK = re.compile(r"\s*\S+(?:[^\S \n]\s*(?:\S+|\Z))*|\s+")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others in order from
    U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, the identity map, and the worker's memory of aligned chunks."""

    def __init__(self, a_path: str, b_path: str):
        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        size = self.a.get_vocab_size()
        self.a_bytes = [b""] * size
        for piece, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in piece) if all(c in alphabet for c in piece) else piece.encode()
        b = self.b
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        if len(pieces) > 1 << B_BITS or size > 1 << (31 - B_BITS):
            raise ValueError("a vocabulary is too large for 31-bit pair numbers")
        plain = [i for i in range(len(pieces)) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i) or b.is_unused(i))]
        same = {}
        for i in [*plain, *(i for i in range(len(pieces)) if b.is_byte(i))]:
            same.setdefault(self.b_bytes[i], i)
        #: B id with the bytes of each A id, -1 where there is none.
        self.same = [same.get(x, -1) for x in self.a_bytes]
        self.same_array = np.array(self.same, np.int64)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        #: Each id as text of a group: in front of another of its side, and as the last one.
        self.said = [np.array([[f"{i},", f"{i}{end}"] for i in range(len(y))], object) for y, end in ((self.a_bytes, "|"), (self.b_bytes, ";"))]
        self.chunked = not any(re.search(f"[^{MARK}]{MARK}", pieces[i]) or (len(pieces[i]) > 1 and "\n" in pieces[i]) for i in plain)
        self.before = len(b.encode("\n"))
        self.young: dict = {}
        self.old: dict = {}
        self.held = 0

    def encode(self, chunks: list[str]) -> list[tuple[list[int], list[int]]]:
        """A and B ids of chunks of space+text."""
        first = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        if self.chunked:  # behind a line feed a chunk gets no prefix of its own
            second = [x[self.before:] for x in self.b.encode(["\n" + c for c in chunks], num_threads=1)]
        else:
            second = self.b.encode([c[1:] for c in chunks], num_threads=1)
        return list(zip(first, second))

    def align(self, chunks: list[str], ids: list[tuple[list[int], list[int]]]) -> list[tuple | None]:
        """Per chunk ``(n_a, n_b, n_groups, n_links, text of the groups, A ids of exact groups, pair numbers of the others)``, the last
        two as little-endian unsigned 32-bit integers; None if the bytes differ.  The text ends with a semicolon."""
        import numpy as np
        data = [c.encode() for c in chunks]
        sound = [b"".join(map(self.a_bytes.__getitem__, a)) == d == b"".join(map(self.b_bytes.__getitem__, b)) for d, (a, b) in zip(data, ids)]
        ids = [x for x, ok in zip(ids, sound) if ok]
        n_a, n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
        a, b = (np.fromiter((i for x in ids for i in x[k]), np.int64, int(n.sum())) for k, n in ((0, n_a), (1, n_b)))
        # all chunks stand in a row of bytes; chunk ends are ends of both
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        in_a, in_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        a_first, b_first = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        owner = np.searchsorted(np.cumsum(n_a), a_first, "right")  # chunk of each group
        groups, links = np.bincount(owner, minlength=len(ids)), np.bincount(owner, in_a * in_b, len(ids)).astype(np.int64)
        exact = np.flatnonzero((in_a == 1) & (in_b == 1))
        exact = exact[self.same_array[a[a_first[exact]]] == b[b_first[exact]]]
        other = np.ones(len(cuts), bool)
        other[exact] = False
        other = np.flatnonzero(other)
        times = in_a[other] * in_b[other]
        of, place = np.repeat(other, times), np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        pairs = a[a_first[of] + place // in_b[of]] << B_BITS | b[b_first[of] + place % in_b[of]]

        def split(values, owners):
            raw, ends = values.astype("<u4").tobytes(), 4 * np.cumsum(np.bincount(owners, minlength=len(ids)))
            return [raw[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
        said = np.empty(len(a) + len(b), object)
        said[np.arange(len(a)) + b_first[a_group]] = self.said[0][a, (np.arange(len(a)) == (a_first + in_a - 1)[a_group]).astype(int)]
        said[np.arange(len(b)) + (a_first + in_a)[b_group]] = self.said[1][b, (np.arange(len(b)) == (b_first + in_b - 1)[b_group]).astype(int)]
        said, ends = said.tolist(), np.cumsum(n_a + n_b).tolist()
        texts = ["".join(said[x:y]) for x, y in zip([0, *ends[:-1]], ends)]
        made = iter(zip(n_a.tolist(), n_b.tolist(), groups.tolist(), links.tolist(), texts, split(a[a_first[exact]], owner[exact]), split(pairs, owner[of])))
        return [next(made) if ok else None for ok in sound]

    def records(self, chunks: set[str]) -> dict:
        """Record of each distinct chunk."""
        if len(self.young) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        out, new = {}, []
        for c in chunks:
            r = self.young.get(c, 0)
            if r == 0:
                r = self.old.get(c, 0)
                if r == 0:
                    new.append(c)
                    continue
                self.young[c] = r
            out[c] = r
        for c, r in zip(new, self.align(new, self.encode(new)) if new else []):
            out[c] = self.young[c] = r
            self.held += 2 * len(c) + (len(r[4]) + len(r[5]) + len(r[6]) if r else 0)
        return out

    def clear(self) -> None:
        self.young, self.old, self.held = {}, {}, 0


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    # tasks fill an executor's cores already; the library's own threads cost a fifth more CPU time here
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(a_path, b_path)


def aligned(own: Aligner, texts: list[str]) -> dict:
    """A slice of texts: numbers of each, and its distinct links with how often each text holds them.

    ``exact``: ``(text, A id, times)`` of links with the map's image; ``other``: ``(text, pair number, times)``.
    """
    import numpy as np
    split = [(CHUNK.findall(" " + t) if own.chunked else [" " + t]) if t else [] for t in texts]
    records = own.records({c for s in split for c in s})
    number = {c: i for i, c in enumerate(records)}
    kept = list(records.values())
    sound = np.array([r is not None for r in kept], bool)
    kept = [r or (0, 0, 0, 0, "", b"", b"") for r in kept]
    rows = [[number[c] for c in s] for s in split]
    rows = [r if all(sound[i] for i in r) else [] for r in rows] if not sound.all() else rows
    flat = np.fromiter((i for r in rows for i in r), np.int64, sum(map(len, rows)))
    owner = np.repeat(np.arange(len(texts)), [len(r) for r in rows])
    sums = [np.bincount(owner, np.array([r[k] for r in kept], float)[flat], len(texts)).astype(np.int64) if len(flat) else np.zeros(len(texts), np.int64) for k in range(4)]
    said = [r[4] for r in kept]
    shas = [hashlib.sha256("".join([said[i] for i in r])[:-1].encode()).hexdigest() if r else "" for r in rows]

    def links(k):
        parts = [r[k] for r in kept]
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
        values = np.frombuffer(b"".join([parts[i] for i in flat.tolist()]), "<u4").astype(np.int64)
        return np.repeat(owner, sizes[flat] if len(flat) else 0), values

    exact_owner, exact = links(5)
    other_owner, other = links(6)
    a_of = other >> B_BITS
    image = own.same_array[a_of] == (other & ((1 << B_BITS) - 1))
    exact_owner, exact = np.concatenate([exact_owner, other_owner[image]]), np.concatenate([exact, a_of[image]])
    other_owner, other = other_owner[~image], other[~image]

    def distinct(owners, values):
        found, times = np.unique(owners << 32 | values, return_counts=True)
        return found >> 32, found & 0xFFFFFFFF, times

    return {"sums": sums, "shas": shas, "exact": distinct(exact_owner, exact), "other": distinct(other_owner, other)}


ENCODED = """slice long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, shas array<string>,
exact binary, other binary, pairs array<int>, pair_docs array<int>, vector array<long>"""


def encode(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per slice of documents (columns as in ``ENCODED``), and one per task with its ``vector`` alone.

    ``exact`` and ``other`` hold rows of three unsigned 32-bit integers: number of the document in the slice; A id, or place
    in ``pairs``; times.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(ENCODED))

    def triples(*columns):
        import numpy as np
        return np.stack(columns, 1).astype("<u4").tobytes()

    def run(batches):
        import numpy as np
        from pyspark import TaskContext
        own = aligner(a_path, b_path)
        vector, at = np.zeros(len(own.same), np.int64), TaskContext.get().partitionId() << 32
        try:
            for batch in batches:
                for a, b, texts in text_slices(batch, "_text", SLICE):
                    made = aligned(own, texts)
                    (d1, ids, m1), (d2, codes, m2) = made["exact"], made["other"]
                    vector += np.bincount(ids, minlength=len(vector))
                    pairs, place, n = np.unique(codes, return_inverse=True, return_counts=True)
                    row = [at, batch.column("_key").slice(a, b - a).to_pylist(), *[s.tolist() for s in made["sums"]], made["shas"],
                           triples(d1, ids, m1), triples(d2, place, m2), pairs.tolist(), n.tolist(), None]
                    at += 1
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)
        finally:
            own.clear()
            give_back()
        row = [None] * (len(schema) - 1) + [vector.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

    src = df.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
    return src.mapInArrow(run, ENCODED)


def vocabulary_counts(encoded: DataFrame) -> list[int]:
    """Documents that hold each A id linked with its image: the tasks' vectors, added up by place."""
    rows = (encoded.where("vector is not null").select(F.posexplode("vector").alias("a", "n")).where("n > 0")
            .groupBy("a").agg(F.sum("n").alias("n")).collect())  # a row per id of the vocabulary at most
    return [(r.a, r.n) for r in rows]


def pair_counts(encoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(slice, pair)`` rows of irregular links, and ``(pair, n)``: documents of the corpus that hold each."""
    held = encoded.where("slice is not null").select("slice", F.inline(F.arrays_zip("pairs", "pair_docs")))
    return held.select("slice", F.col("pairs").alias("pair")), held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_docs").alias("n"))


def align(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(per document, per id pair)``.

    Per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.  Per id pair linked anywhere: a, b, n
    (documents).
    """
    import numpy as np
    import pyarrow as pa
    spark = df.sparkSession
    path = work_path(spark, "alignment")
    encode(df, a_path, b_path, key, text).write.parquet(path)
    encoded = spark.read.parquet(path)
    own = aligner(a_path, b_path)
    exact = np.zeros(len(own.same), np.int64)
    for a, n in vocabulary_counts(encoded):
        exact[a] = n
    held, totals = pair_counts(encoded)
    totals = keep(totals)
    best = exact.copy()
    for r in totals.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("n").alias("n")).collect():  # a row per A id at most
        best[r.a] = max(best[r.a], r.n)
    back = held.join(totals, "pair").select("slice", "pair", "n")
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def counted(left, right):
        row = left.to_pylist()[0]
        pairs = np.array(row["pairs"], np.int64)
        count = np.zeros(len(pairs), np.int64)
        if len(pairs):
            count[np.searchsorted(pairs, right.column("pair").to_numpy())] = right.column("n").to_numpy()
        size = len(row["ids"])
        n_best, count_sum = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for data, ids, n in (("exact", None, exact), ("other", pairs >> B_BITS, count)):
            doc, at, times = np.frombuffer(row[data], "<u4").reshape(-1, 3).T.astype(np.int64)
            a_id = at if ids is None else ids[at]
            np.add.at(n_best, doc, times * (n[at] == best[a_id]))
            np.add.at(count_sum, doc, times * n[at])
        return pa.table({"doc_id": pa.array(row["ids"], pa.int64()), **{k: pa.array(row[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": n_best, "count_sum": count_sum, "groups_sha256": pa.array(row["shas"], pa.string())})

    slices = spark.read.parquet(path).where("slice is not null").drop("pair_docs", "vector")
    documents = slices.groupBy("slice").cogroup(back.groupBy("slice")).applyInArrow(counted, kind).withColumnRenamed("doc_id", key)
    images = spark.createDataFrame([(a, b, int(exact[a])) for a, b in enumerate(own.same) if b >= 0 and exact[a]], "a int, b int, n long")
    pairs = totals.select(F.shiftright("pair", B_BITS).alias("a"), F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b"), "n").unionByName(images)
    return documents, pairs


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return align(read(spark, sf_dir, "documents"), *default_tokenizers())[0]


QUERIES = {"op12_token_alignment": op12_token_alignment}
