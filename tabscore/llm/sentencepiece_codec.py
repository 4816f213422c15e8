"""SentencePiece encoding and decoding on the tokenizers library.

The ``.model`` protobuf is parsed here; from it the normaliser, the metaspace marker, the unigram scores (or the
merge order of a BPE model) and byte fallback are rebuilt as a ``tokenizers.Tokenizer``.  Distinct chunks of a
batch are encoded together and remembered per worker, from task to task.  Parity with the ``sentencepiece`` library is
verified on every distinct chunk where chunks cannot merge (behind a line feed, or behind a letter for line feeds, so that
chunks with and without a marker are compared as they stand in a text), and else on every whole text.

Defined results: a null text counts as empty and gives no ids; a null ``doc_id`` stays null; repeated rows give
repeated rows; further input columns pass through ``encode`` untouched.  ``n_tokens`` etc. are added last and
replace input columns of the same name.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscore.llm.chunks import ChunkMemory, give_back, text_slices
from tabscore.llm.common import read

MARK = "▁"
#: Piece types of the model protobuf (fixed values of its public schema).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Model types of the trainer spec (fixed values of its public schema).
UNIGRAM, BPE = 1, 2
#: Chunks encoded and compared in one row.
ROW = 40


def fields(data: bytes):
    """``(number, wire type, value)`` of each field of a protobuf message."""
    at = 0

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 1:
            value, at = data[at:at + 8], at + 8
        elif kind == 2:
            n = varint()
            value, at = data[at:at + n], at + n
        elif kind == 5:
            value, at = data[at:at + 4], at + 4
        else:
            raise ValueError(f"wire type {kind} in the model file")
        yield key >> 3, kind, value


def parse_model(data: bytes) -> dict:
    """Pieces ``(text, score, type)``, model type, byte fallback, unknown id and normaliser settings."""
    out = {"pieces": [], "type": UNIGRAM, "byte_fallback": False, "unk_id": 0, "charsmap": b"",
           "dummy_prefix": True, "squeeze": True, "escape": True}
    for number, _, value in fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, _, v in fields(value):
                if n == 1:
                    text = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            out["pieces"].append((text, score, kind))
        elif number == 2:
            for n, _, v in fields(value):
                if n == 3:
                    out["type"] = v
                elif n == 35:
                    out["byte_fallback"] = bool(v)
        elif number == 3:
            for n, _, v in fields(value):
                if n == 2:
                    out["charsmap"] = v
                elif n == 3:
                    out["dummy_prefix"] = bool(v)
                elif n == 4:
                    out["squeeze"] = bool(v)
                elif n == 5:
                    out["escape"] = bool(v)
    out["unk_id"] = next((i for i, p in enumerate(out["pieces"]) if p[2] == UNKNOWN), 0)
    return out


def unpacked(ids: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


class Codec:
    """Encoder and decoder of one SentencePiece model."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers
        with open(path, "rb") as f:
            m = self.model = parse_model(f.read())
        pieces = m["pieces"]
        vocab = {}
        for i, (text, _, _) in enumerate(pieces):
            vocab.setdefault(text, i)
        unk = pieces[m["unk_id"]][0]
        if m["type"] == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in pieces], m["unk_id"], m["byte_fallback"])
        elif m["type"] == BPE:
            usable = {p: s for p, s, kind in pieces if kind in (NORMAL, USER_DEFINED)}
            merges = []
            for p, s in usable.items():
                for k in range(1, len(p)):
                    if p[:k] in usable and p[k:] in usable:
                        merges.append((-s, vocab[p[:k]], vocab[p[k:]], p[:k], p[k:]))
            merges.sort()
            core = models.BPE(vocab, [x[3:] for x in merges], unk_token=unk, fuse_unk=True,
                              byte_fallback=m["byte_fallback"])
        else:
            raise ValueError("only unigram and BPE models")
        self.tokenizer = Tokenizer(core)
        steps = [normalizers.Precompiled(m["charsmap"])] if m["charsmap"] else []
        if m["squeeze"]:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        if m["dummy_prefix"]:
            steps.append(normalizers.Prepend(" "))
        if m["escape"]:
            steps.append(normalizers.Replace(" ", MARK))
        #: The normaliser of whole texts; chunks are encoded after it.
        self.normal = normalizers.Sequence(steps)
        self.plain = not m["charsmap"] and not m["squeeze"] and m["escape"] and m["dummy_prefix"]
        # No merge crosses a border that lies inside no piece.  Two such borders are used: before a run of markers,
        # and around a line feed; where a piece holds one of them (or the model is no BPE), texts stay whole.
        words = [p for p, _, kind in pieces if kind in (NORMAL, USER_DEFINED)]
        self.chunked = m["type"] == BPE and m["byte_fallback"] and not any(
            re.search(f"[^{MARK}]{MARK}", p) or (len(p) > 1 and "\n" in p) for p in words)
        self.chunk = re.compile(f"\n+|{MARK}*[^{MARK}\n]+|{MARK}+")
        self.memory = ChunkMemory(self._encode_new, 120_000)
        self.library = processor(path)
        self.read_back = self.library.decode
        #: Whether parity is known from chunks, what stands before a chunk when it is compared, and the chunks that differ.
        self.by_chunk = self.chunked and self.plain
        self.lead = {lead: self.library.encode(lead) for lead in ("\n", "a")}
        self.feed = self._ids(["\n"])[0]
        self.bad: set[str] = set()
        #: Chunks whose ids decode to another text.
        self.other: set[str] = set()
        # Decoder rebuilt the same way: bytes fuse, the marker becomes a space, the dummy prefix goes.
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        self.tokenizer.decoder = decoders.Sequence(steps + ([decoders.Strip(" ", 1, 0)] if m["dummy_prefix"] else []))
        self.raw = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in pieces]
        self.special = {i for i, p in enumerate(pieces) if p[2] in (CONTROL, UNKNOWN)}

    def begin(self) -> None:
        """A task begins: chunks known from the worker's earlier tasks stay known, unless those marked as different have grown many."""
        if len(self.bad) + len(self.other) > self.memory.size:
            self.memory.clear()
            self.bad.clear()
            self.other.clear()

    def normalise(self, text: str) -> str:
        if self.plain:
            return (MARK + text.replace(" ", MARK)) if text else ""
        return self.normal.normalize_str(text) if text and text.strip(" ") else ""

    def _encode_new(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each of the distinct chunks; marks those that the library encodes to other ids, or whose ids are read back otherwise.

        Chunks are encoded and compared many in a row, each behind a line feed, as they stand in a text: no merge crosses a line
        feed and no chunk of words holds one, so rows are equal only if all their chunks are, and are cut at the line
        feeds' ids.  The chunks of a row that differs, and line feeds, are encoded and compared one by one.
        """
        if not self.by_chunk:
            return self._ids(chunks)
        self.bad.difference_update(chunks)
        self.other.difference_update(chunks)
        lead, known = self.lead["\n"], {}
        alone = [c for c in chunks if c[0] == "\n"]
        words = [c for c in chunks if c[0] != "\n"]
        rows = [words[k:k + ROW] for k in range(0, len(words), ROW)]
        joined = ["\n".join(row) for row in rows]
        ids = self._ids(joined)
        cut = [self._cut(x, len(row)) for x, row in zip(ids, rows)]
        readings = self._readings([f"\n{t}".replace(MARK, " ") for t in joined], [lead + x for x in ids])
        for row, parts, (text, x, y, p, q, r) in zip(rows, cut, readings):
            if parts and x == y and p == q == r == text:
                known.update(zip(row, parts))
            else:
                alone += row
        ids = self._ids(alone)
        known.update(zip(alone, ids))
        texts = [("a" if c[0] == "\n" else "\n") + c.replace(MARK, " ") for c in alone]
        for c, (text, x, y, p, q, r) in zip(alone, self._readings(texts, [self.lead[t[0]] + x for t, x in zip(texts, ids)])):
            if not (x == y and p == q == r):
                self.bad.add(c)
            if r != text:
                self.other.add(c)
        return [known[c] for c in chunks]

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _cut(self, ids: list[int], parts: int) -> list[list[int]]:
        """Ids of a row, cut at the line feeds' ids; empty if these are not as many as stand between its parts."""
        if len(self.feed) != 1 or ids.count(self.feed[0]) != parts - 1:
            return []
        out, start = [], 0
        for _ in range(parts - 1):
            end = ids.index(self.feed[0], start)
            out.append(ids[start:end])
            start = end + 1
        return [*out, ids[start:]]

    def _readings(self, texts: list[str], ids: list[list[int]]):
        """``(text, ids, the library's ids, the ids read back by the library, by tokenizers and here)`` of each text."""
        if not texts:
            return []
        return zip(texts, ids, self.library.encode(texts, num_threads=1), self.read_back(ids),
                   self.tokenizer.decode_batch(ids, skip_special_tokens=False), map(self.decode, ids))

    def both(self, texts: list[str]) -> tuple[list[bytes], list[bool], list[str]]:
        """Ids of each text as little-endian unsigned 32-bit integers, whether the sentencepiece library gives the same, and the
        text that the ids decode to.  Each distinct chunk's ids are decoded once, so a text's decoding is its chunks' in a row."""
        parts = [(self.chunk.findall(x) if self.chunked else [x] if x else []) for x in map(self.normalise, texts)]
        packed = self.memory.pack(parts)
        if self.by_chunk:
            parity = [not self.bad or self.bad.isdisjoint(p) for p in parts]
            back = [self.decode(unpacked(x)) if self.other and not self.other.isdisjoint(p) else "".join(p).replace(MARK, " ")[1:] for x, p in zip(packed, parts)]
            return packed, parity, back
        lists = list(map(unpacked, packed))
        back = [self.decode(x) for x in lists]
        theirs = zip(self.library.encode(texts, num_threads=1), self.read_back(lists), self.tokenizer.decode_batch(lists, skip_special_tokens=False))
        return packed, [x == y and p == q == r for x, (y, p, q), r in zip(lists, theirs, back)], back

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Ids and parity of each text."""
        return self.both(texts)[:2]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: piece bytes in a row; ids that are control or unknown pieces, or bytes that are no valid
        UTF-8, go through the tokenizers library's decoder."""
        try:
            if self.special.isdisjoint(ids):
                out = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8")
                return out[1:] if self.model["dummy_prefix"] and out[:1] == " " else out
        except UnicodeDecodeError:
            pass
        return self.tokenizer.decode([i for i in ids if self.model["pieces"][i][2] != CONTROL], skip_special_tokens=False)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    # tasks fill an executor's cores already; the library's own threads only cost CPU time
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Codec(path)
    give_back()  # what rebuilding the model took
    return made


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encode(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Add ``token_ids`` (little-endian unsigned 32-bit integers), ``decoded`` (the ids' text) and ``parity``.

    ``parity``: the ``sentencepiece`` library gives the same ids for all of the text, and it and the ``tokenizers`` library
    read them back alike.
    One narrow pass without a shuffle; a batch is cut by text size, so long texts don't add up in a worker.
    """
    import pyarrow as pa
    added = [("token_ids", T.BinaryType()), ("decoded", T.StringType()), ("parity", T.BooleanType())]
    rest = [f for f in df.schema.fields if f.name not in dict(added)]
    names = [f.name for f in rest]

    def run(batches):
        own = codec(model_path)
        own.begin()
        try:
            yield from encoded(own, batches)
        finally:
            give_back()

    def encoded(own, batches):
        for batch in batches:
            for a, b, texts in text_slices(batch, text):
                packed, parity, back = own.both(texts)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns, pa.array(packed, pa.binary()), pa.array(back, pa.string()), pa.array(parity, pa.bool_())], names=[*names, *dict(added)])

    return df.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, T.StructType(rest + [T.StructField(n, t) for n, t in added]))


def digest(df: DataFrame, model_path: str) -> DataFrame:
    """Per document: id count, checksum of the ids, and whether the decoded text is the text."""
    src = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (encode(src, model_path)
            .select("doc_id", (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
                    F.crc32("token_ids").alias("ids_crc32"),
                    (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"), "parity"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: doc_id, n_tokens, ids_crc32, round_trip, parity."""
    return digest(read(spark, sf_dir, "documents"), default_model())


QUERIES = {"op3_sentencepiece": op3_sentencepiece}
