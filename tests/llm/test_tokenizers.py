"""Chunked encoding against whole-text encoding by the libraries; file format round trips."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabscore.llm import sentencepiece_codec as sp
from tabscore.llm import token_files as tf

EDGE = ["", "   ", "  a  b ", "\n\n x\t y", "日本語 😀 \x00z\x1fq", " lead", "trail ", "a▁b", "▁", "<s> </s> <unk>", "é. É, éa.b",
        "word  " * 50, "it's. He'll, 're. x́. q́, A̧.", "ΑΣ. ΑΣ, İI K.", "a.b,c .. ., !. ,, end.", "x.́ y,̸ z!",
        "ß. ÿ, ×. ÷, µ.", "1.2, 3.", "Long " * 30_000]


def noise(n=300):
    rng = random.Random(5)
    alphabet = "aAbé.,'! \n\t0́ßñ▁<>≠sΣ"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_sentencepiece_equals_library():
    path = sp.default_model()
    own, lib = sp.Codec(path), sp.processor(path)
    texts = EDGE + noise()
    packed, parity = own.encode(texts)
    ids = [np.frombuffer(p, "<u4").tolist() for p in packed]
    assert ids == lib.encode(texts)
    assert all(parity)
    assert [own.decode(x) for x in ids] == lib.decode(ids)
    assert own.tokenizer.decode_batch(ids, skip_special_tokens=False) == lib.decode(ids)


def test_parity_covers_what_follows_a_line_feed():
    """A difference in the first word of a later line, or in a line feed, is seen in every text."""
    own = sp.Codec(sp.default_model())
    lib = own.library

    class Other:
        def __init__(self, odd):
            self.odd = odd

        def encode(self, texts, **options):
            one = lambda t: lib.encode(t) + [5] * (self.odd in t)
            return one(texts) if isinstance(texts, str) else [one(t) for t in texts]
    for odd in ("\nzebra", "\n\n"):
        own.library = Other(odd)
        own.memory.clear()
        assert own.encode(["a\nzebra b\n\nc", "a zebra\nb", ""])[1] == [False, True, True]


def test_unigram_model_is_rebuilt(tmp_path):
    """A hand-made unigram protobuf: scores decide, unknown characters fall back to bytes."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number, kind, data):
        return varint(number << 3 | kind) + (varint(len(data)) + data if kind == 2 else data)

    import struct
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    pieces += [("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ab", -4.0, 1), ("▁ab", -7.0, 1), ("▁a", -4.0, 1)]
    data = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, varint(t))) for p, s, t in pieces)
    data += field(2, 2, field(3, 0, varint(1)) + field(35, 0, varint(1)))
    data += field(3, 2, field(1, 2, b"identity") + field(3, 0, varint(1)) + field(4, 0, varint(0)) + field(5, 0, varint(1)))
    path = tmp_path / "own.model"
    path.write_bytes(data)
    own, lib = sp.Codec(str(path)), sp.processor(str(path))
    texts = ["ab ab", "a b", "abab é", " a", "", "b" * 40]
    assert [np.frombuffer(p, "<u4").tolist() for p in own.encode(texts)[0]] == lib.encode(texts)


def test_sentencepiece_frame(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (None, None, "y"), (50, "", None), (50, "é\n", "z"), (50, "é\n", "z")],
                               "doc_id long, text string, decoded string")
    out = sorted(sp.digest(df, sp.default_model()).collect(), key=str)
    assert len(out) == 5 and all(r.round_trip and r.parity for r in out)
    assert sp.digest(df.limit(0), sp.default_model()).count() == 0
    full = sp.encode(df, sp.default_model()).where("doc_id = 1").first()
    assert full.decoded == "a b" and len(full.token_ids) % 4 == 0


def test_words_equal_whole_texts():
    path = tf.default_tokenizer()
    own, lib = tf.WordEncoder(path), Tokenizer.from_file(path)
    assert own.chunked
    texts = EDGE + noise(2000)
    got = [np.frombuffer(p, "<u4").tolist() for p in own.encode(texts)]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_index_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(-2 ** 62, 2 ** 62, n))
    slots = tf.Lookup(tf.build_index(keys)).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_files_round_trip(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randint(-50, 400), f"text {i} of mine." * rng.randint(0, 9)) for i in range(300)]
    rows += [(7, None), (7, ""), (None, "no key"), (None, "no key"), (None, None)] + [(9, f"hot {i % 40}") for i in range(300)]
    df = spark.createDataFrame([(k, t, "q") for k, t in rows], "doc_id long, text string, start string").repartition(5)
    shards = tf.write(df, str(tmp_path), tf.default_tokenizer())
    assert sum(s["n_docs"] for s in shards) == len(rows)
    asked = df.select("doc_id").unionByName(spark.createDataFrame([(10 ** 9,), (-10 ** 9,)], "doc_id long"))
    got = tf.read_back(asked, shards, with_ids=True).collect()
    lib = Tokenizer.from_file(tf.default_tokenizer())

    def ids(t):
        return np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
    assert sorted((str(r.doc_id), bytes(r.token_ids)) for r in got) == sorted((str(k), ids(t)) for k, t in rows)
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.token_ids)) and r.n_tokens * 4 == len(r.token_ids) for r in got)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in got]
    assert order[:3] == [None] * 3 and order[3:] == sorted(order[3:])


def test_absent_keys_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(i * 3, "x") for i in range(500)], "doc_id long, text string")
    shards = tf.write(df, str(tmp_path / "a"), tf.default_tokenizer())
    others = spark.createDataFrame([(i * 3 + 1,) for i in range(500)], "doc_id long")
    assert tf.read_back(others, shards).count() == 0
    assert tf.write(df.limit(0), str(tmp_path / "b"), tf.default_tokenizer()) == []
    assert tf.read_back(others, []).count() == 0


def test_text_of_chunks_is_text_of_ids():
    """Decoding chunk by chunk gives what decoding all ids of a text gives, also where chunks decode to another text."""
    own = sp.Codec(sp.default_model())
    texts = EDGE + noise(200)
    packed, _, back = own.both(texts)
    assert back == [own.decode(sp.unpacked(p)) for p in packed] == own.read_back([sp.unpacked(p) for p in packed])
    own.other = set(own.memory.young)
    assert own.both(texts)[2] == back


def test_chunks_stay_known_from_task_to_task():
    """A worker's next task finds the chunks of the ones before, on one thread; marked ones never add up beyond the memory's size."""
    import os

    from tabscore.llm import sentencepiece_codec as sp
    own = sp.codec(sp.default_model())
    own.encode(["ab cd"])
    own.begin()
    assert own.memory.young and os.environ["TOKENIZERS_PARALLELISM"] == "false"
    own.other.update(map(str, range(own.memory.size + 1)))
    own.begin()
    assert not own.memory.young and not own.other and not own.bad


def test_new_chunks_are_encoded_and_compared_in_rows():
    """The libraries get rows of chunks, not single ones; a chunk that differs is still found alone, and ids are those of single chunks."""
    own = sp.Codec(sp.default_model())
    lib, calls = own.library, []

    class Other:
        def encode(self, texts, **options):
            calls.append(len(texts))
            return [x + [5] * ("zebra" in t) for t, x in zip(texts, lib.encode(texts))]
    own.library = Other()
    words = [f"w{i}é" for i in range(5 * sp.ROW)]
    texts = [" ".join(words), "a zebra", "\n\n".join(words[:9]), ""]
    packed, parity, back = own.both(texts)
    assert parity == [True, False, True, True] and back == texts and own.bad == {"▁zebra"}
    assert [sp.unpacked(p) for p in packed] == lib.encode(texts)
    assert sum(calls) <= 6 + sp.ROW + 1 + 2
    own.feed = []  # a model that gives a line feed several ids, or none of its own
    own.memory.clear()
    assert own.both(texts) == (packed, parity, back)
