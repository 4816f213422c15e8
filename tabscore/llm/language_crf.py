"""Language identification by a linear-chain conditional random field over words.

Each word's label score is a sum of learned weights of its affixes, n-grams and whole form (the lexicon); learned
transitions join neighbouring words, and forward-backward gives every word's label probabilities, so mixed texts
are labelled word by word.  A document's language has the largest mean probability over its words.

The model is fitted on the driver from a bounded sample: rows whose ``crc32(doc_id) % 4`` isn't 2 and whose language is
known, drawn by hash so that about ``SAMPLE_CHARS`` characters of each language come, and at least one text of each; of a text at
most the first ``SAMPLE_CHARS`` characters are learned from.  Everything
else runs where the rows are, in one narrow pass; forward-backward works on equal segments of all texts of a
slice at once (segment transfer matrices, then a scan over segments), so a very long text costs no more a word.

Defined results: ``und`` with score 0 where the text is null or has no letter, or nothing could be learned; repeated rows
give repeated rows; rows with a null id are never learned from and count as not held out.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.llm.chunks import give_back, text_slices
from tabscore.llm.common import read

#: Characters of each language that are learned from (a documented bound of the fit).
SAMPLE_CHARS = 400_000
BUCKETS = 1 << 17
SEGMENT = 64
#: Words that a learning step looks at together (whole sequences): bounds the driver's memory.
AT_ONCE = 1 << 15
UNDETERMINED = "und"

EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def plain(token: str) -> str:
    """A token's word: lower case, without what isn't a letter at its ends (empty: no letter)."""
    if token.isalpha():
        return token.lower()
    return EDGE.sub("", token).lower() if any(map(str.isalpha, token)) else ""


def features(word: str) -> list[int]:
    """Feature numbers of a word: prefixes and suffixes of 1 to 4 characters, n-grams of 2 and 3 inside its borders, and
    the word itself."""
    n, crc = len(word), zlib.crc32
    b = f"^{word}$"
    parts = [b[:k + 1] for k in range(1, min(4, n) + 1)] + [b[-k - 1:] for k in range(1, min(4, n) + 1)]
    parts += [b[i:i + k] for k in (2, 3) for i in range(1, n - k + 2)]
    return [crc(p.encode("utf-8", "replace")) % BUCKETS for p in parts] + [crc(b.encode("utf-8", "replace"), 1) % BUCKETS]


def flat_features(words: list[str]):
    """Feature numbers of all words in a row, and where each word's begin."""
    import numpy as np
    lists = [features(w) for w in words]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((x for one in lists for x in one), np.int64, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def forward_backward(emit, starts, first, trans):
    """Label probabilities of every word, and the expected transitions, of texts that stand in a row.

    ``emit``: words x labels scores; ``starts``: number of each text's first word (ascending, no empty text);
    ``first`` and ``trans``: scores of a first label and of label pairs.
    """
    import numpy as np
    n, L = emit.shape
    sizes = np.diff(np.append(starts, n))
    segments = -(-sizes // SEGMENT)
    total = int(segments.sum())
    seg_first = np.concatenate([[0], np.cumsum(segments)[:-1]])
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(n) - starts[text_of]
    row, col = seg_first[text_of] + inside // SEGMENT, inside % SEGMENT
    p = np.ones((SEGMENT, total, L))
    live = np.zeros((SEGMENT, total), bool)
    p[col, row] = np.exp(emit - emit.max(1, keepdims=True))
    live[col, row] = True
    head = np.zeros(total, bool)
    head[seg_first] = True
    T = np.exp(trans - trans.max())
    pi = np.exp(first - first.max())
    # 1. transfer matrix of each segment
    M = np.broadcast_to(np.eye(L), (total, L, L)).copy()
    for t in range(SEGMENT):
        new = M @ T
        if t == 0:
            new[head] = pi  # whatever came before, a text starts with the first-label scores
        new *= p[t][:, None, :]
        new /= new.max((1, 2), keepdims=True)
        M = np.where(live[t][:, None, None], new, M)
    # 2. probabilities at segment borders, over texts side by side
    alpha_in, beta_out = np.full((total, L), 1.0 / L), np.full((total, L), 1.0 / L)
    order = np.argsort(-segments, kind="stable")
    longest = segments[order]
    a = np.full((len(sizes), L), 1.0 / L)
    for k in range(int(longest[0]) if len(longest) else 0):
        act = order[:np.searchsorted(-longest, -k, "left")]
        s = seg_first[act] + k
        alpha_in[s] = a[act]
        v = np.einsum("ij,ijk->ik", a[act], M[s])
        a[act] = v / v.sum(1, keepdims=True)
    b = np.full((len(sizes), L), 1.0 / L)
    for k in range(int(longest[0]) if len(longest) else 0):
        act = order[:np.searchsorted(-longest, -k, "left")]
        s = seg_first[act] + segments[act] - 1 - k
        beta_out[s] = b[act]
        v = np.einsum("ijk,ik->ij", M[s], b[act])
        b[act] = v / v.sum(1, keepdims=True)
    # 3. within segments
    alpha = np.empty((SEGMENT, total, L))
    now = alpha_in
    for t in range(SEGMENT):
        new = now @ T
        if t == 0:
            new[head] = pi
        new *= p[t]
        new /= new.sum(1, keepdims=True)
        now = np.where(live[t][:, None], new, now)
        alpha[t] = now
    post, pairs, back = np.empty((SEGMENT, total, L)), np.zeros((L, L)), beta_out
    for t in range(SEGMENT - 1, -1, -1):
        g = alpha[t] * back
        post[t] = g / g.sum(1, keepdims=True)
        carried = p[t] * back
        before = alpha[t - 1] if t else alpha_in
        both = live[t] if t else live[t] & ~head
        joint = before[both][:, :, None] * T * carried[both][:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        new = carried @ T.T
        new /= new.sum(1, keepdims=True)
        back = np.where(live[t][:, None], new, back)
    return post[col, row], pairs


@dataclass
class Model:
    """Learned weights, and the worker's memory of words already scored."""

    labels: list[str]
    weights: object  # BUCKETS x labels
    first: object
    trans: object
    remembered: int = 120_000
    _rows: dict = field(default_factory=dict, repr=False)
    _words: dict = field(default_factory=dict, repr=False)
    _scores: object = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_rows": {}, "_words": {}, "_scores": None}

    def forget(self) -> None:
        """Give the memory of scored words up."""
        self._rows, self._words, self._scores = {}, {}, None

    def emissions(self, tokens: list[str]):
        """Row of each token in the score table (0: no letter); the table starts anew when it has grown large."""
        import numpy as np
        if self._scores is None or len(self._rows) > self.remembered:
            self._rows, self._words, self._scores = {}, {}, np.zeros((1, len(self.labels)))
        rows = self._rows
        known, words, size = self._words, [], len(self._scores)
        for t in set(tokens):
            if t not in rows:
                w = plain(t)
                at = known.get(w)
                if at is None:
                    at = known[w] = size + len(words) if w else 0
                    if w:
                        words.append(w)
                rows[t] = at
        if words:
            flat, at = flat_features(words)
            self._scores = np.concatenate([self._scores, np.add.reduceat(self.weights[flat], at, axis=0)])
        return np.fromiter(map(rows.__getitem__, tokens), np.int64, len(tokens)), self._scores

    def words(self, texts: list[str]):
        """Per text its tokens with letters; and the label probabilities of all of them in a row."""
        import numpy as np
        split = [t.split() for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        rows, table = self.emissions([t for s in split for t in s])
        has = rows > 0
        owner, rows = owner[has], rows[has]
        if not len(rows):
            return split, has, owner, np.zeros((0, len(self.labels)))
        starts = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
        post, _ = forward_backward(table[rows], starts, self.first, self.trans)
        return split, has, owner, post

    def predict(self, texts: list[str]) -> list[tuple[str, float, int]]:
        """Language, score and number of words with letters of each text."""
        import numpy as np
        if not self.labels:
            return [(UNDETERMINED, 0.0, 0) for _ in texts]
        _, _, owner, post = self.words(texts)
        total = np.stack([np.bincount(owner, post[:, k], len(texts)) for k in range(len(self.labels))], 1)
        n = np.bincount(owner, minlength=len(texts))
        best = total.argmax(1)
        return [(self.labels[b], min(1.0, float(row[b] / c)), int(c)) if c else (UNDETERMINED, 0.0, 0)
                for b, row, c in zip(best, total, n)]

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """``(token, language, probability)`` of every token with a letter."""
        split, has, _, post = self.words([text])
        best = post.argmax(1) if len(post) else []
        return [(t, self.labels[b], float(p[b])) for t, b, p in zip((t for t, h in zip(split[0], has) if h), best, post)]


def fit(samples: list[tuple[str, str]], rounds: int = 24, rate: float = 0.15, ridge: float = 3e-6) -> Model:
    """Learn from ``(text, language)`` rows.  Lines of different texts are joined into mixed sequences, so that
    transitions between languages are seen too; Adam steps on the exact gradient of the likelihood."""
    import numpy as np
    labels = sorted({lang for _, lang in samples})
    number = {x: i for i, x in enumerate(labels)}
    lines = [(line.split(), number[lang]) for text, lang in samples for line in text.split("\n")]
    lines = [([w for w in map(plain, words) if w], y) for words, y in lines]
    lines = sorted(((w, y) for w, y in lines if w), key=lambda x: zlib.crc32(" ".join(x[0]).encode("utf-8", "replace")))
    if not lines:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros((0, 0)))
    L = len(labels)
    vocab: dict[str, int] = {}
    word = np.array([vocab.setdefault(t, len(vocab)) for w, _ in lines for t in w], np.int64)
    gold = np.repeat([y for _, y in lines], [len(w) for w, _ in lines])
    sizes = [sum(len(w) for w, _ in lines[i:i + 8]) for i in range(0, len(lines), 8)]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    flat, at = flat_features(list(vocab))
    n_words = len(vocab)
    del lines, vocab  # from here on words are numbers
    owner = np.repeat(np.arange(n_words), np.diff(np.append(at, len(flat))))
    inner = np.ones(len(word), bool)
    inner[starts] = False
    seen = np.zeros((L, L))
    np.add.at(seen, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    eye, miss = np.eye(L), np.empty((len(word), L))
    runs = [0, *(np.flatnonzero(np.diff(starts // AT_ONCE)) + 1).tolist(), len(starts)]
    ends = np.append(starts, len(word))
    # all labels weigh alike, however many words their samples hold
    weight = (len(gold) / (L * np.bincount(gold, minlength=L)))[gold]
    params = [np.zeros((BUCKETS, L)), np.zeros(L), np.zeros((L, L))]
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in params]
    for step in range(1, rounds + 1):
        W, first, trans = params
        table = np.add.reduceat(W[flat], at, axis=0)
        pairs = np.zeros((L, L))
        for a, b in zip(runs, runs[1:]):
            here = slice(ends[a], ends[b])
            post, some = forward_backward(table[word[here]], starts[a:b] - starts[a], first, trans)
            miss[here] = (eye[gold[here]] - post) * weight[here, None]
            pairs += some
        by_word = np.stack([np.bincount(word, miss[:, k], n_words) for k in range(L)], 1)
        grad = np.stack([np.bincount(flat, by_word[owner, k], BUCKETS) for k in range(L)], 1)
        grads = [grad / len(word) - ridge * W, miss[starts].sum(0) / len(starts) - 1e-3 * first, (seen - pairs) / len(word) - 1e-4 * trans]
        for x, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model(labels, params[0].astype(np.float32), params[1], params[2])


def remainder(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4


def learn(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", chars: int = SAMPLE_CHARS) -> Model:
    """Fit on the bounded sample.  Two aggregate passes; only the sample reaches the driver."""
    src = (df.select(F.col(key).cast("string").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
           .where("id is not null and lang is not null and text is not null").where(remainder("id") != 2))
    sizes = {r.lang: r.n for r in src.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}  # a row per language
    draw = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 30))
    wanted = F.lit(False)
    for one, n in sorted(sizes.items()):
        wanted = wanted | ((F.col("lang") == one) & (draw < int((1 << 30) * min(1.0, chars / max(n or 1, 1)))))
    short = F.substring("text", 1, chars).alias("text")
    drawn = src.where(wanted).select("lang", draw.alias("draw"), "id", short)
    # the text with the smallest draw of each language comes whatever its length (it is among the drawn ones, if there are any)
    first = src.groupBy("lang").agg(F.min(F.struct(draw.alias("draw"), "id", short)).alias("x")).select("lang", "x.*")
    if not sizes:
        return fit([])
    rows = [(r.text, r.lang) for r in drawn.collect()]
    have = {lang for _, lang in rows}
    rows += [(r.text, r.lang) for r in first.where(~F.col("lang").isin(sorted(have))).collect()] if len(have) < len(sizes) else []
    model = fit(sorted(rows))
    give_back()  # else the driver keeps what learning held for the rest of the application
    return model


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, lang_pred, score, n_words of every row."""
    import pyarrow as pa

    def run(batches):
        try:
            yield from identified(batches)
        finally:
            model.forget()
            give_back()

    def identified(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch, "text"):
                lang, score, n = zip(*model.predict(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("held_out").slice(a, b - a), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64())],
                    names=["id", "held_out", "lang_pred", "score", "n_words"])

    kind = dict(df.dtypes)[key]
    src = df.select(F.col(key).alias("id"), F.coalesce(remainder(key) == 2, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double, n_words long").withColumnRenamed("id", key)


def keep_known(df: DataFrame, model: Model, least: float = 0.0, text: str = "text") -> DataFrame:
    """Rows of ``df``, all columns, whose text has a letter and a language with at least ``least`` mean probability."""
    import pyarrow as pa

    def run(batches):
        try:
            yield from known(batches)
        finally:
            model.forget()
            give_back()

    def known(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch, text):
                good = [lang != UNDETERMINED and score >= least for lang, score, _ in model.predict(texts)]
                yield batch.slice(a, b - a).filter(pa.array(good, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, held_out, lang_pred, score, n_words."""
    docs = read(spark, sf_dir, "documents")
    return identify(docs, learn(docs))


QUERIES = {"op10_language_crf": op10_language_crf}
