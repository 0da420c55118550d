"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of its subwords (byte n-grams of its
words, with word boundaries), hashed to a fixed number of buckets; a linear
softmax gives the languages. The model is trained by stochastic gradient
descent in numpy on a bounded sample of labelled documents, whose features
are extracted by Spark tasks. The trained model is one small table, so
prediction is one pass over the documents without a shuffle.

A part of the sample is set aside to calibrate: a temperature for the scores,
and the rejection. The softmax has to prefer some language, so a text is rejected
for being *unfamiliar*: by the mean over its subwords of the highest log share
that any language gives them, measured in standard deviations below that of
known texts (which shrink with the text's length). The limit is fitted
on rows of both kinds: known are the calibration texts and mixtures of two
languages; unknown are texts of each language under the shares of the
others, and texts with their letters shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import id_and_text, release_memory

BUCKETS = 1 << 14
ORDERS = (2, 3, 4)
UNKNOWN = "und"
#: Bound of the training sample: documents drawn per language, and in all (at least one per
#: language). A document's features take at most 6 bytes a bucket, 96 KB.
SAMPLE_PER_LANGUAGE, SAMPLE = 800, 4096
#: Characters whose subwords are looked up at a time.
_STRETCH = 500_000

# bytes that are no part of a word: ASCII but letters; capitals are lowered before
_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def _subwords(raw: np.ndarray):
    """Per order: (positions of the n-grams that lie in one word or reach over its ends, buckets)."""
    blank = raw == 0x20
    wide = raw.astype(np.uint32)
    for n in ORDERS:
        size = len(raw) - n + 1
        if size <= 0:
            continue
        code = wide[:size].copy()
        keep = ~(blank[:size] & blank[n - 1:n - 1 + size])
        for k in range(1, n):
            code = code * np.uint32(0x01000193) ^ wide[k:k + size]
            if k < n - 1:
                keep &= ~blank[k:k + size]
        code = code * np.uint32(0x9E3779B1) + np.uint32(n)
        code ^= code >> np.uint32(15)
        at = np.flatnonzero(keep)
        yield at, (code[at] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 14)


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each with a blank at both ends, and their cuts."""
    parts = [b" " + t.lower().encode().translate(_FOLD) + b" " for t in texts]
    cuts = np.cumsum([0, *map(len, parts)])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), cuts


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's subwords and how often each occurs."""
    raw, _ = _folded([text])
    total = np.zeros(BUCKETS, dtype=np.int64)
    for _, bucket in _subwords(raw):
        total += np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used, total[used]


def shuffled(text: str) -> str:
    """The text with its letters in another order; blanks and signs keep their places."""
    at = [k for k, c in enumerate(text) if c.isalpha()]
    out = list(text)
    for k, j in zip(at, np.random.default_rng(len(at)).permutation(len(at)).tolist()):
        out[k] = text[at[j]]
    return "".join(out)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray            # bucket x language: embeddings times the linear layer
    bias: np.ndarray
    temperature: float = 1.0

    known: np.ndarray | None = None      # bucket: highest log share that a language gives it
    usual: tuple = (0.0, 1.0, 0.0)       # mean, variance between texts, variance of a subword
    limit: float = np.inf                # deviations below the mean that are rejected

    def means(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean over each text's subwords of their rows (last column: familiarity), and their number."""
        columns = self.table.shape[1] + 1
        table = np.column_stack((self.table, self.known if self.known is not None else np.zeros(len(self.table))))
        out, numbers = np.zeros((len(texts), columns)), np.zeros(len(texts))
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) < _STRETCH):
                size += len(texts[hi])
                hi += 1
            raw, cuts = _folded(texts[lo:hi])
            total = np.zeros((hi - lo, columns))
            number = np.zeros(hi - lo)
            reach = max(ORDERS) - 1
            for a in range(0, len(raw), _STRETCH):       # a very long text goes through in parts
                for at, bucket in _subwords(raw[a:a + _STRETCH + reach]):
                    own = np.searchsorted(at, _STRETCH)   # n-grams that start in this part
                    doc = np.searchsorted(cuts, at[:own] + a, side="right") - 1
                    sums, count = self._sums(table, doc, bucket[:own], hi - lo)
                    total += sums
                    number += count
            out[lo:hi] = total / np.maximum(number, 1)[:, None]
            numbers[lo:hi] = number
            lo = hi
        return out, numbers

    def logits(self, texts: list[str]) -> np.ndarray:
        return self.means(texts)[0][:, :-1] + self.bias

    def unfamiliar(self, familiarity: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Standard deviations that a text lies below known ones."""
        mean, between, within = self.usual
        return (mean - familiarity) / np.sqrt(between + within / np.maximum(number, 1))

    @staticmethod
    def _sums(table: np.ndarray, doc: np.ndarray, bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        edge = np.searchsorted(doc, np.arange(n + 1))
        total = np.zeros((n, table.shape[1]))
        full = np.flatnonzero(np.diff(edge))
        if len(full):
            total[full] = np.add.reduceat(table[bucket], edge[full], axis=0)
        return total, np.diff(edge)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, calibrated probability, whether rejected) of each text."""
        mean, number = self.means(texts)
        z = (mean[:, :-1] + self.bias) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return ([self.langs[k] for k in p.argmax(axis=1)], p.max(axis=1),
                self.unfamiliar(mean[:, -1], number) > self.limit)


def held_out(id_col: str = "doc_id"):
    """Documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int):
    """Features of a bounded, repeatable sample of the labelled documents.

    Each language gives about ``per_language`` documents, those with the
    smallest hash of the id; the cut is set from the language's count.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col)
                      & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = rows.groupBy("lang").count().collect()               # one row a language
    if not sizes:
        return []
    per_language = max(1, min(per_language, SAMPLE // len(sizes)))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).cast("double") / float(1 << 30)
    cut = F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], per_language / r["count"])]),
                       F.col("lang"))
    drawn = rows.where(draw < cut).withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(5)))

    def run(batches):
        for batch in batches:
            out = {"lang": [], "calibrate": [], "bucket": [], "n": [], "draw": []}
            for text, lang, draw in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                # of a text that calibrates, the letters are also taken in a shuffled order
                for kind, t in ((lang, text), *([(None, shuffled(text))] if draw == 0 else [])):
                    bucket, n = counts(t)
                    out["lang"].append(kind)
                    out["draw"].append(draw)
                    out["calibrate"].append(draw == 0)
                    out["bucket"].append(bucket.astype(np.uint16).tobytes())
                    out["n"].append(n.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("lang", pa.string()), ("calibrate", pa.bool_()), ("bucket", pa.binary()), ("n", pa.binary()),
                 ("draw", pa.int64())]))

    got = drawn.mapInArrow(run, "lang string, calibrate boolean, bucket binary, n binary, draw long").collect()
    got.sort(key=lambda r: (r["lang"] or "", r["bucket"], r["n"]))      # one order whatever the partitions
    return got


def train(examples, dim: int = 16, epochs: int = 6, rate: float = 0.6, seed: int = 11,
          reject_share: float = 0.002) -> Model | None:
    """Fit by SGD; about ``reject_share`` of known texts may be rejected."""
    langs = sorted({r["lang"] for r in examples if r["lang"] is not None})
    if not langs:
        return None
    number = {x: k for k, x in enumerate(langs)} | {None: -1}
    # views of the packed features; a document's are widened only while it is used
    data = [(np.frombuffer(r["bucket"], np.uint16), np.frombuffer(r["n"], np.uint32),
             number[r["lang"]], r["calibrate"]) for r in examples if len(r["bucket"])]
    wide = lambda d: (d[0].astype(np.int64), d[1] / d[1].sum(dtype=np.float64))
    foreign = [d for d in data if d[2] < 0]
    data = [d for d in data if d[2] >= 0]
    fit = [d for d in data if not d[3]] or data
    hold = [d for d in data if d[3]] or data
    rnd = np.random.default_rng(seed)
    emb = rnd.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    out = np.zeros((dim, len(langs)))
    bias = np.zeros(len(langs))
    steps, done = epochs * max(1, len(fit)), 0
    for _ in range(epochs):
        for k in rnd.permutation(len(fit)).tolist():
            (bucket, share), y = wide(fit[k]), fit[k][2]
            step = rate * (1 - done / steps)
            done += 1
            x = share @ emb[bucket]
            z = x @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= step * np.outer(x, p)
            bias -= 0.1 * step * p
            # shares are small: rescaled so that a document moves its subwords as a whole
            emb[bucket] -= step * np.outer(share * min(len(bucket), 400), back)
    model = Model(langs, (emb @ out).astype(np.float32), bias)
    if hold:
        z = np.stack([share @ model.table[bucket] + bias for bucket, share in map(wide, hold)])
        y = np.array([d[2] for d in hold])

        def loss(t: float) -> float:
            v = z / t
            v = v - v.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(v).sum(axis=1)) - v[np.arange(len(y)), y]))

        model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
        _calibrate_rejection(model, fit, hold, foreign, reject_share)
    return model


def _calibrate_rejection(model: Model, fit, hold, foreign, reject_share: float) -> None:
    total = np.zeros((len(model.langs), BUCKETS))
    for bucket, n, y, _ in fit:
        total[y, bucket] += n
    share = np.log((total + 0.5) / (total.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    model.known = share.max(axis=0).astype(np.float32)

    def familiarity(docs, known):
        """(mean of ``known`` over the subwords, their number) of packed documents."""
        n = np.array([d[1].sum(dtype=np.float64) for d in docs])
        return np.array([d[1] @ known[d[0]].astype(np.float64) for d in docs]) / n, n

    own, n = familiarity(hold, model.known)
    mean = float(np.average(own, weights=np.minimum(n, 500)))
    whole = total.sum(axis=0)
    # neighbouring n-grams overlap: a text has fewer independent subwords than it has subwords
    within = float(len(ORDERS) * np.average((model.known - mean) ** 2, weights=np.maximum(whole, 1e-9)))
    long = own[n >= np.median(n)]
    model.usual = (mean, float(np.var(long)) + 1e-6, within)
    # two languages in one text, half and half
    mixed = [(a, b) for a, b in zip(hold, hold[len(hold) // 2:] + hold[:len(hold) // 2]) if a[2] != b[2]]
    known = [model.unfamiliar(own, n)]
    if mixed:
        (fa, na), (fb, nb) = (familiarity([m[k] for m in mixed], model.known) for k in (0, 1))
        known.append(model.unfamiliar((fa * na + fb * nb) / (na + nb), na + nb))
    unknown = []
    if foreign:
        unknown.append(model.unfamiliar(*familiarity(foreign, model.known)))
    for k in range(len(model.langs)):                   # each language as the others see it
        left = [d for d in hold if d[2] == k]
        if left and len(model.langs) > 1:
            others = np.delete(share, k, axis=0).max(axis=0)
            unknown.append(model.unfamiliar(*familiarity(left, others)))
    low = float(np.quantile(np.concatenate(known), 1 - reject_share))
    high = float(np.quantile(np.concatenate(unknown), 0.05)) if unknown else low
    # between the two kinds where they lie apart; else known texts decide
    model.limit = (low + high) / 2 if high > low else low


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Train on labelled documents outside the held-out part; None if there are none."""
    return train(sample(docs, id_col, text_col, lang_col, per_language))


def _has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text)) if text else False


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
            keep_columns: bool = False) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` from whole texts.

    Texts that are null or have no letter get ``und``, score 0 and are
    rejected; so is every text if nothing could be learned. Others get the
    likeliest learned language and its calibrated probability, and are
    rejected if their subwords are too unfamiliar to be of a learned language. Only the text is an
    input. Repeated rows and ids give a row each. With ``keep_columns`` the
    rows that are not rejected come back with exactly the input's columns.
    A very long text is read whole, by one task; nothing is cut off.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index(text_col) if keep_columns else 1
    source = docs if keep_columns else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        model = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts = part.column(text_at).to_pylist()
                known = [k for k, t in enumerate(texts) if model is not None and _has_letter(t)]
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                low = np.ones(len(texts), dtype=bool)
                if known:
                    names, p, rejected = model.predict([texts[k] for k in known])
                    score[known], low[known] = p, rejected
                    for k, name in zip(known, names):
                        lang[k] = name
                if keep_columns:
                    yield part.filter(pa.array(~low))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(lang), pa.array(score), pa.array(low)],
                        names=["doc_id", "lang_pred", "score", "rejected"])
        release_memory()

    if keep_columns:
        return source.mapInArrow(run, docs.schema)
    return source.mapInArrow(run, T.StructType([
        source.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]))
