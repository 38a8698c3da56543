"""Toxicity by a convolutional text classifier, trained in NumPy.

A word is the sum of hashed embeddings of itself and of its beginnings; filters of several
widths run over the words of the whole text, each keeps its maximum, and a logistic layer weighs the maxima. Trained by
Adam on labelled rows outside the held-out fold: at most ``SAMPLE`` rows, half of them toxic where there are enough,
picked by a hash of the id. This bound is a parameter; scoring reads every text.

Thresholds are calibrated by language on all labelled rows of the training folds that are not fitted on, scored by Spark
and counted by language, label and log-odds in steps of 1/64. The fit prefers toxic rows, so the counts of each label are weighed up to all
its rows. The language is guessed from function words
of the text itself, so that no column but the text is an input of a score; log-odds are shifted by the language's
threshold so that a score of 0.7 or more always means toxic. A language with few examples uses the common threshold,
and even odds if there are few examples in all.

A text's score depends on that text alone: windows end with it, and places beyond it count as empty words. A null or empty
text gets the score of no words; a very long one is scored whole. An empty table gives no rows. Without labels of both kinds every score is the base rate of the
labels (0 without any). Repeated rows get equal scores; other columns are ignored or carried.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from telemetry_ops.llm.common import by_size, fold, map_texts, slices

THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
SAMPLE = 3000  # labelled rows the classifier is fitted on, at most
BUCKETS = 1 << 15
DIMS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
EPOCHS = 8
LEAST_STEPS = 120  # few rows are passed over more often
LEAST_DOCS = 3  # training rows that must share a bucket, else its embedding stays zero
LONGEST_START = 8  # bytes of a word's longest beginning that has an embedding
BATCH = 64
RATE = 0.02
SPREAD = 0.02  # of the first embeddings: a word never trained on adds next to nothing
LEAST_PER_LANGUAGE = 20  # toxic rows needed for a threshold of its own
CACHED_WORDS = 150_000
PROJECTED = 4096  # words whose projections are made at a time
STEPS = 64  # of log-odds, in which rows are counted for thresholds
# fixed values: frequent function words that tell the languages apart
FUNCTION_WORDS = {
    "en": "the of and to in that is for it was with as by are this".split(),
    "de": "der die und das den von zu mit sich des auf ist nicht ein".split(),
    "fr": "le les et des une du est que dans pour qui au sur par".split(),
    "es": "el los las y del que una se con para por su como no".split(),
}
LANGUAGES = tuple(FUNCTION_WORDS)
_LANGUAGE_OF = {}
for _i, _words in enumerate(FUNCTION_WORDS.values()):
    for _w in _words:
        _LANGUAGE_OF.setdefault(_w.encode(), set()).add(_i)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def features(word: bytes) -> list[int]:
    """Buckets of a word: itself without punctuation, and its beginnings."""
    core = word.strip(b".,;:!?|()\"'")
    start = zlib.crc32(b"w" + core)
    return [start % BUCKETS, *(zlib.crc32(core[:n]) % BUCKETS for n in range(3, min(len(core), LONGEST_START) + 1))]


def language(words: list[bytes]) -> int:
    """Index into ``LANGUAGES`` of the language with most function words, the first of equals."""
    votes = [0] * len(LANGUAGES)
    for w in words:
        for i in _LANGUAGE_OF.get(w, ()):
            votes[i] += 1
    return votes.index(max(votes))


@dataclass
class Model:
    embed: np.ndarray  # buckets x dims
    kernel: list  # per width: (width, dims, filters)
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    shift: np.ndarray  # log-odds added per language

    def projections(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to each filter at each place inside it: words x (sum of widths * filters)."""
        feats = [features(w) for w in words]
        sizes = np.fromiter(map(len, feats), np.int64, len(feats))
        flat = np.fromiter((f for fs in feats for f in fs), np.int64, int(sizes.sum()))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        vectors = np.add.reduceat(self.embed[flat], starts, axis=0)
        matrix = np.concatenate([k.transpose(1, 0, 2).reshape(DIMS, -1) for k in self.kernel], axis=1)
        return vectors @ matrix


def _logit(p):
    return np.log(p) - np.log1p(-p)


def _windows(ids: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each place of a window, the word there for every start; ``ids`` has a run of empty words after every document.

    A window that starts on an empty word holds nothing else, so none reaches into the next document.
    """
    blank = np.zeros(len(ids), bool)
    ends = np.append(starts[1:], len(ids))
    for k in range(1, max(WIDTHS)):
        blank[ends - k] = True
    out = [ids]
    for j in range(1, max(WIDTHS)):
        out.append(np.where(blank, 0, np.append(ids[j:], np.zeros(j, ids.dtype))))
    return out


def _pooled(projected: np.ndarray, ids: np.ndarray, starts: np.ndarray):
    """Maxima of every filter over each document; ``ids`` has a run of empty words after every document."""
    out, column, words = [], 0, _windows(ids, starts)
    for width in WIDTHS:
        total = projected[ids, column:column + FILTERS].copy()
        for j in range(1, width):
            column += FILTERS
            total += projected[words[j], column:column + FILTERS]
        column += FILTERS
        out.append(np.maximum.reduceat(total, starts, axis=0))
    return np.concatenate(out, axis=1)


class Scorer:
    """Applies a model to slices of texts, remembering the projections of words."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self):
        self.index: dict[bytes, int] = {}
        self.table = np.zeros((1 << 14, sum(WIDTHS) * FILTERS), np.float32)  # row 0: the empty word

    def _remember(self, words: list[bytes]) -> None:
        """Projections of new words, a few at a time, into a table that doubles when it is full."""
        at = len(self.index) + 1
        self.index.update(zip(words, range(at, at + len(words))))
        if at + len(words) > len(self.table):
            table = np.zeros((max(2 * len(self.table), at + len(words)), self.table.shape[1]), np.float32)
            table[:at] = self.table[:at]
            self.table = table
        for i in range(0, len(words), PROJECTED):
            part = words[i:i + PROJECTED]
            self.table[at + i:at + i + len(part)] = self.model.projections(part)

    def odds(self, texts: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """Log-odds before the shift, and the languages."""
        if len(self.index) > CACHED_WORDS:
            self._forget()
        cut = [words_of(t) for t in texts]
        missing = list(set().union(*cut).difference(self.index))
        if missing:
            self._remember(missing)
        pad = max(WIDTHS) - 1 or 1
        sizes = np.fromiter(map(len, cut), np.int64, len(cut)) + pad
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        ids = np.zeros(int(sizes.sum()), np.int64)
        for start, words in zip(starts.tolist(), cut):
            ids[start:start + len(words)] = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        m = self.model
        hidden = np.maximum(_pooled(self.table, ids, starts) + m.bias, 0)
        return hidden @ m.weight + m.offset, [language(w) for w in cut]

    def scores(self, texts: list[bytes]) -> list[float]:
        odds, spoken = self.odds(texts)
        odds = odds + self.model.shift[spoken]
        return (1 / (1 + np.exp(-np.clip(odds, -30, 30)))).tolist()


def _constant(p: float) -> Model:
    p = min(max(p, 0.0), 1 - 1e-9)
    odds = float(_logit(p)) if p > 0 else -30.0
    return Model(np.zeros((BUCKETS, DIMS)), [np.zeros((w, DIMS, FILTERS)) for w in WIDTHS],
                 np.zeros(len(WIDTHS) * FILTERS), np.zeros(len(WIDTHS) * FILTERS), odds, np.zeros(len(LANGUAGES)))


def _kept_out(y: np.ndarray) -> np.ndarray:
    """Every fifth row, or none if that leaves a side without rows of both labels."""
    kept_out = np.arange(len(y)) % 5 == 4
    if len(set(y[~kept_out])) < 2 or len(set(y[kept_out])) < 2:
        kept_out[:] = False
    return kept_out


def fit(texts: list[bytes], labels: list[int], seed: int = 7) -> Model:
    """Train on rows; every fifth is kept out of the fit to choose thresholds."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return _constant(float(y.mean()) if len(y) else 0.0)
    cut = [words_of(t) for t in texts]
    vocabulary = {w: i + 1 for i, w in enumerate(sorted(set().union(*cut)))}
    feats = [[]] + [features(w) for w in vocabulary]
    docs = [np.array([vocabulary[w] for w in c] + [0] * (max(WIDTHS) - 1), np.int64) for c in cut]
    sizes = np.array([len(f) for f in feats])
    flat = np.array([f for fs in feats for f in fs], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    rng = np.random.default_rng(seed)
    kept_out = _kept_out(y)
    model = Model(rng.normal(0, SPREAD, (BUCKETS, DIMS)),
                  [rng.normal(0, 0.5 / np.sqrt(w), (w, DIMS, FILTERS)) for w in WIDTHS],
                  np.zeros(len(WIDTHS) * FILTERS), rng.normal(0, 0.3, len(WIDTHS) * FILTERS), 0.0,
                  np.zeros(len(LANGUAGES)))
    shared = np.zeros(BUCKETS, np.int64)
    for i in np.flatnonzero(~kept_out).tolist():
        shared[np.unique(np.concatenate([feats[j] for j in np.unique(docs[i])]).astype(np.int64))] += 1
    usable = (shared >= LEAST_DOCS)[:, None]
    model.embed *= usable
    params = {"embed": model.embed, "bias": model.bias, "weight": model.weight, "offset": np.zeros(1),
              **{f"k{w}": k for w, k in zip(WIDTHS, model.kernel)}}
    first_m = {n: np.zeros_like(p) for n, p in params.items()}
    second_m = {n: np.zeros_like(p) for n, p in params.items()}
    train, t = np.flatnonzero(~kept_out), 0
    weights = np.where(y == 1, 0.5 / max(y[train].mean(), 1e-6), 0.5 / max(1 - y[train].mean(), 1e-6))

    def vectors(ids):
        spots = np.concatenate([np.arange(first[i], first[i + 1]) for i in ids.tolist()] or [np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(ids)), sizes[ids])
        out = np.zeros((len(ids), DIMS))
        np.add.at(out, owner, params["embed"][flat[spots]])
        return out, flat[spots], owner

    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(train)))):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            rows = train[at:at + BATCH]
            ids = np.concatenate([docs[i] for i in rows])
            lengths = np.array([len(docs[i]) for i in rows])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            distinct = np.unique(ids)  # holds the empty word
            words = [np.searchsorted(distinct, x) for x in _windows(ids, starts)]
            vecs, buckets, owner = vectors(distinct)
            maxima, where = [], []
            for w in WIDTHS:
                total = np.zeros((len(ids), FILTERS))
                for j in range(w):
                    total += (vecs @ params[f"k{w}"][j])[words[j]]
                top = np.maximum.reduceat(total, starts, axis=0)
                spot = np.stack([total[s:s + n].argmax(0) + s for s, n in zip(starts, lengths)])
                maxima.append(top)
                where.append(spot)
            pre = np.concatenate(maxima, 1) + params["bias"]
            hidden = np.maximum(pre, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ params["weight"] + params["offset"], -30, 30)))
            d = (p - y[rows]) * weights[rows] / len(rows)
            grads = {"weight": hidden.T @ d + 1e-4 * params["weight"], "offset": np.array([d.sum()])}
            d_pre = np.outer(d, params["weight"]) * (pre > 0)
            grads["bias"] = d_pre.sum(0)
            d_vec = np.zeros_like(vecs)
            for n, w in enumerate(WIDTHS):
                part = d_pre[:, n * FILTERS:(n + 1) * FILTERS]
                kernel = params[f"k{w}"]
                grad = np.zeros_like(kernel)
                for j in range(w):
                    word = words[j][where[n]]
                    grad[j] = np.einsum("bf,bfd->df", part, vecs[word])
                    np.add.at(d_vec, word.ravel(), (part[:, :, None] * kernel[j].T[None]).reshape(-1, DIMS))
                grads[f"k{w}"] = grad
            touched = np.abs(d_vec).sum(1) > 0
            use = touched[owner]
            g_embed = np.zeros_like(params["embed"])
            np.add.at(g_embed, buckets[use], d_vec[owner[use]])
            grads["embed"] = g_embed * usable
            t += 1
            for n, g in grads.items():
                first_m[n] = 0.9 * first_m[n] + 0.1 * g
                second_m[n] = 0.99 * second_m[n] + 0.01 * g * g
                params[n] -= RATE * (first_m[n] / (1 - 0.9 ** t)) / (np.sqrt(second_m[n] / (1 - 0.99 ** t)) + 1e-8)
    model.offset = float(params["offset"][0])
    held = np.flatnonzero(kept_out)
    if not len(held):
        held = np.arange(len(y))
    scorer = Scorer(model)
    raw = np.concatenate([scorer.scores([texts[i] for i in held[a:a + 512]]) for a in range(0, len(held), 512)])
    odds = _logit(np.clip(raw, 1e-12, 1 - 1e-12))
    spoken = np.array([language(cut[i]) for i in held])
    model.shift = _shifts(odds, spoken, y[held], 1 - y[held], y[held])
    return model


def _shifts(odds: np.ndarray, spoken: np.ndarray, toxic: np.ndarray, clean_: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Shifts by language from weighed counts of toxic and clean rows at each of ``odds``; ``rows`` counts toxic ones."""
    common = _threshold(odds, toxic, clean_) if rows.sum() >= LEAST_PER_LANGUAGE else 0.0
    out = np.zeros(len(LANGUAGES))
    for n in range(len(LANGUAGES)):
        own = spoken == n
        enough = rows[own].sum() >= LEAST_PER_LANGUAGE
        out[n] = _logit(THRESHOLD) - (_threshold(odds[own], toxic[own], clean_[own]) if enough else common)
    return out


def _threshold(odds: np.ndarray, toxic: np.ndarray, clean_: np.ndarray) -> float:
    """The log-odds between two neighbouring values that give the best F1, in the middle of the widest best gap."""
    values, at = np.unique(-odds, return_inverse=True)
    odds = -values
    toxic, clean_ = np.bincount(at, toxic), np.bincount(at, clean_)
    f1 = 2 * np.cumsum(toxic) / (np.cumsum(toxic + clean_) + toxic.sum())
    next_ = np.append(odds[1:], odds[-1] - 2.0)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    i = best[np.argmax(odds[best] - next_[best])]
    return float((odds[i] + next_[i]) / 2)


def _calibrated(model: Model, docs: DataFrame, marked: DataFrame, rows: list, text: str, key: str) -> Model:
    """``model`` with thresholds from all labelled rows (k, y) but those of ``rows`` it was fitted on."""
    y = np.array([r["y"] for r in rows])
    if len(set(y.tolist())) < 2:
        return model
    kept_out = _kept_out(y)
    # as an Arrow table: a list of rows would start a second pool of Python workers, which stays beside the first
    fitted = pa.table({"k": [r["k"] for r, out in zip(rows, kept_out) if not out]})
    known = docs.sparkSession.createDataFrame(fitted, T.StructType([marked.schema["k"]]))
    rest = by_size(marked.join(F.broadcast(known), "k", "left_anti").select("k", "y"))
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(rest, "k")

    def make():
        scorer = Scorer(model)

        def work(texts):
            odds, spoken = scorer.odds(texts)
            return {"step": np.floor(np.clip(odds, -30, 30) * STEPS).astype(np.int64), "spoken": spoken}
        return work

    steps = map_texts(source, "t", ["k", "y"], [("step", T.LongType()), ("spoken", T.LongType())], make)
    once = steps.groupBy("k", "y").agg(F.min(F.struct("step", "spoken")).alias("x"))
    counts = once.groupBy("y", "x.step", "x.spoken").agg(F.count(F.lit(1)).alias("n")).collect()  # steps x languages x 2
    label, step, spoken, n = np.array([tuple(r) for r in counts], np.int64).reshape(-1, 4).T
    if len(set(label.tolist())) < 2:
        return model  # as calibrated on the sample
    weight = [1 + (y[~kept_out] == v).sum() / n[label == v].sum() for v in (0, 1)]
    toxic = np.where(label == 1, n, 0)
    model.shift = _shifts((step + 0.5) / STEPS, spoken, toxic * weight[1], np.where(label == 0, n, 0) * weight[0], toxic)
    return model


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out fold, half of them toxic where there are enough;
    thresholds are from all others."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(
        F.max(label).cast("int").alias("y"))
    marked = marked.where(fold(F.col("k"), FOLDS) != HELD_OUT).withColumn("h", F.xxhash64("k"))
    half = sample // 2
    picked = marked.where("y = 1").orderBy("h", "k").limit(half).unionByName(
        marked.where("y = 0").orderBy("h", "k").limit(sample - half))
    rows = (docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
            .join(F.broadcast(picked), "k").groupBy("h", "k", "y").agg(F.min("t").alias("t")).collect())  # at most ``sample``
    rows.sort(key=lambda r: (r["h"], r["k"]))
    model = fit([bytes(r["t"]) for r in rows], [r["y"] for r in rows])
    return _calibrated(model, docs, marked, rows, text, key)


def score(docs: DataFrame, model: Model, text: str = "text", keys: list[str] | None = None) -> DataFrame:
    """``keys`` and ``score`` of every whole text."""
    def make():
        scorer = Scorer(model)
        return lambda texts: {"score": scorer.scores(texts)}

    return map_texts(docs, text, keys or ["doc_id"], [("score", T.DoubleType())], make)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, ``held_out``, ``score``, ``predicted``."""
    scored = score(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), train(docs, labels, text, key), "t", ["k"])
    return scored.select(F.col("k").alias(key), (fold(F.col("k"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, labelled: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, by a model fitted on ``labelled`` documents."""
    model, at = train(labelled, labels, text, key), docs.columns.index(text)

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:  # a text goes to Python once, in its row
            for part in slices(batch, at, 512, 4 << 20):
                texts = [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]
                yield part.filter(pa.array(np.array(scorer.scores(texts)) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
