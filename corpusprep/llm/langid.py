"""Language identification: averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

A text is the average of the embeddings of its subwords: each run of letters, with marks for its two
ends, as a whole and as all its character n-grams, hashed into a fixed number of rows. A softmax over
that average gives the language. Rows and softmax are trained together by stochastic gradient descent in
numpy, on a bounded sample of labelled rows; a part of the sample is kept out to set the softmax's
temperature and the limit of rejection. A trained model is three small arrays of fixed size, whatever the data.

A softmax is as sure of texts in languages that it never saw as of others, so that its score cannot reject them.
What can is how familiar a text's subwords are in the language it is taken for: their mean log frequency there,
as a deviation from that of kept-out texts, in units of what texts of that length deviate. The limit is
calibrated by leaving out one label at a time: models of the other labels show how far texts of an unlearned
language deviate, and the limit is put between them and the kept-out texts of learned ones, beyond two and a half
times what the latter ever deviate, so that clean texts stay, those with passages in another language too.

Since averages and softmax are linear up to the exponent, what a word adds is looked up once per word and task;
prediction reads whole texts.

Defined results: a text that is null or has no letter is ``und`` with score 0, and rejected. Without
any labelled row there is no language to learn, and every text is ``und``. Rows with a null label are
never learned from. Repeated rows count as often as they occur; rows that share an id, or have none, are sampled by
their texts. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import BASES, powers, slices

BUCKETS = 1 << 16
DIMENSION = 8
NGRAMS = (2, 3, 4)
UNKNOWN = "und"
#: Bound of the sample that is learned from: rows in all, shared evenly between the labels.
SAMPLE_ROWS = 1200
#: How much farther than any kept-out text a text must deviate to be rejected.
MARGIN = 2.5
#: Subwords of an average text's worth of evidence, in the mean familiarity of a language.
_EVIDENCE = 50

_BASE = np.uint64(BASES[0])


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def features(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of the word) of all subwords of white-space separated words.

    What is no letter is a mark; n-grams may begin or end with a mark, with letters only in between.
    """
    code = np.frombuffer(f" {' '.join(words)} ".lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[code]
    word = np.cumsum(code == 32) - 1
    code = np.where(letter, code, 0).astype(np.uint64) + np.uint64(1)
    found, owner = [], []
    for n in NGRAMS:
        size = len(code) - n + 1
        if size < 1:
            continue
        good = letter[:size] | letter[1 : size + 1] if n == 2 else np.ones(size, bool)
        h = np.full(size, n, np.uint64)
        for k in range(n):
            h = h * _BASE + code[k : k + size]
            if n > 2 and 0 < k < n - 1:
                good &= letter[k : k + size]
        at = np.flatnonzero(good)
        found.append(_bucket(h[at], buckets))
        owner.append(word[np.where(letter[at], at, at + 1)])
    # Whole runs, by the difference of running sums.
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    if len(starts):
        power, inverse = powers(0, len(code) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * power[: len(code)], dtype=np.uint64)])
        h = (total[ends] - total[starts]) * inverse[starts]
        found.append(_bucket(h, buckets))
        owner.append(word[starts])
    return np.concatenate(found), np.concatenate(owner)


@dataclass
class Model:
    """``scores``: what one subword adds to each language, by bucket; ``bias`` and temperature. ``familiar``: the log
    frequency of a subword in each language, and its ``usual`` mean over a text; ``spread``: variance of that mean per
    subword, and between texts; ``limit``: the least deviation, in those units, of a text that is not rejected."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    familiar: np.ndarray | None = None
    usual: np.ndarray | None = None
    spread: tuple[float, float] = (1.0, 1.0)
    limit: float = -np.inf

    def probabilities(self, total: np.ndarray, count: int) -> np.ndarray:
        z = (total / count + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def deviation(self, language: int, total: float, count: int) -> float:
        """How unfamiliar subwords of that total log frequency are in a language: about 0 for its texts, less for others."""
        return float((total / count - self.usual[language]) / np.sqrt(self.spread[0] / count + self.spread[1]))


class WordScores:
    """What each word of a text adds, kept by word; emptied when full, so that memory is bounded."""

    def __init__(self, model: Model, entries: int = 300_000, longest: int = 48):
        self.model, self.longest = model, longest
        self.table = np.concatenate([model.scores, model.familiar], 1) if model.languages else model.scores
        self.sums = np.zeros((entries, self.table.shape[1] + 1))
        self.place: dict[str, int] = {}

    def _sums(self, words: list[str]) -> np.ndarray:
        found, owner = features(words, len(self.table))
        scores = self.table[found]
        columns = [np.bincount(owner, scores[:, k], len(words)) for k in range(scores.shape[1])]
        return np.stack([*columns, np.bincount(owner, minlength=len(words))], 1)

    def learn(self, words: set[str]) -> None:
        """Make sure that all these words are known, for as many as there is room."""
        new = [w for w in words if w not in self.place and len(w) <= self.longest]
        if len(self.place) + len(new) > len(self.sums):
            self.place.clear()
            new = [w for w in words if len(w) <= self.longest][: len(self.sums)]
        for start in range(0, len(new), 16_384):
            part, at = new[start : start + 16_384], len(self.place)
            self.sums[at : at + len(part)] = self._sums(part)
            self.place.update(zip(part, range(at, at + len(part))))

    def total(self, text: str) -> np.ndarray:
        """Sums over all words of the text: scores and log frequencies by language, and the number of subwords."""
        out, place = np.zeros(self.sums.shape[1]), self.place
        words = text.split()
        for start in range(0, len(words), 65_536):
            part = words[start : start + 65_536]
            try:
                at = [place[w] for w in part]
            except KeyError:
                self.learn(set(part))
                at = [place[w] for w in part if w in place]
                if len(at) < len(part):
                    for w in part:
                        if w not in place:
                            out += self._sums([w])[0]
            out += self.sums[at].sum(0)
        return out

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)"""
        total = self.total(text) if text else None
        if total is None or not total[-1] or not self.model.languages:
            return UNKNOWN, 0.0, True
        count, n = int(total[-1]), len(self.model.languages)
        p = self.model.probabilities(total[:n], count)
        best = int(p.argmax())
        return self.model.languages[best], float(p[best]), self.model.deviation(best, total[n + best], count) < self.model.limit

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        found = []
        for start in range(0, len(texts), 256):
            part = texts[start : start + 256]
            self.learn({w for text in part if text for w in text.split()})
            found.extend(self.predict(text) for text in part)
        return found


def sample(docs: DataFrame, learn_from: Column, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, lang) of at most ``rows`` labelled rows, about as many of each label, chosen by a hash of id and text.

    Each label is cut on its own, so that many rows of one leave room for the others.
    """
    labelled = docs.filter(learn_from & F.col(lang_col).isNotNull()).select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(rows).collect()}
    if not counts:
        return labelled.select("h", "text", "lang").limit(0)
    share = rows / len(counts)
    rate = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, share / n))))
    unit = F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.filter(unit < F.element_at(rate, F.col("lang")))
    # Rows alike in id and text have one hash: as many as they are, no more than the label's share of them is taken.
    at = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return chosen.withColumn("_at", at).filter(F.col("_at") <= max(1, int(share))).select("h", "text", "lang").orderBy("h", "lang", "text").limit(rows)


def _rows(texts: list[str], langs: list[str], buckets: int) -> list[tuple[np.ndarray, np.ndarray, str]]:
    """(buckets, how often each, label) of the texts that have subwords."""
    rows = []
    for text, lang in zip(texts, langs):
        at, n = np.unique(features((text or "").split(), buckets)[0], return_counts=True)
        if len(at):
            rows.append((at, n, lang))
    return rows


def _learn(rows: list, languages: list[str], buckets: int, dimension: int, epochs: int, rate: float, rng: np.random.Generator) -> Model:
    """Embeddings and softmax by stochastic gradient descent, and the log frequencies of subwords."""
    embedding = rng.uniform(-1 / dimension, 1 / dimension, (buckets, dimension)).astype(np.float32)
    softmax = np.zeros((dimension, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    place = {lang: k for k, lang in enumerate(languages)}
    weights = [(n / n.sum()).astype(np.float32) for _, n, _ in rows]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(rows)):
            at, weight, truth = rows[i][0], weights[i], place[rows[i][2]]
            hidden = weight @ embedding[at]
            z = hidden @ softmax + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[truth] -= 1
            back = softmax @ p
            softmax -= step * np.outer(hidden, p)
            bias -= step * 0.1 * p
            embedding[at] -= (step * len(at) ** 0.5) * weight[:, None] * back
    seen = np.full((buckets, len(languages)), 0.5)
    for at, n, lang in rows:
        seen[at, place[lang]] += n
    return Model(languages, (embedding @ softmax).astype(np.float64), bias.astype(np.float64), familiar=np.log(seen / seen.sum(0)))


def _taken_for(model: Model, rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: the language it is taken for, the mean log frequency of its subwords there, and their number."""
    size = np.array([n.sum() for _, n, _ in rows], np.float64)
    best = np.array([int(((n / n.sum()) @ model.scores[at] + model.bias).argmax()) for at, n, _ in rows], np.int64)
    mean = np.array([n @ model.familiar[at, k] / n.sum() for (at, n, _), k in zip(rows, best)])
    return best, mean, size


def _measure(model: Model, rows: list) -> np.ndarray:
    """Set what is usual, from kept-out rows; returns the deviations of those that are taken for what they are."""
    best, mean, size = _taken_for(model, rows)
    right = np.array([model.languages[k] == lang for k, (_, _, lang) in zip(best, rows)], bool)
    best, mean, size = best[right], mean[right], size[right]
    weight = size / (size + _EVIDENCE)
    total = np.bincount(best, weight, len(model.languages))
    overall = (mean * weight).sum() / max(weight.sum(), 1e-9)
    model.usual = np.where(total > 0, np.bincount(best, mean * weight, len(model.languages)) / np.maximum(total, 1e-9), overall)
    off = mean - model.usual[best]
    long_ = size >= np.median(size) if len(size) else right[:0]
    between = float((off[long_] ** 2).mean()) if long_.any() else 1.0
    per_subword = float((off[~long_] ** 2 * size[~long_]).mean()) if (~long_).any() else between * _EVIDENCE
    model.spread = (max(per_subword, 1e-6), max(between, 1e-6))
    return off / np.sqrt(model.spread[0] / size + model.spread[1])


def train(
    texts: list[str],
    langs: list[str],
    buckets: int = BUCKETS,
    dimension: int = DIMENSION,
    epochs: int = 5,
    rate: float = 0.5,
    kept_out: float = 0.2,
    margin: float = MARGIN,
    seed: int = 7,
) -> Model:
    """Learn from whole texts; the same rows in the same order give the same model."""
    return train_rows(_rows(texts, langs, buckets), buckets, dimension, epochs, rate, kept_out, margin, seed)


def train_rows(
    rows: list[tuple[np.ndarray, np.ndarray, str]],
    buckets: int = BUCKETS,
    dimension: int = DIMENSION,
    epochs: int = 5,
    rate: float = 0.5,
    kept_out: float = 0.2,
    margin: float = MARGIN,
    seed: int = 7,
) -> Model:
    """As :func:`train`, from the buckets of each text's subwords, how often each occurs, and the label."""
    if not rows:
        return Model([], np.zeros((buckets, 0)), np.zeros(0))
    languages = sorted({lang for _, _, lang in rows})
    order = np.random.default_rng(seed).permutation(len(rows))
    kept = [rows[i] for i in order[: int(len(rows) * kept_out)]]
    learned = [rows[i] for i in order[len(kept) :]]
    model = _learn(learned, languages, buckets, dimension, epochs, rate, np.random.default_rng(seed))
    kept = kept or learned
    model.temperature = _temperature(model, kept)
    clean = _measure(model, kept)
    farthest = min(float(clean.min()) if len(clean) else 0.0, -1.0)
    model.limit = margin * farthest
    strangers = []
    for left_out in languages if len(languages) > 2 else ():
        others = [lang for lang in languages if lang != left_out]
        without = _learn([r for r in learned if r[2] != left_out], others, buckets, dimension, epochs, rate, np.random.default_rng(seed))
        known = [r for r in kept if r[2] != left_out]
        if known:
            _measure(without, known)
            best, mean, size = _taken_for(without, [r for r in rows if r[2] == left_out])
            off = (mean - without.usual[best]) / np.sqrt(without.spread[0] / size + without.spread[1])
            strangers.append(off[size >= _EVIDENCE])
    strangers = np.concatenate(strangers) if strangers else np.zeros(0)
    if len(strangers) and np.median(strangers) < model.limit:
        # Halfway, by ratio, to the texts of unlearned languages.
        model.limit = -float(np.sqrt(model.limit * np.median(strangers)))
    return model


def _temperature(model: Model, rows: list) -> float:
    """The temperature of the least log loss; the grid is widened as long as the least is at its end."""
    z = np.array([(n / n.sum()) @ model.scores[at] + model.bias for at, n, _ in rows])
    truth = np.array([model.languages.index(lang) for _, _, lang in rows])

    def loss(temperature: float) -> float:
        scaled = (z - z.max(1, keepdims=True)) / temperature
        own = scaled[np.arange(len(z)), truth] - np.log(np.exp(scaled).sum(1))
        # Without any row that is taken for another language, ever lower temperatures would fit: as if one in a
        # thousand were.
        return float(-np.log(0.999 * np.exp(own) + 0.001 / z.shape[1]).mean()) + 1e-4 * np.log(temperature) ** 2

    low, high = 0.25, 4.0
    while True:
        grid = np.geomspace(low, high, 25)
        best = int(np.argmin([loss(t) for t in grid]))
        if 0 < best < len(grid) - 1 or high / low > 1e6:
            return float(grid[best])
        low, high = (low / 4, high) if best == 0 else (low, high * 4)


def fit(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """A model of a bounded sample of the rows for which ``learn_from`` holds and the label is not null."""

    def counted(batches):
        for batch in batches:
            found = _rows(batch.column("text").to_pylist(), list(zip(batch.column("h").to_pylist(), batch.column("lang").to_pylist())), BUCKETS)
            columns = [[label[0] for *_, label in found], [label[1] for *_, label in found], [at.astype("<i4").tobytes() for at, *_ in found], [n.astype("<i8").tobytes() for _, n, _ in found]]
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["h", "lang", "at", "n"])

    # Texts stay in tasks: the driver gets counts by bucket, of a size that buckets and rows bound.
    sampled = sample(docs, learn_from, id_col, text_col, lang_col, rows)
    found = sampled.mapInArrow(counted, "h long, lang string, at binary, n binary").collect()
    found.sort(key=lambda r: (r["h"], r["lang"], bytes(r["at"])))
    return train_rows([(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["n"], "<i8"), r["lang"]) for r in found])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for every row, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: buckets x languages
    read = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def run(batches):
        words = WordScores(shared.value)
        for batch in slices(batches, "langid"):
            found = list(zip(*words.predict_all(batch.column("text").to_pylist()))) or [(), (), ()]
            columns = [pa.array(values, kind) for values, kind in zip(found, (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "lang_pred", "score", "rejected"])

    return read.mapInArrow(run, "id long, lang_pred string, score double, rejected boolean")


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is not rejected.

    Only the text goes to Python, and one boolean comes back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = WordScores(shared.value)
        for batch in slices((pa.RecordBatch.from_arrays([t], names=["text"]) for t in texts), "langid"):
            found = words.predict_all(batch.column("text").to_pylist())
            yield pa.array([not rejected for _, _, rejected in found], pa.bool_())

    return docs.filter(known(F.col(text_col).cast("string")))
