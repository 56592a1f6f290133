"""Quality classifier by co-training of a text view and a metadata view.

The text view sees which word features a document holds (a word's letters, its trailing marks, runs of a repeated word); the
metadata view sees what is known about the page without reading it: language, source, length and layout (lines, shares of
kinds of characters). Both are logistic models. One pass over all documents marks, for each, which of the candidate features it
holds and its metadata. In each round both views score every marked document, and of the texts a view is confident about a
bounded number, drawn evenly from the whole corpus by hash, joins the other view's training set with the guessed label; the
text view then chooses its features again. At the end each view is calibrated on labelled documents that took no part in
training, a third logistic model combines the two calibrated views, and all documents are scored. Accuracy is reported on
labelled documents that took part in none of this.

A document is good if its label says quality 1 and not toxic. Bounds: ``max_labelled`` labelled documents (those with the least
hashes of their ids; others count as unlabelled), CANDIDATES features, which the labelled training documents hold and whose
classes they tell apart best, and PER_ROUND texts handed over by a view in a round. The driver holds marks of those documents
only. Scoring, and the search for confident documents, cover all documents.

Defined cases: a null or empty text has no word features and is scored by the rest; null or missing metadata columns count
as empty; labels without a document and documents without a label are fine; a label with null quality counts only if it says
toxic; of rows that share an id the one with the least hash of its text is trained on; copies of a text are handed over once;
repeated rows get equal scores; a null id is scored but not trained on; with no usable labels (none, or one class only) every
document gets score 0.5 and is kept; an empty table gives an empty result; extra columns pass through whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import Memo, slices
from tessera.llm.common import drop_staged, map_rows, staged

HASH_BITS = 18
N_FEATURES, CANDIDATES = 512, 2048
ROUNDS = 4
MAX_LABELLED = 4000
#: Texts that a view hands over in a round at most, and the log-odds from which it is confident.
PER_ROUND, SURE = 500, 3.0
#: What a labelled document serves for: of 20 hash values, those for tests and those for calibration; the rest train.
TRAIN, CALIBRATE, TEST = 0, 1, 2
TEST_PARTS, CALIBRATE_PARTS = 3, 5
#: How much more the loss of good documents weighs than that of bad ones kept, and how many may be lost.
GOOD_WEIGHT, MAX_FALSE_REJECTS = 5.0, 0.05
LANG_BUCKETS, SOURCE_BUCKETS = 8, 32
#: Numbers of layout() behind language and source.
LAYOUT = 10
SYMBOLS = frozenset("#*$%&|<>")


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: its letters, beginnings of long ones, and the marks behind or around them."""
    core = "".join(c for c in word if c.isalnum())
    marks = "".join(c for c in word if not c.isalnum())
    low = core.lower()
    found = [f"w{low}"] if core else []
    if len(low) > 6:
        found += [f"p{low[:4]}", f"p{low[:6]}"]
    if marks:
        found.append(f"m{marks[:4]}")
    if len(core) > 3 and core.isupper():
        found.append("shout")
    return tuple(zlib.crc32(f.encode()) >> (32 - HASH_BITS) for f in found)


def special_feature(name: str) -> int:
    return zlib.crc32(f"!{name}".encode()) >> (32 - HASH_BITS)


REPEATS = [special_feature(f"repeat{k}") for k in range(1, 5)]


class TextFeatures:
    """Distinct hashed features of whole texts; words are looked up once per worker."""

    def __init__(self, wanted: np.ndarray | None = None) -> None:
        self.wanted = None if wanted is None else frozenset(wanted.tolist())
        self.memo = Memo(100_000)

    def _make(self, words: list[str]) -> list[tuple[int, ...]]:
        found = map(word_features, words)
        return list(found) if self.wanted is None else [tuple(f for f in fs if f in self.wanted) for fs in found]

    def of(self, texts: list[str]) -> list[set[int]]:
        cut = [t.split() for t in texts]
        get = self.memo.learn(set().union(*cut) if cut else set(), self._make).__getitem__
        out = []
        for words in cut:
            found: set[int] = set()
            for fs in map(get, set(words)):
                if fs:
                    found.update(fs)
            same = sum(map(str.__eq__, words, words[1:]))
            for k, f in enumerate(REPEATS):
                if same * 10 > len(words) * (k + 1):
                    found.add(f)
            out.append(found)
        return out


def layout(text: str, lang: str | None, source: str | None) -> list[float]:
    """Metadata of a page: bucketed language and source, then length and layout."""
    row = [0.0] * (LANG_BUCKETS + SOURCE_BUCKETS)
    row[zlib.crc32((lang or "").encode()) % LANG_BUCKETS] = 1.0
    row[LANG_BUCKETS + zlib.crc32((source or "").encode()) % SOURCE_BUCKETS] = 1.0
    n = max(1, len(text))
    spaces, lines = text.count(" "), text.count("\n") + 1
    data = text.encode()
    upper = len(data) - len(data.translate(None, _UPPER))
    digit = len(data) - len(data.translate(None, _DIGIT))
    symbol = len(data) - len(data.translate(None, _SYMBOL))
    mark = len(data) - len(data.translate(None, _MARK))
    return row + [np.log1p(len(text)), np.log1p(lines), np.log1p(n / lines), spaces / n, upper / n, digit / n, min(1.0, 10 * symbol / n), mark / n, float(upper * 2 > n), float(symbol * 20 > n)]


_UPPER, _DIGIT, _SYMBOL, _MARK = bytes(range(65, 91)), bytes(range(48, 58)), "".join(sorted(SYMBOLS)).encode(), b".,;:!?"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 250) -> np.ndarray:
    """Weights (the last one is the intercept) by accelerated gradient steps on the balanced ridge loss."""
    x1 = np.c_[x, np.ones(len(x))].astype("f4")
    weight = np.where(y > 0.5, 0.5 / max(1e-9, y.mean()), 0.5 / max(1e-9, 1 - y.mean())).astype("f4")
    bound = 0.25 * float((weight[:, None] * x1**2).sum(axis=1).max())
    w = v = np.zeros(x1.shape[1], dtype="f4")
    for k in range(steps):
        grad = x1.T @ (weight * (sigmoid(x1 @ v) - y)) / len(x1)
        grad[:-1] += ridge * v[:-1]
        step = w
        w = (v - grad / (bound + ridge)).astype("f4")
        v = w + np.float32(k / (k + 3)) * (w - step)
    return w.astype("f8")


def platt(score: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept that turn scores into log-odds on held-out labels."""
    w = np.array([1.0, 0.0])
    x = np.c_[score, np.ones(len(score))]
    for _ in range(30):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(h, x.T @ (p - y) + 1e-3 * (w - [1.0, 0.0]))
    return w


@dataclass
class View:
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    calibration: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0]))

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float) -> None:
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.2)  # no rare feature may stretch the steps
        self.weights = logistic((x - self.mean) / self.scale, y, ridge)

    def score(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.score(x) * self.calibration[0] + self.calibration[1]


def held_features(found: Iterable[Iterable[int]], wanted: np.ndarray) -> np.ndarray:
    """A row for each set of features: which of the wanted ones it holds."""
    place = {f: k for k, f in enumerate(wanted.tolist())}
    rows = list(found)
    x = np.zeros((len(rows), len(place)), dtype=bool)
    for r, fs in enumerate(rows):
        x[r, [place[f] for f in fs if f in place]] = True
    return x


@dataclass
class Model:
    """The two calibrated views and their combination; None as features means that nothing could be learned.

    features are the text view's hashed features; chosen are their places among the candidates.
    """

    features: np.ndarray | None = None
    chosen: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype="i8"))
    text: View = field(default_factory=View)
    meta: View = field(default_factory=View)
    mix: np.ndarray = field(default_factory=lambda: np.array([0.5, 0.5, 0.0]))
    threshold: float = 0.5
    held_out_accuracy: float = float("nan")
    held_out_bad_rejected: float = float("nan")
    handed_over: int = 0
    n_candidates: int = 0
    held_out_good_kept: float = float("nan")

    def text_matrix(self, found: Iterable[Iterable[int]]) -> np.ndarray:
        return held_features(found, self.features).astype("f8")

    def combined(self, t: np.ndarray, m: np.ndarray) -> np.ndarray:
        return sigmoid(self.mix[0] * np.clip(t, -12, 12) + self.mix[1] * np.clip(m, -12, 12) + self.mix[2])


def telling(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The columns that differ most between the classes by chi-square, among those set in at least five rows."""
    good, bad = x[y > 0.5].sum(axis=0), x[y < 0.5].sum(axis=0)
    n1, n0 = max(1, int((y > 0.5).sum())), max(1, int((y < 0.5).sum()))
    p = (good + bad) / (n1 + n0)
    chi = (good / n1 - bad / n0) ** 2 / np.maximum(p * (1 - p), 1e-9) * (n1 * n0 / (n1 + n0))
    chi[(good + bad) < 5] = 0
    best = np.argsort(-chi, kind="stable")[:n]
    return np.sort(best[chi[best] > 8])


def reject_limit(p: np.ndarray, y: np.ndarray) -> float:
    """The limit, 0.5 at most, with the greatest share of bad documents rejected less GOOD_WEIGHT times that of good ones.

    A wrong label costs its own share only: a good label on a bad document cannot pull the limit below the bad ones.
    Of all good labels one in 200 is given up in any case (below 0.5), and no more than MAX_FALSE_REJECTS.
    """
    least = min(0.5, float(np.quantile(p[y > 0.5], 0.005)))
    good, bad = np.sort(p[y > 0.5]), np.sort(p[y < 0.5])
    limits = np.unique(np.r_[least, p[(p > least) & (p < 0.5)], 0.5])
    lost, caught = np.searchsorted(good, limits) / len(good), np.searchsorted(bad, limits) / len(bad)
    gain = np.where((lost <= MAX_FALSE_REJECTS) | (limits == least), caught - GOOD_WEIGHT * lost, -np.inf)
    return float(limits[np.argmax(gain)])


@dataclass
class Given:
    """Marks of documents that a view is confident about, with the labels it guesses; keys are hashes of their texts."""

    keys: np.ndarray
    x: np.ndarray
    meta: np.ndarray
    labels: np.ndarray


#: (model, turn, what each view may not be given again, good and bad ones asked for) -> what each view is given
Draw = Callable[[Model, int, dict[str, np.ndarray], tuple[int, int]], dict[str, Given]]


def cotrain(x: np.ndarray, meta: np.ndarray, y: np.ndarray, keys: np.ndarray, role: np.ndarray, candidates: np.ndarray, draw: Draw, rounds: int = ROUNDS) -> Model:
    """Fit on labelled rows (x: which candidates each holds) and on what draw hands over from the unlabelled documents."""
    train, check, test = (np.flatnonzero(role == k) for k in (TRAIN, CALIBRATE, TEST))
    if any(len(set(y[rows].tolist())) < 2 for rows in (train, check)):
        return Model()
    model = Model()
    sets = {name: Given(keys[train], x[train], meta[train], y[train]) for name in ("text", "meta")}
    for turn in range(rounds + 1):
        own = sets["text"]
        model.chosen = telling(own.x, own.labels, N_FEATURES)
        model.features = candidates[model.chosen]
        model.text.fit(own.x[:, model.chosen].astype("f8"), own.labels, 1e-3)
        model.meta.fit(sets["meta"].meta, sets["meta"].labels, 1e-2)
        model.text.calibration = platt(model.text.score(x[check][:, model.chosen]), y[check])
        model.meta.calibration = platt(model.meta.score(meta[check]), y[check])
        if turn == rounds:
            break
        n_bad = max(1, round(PER_ROUND * (1 - float(y[train].mean()))))
        not_again = {name: np.r_[keys, own.keys] for name, own in sets.items()}
        for name, new in draw(model, turn, not_again, (max(1, PER_ROUND - n_bad), n_bad)).items():
            old = sets[name]
            sets[name] = Given(np.r_[old.keys, new.keys], np.r_[old.x, new.x], np.r_[old.meta, new.meta], np.r_[old.labels, new.labels])
            model.handed_over += len(new.keys)

    def odds(rows: np.ndarray) -> np.ndarray:
        return np.c_[np.clip(model.text.log_odds(x[rows][:, model.chosen]), -12, 12), np.clip(model.meta.log_odds(meta[rows]), -12, 12)]

    both = odds(check)
    spread = both.std(axis=0) + 1e-3
    w = logistic(both / spread, y[check], 1e-3, 400)
    model.mix = np.r_[w[:2] / spread, w[2]]
    model.threshold = reject_limit(model.combined(*both.T), y[check])
    if len(test):
        p, good = model.combined(*odds(test).T), y[test] > 0.5
        model.held_out_accuracy = float(((p >= 0.5) == good).mean())
        model.held_out_bad_rejected = float((p[~good] < model.threshold).mean()) if (~good).any() else float("nan")
        model.held_out_good_kept = float((p[good] >= model.threshold).mean()) if good.any() else float("nan")
    return model


def _meta_col(docs: DataFrame, name: str):
    return (F.col(name) if name in docs.columns else F.lit(None)).cast("string").alias(name)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), _meta_col(docs, "lang"), _meta_col(docs, "source"))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> list:
    """doc_id, y and h of at most so many labelled documents, those with the least hashes h of their ids."""
    quality, toxic = F.min("quality"), F.coalesce(F.max("toxic"), F.lit(0))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.when(toxic > 0, 0.0).otherwise(quality.cast("double")).alias("y")).filter("y is not null")
    known = marks.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    return sorted(known.withColumn("h", F.xxhash64("doc_id", F.lit("co"))).orderBy("h", "doc_id").limit(max_labelled).collect(), key=lambda r: r["doc_id"])


def role_of(h: int) -> int:
    part = h % 20
    return TEST if part < TEST_PARTS else CALIBRATE if part < TEST_PARTS + CALIBRATE_PARTS else TRAIN


def candidate_features(docs: DataFrame, sample: list) -> np.ndarray:
    """The features by which the sample's training documents differ most between the classes, counted on the executors."""
    train = [(r["doc_id"], r["y"]) for r in sample if role_of(r["h"]) == TRAIN]
    n1 = max(1, sum(y > 0.5 for _, y in train))
    n0 = max(1, len(train) - n1)
    chosen = docs.sparkSession.createDataFrame(train, "doc_id long, y double")
    texts = _plain(docs).select("doc_id", "text", F.xxhash64("text").alias("th")).join(F.broadcast(chosen), "doc_id")

    def rows(batches):
        maker = TextFeatures()
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "y", "th", "text")]
            for a, b in slices(cols[3]):
                yield dict(zip(("doc_id", "y", "th"), (c[a:b] for c in cols), strict=False)) | {"found": [sorted(f) for f in maker.of(cols[3][a:b])]}

    found = map_rows(texts, rows, "doc_id long, y double, th long, found array<int>").groupBy("doc_id").agg(F.min_by(F.struct("y", "found"), "th").alias("d"))
    counts = found.select("d.y", F.explode("d.found").alias("f")).groupBy("f").agg(F.sum("y").alias("good"), F.sum(1 - F.col("y")).alias("bad")).filter("good + bad >= 5")
    p = (F.col("good") + F.col("bad")) / (n1 + n0)
    apart = F.col("good") / n1 - F.col("bad") / n0
    chi = apart * apart / F.greatest(p * (1 - p), F.lit(1e-9))
    return np.sort(np.array([r["f"] for r in counts.orderBy(chi.desc(), "f").limit(CANDIDATES).collect()], dtype="i8"))


def marked(docs: DataFrame, candidates: np.ndarray) -> DataFrame:
    """doc_id, th, kind (hashes of text and of metadata columns), bits (which candidates the text holds), meta of every document."""

    def rows(batches):
        maker = TextFeatures(candidates)
        for batch in batches:
            texts, langs, sources = (batch.column(c).to_pylist() for c in ("text", "lang", "source"))
            for a, b in slices(texts):
                bits = np.packbits(held_features(maker.of(texts[a:b]), candidates), axis=1)
                yield {c: batch.column(c).slice(a, b - a) for c in KEY} | {"bits": [r.tobytes() for r in bits], "meta": [layout(*r) for r in zip(texts[a:b], langs[a:b], sources[a:b], strict=True)]}

    return map_rows(_plain(docs).withColumns(_key(_plain(docs))), rows, "doc_id long, th long, kind long, bits binary, meta array<double>")


#: What tells apart documents that may be scored differently.
KEY = ("doc_id", "th", "kind")


def _key(docs: DataFrame) -> dict:
    plain = lambda c: F.coalesce(_meta_col(docs, c), F.lit("\0"))
    return {"doc_id": F.col("doc_id").cast("long"), "th": F.xxhash64(F.coalesce("text", F.lit(""))), "kind": F.xxhash64(plain("lang"), plain("source"))}


def unpacked(bits: list[bytes], n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(bits), dtype="u1").reshape(len(bits), -1), axis=1, count=n).astype(bool) if bits else np.zeros((0, n), dtype=bool)


def _of_batch(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    meta = batch.column("meta")
    return unpacked(batch.column("bits").to_pylist(), n), meta.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def confident(table: DataFrame, n: int, model: Model, turn: int, not_again: dict[str, np.ndarray], asked: tuple[int, int]) -> dict[str, Given]:
    """Draw from all marked documents: of the texts a view is confident about, for each label so many with the least hashes."""
    givers = {"meta": "text", "text": "meta"}  # receiver: giver

    def rows(batches):
        best: dict[tuple[str, int], dict[int, tuple[int, int]]] = {(name, label): {} for name in givers for label in (1, 0)}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, meta = _of_batch(batch, n)
            th, h, ids = (batch.column(c).to_numpy() for c in ("th", "h", "doc_id"))
            odds = {"text": model.text.log_odds(x[:, model.chosen]), "meta": model.meta.log_odds(meta)}
            for (name, label), held in best.items():
                sure = (odds[givers[name]] if label else -odds[givers[name]]) > SURE
                at = np.flatnonzero(sure & ~np.isin(th, not_again[name]))
                for t, k, i in zip(th[at].tolist(), h[at].tolist(), ids[at].tolist(), strict=True):
                    held[t] = min(held.get(t, (k, i)), (k, i))
                most = asked[1 - label]
                if len(held) > 2 * most:
                    best[name, label] = dict(sorted(held.items(), key=lambda e: e[1])[:most])
        for (name, label), held in best.items():
            if held:
                top = sorted((k, t, i) for t, (k, i) in held.items())[: asked[1 - label]]
                yield dict(zip(("h", "th", "doc_id"), zip(*top, strict=True), strict=True)) | {"receiver": [name] * len(top), "label": [label] * len(top)}

    scored = table.filter("doc_id is not null").select("doc_id", "th", F.xxhash64("th", F.lit(turn)).alias("h"), "bits", "meta")
    few = map_rows(scored, rows, "h long, th long, doc_id long, receiver string, label int").groupBy("receiver", "label", "h", "th").agg(F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("receiver", "label").orderBy("h", "th")
    # the constant bound lets the ranked window drop rows before its shuffle
    picked = few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max(asked)).filter(F.col("place") <= F.when(F.col("label") == 1, asked[0]).otherwise(asked[1]))
    ids = [tuple(r) for r in picked.select("doc_id", "th", "receiver", "label").collect()]  # 2 * PER_ROUND rows at most
    chosen = table.sparkSession.createDataFrame(ids, "doc_id long, th long, receiver string, label int")
    got = table.select("doc_id", "th", "bits", "meta").join(F.broadcast(chosen), ["doc_id", "th"]).dropDuplicates(["th", "receiver"]).collect() if ids else []
    out = {}
    for name in givers:
        own = sorted((r for r in got if r["receiver"] == name), key=lambda r: r["th"])
        meta = np.array([r["meta"] for r in own]).reshape(len(own), LANG_BUCKETS + SOURCE_BUCKETS + LAYOUT)
        out[name] = Given(np.array([r["th"] for r in own], dtype="i8"), unpacked([r["bits"] for r in own], n), meta, np.array([float(r["label"]) for r in own]))
    return out


def learned(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> tuple[Model, DataFrame | None]:
    """The model, and the stored marks of all documents that it was fitted with (None if nothing could be learned)."""
    sample = labelled_sample(docs, labels, max_labelled)
    candidates = candidate_features(docs, sample) if sample else np.zeros(0, dtype="i8")
    if not len(candidates):
        return Model(), None
    table = staged(marked(docs, candidates), "cotraining-marks")
    wanted = docs.sparkSession.createDataFrame([(r["doc_id"],) for r in sample], "doc_id long")
    own = table.select("doc_id", "th", "bits", "meta").join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min_by(F.struct("th", "bits", "meta"), "th").alias("d"))
    got = {r["doc_id"]: r["d"] for r in own.collect()}  # max_labelled rows at most
    rows = [(got[r["doc_id"]], r["y"], role_of(r["h"])) for r in sample if r["doc_id"] in got]
    d, y, role = zip(*rows, strict=True)
    x, meta = unpacked([r["bits"] for r in d], len(candidates)), np.array([r["meta"] for r in d])
    model = cotrain(x, meta, np.array(y), np.array([r["th"] for r in d], dtype="i8"), np.array(role), candidates, lambda *asked: confident(table, len(candidates), *asked), rounds)
    if model.features is None:
        drop_staged(table)
        return model, None
    model.n_candidates = len(candidates)
    return model, table


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> Model:
    """Model from labelled documents and all others."""
    model, table = learned(docs, labels, max_labelled, rounds)
    if table is not None:
        drop_staged(table)
    return model


class Scorer:
    """Scores of batches of documents by a fitted model."""

    def __init__(self, model: Model) -> None:
        self.model, self.maker = model, TextFeatures(model.features)

    def of(self, texts: list[str], langs: list, sources: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities by text, by metadata and by both."""
        model = self.model
        if model.features is None:
            half = np.full(len(texts), 0.5)
            return half, half, half
        t = model.text.log_odds(model.text_matrix(self.maker.of(texts)))
        m = model.meta.log_odds(np.array([layout(*r) for r in zip(texts, langs, sources, strict=True)]))
        return sigmoid(t), sigmoid(m), model.combined(t, m)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, p_text, p_meta, score, kept for every document, by a model fitted on these or others."""

    def rows(batches):
        scorer = Scorer(model)
        for batch in batches:
            ids, texts, langs, sources = (batch.column(c).to_pylist() for c in ("doc_id", "text", "lang", "source"))
            for a, b in slices(texts):
                t, m, p = scorer.of(texts[a:b], langs[a:b], sources[a:b])
                yield {"doc_id": ids[a:b], "p_text": t, "p_meta": m, "score": p, "kept": p >= model.threshold}

    return map_rows(_plain(docs), rows, SCORES)


SCORES = "doc_id long, p_text double, p_meta double, score double, kept boolean"


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that the classifier fitted on them keeps.

    Texts are read for marks once; then the few rejected keys are joined away, by a merge join at every size, so that nothing
    that grows is broadcast.
    """
    model, table = learned(docs, labels)
    if table is None:
        return docs

    def rejected(batches):
        for batch in batches:
            if batch.num_rows:
                x, meta = _of_batch(batch, model.n_candidates)
                bad = model.combined(model.text.log_odds(x[:, model.chosen]), model.meta.log_odds(meta)) < model.threshold
                yield {c: batch.column(c).filter(pa.array(bad)) for c in KEY}

    bad = staged(map_rows(table, rejected, "doc_id long, th long, kind long").distinct(), "cotraining-rejected").alias("bad")
    drop_staged(table)
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in _key(docs).items()]).alias("doc")
    same = [F.col(f"doc.{c}").eqNullSafe(F.col(f"bad.{c}")) for c in KEY]
    return rows.join(bad.hint("merge"), same, "left_anti").select("row.*")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_text, p_meta, score, kept for every document, by a model fitted on them."""
    model, table = learned(docs, labels)
    if table is None:
        return score(docs, model)

    def rows(batches):
        for batch in batches:
            if batch.num_rows:
                x, meta = _of_batch(batch, model.n_candidates)
                t, m = model.text.log_odds(x[:, model.chosen]), model.meta.log_odds(meta)
                p = model.combined(t, m)
                yield {"doc_id": batch.column("doc_id"), "p_text": sigmoid(t), "p_meta": sigmoid(m), "score": p, "kept": p >= model.threshold}

    return map_rows(table.select("doc_id", "bits", "meta"), rows, SCORES)
