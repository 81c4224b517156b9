"""Toxicity by a support vector machine on a subsequence string kernel with Nystrom landmarks.

The kernel counts common subsequences of ``LENGTH`` letters of two strings, each weighted by
``DECAY`` to the power of the stretch it covers in both, so gaps and inserted characters cost a
factor and do not hide a word. Landmarks are letter strings of the training sentences that set
toxic ones apart. A unit (a word, or a run of single characters written apart, in lower case with
look-alike digits and signs read as letters) is mapped to its kernels with the landmarks, times the
inverse root of the landmarks' kernel matrix. A sentence is as toxic as its worst unit and a text
as its worst sentence. Sentences are labelled by their documents; of a toxic document the sentence
with the largest margin is the positive one, found anew in each round of training.

Training reads at most ``sample`` labelled documents of each class, drawn by hash, and of these
``max_sentences`` sentences. Scores come from the text alone. Documents without text score like a
text without units. With labels of one class only, or none, every score is that class's share.
Ties and repeated rows do not matter, as rows are scored one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.work import beside, ship, whole

LENGTH, DECAY = 3, 0.5
GRAMS = range(4, 11)
UNIT, STEP = 32, 16
NEAR = 0.65
#: Landmarks that a sample may have although they could be due to chance.
FEW = 12
#: Kernel with some landmark that a unit needs to be a witness.
SEEN = 0.3
CACHED = 150_000
#: Texts whose words are scored together.
SLICE = 300
#: Signs that stand for letters.
LOOKALIKES = str.maketrans("0134578@$!", "oieastbasi")
APART = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
SENTENCE_END = r"(?<=[.!?])\s+|\n+"


def letters(token: str) -> str:
    """A token as a unit: its letters between marks for the start and the end of a word."""
    inner = EDGES.sub("", token.lower()).translate(LOOKALIKES)
    return "^" + "".join([c for c in inner if c.isalpha()]) + "$"


def tokens(text: str) -> set[str]:
    """Distinct words as written, and runs of single characters joined."""
    found = set(text.split())
    found.update("".join(m[0].split()) for m in APART.finditer(text))
    return found


def placed_tokens(sentence: str) -> list[tuple[str, str, str]]:
    """Words with those before and after, and runs of single characters joined."""
    words = ["", *sentence.split(), ""]
    runs = ["".join(m[0].split()) for m in APART.finditer(sentence)]
    around = zip(words[1:-1], words, words[2:], strict=False)
    return [*around, *((r, "", "") for r in runs)]


def windows(unit: str) -> list[str]:
    """A unit itself, or overlapping pieces of a very long one."""
    if len(unit) <= UNIT:
        return [unit]
    return [unit[i : i + UNIT] for i in range(0, len(unit) - STEP, STEP)]


def padded(units: list[str], width: int) -> np.ndarray:
    raw = "".join([u.ljust(width, "\0") for u in units]).encode("utf-32-le")
    return np.frombuffer(raw, dtype=np.uint32).reshape(len(units), width).astype(np.int64)


def kernel(s: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of row i of ``s`` with row i of ``z`` (0 is padding)."""
    n, width, m = len(s), s.shape[1], z.shape[1]
    # decay of a match at column j as seen from column k > j, both ends' factor included
    away = np.arange(m + 1)[None, :] - np.arange(m)[:, None]
    reach = np.where(away > 0, DECAY ** (away + 1.0), 0).astype(np.float32)
    total = np.zeros(n, dtype=np.float32)
    # prime[q][:, j]: kernels of length q, decayed to the current ends
    prime = [np.ones((n, m + 1), np.float32)]
    prime += [np.zeros((n, m + 1), np.float32) for _ in range(LENGTH - 1)]
    for i in range(width):
        same = ((s[:, i : i + 1] == z) & (z > 0)).astype(np.float32)
        total += DECAY**2 * (same * prime[LENGTH - 1][:, :-1]).sum(axis=1)
        new = [prime[0]]
        for q in range(1, LENGTH):
            new.append(DECAY * prime[q] + (prime[q - 1][:, :-1] * same) @ reach)
        prime = new
    return total


def pair_bits(codes: np.ndarray, reach: int) -> np.ndarray:
    """A 128-bit set (two words) of the pairs of letters at most ``reach`` apart."""
    out = np.zeros((len(codes), 2), dtype=np.uint64)
    for gap in range(1, reach + 1):
        a, b = codes[:, :-gap], codes[:, gap:]
        h = (a * 1_000_003 + b * 7_919) * 2_654_435_761 >> 7
        bit = np.where((a > 0) & (b > 0), np.uint64(1) << (h & 63).astype(np.uint64), np.uint64(0))
        upper = (h >> 6 & 1).astype(bool)
        for half in (0, 1):
            chosen = np.where(upper == bool(half), bit, np.uint64(0))
            out[:, half] |= np.bitwise_or.reduce(chosen, axis=1)
    return out


@dataclass
class Model:
    landmarks: list[str]
    evidence: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -1.0
    curve: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))
    share: float = 0.0

    def prepare(self) -> None:
        self.z = padded(self.landmarks, max(GRAMS))
        self.bits = pair_bits(self.z, 1)
        self.least = np.ceil(NEAR * np.bitwise_count(self.bits).sum(axis=1))
        self.norm = np.sqrt(kernel(self.z, self.z))

    def related(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit, landmark) pairs where the unit has most of the landmark's pairs of letters."""
        rows, cols = [], []
        for j, own in enumerate(self.bits):
            shared = np.bitwise_count(bits[:, 0] & own[0]) + np.bitwise_count(bits[:, 1] & own[1])
            near = np.flatnonzero(shared >= self.least[j])
            rows.append(near)
            cols.append(np.full(len(near), j))
        return np.concatenate(rows), np.concatenate(cols)

    def kernels(self, units: list[str]) -> np.ndarray:
        """Squares of the normalised kernels of units with the landmarks.

        A landmark counts as unrelated (0) to a unit that lacks many of its neighbouring pairs
        of letters, even with two characters in between.
        """
        out = np.zeros((len(units), len(self.landmarks)), dtype=np.float32)
        order = np.argsort([len(u) for u in units], kind="stable")
        for part in np.array_split(order, max(1, len(order) // 20_000)):
            if not len(part):
                continue
            codes = padded([units[i] for i in part], max(4, len(units[part[-1]])))
            row, col = self.related(pair_bits(codes, 3))
            if not len(row):
                continue
            used, at = np.unique(row, return_inverse=True)
            own = np.sqrt(kernel(codes[used], codes[used]))[at]
            both = kernel(codes[row], self.z[col])
            out[part[row], col] = (both / np.maximum(own * self.norm[col], 1e-9)) ** 2
        return out

    def margins(self, written: list[str]) -> np.ndarray:
        """Margin of tokens as written: that of the worst window."""
        parts = [windows(letters(t)) for t in written]
        flat = sorted({w for p in parts for w in p})
        of = dict(zip(flat, self.kernels(flat) @ self.weights + self.bias, strict=True))
        return np.array([max(of[w] for w in p) for p in parts])

    def score(self, margins: list[float]) -> float:
        x = self.curve @ self.summary(margins)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))

    def summary(self, margins: list[float]) -> np.ndarray:
        """The two largest margins of a text, within bounds."""
        top = sorted(margins, reverse=True)[:2] + [self.bias] * 2
        return np.array([max(-2.0, min(2.0, top[0])), max(-2.0, min(2.0, top[1])), 1.0])


def choose_landmarks(units_of: list[set[str]], toxic: np.ndarray, most: int) -> dict[str, float]:
    """Letter strings that are significantly more frequent in toxic documents than in clean ones.

    Taken by significance, which is the value; one whose words mostly contain a stronger one is
    left out.
    """
    seen = (Counter(), Counter())
    for units, y in zip(units_of, toxic, strict=True):
        seen[int(y)].update(units)
    n = [max(1, int((toxic == y).sum())) for y in (0, 1)]
    grams: dict[str, list[str]] = {}
    for u, count in seen[1].items():
        if count * n[0] > 4 * seen[0][u] * n[1]:
            for g in grams_of(u):
                grams.setdefault(g, []).append(u)
    least = max(2, n[1] // 100)
    found = {g for g, us in grams.items() if sum(seen[1][u] for u in us) >= least}
    in_clean = Counter()
    for u, count in seen[0].items():
        for g in grams_of(u) & found:
            in_clean[g] += count
    holders: dict[str, list[int]] = {}
    for d, (units, y) in enumerate(zip(units_of, toxic, strict=True)):
        if y:
            for u in units:
                holders.setdefault(u, []).append(d)
    covers, sure = {}, {}
    share = n[1] / (n[0] + n[1])
    for g in sorted(found):
        docs = {d for u in grams[g] for d in holders[u]}
        if (odds := -log_tail(len(docs), in_clean[g], share)) > 0:
            covers[g], sure[g] = docs, odds
    # chance alone brings about one string beyond this; small samples keep their strongest few
    bar = min(math.log(max(2, len(found))), sorted(sure.values())[-min(FEW, len(sure))] if sure else 0)
    covers = {g: docs for g, docs in covers.items() if sure[g] >= bar}
    chosen: dict[str, float] = {}
    explained: set[str] = set()
    for g in sorted(covers, key=lambda g: (-sure[g], -len(g), g)):
        toxic_units = sum(seen[1][u] for u in grams[g])
        if sum(seen[1][u] for u in grams[g] if u in explained) <= 0.5 * toxic_units:
            chosen[g] = sure[g]
            explained.update(grams[g])
            if len(chosen) == most:
                break
    return chosen


def log_tail(hits: int, others: int, share: float) -> float:
    """Log of about the chance of at least ``hits`` toxic documents among ``hits + others``."""
    n = hits + others
    p = hits / n
    if p <= share:
        return 0.0
    gain = hits * math.log(p / share)
    if others:
        gain += others * math.log((1 - p) / (1 - share))
    return -gain


def grams_of(unit: str) -> set[str]:
    return {unit[i : i + size] for size in GRAMS for i in range(len(unit) - size + 1)}


def train_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 600):
    """Linear machine with squared hinge loss by gradient steps of a safe size."""
    ones = np.concatenate([x, np.ones((len(x), 1))], axis=1).astype(np.float64)
    w = np.zeros(ones.shape[1])
    ridge = 1e-3
    step = 1 / (2 * (weight[:, None] * ones * ones).sum() + ridge)
    momentum = w.copy()
    for t in range(rounds):
        slack = np.maximum(0, 1 - y * (ones @ momentum))
        grad = -2 * ones.T @ (weight * y * slack) + ridge * momentum
        new = momentum - step * grad
        momentum, w = new + t / (t + 3) * (new - w), new
    return w[:-1], w[-1]


def fit(
    sentences: list[tuple[int, str]], label: dict[int, int], most: int = 64, rarity: float = 1.0
) -> Model:
    """A model from (document, sentence) rows and the documents' labels.

    A word between the same two words counts once, so copies carry no extra weight, and as clean
    if a clean document has it there. ``rarity`` is how many clean documents each
    clean one of the sample stands for, if a toxic one stands for itself.
    """
    share = sum(label.values()) / len(label) if label else 0.0
    model = Model([], share=share)
    if share in (0.0, 1.0):
        return model
    ids = sorted(label)
    row = {d: i for i, d in enumerate(ids)}
    toxic = np.array([label[d] for d in ids])
    units_of: list[set[str]] = [set() for _ in ids]
    seen: set[int] = set()
    for d, sentence in sorted(sentences, key=lambda x: (label[x[0]], x)):
        for place in placed_tokens(sentence):
            if (known := hash(place)) not in seen:
                seen.add(known)
                units_of[row[d]].update(windows(letters(place[0])))
    picked = choose_landmarks(units_of, toxic, most)
    if not picked:
        return model
    model.landmarks = list(picked)
    model.prepare()
    gram = np.stack([kernel(np.broadcast_to(z, model.z.shape), model.z) for z in model.z])
    gram = (gram / (model.norm[:, None] * model.norm[None, :])) ** 2
    values, vectors = np.linalg.eigh(gram + 1e-4 * np.eye(len(gram)))
    root = vectors @ np.diag(np.maximum(values, 1e-4) ** -0.5) @ vectors.T
    units = sorted(set().union(*units_of))
    number = {u: i for i, u in enumerate(units)}
    near = model.kernels(units)
    phi, related = (near @ root).astype(np.float32), near.any(axis=1)
    members = [np.array([number[u] for u in us], dtype=int) for us in units_of]
    of_toxic = [m for m, y in zip(members, toxic, strict=True) if y and len(m)]
    of_clean = [m for m, y in zip(members, toxic, strict=True) if not y and len(m)]
    clean = np.unique(np.concatenate([np.zeros(0, int), *of_clean]))
    often = np.bincount(np.concatenate([np.zeros(0, int), *of_clean]), minlength=len(units))
    # before there are margins, the witnesses are units close to a landmark that clean texts lack
    own = np.setdiff1d(np.unique(np.concatenate([np.zeros(0, int), *of_toxic])), clean)
    witness = own[near[own].max(axis=1) >= SEEN] if len(own) else own
    for _ in range(3):
        if not len(witness):
            return Model([], share=share)
        # units unrelated to every landmark are alike and stand in one row of zeros
        kin = clean[related[clean]]
        x = np.concatenate([phi[witness], phi[kin], np.zeros((1, phi.shape[1]))])
        y = np.where(np.arange(len(x)) < len(witness), 1.0, -1.0)
        # a clean unit weighs by the clean documents that have it
        weight = np.concatenate([np.full(len(witness), 1 / len(witness)), often[kin] / max(1, often[kin].sum()), [0.25]])
        w, b = train_svm(x, y, weight)
        margin = phi @ w + b
        shown = [m[margin[m] >= min(0.8, margin[m].max())] for m in of_toxic]
        found = np.unique(np.concatenate(shown))
        witness = found[near[found].max(axis=1) >= SEEN]
    model.weights, model.bias = (root @ w).astype(np.float32), float(b)
    known = [i for i, m in enumerate(members) if len(m)]
    x = np.array([model.summary(margin[members[i]].tolist()) for i in known])
    model.curve = calibrate(x, toxic[known], np.where(toxic[known] == 1, 1.0, rarity))
    return model


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 0.05 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1, 4 / (1e-9 + np.abs(step).max()))
    return w


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 750, max_sentences: int = 150_000, most: int = 64
) -> Model:
    """Fit on labelled documents that are not held out."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    drawn = known.where("toxic = 1").orderBy(*order).limit(sample)
    drawn = drawn.union(known.where("toxic = 0").orderBy(*order).limit(sample))
    label = {r.doc_id: r.toxic for r in drawn.collect()}  # at most 2 * sample rows
    n = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    used = sum(label.values())
    rarity = n.get(0, 1) * max(1, used) / (max(1, len(label) - used) * n.get(1, 1))
    rows = (
        docs.where(F.col("doc_id").isin(*label) if label else F.lit(False))
        .select("doc_id", F.explode(F.split(whole(), SENTENCE_END)).alias("sentence"))
        .where("sentence <> ''")
        .orderBy(F.xxhash64("doc_id", "sentence"), "doc_id", "sentence")
        .limit(max_sentences)
        .collect()
    )
    return fit([(r.doc_id, r.sentence) for r in rows], label, most, rarity)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` with ``toxic_score``, from 0 to 1."""
    ship(docs.sparkSession)

    def run(batches):
        if model.landmarks:
            model.prepare()
        cache: dict[str, float] = {}
        for batch in batches:
            texts = batch["text"].tolist()
            scores = []
            for i in range(0, len(texts), SLICE):
                scores += scores_of(texts[i : i + SLICE], cache)
            yield pd.DataFrame({"toxic_score": np.array(scores, dtype=float)})

    def scores_of(texts: list, cache: dict[str, float]) -> list[float]:
        if not model.landmarks:
            return [model.share] * len(texts)
        if len(cache) > CACHED:
            cache.clear()
        found = [tokens(t) if isinstance(t, str) else set() for t in texts]
        new = sorted({t for ts in found for t in ts if t not in cache})
        cache.update(zip(new, model.margins(new).tolist(), strict=True))
        return [model.score([cache[t] for t in ts]) for ts in found]

    return beside(docs, run, ["text"], docs.columns, "toxic_score double")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels, **options)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not classified as toxic, with their own columns."""
    model = train(docs, labels, **options)
    others = [c for c in docs.columns if c != "text"]
    scored = score(docs.select(F.struct(*others).alias("record"), "text"), model)
    kept = scored.where("toxic_score < 0.5")
    return kept.select(*[(F.col(c) if c == "text" else F.col("record")[c]).alias(c) for c in docs.columns])
