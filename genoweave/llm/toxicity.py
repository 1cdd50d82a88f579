"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on its posterior labels."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Container, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, utf8

#: Seed lexicon of mild insults in four languages; fixed values.
LEXICON = tuple(
    """
    idiot moron stupid loser trash scum pathetic worthless disgusting clown dumb fool jerk imbecile garbage vermin
    dumm dummkopf trottel abschaum versager widerlich
    imbécile crétin ordure minable dégoûtant abruti
    idiota estúpido imbécil basura asqueroso inútil
    """.split()
)
LEET = str.maketrans("013457@$!", "oieastasi")
WORD = re.compile(r"[^\W\d_]+")
STRETCHED = re.compile(r"(.)\1{2,}")
#: Words that a Python worker remembers.
KNOWN_WORDS = 50_000
MARKS = ".,;:!?\"'()"
PREFIXES = (4, 5, 6, 7, 8)
#: A sign in so many different words of a text is a sign of its own, with as many marks.
OFTEN = {2: "+", 4: "++"}


def word_signs(word: str) -> set[str]:
    """What voters and the classifier look at in a token without blanks, lower-cased: its words, their beginnings and patterns."""
    out = set()
    for w in WORD.findall(word):
        out.add(f"={w}")
        out.update(w[:n] for n in PREFIXES if len(w) >= n)
    plain = STRETCHED.sub(r"\1", word.translate(LEET).replace("*", "").replace(".", ""))
    if plain not in out and plain != word.strip(MARKS) and plain.strip(MARKS) in LEXICON:
        out.add("#disguised")
    return out


def text_signs(text: str, of_word: Callable[[str], Iterable[str]] = word_signs) -> set[str]:
    """All signs of a text: those of its different words, and those that several words have, marked."""
    seen = Counter(s for w in set(text.lower().split()) for s in of_word(w))
    return {*seen, *(s + mark for s, n in seen.items() if n > 1 for least, mark in OFTEN.items() if n >= least)}


def known_signs(weights: Iterable[str]) -> Callable[[str], tuple[str, ...]]:
    """word_signs of a word as far as weights has them, marked or not. Plain words are cut up by hand; words seen before are remembered."""
    wanted = {s.rstrip("+") for s in weights}
    known: dict[str, tuple[str, ...]] = {}

    def of_word(word: str) -> tuple[str, ...]:
        found = known.get(word)
        if found is None:
            if len(known) > KNOWN_WORDS:
                known.clear()
            core = word.strip(MARKS)
            if core.isalpha() and "!" not in word and not STRETCHED.search(core):
                signs = (f"={core}", *[core[:n] for n in PREFIXES if len(core) >= n])
            else:
                signs = word_signs(word)
            found = known[word] = tuple([s for s in signs if s in wanted])
        return found

    return of_word


@dataclass(frozen=True)
class Limits:
    """Bounds of fitting. Counts, votes and scores cover every row; only the fit is on a sample of labelled rows."""

    sample_rows: int = 10_000
    candidates: int = 50_000  # signs of toxic texts, the most frequent
    voters: int = 256
    chance: float = 0.05  # that any sign at all is taken for a voter by luck
    rounds: int = 40


@dataclass
class Model:
    bias: float
    weights: dict[str, float]
    voters: list[str] = field(default_factory=list)
    accuracy: dict[str, tuple[float, float]] = field(default_factory=dict)
    strength: dict[str, float] = field(default_factory=dict)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fifth of the ids that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample_labelled(docs: DataFrame, labels: DataFrame, limits: Limits, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, y) of at most about limits.sample_rows labelled rows, by a hash of the id; held-out rows are left out. Of rows with the same id
    one counts, the one whose text has the smallest hash."""
    usable = labels.where(~held_out(id_col) & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("y"))
    n = usable.count()
    share = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = usable.where(share < F.lit(limits.sample_rows / max(n, 1)))
    found = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(chosen), id_col)  # about sample_rows ids
    return found.groupBy(id_col).agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("y").alias("y")).select("text", "y")


def count_signs(sample: DataFrame, candidates: Container[str] | None = None) -> DataFrame:
    """(sign, n): in how many texts of the sample each sign is, or each of the candidates."""

    def run(batches):
        of_word = word_signs if candidates is None else known_signs(candidates)
        found = Counter()

        def counted():
            kept = [(s, n) for s, n in found.items() if candidates is None or s in candidates]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array([s for s, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["sign", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                found.update(text_signs(t, of_word))
                if len(found) > 50_000:  # a text has thousands of signs
                    yield counted()
        yield counted()

    return sample.select("text").mapInArrow(run, "sign string, n long").groupBy("sign").agg(F.sum("n").alias("n"))


def mine_signs(sample: DataFrame, limits: Limits) -> tuple[list[str], float]:
    """(signs of toxic texts that luck doesn't explain, the most telling first; share of toxic texts).

    Signs are first counted in the toxic texts, and those found in three or more then in the others.
    """
    total, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not toxic or toxic == total:
        return [], 0.0
    rate = toxic / total
    often = {r.sign: r.n for r in count_signs(sample.where("y = 1")).where("n >= 3").orderBy(F.desc("n"), "sign").limit(limits.candidates).collect()}
    others = {r.sign: r.n for r in count_signs(sample.where("y = 0"), frozenset(often)).collect()}

    def gain(t: int, c: int) -> float:
        """Nats by which a sign's own rate explains its counts better than the common rate."""
        q = t / (t + c)
        return t * math.log(q / rate) + (c * math.log((1 - q) / (1 - rate)) if c else 0.0)

    least = math.log(max(len(often), 1) / limits.chance)
    gains = [(gain(t, others.get(s, 0)), s) for s, t in often.items() if t > others.get(s, 0)]
    good = sorted((-g, -len(s), s) for g, s in gains if g >= least)
    return [s for *_, s in good[: limits.voters]], rate


def label_model(votes, given, rate: float, rounds: int):
    """Posterior of the toxic class for each row of votes (rows x voters, 0 or 1), the voters' (hit, false alarm) rates and their strength.

    A latent class model by expectation-maximization. given holds noisy labels, which are one voter more whose reliability is
    estimated with the others. Correlated voters share their say: a voter's strength is 1 over 1 plus the sum of its positive
    correlations, within classes, with the other voters.
    """
    import numpy as np

    n, m = votes.shape
    p = np.where(given == 1, 0.95, 0.05) if n else np.zeros(0)
    strength, trust = np.ones(m), np.array([0.95, 0.05])
    hit, alarm = np.full(m, 0.3), np.full(m, 0.01)
    gram = votes.T @ votes
    for _ in range(rounds):
        hit = (p @ votes + 0.3) / (p.sum() + 1)
        alarm = ((1 - p) @ votes + 0.002 * rate) / ((1 - p).sum() + 1)
        hit, alarm = np.clip(hit, 1e-4, 1 - 1e-4), np.clip(alarm, 1e-6, 1 - 1e-4)
        trust = np.clip([(p @ given + 9.5) / (p.sum() + 10), ((1 - p) @ given + 0.5) / ((1 - p).sum() + 10)], 1e-3, 1 - 1e-3)
        # the covariance of what the classes leave unexplained, from sums already there
        cross = np.outer(p @ votes, hit) + np.outer((1 - p) @ votes, alarm)
        own = (p @ p) * np.outer(hit, hit) + ((1 - p) @ (1 - p)) * np.outer(alarm, alarm)
        mixed = (p @ (1 - p)) * np.outer(hit, alarm)
        cov = (gram - cross - cross.T + own + mixed + mixed.T) / max(n, 1)
        sd = np.sqrt(np.clip(np.diag(cov), 0, None)) + 1e-9
        corr = np.clip(cov / np.outer(sd, sd), 0, 1)
        corr[corr < 0.1] = 0
        np.fill_diagonal(corr, 0)
        strength = 1 / (1 + corr.sum(axis=1))
        prior = np.clip(p.mean(), 1e-3, 0.5) if n else rate
        logit = np.log(prior / (1 - prior)) + votes @ (strength * np.log(hit / alarm)) + (1 - votes) @ (strength * np.log((1 - hit) / (1 - alarm)))
        logit += np.where(given == 1, np.log(trust[0] / trust[1]), np.log((1 - trust[0]) / (1 - trust[1])))
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p, np.stack([hit, alarm], axis=1), strength


def covering(x, p, always: int, least: int = 3) -> list[int]:
    """Columns of x for the classifier: of those in order after the first `always`, the ones that add so many likely toxic rows
    to those that the ones before them hit. What says the same as another would only share its weight."""
    import numpy as np

    toxic = p > 0.5
    hit, out = np.zeros(len(x), dtype=bool), []
    for k in range(x.shape[1]):
        new = (x[:, k] > 0) & toxic & ~hit
        if k < always and x[:, k].any() or new.sum() >= least:
            out.append(k)
            hit |= x[:, k] > 0
    return out


def linear_fit(x, p, ridge: float = 0.02, steps: int = 40):
    """Weights and bias of a logistic regression of the soft labels p on x, by Newton's method."""
    import numpy as np

    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-3
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(keep), x.T @ (p - q) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labelled rows of docs that aren't held out.

    Voters are the seed lexicon's words, the pattern for disguised spellings, and words and beginnings of words mined from the
    sample. Without labelled rows of both classes the seed lexicon alone decides. The driver holds at most about
    limits.sample_rows rows of a number for each voter.
    """
    import numpy as np

    sample = cut(sample_labelled(docs, labels, limits, id_col, text_col, label_col))
    mined, rate = mine_signs(sample, limits)
    seeds = [f"={w}" for w in LEXICON] + ["#disguised"]
    if not rate:
        return Model(-3.0, dict.fromkeys(seeds, 6.0), seeds)
    names = list(dict.fromkeys([*seeds, *mined]))
    at = {s: k for k, s in enumerate(names)}

    def run(batches):
        of_word = known_signs(at)
        for b in batches:
            rows = [sorted(at[s] for s in text_signs(t, of_word) if s in at) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), b.column(1)], ["signs", "y"])

    rows = sample.mapInArrow(run, "signs array<int>, y int").collect()
    x = np.zeros((len(rows), len(names)))
    for k, r in enumerate(rows):
        x[k, r.signs] = 1
    p, rates, strength = label_model(x, np.array([r.y for r in rows]), rate, limits.rounds)
    used = covering(x, p, len(seeds))
    weights, bias = linear_fit(x[:, used], p)
    out = {names[k]: float(w) for k, w in zip(used, weights) if abs(w) > 1e-3}
    seen = x.sum(axis=0) > 0
    # a seed that the sample never shows is enough by itself
    shown = [out[s] for s in seeds if out.get(s, 0) > 0]
    out |= dict.fromkeys([s for k, s in enumerate(seeds) if not seen[k]], max(float(np.median(shown)) if shown else 0.0, 1.0 - bias))
    return Model(bias, out, names, {v: tuple(map(float, r)) for v, r in zip(names, rates)}, dict(zip(names, map(float, strength))))


def scorer(model: Model) -> Callable[[str], float]:
    """A function from a text to the log odds that it is toxic."""
    weights, of_word = model.weights, known_signs(model.weights)
    return lambda text: model.bias + sum(sorted(weights[s] for s in text_signs(text, of_word) if s in weights))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and score double, 0 to 1, for every row: of its whole text alone, without a shuffle.

    A null or empty text has the score of a text without any sign. Null ids and repeated rows are kept; an empty table gives
    no rows.
    """

    def run(batches):
        logit = scorer(model)
        for b in batches:
            z = [logit(t.decode()) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) for x in z], pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t")).mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """id_col, held_out, score and predicted (1 from 0.5 on) for every row of docs; see fit and score."""
    out = score(docs, fit(docs, labels, limits, id_col, text_col, label_col), id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that the model doesn't call toxic, with all their columns, row by row."""

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        logit = scorer(model)  # once for all batches: it remembers words
        for texts in batches:
            yield pa.array([logit(t.as_py() or "") < 0 for t in texts], pa.bool_())

    return docs.where(clean(text_col))
