"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words sums over all subsequences of three letters (with up to two letters between them) that both hold,
weighted by DECAY to the length they span (Lodhi et al. 2002), so insults with gaps, inserted characters or new endings
stay near the insult.  It is normalised by each word's own weight.  Landmarks are words of the labelled sentences;
the machine is trained in their Nyström space, and as every landmark is an explicit vector of subsequence weights, the
trained function folds into one table of 28**3 weights, which scores whole texts with array arithmetic.  A text's score is
that of its most toxic word, made a probability by a logistic fit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, fold, rows_of, space_table, text_buffers, word_bounds

LETTERS, DECAY = 28, 0.6
PATTERNS = [(j, k) for k in range(2, 5) for j in range(1, k)]  # places of the second and third letter after the first
HELD_OUT = 2
#: The machine learns from at most this many labelled documents (those with the least hash of their id).
LABELLED_DOCS = 20_000
#: At most so many words of toxic and of other sentences take part in the fit, and so many landmarks.
TOXIC_WORDS, OTHER_WORDS, LANDMARKS = 600, 6_000, 300
THRESHOLD = 0.3
SPELLED = 3  # so many words of one or two letters in a row may spell out a word


def letter_codes() -> np.ndarray:
    """a-z (either case): 1 to 26; bytes of other scripts: 27; look-alike digits count as letters; everything else: 0."""
    code = np.zeros(256, np.int32)
    for i in range(26):
        code[[65 + i, 97 + i]] = i + 1
    code[128:] = 27
    for digit, letter in zip("01345@", "oieasa", strict=True):
        code[ord(digit)] = ord(letter) - 96
    return code


def explicit(word: bytes, codes: np.ndarray) -> dict[int, float]:
    """The word's vector of subsequence weights, normalised."""
    c = codes[np.frombuffer(word, np.uint8)].tolist()
    out: dict[int, float] = {}
    norm = 0.0
    for i in range(len(c)):
        for j, k in PATTERNS:
            if i + k < len(c) and c[i] and c[i + j] and c[i + k]:
                key = (c[i] * LETTERS + c[i + j]) * LETTERS + c[i + k]
                out[key] = out.get(key, 0.0) + DECAY ** (k + 1)
                norm += DECAY ** (2 * (k + 1))
    return {key: v / norm**0.5 for key, v in out.items()}


def _dense(vectors: list[dict[int, float]]) -> np.ndarray:
    out = np.zeros((len(vectors), LETTERS**3), np.float32)
    for row, v in zip(out, vectors, strict=True):
        row[list(v)] = list(v.values())
    return out


def _kernel(vectors: list[dict[int, float]], landmarks: np.ndarray) -> np.ndarray:
    out = np.zeros((len(vectors), len(landmarks)))
    for row, v in zip(out, vectors, strict=True):
        if v:
            row[:] = landmarks[:, list(v)] @ np.array(list(v.values()), np.float32)
    return out


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine in the primal, by Newton steps on the vectors inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(40):
        inside = y * (x @ w) < 1
        xs, cs = x[inside], weight[inside]
        new = np.linalg.solve(np.diag(penalty) + (xs * cs[:, None]).T @ xs, (xs * cs[:, None]).T @ y[inside])
        if np.abs(new - w).max() < 1e-6:
            break
        w = w + 0.7 * (new - w)
    return w[:-1], float(w[-1])


def fit_words(toxic: list[tuple[str, int]], other: list[str]) -> dict | None:
    """A weight table and a bias from words of toxic sentences, with how many documents hold them, and of other sentences."""
    codes = letter_codes()
    seen = np.array([n for w, n in toxic if explicit(w.encode(), codes)], float)
    toxic, other = ([v for v in (explicit(w.encode(), codes) for w in words) if v] for words in ([w for w, _ in toxic], other))
    if not toxic or not other:
        return None
    landmarks = _dense([*toxic[: LANDMARKS * 2 // 3], *other[: LANDMARKS // 3]])
    value, vector = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = value > 1e-6
    root = vector[:, good] / np.sqrt(value[good])  # k(x, landmarks) @ root: Nyström features
    x = _kernel([*toxic, *other], landmarks) @ root
    y = np.concatenate([np.ones(len(toxic)), -np.ones(len(other))])
    c = np.concatenate([2.0 * len(other) * seen / seen.sum() + 20.0, np.full(len(other), 20.0)])
    w, bias = svm(x, y, c)
    return {"table": (landmarks.T @ (root @ w)).astype(np.float32), "bias": bias}


def text_scores(data: np.ndarray, offsets: np.ndarray, model: dict, codes: np.ndarray) -> np.ndarray:
    """Per document of a block, the machine's value of its highest word (its bias, if there are no words)."""
    out = np.full(len(offsets) - 1, model["bias"])
    n = len(data)
    start, end, per_doc = word_bounds(data, offsets, ~space_table())
    if not len(start):
        return out
    c = codes[data]
    word = np.zeros(n + 4, np.int32)
    word[start] = 1
    word[offsets[(offsets > 0) & (offsets < n)]] += 1 << 20  # (documents end words, too)
    word = np.cumsum(word)
    c = np.concatenate([c, np.zeros(4, np.int32)])
    # a space between two letters starts a new word, so equal numbers mean the same word
    above, norm = np.zeros(n, np.float32), np.zeros(n, np.float32)
    some = c > 0
    for j, k in PATTERNS:
        valid = some[:n] & some[j : n + j] & some[k : n + k] & (word[:n] == word[k : n + k])
        at = np.flatnonzero(valid)
        above[at] += model["table"][(c[at] * LETTERS + c[at + j]) * LETTERS + c[at + k]] * np.float32(DECAY ** (k + 1))
        norm[at] += np.float32(DECAY ** (2 * (k + 1)))
    total, weight = np.add.reduceat(above, start), np.add.reduceat(norm, start)
    value = np.where(weight > 0, total / np.sqrt(np.maximum(weight, 1e-12)), 0.0) + model["bias"]
    filled = np.flatnonzero(per_doc > 0)
    out[filled] = np.maximum.reduceat(value, (np.cumsum(per_doc) - per_doc)[filled])
    for doc, value in spelled_values(c, start, end, np.repeat(np.arange(len(per_doc)), per_doc), model):
        np.maximum.at(out, doc, value)
    return out


def spelled_values(c: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, model: dict):
    """(documents, values) of what is spelled out: the letters alone of SPELLED or more words in a row that have one letter
    each at most (then two), and of words with so many other characters that PATTERNS may not reach over them."""
    before = np.concatenate([[0], np.cumsum(c > 0)])
    letters = before[end] - before[start]
    for most in (1, 2, None):
        if most:
            short = letters <= most
            begin = short.copy()
            begin[1:] &= ~short[:-1] | (doc[1:] != doc[:-1])
            group = np.cumsum(begin)
            chosen = short & (np.bincount(group[short], minlength=len(start) + 1)[group] >= SPELLED)
        else:
            group, chosen = np.arange(len(start)), end - start - letters >= 3
        words = np.flatnonzero(chosen & (letters > 0))
        if not len(words):
            continue
        of = np.repeat(words, (end - start)[words])
        at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum((end - start)[words]) - (end - start)[words], (end - start)[words])
        of, at = of[c[at] > 0], at[c[at] > 0]
        unit, n = group[of], len(of)
        x, same = np.concatenate([c[at], np.zeros(4, np.int32)]), np.concatenate([unit, np.full(4, -1)])
        above, norm = np.zeros(n, np.float32), np.zeros(n, np.float32)
        for j, k in PATTERNS:
            i = np.flatnonzero(same[:n] == same[k : n + k])
            above[i] += model["table"][(x[i] * LETTERS + x[i + j]) * LETTERS + x[i + k]] * np.float32(DECAY ** (k + 1))
            norm[i] += np.float32(DECAY ** (2 * (k + 1)))
        first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        total, weight = np.add.reduceat(above, first), np.add.reduceat(norm, first)
        some = weight > 0
        yield doc[of[first[some]]], total[some] / np.sqrt(weight[some]) + model["bias"]


def _values(model):
    """(..., value): the highest word of every text; other columns pass."""

    def run(batches):
        import pyarrow as pa

        codes = letter_codes()
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            parts = [text_scores(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], model, codes)
                     for i, j in blocks(np.diff(offsets))]
            value = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.record_batch([batch.column("doc_id"), batch.column("extra"), pa.array(value, pa.float64())],
                                  names=["doc_id", "extra", "value"])

    return run


def _scored(rows: DataFrame, model: dict) -> DataFrame:
    return rows.mapInArrow(_values(model), "doc_id long, extra int, value double")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, extra): training documents with their label; at most LABELLED_DOCS, without the held-out fold.

    A document with contradicting labels counts as toxic; NULL ids and labels are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(fold(F.col("doc_id"), 4) != HELD_OUT)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("extra")).withColumn("draw", F.xxhash64("doc_id"))
    last = known.select("draw").orderBy("draw").limit(LABELLED_DOCS).agg(F.max("draw")).first()[0]
    known = known.filter(F.col("draw") <= (last if last is not None else 0)).select("doc_id", "extra")
    return rows_of(docs).join(known, "doc_id").select("doc_id", "text", "extra")


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The fitted table, bias and logistic curve; without labels of both kinds, a constant score (0.1 without any)."""
    sample = labelled(docs, labels).cache()
    try:
        n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("extra"), F.lit(0))).first()
        flat = {"table": np.zeros(LETTERS**3, np.float32), "bias": 0.0, "slope": 0.0, "shift": _logit((toxic + 0.5) / (n + 5))}
        if not toxic or toxic == n:
            return flat
        # In how many toxic and other documents does each word of their sentences occur?
        words = sample.select("extra", F.explode(F.array_distinct(F.flatten(F.transform(
            F.split(F.lower("text"), r"[.!?\n]+"), lambda s: F.split(s, r"[\s,;:]+"))))).alias("word"))
        words = words.filter(F.length("word").between(3, 40)).groupBy("word").agg(
            F.sum("extra").alias("bad"), F.sum(1 - F.col("extra")).alias("good"))
        lift = ((F.col("bad") + 0.5) / (toxic + 1)) / ((F.col("good") + 0.5) / (n - toxic + 1))
        words = words.withColumn("lift", lift).cache()
        evidence = F.col("bad") * F.log("lift")
        least = 2 if toxic < 200 else 3
        bad = words.filter((F.col("bad") >= least) & (F.col("lift") >= 6)).orderBy(evidence.desc(), "word").limit(TOXIC_WORDS)
        usual = words.filter((F.col("good") >= 1) & (F.col("lift") < 3))
        bad = [(r.word, r.bad) for r in bad.select("word", "bad").collect()]
        common = [r.word for r in usual.orderBy(F.col("good").desc(), "word").limit(OTHER_WORDS // 3).select("word").collect()]
        mixed = [r.word for r in usual.orderBy(F.xxhash64("word"), "word").limit(OTHER_WORDS // 3).select("word").collect()]
        model = fit_words(bad, [*common, *mixed])
        if model is None:
            return flat
        # Once more with the words of other sentences that look most toxic to the first fit.
        hard = _scored(usual.filter(F.col("good") >= 2).select(F.col("good").alias("doc_id"), F.col("word").alias("text"), F.lit(0).alias("extra"))
                       .withColumn("doc_id", F.xxhash64("text")), model).orderBy(F.col("value").desc(), "doc_id").limit(OTHER_WORDS // 3)
        hard = usual.withColumn("doc_id", F.xxhash64("word")).join(hard.select("doc_id"), "doc_id", "left_semi")
        hard = sorted(r.word for r in hard.select("word").collect())
        model = fit_words(bad, [*common, *mixed, *hard])
        values = _scored(sample, model).select("value", "extra").collect()  # two numbers per labelled document
        slope, shift = logistic(np.array([v.value for v in values]), np.array([v.extra for v in values], float))
        return {**model, "slope": slope, "shift": shift}
    finally:
        sample.unpersist()


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic curve, by Newton steps with a little ridge (Platt).

    All values together weigh as much as 200, so that a clean separation doesn't make a step of the curve: words a little
    below the margin, such as insults with inserted characters, keep a middling score.
    """
    share = min(1.0, 200 / len(x))
    w = np.array([1.0, _logit((y.sum() + 0.5) / (len(y) + 1))])
    design = np.stack([x, np.ones(len(x))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = share * design.T @ (y - p) - 0.01 * w
        step = np.linalg.solve(share * (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2), grad)
        w = w + np.clip(step, -5, 5)
    return max(float(w[0]), 0.0), float(w[1])


def score_toxicity(docs: DataFrame, labels: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from THRESHOLD on).

    Only the text decides a score.  Empty and NULL texts get the score of a text without words.
    """
    model = train(docs, labels) if model is None else model
    rows = rows_of(docs).select("doc_id", "text", F.lit(0).alias("extra"))
    curve = F.lit(float(model["slope"])) * F.col("value") + F.lit(float(model["shift"]))
    score = 1 / (1 + F.exp(-F.least(F.greatest(curve, F.lit(-30.0)), F.lit(30.0))))
    out = _scored(rows, model).withColumn("score", score)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
