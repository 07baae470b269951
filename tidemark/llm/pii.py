"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what the patterns miss.

Tokens that hold a digit or an ``@`` are the nodes, neighbouring groups of digits that can be one number together as one node;
every other token is outside any entity for certain.  A node has five
labels (outside, email, ip, card, phone).  Potentials: features of its shape and context; a chain between neighbouring
nodes; and skip edges between tokens of a document that are the same or similar (equal letters and digits, or equal last
eight digits), each to its next occurrence, which share evidence over any distance.  Labels come from damped loopy
sum-product message passing, so a number that is a phone in one place helps to find it written differently in another.  The patterns are
the labels to learn from, and what they miss would be taught as outside; so training documents get some of their numbers
once more in other notations, with the label of the number, and as many other numbers in the same notations, outside: what
tells the two apart is the skip edge.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import rows_of

KINDS = ["email", "ip", "card", "phone"]
LABELS = len(KINDS) + 1  # 0: outside
FEATURES = 512  # shapes are hashed into so many weights per label
#: The field is trained on at most this many documents that hold nodes (those with the least hash of their id), labelled by
#: the patterns.  It is a bound on training only; every document is searched.
TRAINING_DOCS = 3000
TRAINING_NODES = 60  # documents with more nodes are not trained on
ROUNDS, DAMPING = 12, 0.3
THRESHOLD = 0.7  # marginal probability at which a node becomes a span
#: Ridge terms per training node.  The shapes' weights are held down more than the edges', so that a number written as any
#: other takes its label from its other occurrences and not from its looks.
NODE_RIDGE, PAIR_RIDGE = 0.0015, 0.000025

EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"\S+")
HELD = re.compile("[0-9@]")
GROUP = re.compile(r"\+?[0-9][0-9().-]*")  # digits that can be a part of a number written in groups
JOINT = re.compile(r"\)? \(?")
MOST_DIGITS = 19
BEFORE, AFTER = "\"'([{<", "\"')]}>.,;:!?"
MARKS = "@.+-()=:/_\""


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of the email pattern: only what stands around an ``@`` is looked at."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and LOCAL.fullmatch(text[begin - 1]):
            begin -= 1
        tail = EMAIL_TAIL.match(text, at) if begin < at else None
        if tail:
            yield begin, tail.end()
            done = tail.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def nodes(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an ``@``, without brackets, quotes and punctuation around them.

    Groups of digits one space apart (a bracket may stand at it) that have 8 to 19 digits together are one node.
    """
    out: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []

    def close():
        digits = sum(c.isdigit() for a, b in run for c in text[a:b])
        if len(run) > 1 and 8 <= digits <= MOST_DIGITS:
            a, b = run[0][0], run[-1][1]
            opened = a > 0 and text[a - 1] == "(" and ")" in text[a:b]  # the bracket around the first digits
            out.append((a - opened, b))
        else:
            out.extend(run)
        run.clear()

    for m in WORD.finditer(text):
        if HELD.search(m[0]):
            a, b = m.span()
            bare = m[0].lstrip(BEFORE)
            a, b = b - len(bare), b - len(bare) + len(bare.rstrip(AFTER))
            if b <= a:
                continue
            if not GROUP.fullmatch(text, a, b):
                close()
                out.append((a, b))
                continue
            if run and not (a - run[-1][1] <= 3 and JOINT.fullmatch(text, run[-1][1], a)):
                close()
            run.append((a, b))
    close()
    return out


def _shape(word: str) -> str:
    return re.sub(r"[0-9]+", lambda m: "9" * min(len(m[0]), 5) if len(m[0]) < 13 else "N",
                  re.sub(r"[^\W\d_]+", "a", word))[:24]


def _bucket(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % FEATURES


def features(text: str, spans: list[tuple[int, int]]) -> list[list[int]]:
    words = [text[a:b] for a, b in spans]
    shapes = [_shape(w) for w in words]
    out = []
    for i, w in enumerate(words):
        digits = sum(c.isdigit() for c in w)
        near = lambda j: shapes[j] if 0 <= j < len(words) and abs(spans[j][0] - spans[i][1]) < 24 + len(w) else "-"  # noqa: E731,B023
        lead = text[max(0, spans[i][0] - 12) : spans[i][0]].split()[-1:] or [""]
        out.append([_bucket(n) for n in (
            "bias", f"shape {shapes[i]}", f"digits {min(digits, 20)}", f"all {w.isdigit()} {min(digits, 20)}",
            f"marks {''.join(c for c in MARKS if c in w)}", f"dots {min(w.count('.'), 4)}", f"luhn {13 <= digits <= 19 and luhn(re.sub('[^0-9]', '', w))}",
            f"before {near(i - 1)}", f"after {near(i + 1)}", f"pair {shapes[i]} {near(i - 1)}", f"pair {shapes[i]} {near(i + 1)}",
            f"lead {lead[0].lower()[:6] if not any(c.isdigit() for c in lead[0]) and len(lead[0]) < 7 else '*'}")])
    return out


def edges(text: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between nodes that stand next to each other, and skip edges to the next same or similar node."""
    chain = [(i, i + 1) for i in range(len(spans) - 1) if spans[i + 1][0] - spans[i][1] <= 3]
    skip, last = set(), {}
    for i, (a, b) in enumerate(spans):
        word = text[a:b].lower()
        digits = re.sub("[^0-9]", "", word)
        for key in (re.sub(r"[\W_]", "", word), ("d", digits[-8:]) if len(digits) >= 8 else None):
            if key:
                if key in last:
                    skip.add((last[key], i))
                last[key] = i
    return chain, sorted(skip - set(chain))


def labels_of(spans: list[tuple[int, int]], found: list[tuple[int, int, int]]) -> np.ndarray:
    """The label of each node by the pattern span that it overlaps (the first kind, if several)."""
    out = np.zeros(len(spans), np.int64)
    starts = [a for a, _ in spans]
    for kind, a, b in reversed(found):
        i = max(bisect_left(starts, a) - 1, 0)
        while i < len(spans) and spans[i][0] < b:
            if spans[i][1] > a:
                out[i] = kind + 1
            i += 1
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(examples: list[tuple[list[list[int]], np.ndarray, list, list]], rounds: int = 400, rate: float = 0.5) -> dict:
    """Pseudo-likelihood: each node's label given its features and its neighbours' labels, by gradient ascent (Adagrad)."""
    weight = np.zeros((FEATURES, LABELS))
    pair = {"chain": np.zeros((LABELS, LABELS)), "skip": np.zeros((LABELS, LABELS))}
    rows, labels, ends = [], [], {"chain": [], "skip": []}
    for feats, y, chain, skip in examples:
        at = len(rows)
        rows.extend(feats)
        labels.extend(y.tolist())
        ends["chain"].extend((a + at, b + at) for a, b in chain)
        ends["skip"].extend((a + at, b + at) for a, b in skip)
    if rows:
        x, y = np.array(rows), np.array(labels)
        ends = {k: np.array(v, np.int64).reshape(-1, 2) for k, v in ends.items()}
        truth = np.eye(LABELS)[y]
        memory = [np.full_like(weight, 1e-6), *(np.full((LABELS, LABELS), 1e-6) for _ in pair)]
        for _ in range(rounds):
            score = weight[x].sum(axis=1)
            for k, e in ends.items():
                np.add.at(score, e[:, 0], pair[k].T[y[e[:, 1]]])
                np.add.at(score, e[:, 1], pair[k][y[e[:, 0]]])
            error = truth - _softmax(score)
            grad = np.zeros_like(weight)
            for f in range(x.shape[1]):
                np.add.at(grad, x[:, f], error)
            grads = [grad - NODE_RIDGE * len(x) * weight]
            for k, e in ends.items():
                g = np.zeros((LABELS, LABELS))
                np.add.at(g.T, y[e[:, 1]], error[e[:, 0]])
                np.add.at(g, y[e[:, 0]], error[e[:, 1]])
                grads.append(g - PAIR_RIDGE * len(x) * pair[k])
            for m, g, w in zip(memory, grads, (weight, *pair.values()), strict=True):
                m += g * g
                w += rate * g / np.sqrt(m)
    return {"weight": weight.astype(np.float32), **pair}


def marginals(model: dict, feats: list[list[int]], chain: list, skip: list) -> np.ndarray:
    """Loopy sum-product with damping: each node's label probabilities."""
    node = model["weight"][np.array(feats)].sum(axis=1).astype(np.float64)
    ends = np.array([*chain, *skip], np.int64).reshape(-1, 2)
    if not len(ends):
        return _softmax(node)
    potential = np.concatenate([np.repeat(model[k][None], len(e), 0) for k, e in (("chain", chain), ("skip", skip)) if e])
    potential = np.exp(np.concatenate([potential, potential.transpose(0, 2, 1)]))  # [edge, from, to]
    source, target = np.concatenate([ends[:, 0], ends[:, 1]]), np.concatenate([ends[:, 1], ends[:, 0]])
    back = np.concatenate([np.arange(len(ends)) + len(ends), np.arange(len(ends))])
    message = np.zeros((len(source), LABELS))
    for _ in range(ROUNDS):
        belief = node.copy()
        np.add.at(belief, target, message)
        out = _softmax(belief[source] - message[back])
        new = np.log(np.maximum(np.einsum("el,elk->ek", out, potential), 1e-300))
        new -= new.max(axis=1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * new
    belief = node.copy()
    np.add.at(belief, target, message)
    return _softmax(belief)


def added_spans(model: dict, text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of nodes outside the pattern spans that the field labels; nodes of a pattern span are held at its label."""
    spans = nodes(text)
    if not spans:
        return []
    known = labels_of(spans, found)
    if (known > 0).all():
        return []
    chain, skip = edges(text, spans)
    feats = features(text, spans)
    held = {**model}
    held["weight"] = np.concatenate([model["weight"], 30.0 * np.eye(LABELS, dtype=np.float32), np.zeros((1, LABELS), np.float32)])
    feats = [[*f, FEATURES + k if k else FEATURES + LABELS] for f, k in zip(feats, known.tolist(), strict=True)]
    probability = marginals(held, feats, chain, skip)
    best = probability.argmax(axis=1)
    return [(int(best[i]) - 1, a, b) for i, (a, b) in enumerate(spans)
            if not known[i] and best[i] and probability[i, best[i]] >= THRESHOLD]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def train(docs: DataFrame, bound: int = TRAINING_DOCS) -> dict:
    """A model from the at most ``bound`` documents with nodes whose rows have the least hashes."""
    rows = rows_of(docs).filter(F.col("text").rlike("[0-9@]")).withColumn("draw", F.xxhash64("doc_id", "text"))
    last = rows.select("draw").orderBy("draw").limit(bound).agg(F.max("draw")).first()[0]
    if last is None:
        return fit([])
    some = rows.filter(F.col("draw") <= last).limit(bound)
    schema = "feats array<array<int>>, labels array<int>, chain array<array<int>>, skip array<array<int>>"
    examples = [(row.feats, np.array(row.labels), [tuple(e) for e in row.chain], [tuple(e) for e in row.skip])
                for row in some.select("text").mapInArrow(_examples, schema).collect()]
    return fit(examples)


def _notations(digits: str, prefix: str, pick: int) -> str:
    """The digits of a number in one of several notations."""
    tail = digits[len(prefix) :]
    return (tail if len(tail) >= 8 else digits, digits, f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"00{digits}",
            f"{tail[:3]} {tail[3:6]} {tail[6:]}", ".".join((tail[:3], tail[3:6], tail[6:])))[pick % 7]


def hidden_cues(text: str, found: list[tuple[int, int, int]]) -> tuple[str, list[tuple[int, int, int]]]:
    """``text`` with its phone and card numbers once more in another notation, and as many other numbers.

    The repeats are spans of their kind, the other numbers are not; the choice follows from the numbers alone.
    """
    spans, parts, size = list(found), [text], len(text)
    for kind, a, b in found:
        if kind < 2:
            continue
        digits = re.sub("[^0-9]", "", text[a:b])
        draw = int.from_bytes(hashlib.blake2b(digits.encode(), digest_size=8).digest(), "little")
        prefix = digits[: (draw >> 1) % 3] if kind == 3 and len(digits) > 10 else ""
        other = "".join(str((int(c) + (draw >> (8 + i)) % 9 + 1) % 10) for i, c in enumerate(digits))
        for number, is_span in ((digits, True), (other, False)):
            pick = (draw >> 4) % 7
            written = _notations(number, prefix, pick) if kind == 3 else (number, " ".join(re.findall(".{1,4}", number)))[pick % 2]
            parts.append((" and then ", "\nAgain: ", " or ", ", later called ", " / ", ". The ", " (see ")[(draw >> 12 + 3 * is_span) % 7])
            size += len(parts[-1])
            if is_span:
                spans.append((kind, size, size + len(written)))
            parts.append(written)
            size += len(written)
    return "".join(parts), spans


def _examples(batches):
    """Features, labels and edges of each document's first nodes: training never brings texts to the driver."""
    import pyarrow as pa

    kind = pa.schema([("feats", pa.list_(pa.list_(pa.int32()))), ("labels", pa.list_(pa.int32())),
                      ("chain", pa.list_(pa.list_(pa.int32()))), ("skip", pa.list_(pa.list_(pa.int32())))])
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            text, found = hidden_cues(text, base_spans(text))
            spans = nodes(text)
            if spans and len(spans) <= TRAINING_NODES:  # longer documents are not used for training
                chain, skip = edges(text, spans)
                rows.append({"feats": features(text, spans), "labels": labels_of(spans, found).tolist(),
                             "chain": [list(e) for e in chain], "skip": [list(e) for e in skip]})
        yield pa.RecordBatch.from_pylist(rows, schema=kind)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_personal_data(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of the patterns' spans, their digest, and all spans as ``kind:start:end``.

    Places are code points, ends exclusive.  An empty or NULL text has no spans; repeated rows give repeated rows.
    """
    model = train(docs) if model is None else model
    return _per_row(docs, model)


def _per_row(docs: DataFrame, model: dict) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        blank = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
        names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                if text is None:
                    rows.append(blank)
                    continue
                found = base_spans(text)
                every = found + added_spans(model, text, found)
                counts = [sum(k == kind for k, _, _ in found) for kind in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(_joined(found).encode()).hexdigest(), _joined(every)))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", *names])

    # Only texts that can hold a span travel to Python.
    text = F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text")
    return rows_of(docs).select("doc_id", text).mapInArrow(run, SCHEMA)


def _masked(model):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for text in batch.column("_t").to_pylist():
                if text is not None:
                    found = base_spans(text)
                    end, parts = 0, []
                    for a, b, kind in sorted((a, b, k) for k, a, b in found + added_spans(model, text, found)):
                        if a < end:  # spans of two kinds can overlap: the first one's mark stands for both
                            end = max(end, b)
                            continue
                        parts.append(text[end:a] + f"<{KINDS[kind]}>")
                        end = b
                    text = "".join(parts) + text[end:]
                out.append(text)
            names = batch.schema.names
            columns = [batch.column(n) if n != "_t" else pa.array(out, pa.string()) for n in names]
            yield pa.record_batch(columns, names=names)

    return run


def mask_personal_data(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, such as ``<email>``; ``n_chars``, if there, is counted anew."""
    model = train(docs) if model is None else model
    touched = F.when(F.col("text").rlike("[0-9@]"), F.col("text").cast("string")).alias("_t")
    wide = docs.select(F.struct("*").alias("_row"), touched)
    done = wide.mapInArrow(_masked(model), wide.schema)
    text = F.coalesce("_t", F.col("_row.text").cast("string"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(text.alias(c))
        elif c == "n_chars":
            columns.append(F.when(F.col("_t").isNotNull(), F.length("_t").cast(docs.schema[c].dataType)).otherwise(F.col("_row.n_chars")).alias(c))
        else:
            columns.append(F.col(f"_row.`{c}`").alias(c))
    return done.select(*columns)
