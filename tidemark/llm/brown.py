"""Language-model scores by a Brown class-based bigram model.

Words are put into classes by exchange clustering: each unit moves to the class that raises the likelihood of the class
bigrams most, until a round moves little.  It starts on a table of fixed size, whose units are the frequent words (at least one
token in FREQUENT), each alone, and all others by their ending; then every training word is a unit of its own, moves by the
counts of its own neighbours' classes, and the result is kept if the likelihood grew.  Only words that no training document
holds have the class of their ending.  P(word | word before) = P(class | class before) * P(word | class); transitions are
smoothed towards the class frequencies, emissions by absolute discounting, whose freed mass is the class's share of unknown
words.

Counts of words are exact and cover all training documents.  They go by chunks, the partitions of the input: each chunk
sends its distinct words with their neighbours' classes, gets back their count over all chunks and their class, and is coded
with this dictionary.  So no vocabulary is ever held whole, and a word of every document is a bounded number of rows per chunk.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    blocks, byte_codes, fold, packed_texts, rows_of, run_hashes, save_table, space_table, text_buffers, unpacked, word_bounds)

HELD_OUT, FOLDS = 1, 5
CLASSES = 24
FREQUENT = 2000
ENDINGS = 384
DISCOUNT = 0.5
SWEEPS = 12
#: Training tokens whose neighbours meet in one task, and words that are weighed together there.
TASK_TOKENS, TOGETHER = 4_000_000, 1_000
EDGE, KNOWN = 0, 32  # the class of a text's edge; added to the class of a word that training documents hold


def lower_codes() -> np.ndarray:
    lower = np.arange(256)
    lower[65:91] += 32
    return byte_codes()[lower]


def words(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray):
    """Of a block: word hashes (A-Z lowered), the number of each word's ending, words per document."""
    start, end, per_doc = word_bounds(data, offsets, ~space_table())
    hashes = run_hashes(data, start, end, codes)
    ending = run_hashes(data, np.maximum(start, end - 3), end, codes) % np.uint64(ENDINGS)
    return hashes, ending.astype(np.int32), per_doc


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]):
    """Distinct hashes with their summed count."""
    import pandas as pd

    hashes, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    code, distinct = pd.factorize(hashes)
    return distinct, np.bincount(code, count, len(distinct)).astype(np.int64)


def _counted(batches):
    """(h, c): each distinct word of the partition once, with its count in training documents."""
    import pyarrow as pa

    codes, parts = lower_codes(), []
    for batch in batches:
        train = batch.column("train").to_numpy(zero_copy_only=False)
        data, offsets = text_buffers(batch.column("text"))
        found = []
        for i, j in blocks(np.diff(offsets)):
            hashes, _, per_doc = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], codes)
            found.append((hashes, np.repeat(train[i:j], per_doc).astype(np.float64)))
            if len(found) == 32:
                parts.append(_merged(found))
                found = []
        if found:
            parts.append(_merged(found))
        if len(parts) > 8:
            parts = [_merged(parts)]
    if parts:
        distinct, total = _merged(parts)
        distinct, total = distinct[total > 0], total[total > 0]
        for i in range(0, len(distinct), 50_000):
            s = slice(i, i + 50_000)
            yield pa.record_batch([pa.array(distinct[s].view(np.int64)), pa.array(total[s])], names=["h", "c"])


def units(hashes: np.ndarray, ending: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """1 + place among the frequent words (sorted hashes), or a number after them by ending; 0 is the text's edge."""
    place = np.minimum(np.searchsorted(seeds, hashes), max(len(seeds) - 1, 0))
    known = seeds[place] == hashes if len(seeds) else np.zeros(len(hashes), bool)
    return np.where(known, 1 + place, 1 + len(seeds) + ending)


def with_edges(values: np.ndarray, per_doc: np.ndarray, edge: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Values with ``edge`` after each document's last one (its end token), and each one's predecessor (the first one's is ``edge``)."""
    size = per_doc + 1
    out = np.full(int(size.sum()), edge, values.dtype)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    out[np.arange(len(values)) + doc] = values
    before = np.empty_like(out)
    before[1:] = out[:-1]
    if len(before):
        before[0] = edge  # (every other document follows the end token of the one before it)
    return out, before


def _pairs(seeds: np.ndarray):
    """(pair, n): bigrams of units of the partition's training documents, as first * U + second."""

    def run(batches):
        import pyarrow as pa

        codes, size = lower_codes(), 1 + len(seeds) + ENDINGS
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            data, offsets = text_buffers(batch.column("text"))
            for i, j in blocks(np.diff(offsets)):
                hashes, ending, per_doc = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], codes)
                unit, before = with_edges(units(hashes, ending, seeds), per_doc)
                total += np.bincount((before * size + unit)[np.repeat(train[i:j], per_doc + 1)], minlength=size * size)
        some = np.flatnonzero(total)
        for i in range(0, len(some), 50_000):
            yield pa.record_batch([pa.array(some[i : i + 50_000]), pa.array(total[some[i : i + 50_000]])], names=["pair", "n"])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def exchange(counts: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit (0 for unit 0 alone) that maximises the class-bigram likelihood, by exchange (Martin et al. 1998)."""
    n = len(counts)
    weight = counts.sum(axis=1) + counts.sum(axis=0)
    order = [u for u in np.argsort(-weight, kind="stable").tolist() if u and weight[u] > 0]
    of = np.zeros(n, np.int64)
    for i, u in enumerate(order):
        of[u] = 1 + i % classes
    k = classes + 1
    member = np.zeros((n, k))
    member[np.arange(n), of] = 1
    member[(weight == 0) & (np.arange(n) > 0)] = 0  # units without tokens join no counts
    table = member.T @ counts @ member
    for _ in range(sweeps):
        moved = 0
        for u in order:
            old = of[u]
            right, left, self_ = counts[u] @ member, counts[:, u] @ member, counts[u, u]
            right[old] -= self_
            left[old] -= self_
            table[old] -= right
            table[:, old] -= left
            table[old, old] -= self_
            member[u, old] = 0
            # gain of joining class c: rows and columns of c change, its diagonal by both sides
            row, column = table.sum(axis=1), table.sum(axis=0)
            gain = (_xlogx(table + right) - _xlogx(table)).sum(axis=1) + (_xlogx(table.T + left) - _xlogx(table.T)).sum(axis=1)
            diagonal = table.diagonal()
            gain += _xlogx(diagonal + right + left + self_) + _xlogx(diagonal) - _xlogx(diagonal + right) - _xlogx(diagonal + left)
            out, in_ = right.sum() + self_, left.sum() + self_
            gain -= _xlogx(row + out) - _xlogx(row) + _xlogx(column + in_) - _xlogx(column)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            moved += new != old
            of[u] = new
            member[u, new] = 1
            table[new] += right
            table[:, new] += left
            table[new, new] += self_
        if moved < 0.005 * len(order):
            break
    return of


def best_classes(table: np.ndarray, left: np.ndarray, right: np.ndarray, same: np.ndarray, old: np.ndarray) -> np.ndarray:
    """For each word the class it moves to while all others stay, as in ``exchange``.

    ``left`` and ``right`` count the classes before and after each word, ``same`` how often the word follows itself.
    """
    at = np.arange(len(old))
    left, right = left.copy(), right.copy()
    left[at, old] -= same
    right[at, old] -= same
    without = np.repeat(table[None], len(old), axis=0)
    without[at, old] -= right
    without[at, :, old] -= left
    without[at, old, old] -= same
    turned = without.transpose(0, 2, 1)
    plain = _xlogx(without)
    gain = (_xlogx(without + right[:, None]) - plain).sum(axis=2) + (_xlogx(turned + left[:, None]) - plain.transpose(0, 2, 1)).sum(axis=2)
    diagonal, each = np.einsum("bii->bi", without), same[:, None]
    gain += _xlogx(diagonal + right + left + each) + _xlogx(diagonal) - _xlogx(diagonal + right) - _xlogx(diagonal + left)
    row, column = without.sum(axis=2), without.sum(axis=1)
    gain -= _xlogx(row + right.sum(axis=1, keepdims=True) + each) - _xlogx(row)
    gain -= _xlogx(column + left.sum(axis=1, keepdims=True) + each) - _xlogx(column)
    gain[:, EDGE] = -np.inf
    new = gain.argmax(axis=1)
    return np.where(gain[at, new] > gain[at, old] + 1e-9, new, old)


def likelihood(table: np.ndarray) -> float:
    """Of the class bigrams, but for a summand that no clustering changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def _neighbours(seeds: np.ndarray, of: np.ndarray):
    """(h, chunk, around, n, old): how often a word of the chunk stands between two classes (before * classes + after) in training
    documents; -1 for a word seen elsewhere only, -2 counts its repeats of itself; ``old`` is its class."""
    k = CLASSES + 1

    def distinct(keys: list[np.ndarray], counts: list[np.ndarray]):
        key, which = np.unique(np.concatenate(keys), return_inverse=True)
        return [key], [np.bincount(which, np.concatenate(counts), len(key)).astype(np.int64)]

    def run(batches):
        import pandas as pd
        import pyarrow as pa

        codes, chunk = lower_codes(), 0
        names, old, known = np.zeros(0, np.uint64), np.zeros(0, np.int8), pd.Index(np.zeros(0, np.uint64))
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk = batch.column("chunk")[0].as_py()
            in_training = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            data, offsets = text_buffers(batch.column("text"))
            for i, j in blocks(np.diff(offsets)):
                hashes, ending, per_doc = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], codes)
                if not len(hashes):
                    continue
                code, here = pd.factorize(hashes)
                first = np.zeros(len(here), np.int64)
                first[code[::-1]] = np.arange(len(hashes))[::-1]
                own = of[units(here, ending[first], seeds)]
                spot = known.get_indexer(here)
                new = spot < 0
                spot[new] = len(names) + np.arange(int(new.sum()))
                if new.any():
                    names, old = np.append(names, here[new]), np.append(old, own[new].astype(np.int8))
                    known = pd.Index(names)
                class_, before = with_edges(own[code], per_doc)
                word, _ = with_edges(spot[code], per_doc, -1)
                after = np.append(class_[1:], EDGE)
                around = np.where(np.repeat(in_training[i:j], per_doc + 1), before * k + after, -1)
                again = (word[1:] == word[:-1]) & (word[1:] >= 0) & (around[1:] >= 0)
                found = np.concatenate([(word * (k * k + 2) + around + 2)[word >= 0], word[1:][again] * (k * k + 2)])
                key, n = np.unique(found, return_counts=True)
                keys.append(key)
                counts.append(n)
            if sum(map(len, keys)) > 2 * len(keys[0]) + TASK_TOKENS:
                keys, counts = distinct(keys, counts)
        (key,), (n,) = distinct(keys, counts)
        word, around = np.divmod(key, k * k + 2)
        for i in range(0, len(key), 50_000):
            s = slice(i, i + 50_000)
            yield pa.record_batch([
                pa.array(names[word[s]].view(np.int64)), pa.array(np.full(len(word[s]), chunk, np.int32)),
                pa.array((around[s] - 2).astype(np.int16)), pa.array(n[s].astype(np.int32)), pa.array(old[word[s]])],
                names=["h", "chunk", "around", "n", "old"])

    return run


def _moved(table: np.ndarray):
    """All ``_neighbours`` of some words to (h, chunk, total, old, class), one row for each word and chunk."""
    k = len(table)

    def run(batches):
        import pandas as pd
        import pyarrow as pa

        parts = [[b.column(c).to_numpy(zero_copy_only=False) for c in ("h", "chunk", "around", "n", "old")] for b in batches if b.num_rows]
        if not parts:
            return
        h, chunk, around, n, kept = (np.concatenate(x) for x in zip(*parts, strict=True))
        code, names = pd.factorize(h)
        old = np.zeros(len(names), np.int64)
        old[code] = kept
        seen = around >= 0
        total = np.bincount(code[seen], n[seen], len(names)).astype(np.int64)
        class_ = old.copy()
        # Words seen once differ by their class and the two beside it alone.
        once = seen & (total[code] == 1)
        cases, which = np.unique(old[code[once]] * (k * k) + around[once], return_inverse=True)
        sides = np.eye(k)
        moves = [best_classes(table, sides[c % (k * k) // k], sides[c % k], np.zeros(len(c)), c // (k * k))
                 for c in np.split(cases, range(TOGETHER, len(cases), TOGETHER))]
        class_[code[once]] = np.concatenate(moves)[which]
        often = np.flatnonzero(total > 1)
        place = np.full(len(names), -1)
        place[often] = np.arange(len(often))
        rows = np.flatnonzero((place[code] >= 0) & (around != -1))
        rows = rows[np.argsort(place[code[rows]], kind="stable")]
        spot = place[code[rows]]
        for at in range(0, len(often), TOGETHER):
            some = slice(*np.searchsorted(spot, [at, at + TOGETHER]))
            size = min(TOGETHER, len(often) - at)
            word, beside, count = spot[some] - at, around[rows[some]].astype(np.int64), n[rows[some]].astype(np.float64)
            of_two = beside >= 0
            left = np.bincount((word * k + beside // k)[of_two], count[of_two], size * k).reshape(size, k)
            right = np.bincount((word * k + beside % k)[of_two], count[of_two], size * k).reshape(size, k)
            same = np.bincount(word[~of_two], count[~of_two], size)
            which = often[at : at + size]
            class_[which] = best_classes(table, left, right, same, old[which])
        pair = np.unique(code * (1 << 32) + chunk.astype(np.int64))  # (chunks are numbers of partitions, from 0)
        word, chunk = pair >> 32, (pair & 0xFFFFFFFF).astype(np.int32)
        first = np.append(True, word[1:] != word[:-1])
        for i in range(0, len(word), 50_000):
            s = slice(i, i + 50_000)
            yield pa.record_batch([
                pa.array(names[word[s]]), pa.array(chunk[s]), pa.array(total[word[s]]), pa.array(old[word[s]].astype(np.int8)),
                pa.array(class_[word[s]].astype(np.int8)), pa.array(first[s])], names=["h", "chunk", "total", "old", "class", "first"])

    return run


def start(rows: DataFrame, documents: int) -> dict:
    """Numbers of tokens and distinct words, and the first classes, by frequent words and endings."""
    counted = rows.select("text", "train").mapInArrow(_counted, "h long, c long")
    totals = save_table(counted.groupBy("h").agg(F.sum("c").alias("total")), "word-counts")
    tokens = totals.agg(F.sum("total"), F.count("total")).first()
    n, distinct = (tokens[0] or 0) + documents, tokens[1] + (documents > 0)
    frequent = totals.filter(F.col("total") >= max(n / FREQUENT, 2)).select("h").collect()  # at most FREQUENT rows
    seeds = np.sort(np.array([r.h for r in frequent], np.int64).view(np.uint64))
    size = 1 + len(seeds) + ENDINGS
    pairs = rows.select("text", "train").mapInArrow(_pairs(seeds), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.zeros(size * size)
    for r in pairs.toArrow().to_batches():  # at most size**2 numbers, whatever the size of the corpus
        counts[r.column("pair").to_numpy(zero_copy_only=False)] = r.column("n").to_numpy(zero_copy_only=False)
    counts = counts.reshape(size, size)
    of = exchange(counts, CLASSES)
    member = np.eye(CLASSES + 1)[of]
    return {"seeds": seeds, "of": of, "table": member.T @ counts @ member, "n": int(n), "distinct": int(distinct),
            "documents": int(documents)}


def _coded(model: dict):
    """Texts as the classes of their words, with what else their scores need of the words' counts."""
    base_floor = model["n"] + 0.5 * (model["distinct"] + 1)
    end_base = np.log10((model["documents"] + 0.5) / base_floor)
    end_known = int(model["documents"] > 0)

    def run(blocks_, dictionary):
        import pyarrow as pa

        codes = lower_codes()
        keys = dictionary.column("h").to_numpy().view(np.uint64)
        order = np.argsort(keys, kind="stable")
        keys, totals, classes = keys[order], dictionary.column("total").to_numpy()[order], dictionary.column("class").to_numpy()[order]
        columns = []
        for block in blocks_.column("block"):
            (doc_id,), (null,), data, offsets = unpacked(block.as_py(), 1)
            hashes, _, per_doc = words(data, offsets, codes)
            place = np.searchsorted(keys, hashes)
            if len(hashes) and ((place >= len(keys)).any() or (keys[place] != hashes).any()):
                raise RuntimeError("a chunk lacks one of its own words: the input's partitions are not the same in every pass")
            count = totals[place]
            doc = np.repeat(np.arange(len(per_doc)), per_doc)
            base = np.bincount(doc, np.log10((count + 0.5) / base_floor), len(per_doc)) + end_base
            weight = np.bincount(doc, np.where(count > 0, np.log10(np.maximum(count - DISCOUNT, DISCOUNT)), 0), len(per_doc))
            known = np.bincount(doc, count > 0, len(per_doc)).astype(np.int64) + end_known
            bounds = pa.array(np.append(0, np.cumsum(per_doc)), pa.int64())
            beside = (classes[place] + KNOWN * (count > 0)).astype(np.uint8)
            beside = pa.Array.from_buffers(pa.large_binary(), len(per_doc), [None, bounds.buffers()[1], pa.py_buffer(beside)])
            columns.append([pa.array(doc_id, pa.int64(), mask=null), pa.array(per_doc + 1, pa.int64()), pa.array(known),
                            pa.array(base, pa.float64()), pa.array(weight, pa.float64()), beside.cast(pa.binary())])
        names = ["doc_id", "n_tokens", "n_known", "base_score", "weight", "classes"]
        if not columns:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())], names=names)
        return pa.concat_tables([pa.table(c, names=names) for c in columns])

    return run


def _of_texts(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of classes: all in a row, which are known words, and how many each text has."""
    data, offsets = text_buffers(column)
    data = data[offsets[0] : offsets[-1]]
    return (data & (KNOWN - 1)).astype(np.int64), data >= KNOWN, np.diff(offsets)


def _class_pairs(batches):
    """(pair, n): class bigrams of the partition's training documents."""
    import pyarrow as pa

    k = CLASSES + 1
    total = np.zeros(k * k, np.int64)
    for batch in batches:
        own, _, per_doc = _of_texts(batch.column("classes"))
        class_, before = with_edges(own, per_doc)
        train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        total += np.bincount((before * k + class_)[np.repeat(train, per_doc + 1)], minlength=k * k)
    yield pa.record_batch([pa.array(np.arange(k * k)), pa.array(total)], names=["pair", "n"])


def _scores(table: np.ndarray, types: np.ndarray):
    """Scores by transitions between classes (``table``) and the known words of each class (``types``)."""
    share = (table.sum(axis=0) + 0.5) / (table.sum() + 0.5 * len(table))
    transition = np.log10((table + share) / (table.sum(axis=1, keepdims=True) + 1.0))
    below = table.sum(axis=0) + DISCOUNT
    unknown = np.log10((DISCOUNT * types + DISCOUNT) / below)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            own, known, per_doc = _of_texts(batch.column("classes"))
            class_, before = with_edges(own, per_doc)
            score = np.bincount(np.repeat(np.arange(len(per_doc)), per_doc + 1), transition[before, class_], len(per_doc))
            emission = np.where(known, -np.log10(below)[own], unknown[own])
            score += np.bincount(np.repeat(np.arange(len(per_doc)), per_doc), emission, len(per_doc))
            score += batch.column("weight").to_numpy()
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "n_tokens", "n_known", "base_score")), pa.array(score)],
                                  names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def clustered(rows: DataFrame, model: dict) -> DataFrame:
    """Each word of each chunk with its total, its first class (``old``) and the one it moves to; ``first`` once for each word."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-model["n"] // TASK_TOKENS))
    around = rows.select("text", "chunk", "train").mapInArrow(
        _neighbours(model["seeds"], model["of"]), "h long, chunk int, around short, n int, old byte")
    # (a word has at most a row per chunk and pair of classes, so the rows of a hot word grow with the chunks alone)
    return save_table(around.repartition(tasks, "h").mapInArrow(
        _moved(model["table"]), "h long, chunk int, total long, old byte, class byte, first boolean"), "word-classes")


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    A text without words has its end token only.  ``docs`` has to be a table or file read (its partitions must hold the same
    rows in every pass).  Words are told apart by 64-bit hashes; among ten million words the chance of any clash is 3e-6.
    """
    held = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    rows = rows_of(docs, F.spark_partition_id().alias("chunk"), (~held).cast("int").alias("train"))
    documents = rows.agg(F.coalesce(F.sum("train"), F.lit(0))).first()[0]
    model = start(rows, documents)
    dictionary = clustered(rows, model)
    packed = packed_texts(rows.select("doc_id", "text", "chunk"), "doc_id").groupBy("chunk")
    for column in ("class", "old"):
        classed = dictionary.select("chunk", "h", "total", F.col(column).alias("class"))
        coded = save_table(packed.cogroup(classed.groupBy("chunk")).applyInArrow(
            _coded(model), "doc_id long, n_tokens long, n_known long, base_score double, weight double, classes binary"), "class-texts")
        pairs = coded.select("classes", (~held).cast("int").alias("train")).mapInArrow(_class_pairs, "pair long, n long")
        table = np.zeros((CLASSES + 1) ** 2)
        for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # a number for each pair of classes
            table[r.pair] = r.n
        table = table.reshape(CLASSES + 1, CLASSES + 1)
        if likelihood(table) >= likelihood(model["table"]):
            break
    types = np.zeros(CLASSES + 1)
    for r in dictionary.filter(F.col("first") & (F.col("total") > 0)).groupBy(F.col(column).alias("class")).count().collect():
        types[r["class"]] = r["count"]
    scored = coded.mapInArrow(
        _scores(table, types), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(model["n"]).cast("long").alias("train_tokens"), "base_score", "score")
