"""Phrase collocations: contiguous word n-grams counted without loss in quotient filters, scored by their weakest cut.

A phrase that occurs ``LEAST`` times has only words that do, so only those get ids (a table, never collected); every other
word ends a phrase but counts in ``n``.  Texts are coded in blocks, blocks ask the word table for the ids of their distinct
words, tasks count packed n-grams of ids in quotient filters (``quotient``), and the filters of one key range are merged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import quotient
from tidemark.llm.blocks import BLOCK_BYTES, block_answers, document_runs, expanded, met_again, numbered, squeezed
from tidemark.llm.common import rows_of, save_table, text_buffers, word_bounds

LEAST = 10  # a candidate occurs so often
COVERED = 50  # a longer candidate with so many hundredths of the occurrences takes a phrase's place
TOP = 2000
SCALE = 1_000_000
#: N-grams a task counts before it writes a filter, and occurrences per key range.
HELD = RANGE = 1 << 20
#: Word ids are dealt out within so many hash buckets, so no task numbers the whole vocabulary.
ID_BUCKETS = 1024
WORDS_BEFORE = quotient.WORDS - 1


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte value: its lower case (A-Z only), is it inside a word, does it end a piece."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    cuts = np.zeros(256, bool)
    cuts[list(b".,;:!?\n\x0b\x0c\r")] = True
    inside = ~cuts
    inside[list(b" \t")] = False
    return lower, inside, cuts


def segments(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, size: int = BLOCK_BYTES):
    """(first, last document, from, to, skipped words) of bounded parts of the texts that together hold every word once.

    A longer document is cut between words; a part then begins with up to two words of the part before, which are skipped:
    they only let phrases go over the cut.
    """
    for i, j in document_runs(np.diff(offsets), size):
        start, stop = int(offsets[i]), int(offsets[j])
        if stop - start <= size:
            yield i, j, start, stop, 0
            continue
        at = start
        while at < stop:
            end = min(at + size, stop)
            while end < stop and inside[data[end]]:  # to the end of the word
                gap = np.flatnonzero(~inside[data[end : end + 65536]])
                end = end + int(gap[0]) if len(gap) else min(end + 65536, stop)
            back, skipped = at, 0
            while back > start and skipped < WORDS_BEFORE:
                lead = back
                while lead > start and not inside[data[lead - 1]]:
                    lead -= 1
                if lead == start:
                    break
                back = lead
                while back > start and inside[data[back - 1]]:
                    reach = max(start, back - 65536)
                    gap = np.flatnonzero(~inside[data[reach:back]])
                    back = reach + int(gap[-1]) + 1 if len(gap) else reach
                skipped += 1
            yield i, j, back, end, skipped
            at = end


def _coded(batches):
    """Per block: its distinct (lang, word) with how often they occur, then the block's words as numbers of those entries.

    A negative number starts a new piece.
    """
    import pyarrow as pa

    lower, inside, cuts = _classes()
    number = numbered()
    schema = pa.schema([("block", pa.int64()), ("local", pa.int32()), ("lang", pa.string()), ("word", pa.binary()),
                        ("n", pa.int64()), ("body", pa.binary())])
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        langs = batch.column("lang").dictionary_encode()
        lang_of, lang_names = np.asarray(langs.indices), langs.dictionary
        for i, j, begin, stop, skipped in segments(data, offsets, inside):
            part = lower[data[begin:stop]]
            places = np.clip(offsets[i : j + 1], begin, stop) - begin
            start, end, per_doc = word_bounds(part, places, inside)
            if len(start) <= skipped:
                continue
            doc = np.repeat(np.arange(j - i), per_doc)
            piece = np.cumsum(cuts[part], dtype=np.int32)[start] + doc
            ends = np.concatenate([[0], np.cumsum(end - start)])
            flat = part[inside[part]].tobytes()
            words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)])
            words = words.dictionary_encode()
            key = lang_of[i:j][doc].astype(np.int64) * len(words.dictionary) + np.asarray(words.indices)
            entry, code = np.unique(key, return_inverse=True)
            n = np.bincount(code[skipped:], minlength=len(entry))
            code = code.astype(np.int32) + 1
            code[1:][piece[1:] != piece[:-1]] *= -1
            block = next(number)
            yield pa.record_batch([
                pa.array(np.full(len(entry), block)), pa.array(np.arange(1, len(entry) + 1, dtype=np.int32)),
                lang_names.take(pa.array(entry // len(words.dictionary))).cast(pa.string()),
                words.dictionary.take(pa.array(entry % len(words.dictionary))).cast(pa.binary()), pa.array(n),
                pa.nulls(len(entry), pa.binary())], schema=schema)
            body = squeezed(np.array([skipped], np.int64), code)
            yield pa.record_batch([[block], [None], [None], [None], [None], [body]], schema=schema)


def _ngram_keys(ids: np.ndarray, new: np.ndarray, skipped: int, id_bits: int):
    """Permuted keys of all n-grams of 2 and 3 words with ids that lie in one piece and end after the skipped words."""
    pair = (ids[:-1] > 0) & (ids[1:] > 0) & ~new[1:]
    two = np.flatnonzero(pair)
    two = two[two + 1 >= skipped]
    three = np.flatnonzero(pair[:-1] & pair[1:])
    three = three[three + 2 >= skipped]
    x = np.concatenate([ids[two], ids[three]])
    y = np.concatenate([ids[two + 1], ids[three + 1]])
    z = np.concatenate([np.zeros(len(two), np.uint64), ids[three + 2]])
    return quotient.permuted(*quotient.packed(x, y, z, id_bits), quotient.half_bits(id_bits))


def _filters(batches, id_bits: int, prefix: int, held: int = HELD):
    """Filters (range, filter) of the n-grams of this task's blocks, one for each range and ``held`` n-grams."""
    import pyarrow as pa

    half = quotient.half_bits(id_bits)
    waiting, size = [], 0

    def flush():
        left, right = (np.concatenate(c) for c in zip(*waiting, strict=True))
        left, right, count = quotient.folded(left, right, None, half)
        part = left >> np.uint64(half - prefix)
        first = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
        out = [quotient.written(left[a:b], right[a:b], count[a:b], half, prefix)
               for a, b in zip(first, [*first[1:], len(left)], strict=True)]
        return pa.record_batch([pa.array(part[first].astype(np.int64)), pa.array(out, pa.binary())], names=["range", "filter"])

    for _, (local, found), body in block_answers(batches, ["local", "id"]):
        (skipped,), code = expanded(body)
        number = np.abs(code)
        table = np.zeros(int(number.max()) + 1, np.uint64)
        table[local] = found.astype(np.uint64)
        keys = _ngram_keys(table[number], code < 0, int(skipped), id_bits)
        if len(keys[0]):
            waiting.append(keys)
            size += len(keys[0])
        if size >= held:
            yield flush()
            waiting, size = [], 0
    if size:
        yield flush()


def _merged(batches, id_bits: int, prefix: int, least: int, held: int = HELD):
    """N-grams (x, y, z, f) of at least ``least`` occurrences, from filters whose ranges follow each other."""
    import pyarrow as pa

    half = quotient.half_bits(id_bits)
    current, waiting, size, done = None, [], 0, 0

    def merge():
        return quotient.folded(*(np.concatenate(c) for c in zip(*waiting, strict=True)), half)

    def rows():
        left, right, count = merge()
        often = count >= least
        ids = quotient.unpacked_ids(*quotient.restored(left[often], right[often], half), id_bits)
        return pa.record_batch([*(pa.array(c.astype(np.int64)) for c in ids), pa.array(count[often])], names=["x", "y", "z", "f"])

    for batch in batches:
        for part, raw in zip(batch.column("range").to_pylist(), batch.column("filter"), strict=True):
            if part != current and waiting:
                yield rows()
                waiting, size, done = [], 0, 0
            current = part
            waiting.append(quotient.read(raw.as_buffer(), part, half, prefix))
            size += len(waiting[-1][0])
            if size >= held + 2 * done:  # keys not merged yet stay in proportion to the merged ones
                waiting = [merge()]
                size = done = len(waiting[0][0])
    if waiting:
        yield rows()


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in exact decimals (counts below 10**15); at most 1,000,000, as l and r are at least a."""
    exact = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", exact(a) * exact(a) * F.lit(SCALE).cast("decimal(7,0)"), exact(left) * exact(right))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables (lang, n) of all words, (lang, word, id, f) of words and (x, y, z, f) of n-grams of word ids (z = 0: two words)
    that occur ``least`` times or more.  Counts are exact."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    coded = save_table(rows_of(docs, lang).select("text", "lang").mapInArrow(
        _coded, "block long, local int, lang string, word binary, n long, body binary"), "phrase-blocks")
    entries, bodies = coded.filter("body IS NULL"), coded.filter("body IS NOT NULL")
    totals = save_table(entries.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    often = entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(ID_BUCKETS))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    words = save_table(often.withColumn("bucket", bucket).select(
        "lang", "word", "f", (place.cast("long") * ID_BUCKETS + F.col("bucket")).alias("id")), "phrase-words")
    top = words.agg(F.max("id")).first()[0] or 1
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    id_bits = int(top).bit_length()
    prefix = min(max(0, (2 * all_words // RANGE).bit_length()), quotient.half_bits(id_bits))
    answers = entries.join(words.select("lang", "word", "id"), ["lang", "word"]).select("block", "local", "id")
    filters = met_again(bodies, answers).mapInArrow(lambda b: _filters(b, id_bits, prefix), "range long, filter binary")
    filters = filters.repartition("range").sortWithinPartitions("range")
    grams = save_table(filters.mapInArrow(lambda b: _merged(b, id_bits, prefix, least), "x long, y long, z long, f long"), "phrase-grams")
    return totals, words, grams


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 or 3 words.

    ``docs`` has ``text`` (NULL: empty) and ``lang`` (NULL: ``und``); whatever else it has is ignored.  Equal rows count each.
    A language without candidates has no rows, nor has an empty table.  Texts may be of any length.
    """
    totals, words, grams = phrase_counts(docs, least)
    word = lambda at: words.select(F.col("id").alias(at), F.col("word").alias(f"word_{at}"), F.col("f").alias(f"f_{at}"))
    pairs = grams.filter("z = 0").select("x", "y", F.col("f").alias("f_xy"))
    triples = grams.filter("z > 0")

    longer = triples.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("z").alias("y")))).alias("p"), "f")
    longer = longer.groupBy("p.x", "p.y").agg(F.max("f").alias("longest"))
    alone = pairs.join(longer, ["x", "y"], "left").filter(F.coalesce(100 * F.col("longest") < covered * F.col("f_xy"), F.lit(True)))
    named = words.select(F.col("id").alias("x"), "lang", F.col("word").alias("word_x"), F.col("f").alias("f_x"))
    two = alone.join(named, "x").join(word("y"), "y").select(
        "lang", F.concat("word_x", F.lit(b" "), "word_y").alias("phrase"), F.col("f_xy").alias("a"),
        F.col("f_x").alias("l"), F.col("f_y").alias("r"), _score(F.col("f_xy"), F.col("f_x"), F.col("f_y")).alias("score"))

    three = triples.join(pairs, ["x", "y"]).join(pairs.toDF("y", "z", "f_yz"), ["y", "z"])
    three = three.join(named, "x").join(word("y"), "y").join(word("z"), "z")
    cut = lambda left, right: F.struct(_score(F.col("f"), F.col(left), F.col(right)).alias("score"),
                                       F.col(left).alias("l"), F.col(right).alias("r"))
    three = three.withColumn("first", cut("f_x", "f_yz")).withColumn("second", cut("f_xy", "f_z"))
    lowest = F.when(F.col("second.score") < F.col("first.score"), F.col("second")).otherwise(F.col("first"))
    three = three.withColumn("cut", lowest).select(
        "lang", F.concat("word_x", F.lit(b" "), "word_y", F.lit(b" "), "word_z").alias("phrase"), F.col("f").alias("a"),
        "cut.l", "cut.r", "cut.score")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")
