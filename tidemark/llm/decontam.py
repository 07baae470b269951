"""Benchmark decontamination by template canonicalisation.

Texts are read as tokens: runs of letters, and numbers.  Numbers, names (capitalised words inside a sentence) and units
(after a number) become typed placeholders; the rest is lower-cased.  Windows of WINDOW canonical tokens are hash-joined with
those of the benchmark.  RUN tokens in a row (or a whole shorter item) whose windows all match along one alignment are a hit
if their slots are consistent: equal benchmark values stand for equal values in the document and different ones for different
ones, so a question asked again with other numbers or names is found, and a text of the same shape with unrelated fillings is
not.  Every stretch is judged by itself, so what a copy holds further on does not acquit it.

Beside the templates, RUN tokens in a row that are equal as written (lower-cased; capitals of all scripts up to three bytes), or a whole shorter item of any length, are
a hit whatever they hold and whatever stands around them.  A capital that opens a sentence may be a name or not, so both
readings are tried, in texts and items alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import BASE, MIX_B, blocks, byte_codes, mixed, rows_of, run_hashes, save_table, text_buffers

WINDOW = 8
LITERALS = 5  # at least so many tokens of a window are words, not placeholders
RUN = 13  # tokens that must match in a row; a shorter item must match whole
#: Up to so many benchmark windows (8 bytes each) their hashes are sent to all tasks as a filter before the join; beyond
#: that all windows are joined by a shuffle.  Results are the same.
FILTER_WINDOWS = 4_000_000
#: Up to so many ids of contaminated rows are broadcast to drop the rows.
BROADCAST_IDS = 2_000_000
#: Units of measure and currency words (fixed list).
UNITS = [
    "km", "m", "cm", "mm", "mi", "miles", "mile", "meters", "metres", "feet", "foot", "ft", "inches", "inch", "yards",
    "kg", "g", "mg", "lb", "lbs", "pounds", "tons", "grams", "liters", "litres", "l", "ml", "gallons",
    "s", "sec", "seconds", "second", "min", "minutes", "minute", "h", "hours", "hour", "days", "day", "weeks", "week",
    "months", "month", "years", "year", "percent", "dollars", "dollar", "cents", "euros", "euro", "degrees",
    "mph", "kmh", "kwh", "w", "kw", "mw", "v", "hz", "khz", "mhz", "ghz", "kb", "mb", "gb", "tb",
]
NUMBER_CODE, NAME_CODE, UNIT_CODE = mixed(np.array([11, 13, 17], np.uint64))


def _classes() -> tuple[np.ndarray, ...]:
    """Letters, digits, codes of bytes; the lower case of every character of up to three bytes, and whether it is a capital.

    A character whose lower case has another number of bytes, or of characters, is left as it is.
    """
    letters, digits = np.zeros(256, bool), np.zeros(256, bool)
    letters[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    digits[48:58] = True
    lower = np.arange(1 << 16)
    size = lambda c: 1 if c < 128 else 2 if c < 2048 else 3
    for c in range(1 << 16):
        small = chr(c).lower()
        if len(small) == 1 and ord(small) < 1 << 16 and size(ord(small)) == size(c):
            lower[c] = ord(small)
    return letters, digits, byte_codes(), lower, lower != np.arange(1 << 16)


def _lowered(data: np.ndarray, lower: np.ndarray, capital: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in lower case, and which of them begin a capital."""
    out, begins = data.copy(), np.zeros(len(data), bool)
    big = np.flatnonzero(capital[:128][np.minimum(data, 127)] & (data < 128))
    out[big] = lower[data[big]]
    begins[big] = True
    for first, past, length, mask in ((0xC2, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F)):
        at = np.flatnonzero((data >= first) & (data < past))
        at = at[at + length <= len(data)]
        code = data[at].astype(np.int64) & mask
        for k in range(1, length):
            code = code << 6 | (data[at + k] & 0x3F)
        big = capital[code]
        at, code = at[big], lower[code[big]]
        begins[at] = True
        for k in reversed(range(1, length)):
            out[at + k] = 0x80 | code & 0x3F
            code = code >> 6
        out[at] = (0xC0 if length == 2 else 0xE0) | code
    return out, begins


def _hash(words: list[str], table: np.ndarray) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return run_hashes(data, np.concatenate([[0], ends[:-1]]), ends, table)


def tokens(data: np.ndarray, offsets: np.ndarray, tables=None):
    """Of a block of documents: canonical codes, hashes of the tokens as written (lower case), is-placeholder, is a capital that
    opens a sentence, tokens per document."""
    letters, digits, codes, lower, capitals = tables or _classes()
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool), np.zeros(len(offsets) - 1, np.int64)
    kind = letters[data].astype(np.int8)
    is_digit = digits[data]
    inner = np.zeros(n, bool)  # a point or comma between digits belongs to the number
    inner[1:-1] = ((data[1:-1] == 46) | (data[1:-1] == 44)) & is_digit[:-2] & is_digit[2:]
    kind[is_digit | inner] = 2
    cut = offsets[(offsets > 0) & (offsets < n)]
    first = kind > 0
    first[1:] &= kind[1:] != kind[:-1]
    first[cut] = kind[cut] > 0
    last = kind > 0
    last[:-1] &= kind[1:] != kind[:-1]
    last[cut - 1] = kind[cut - 1] > 0
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    per_doc = np.diff(np.searchsorted(start, offsets))
    small, capital_at = _lowered(data, lower, capitals)
    raw = run_hashes(small, start, end, codes)
    of = kind[start]
    # sentence starts: the first token of a document, and those with a sentence's end (or a line's) just before
    breaks = np.zeros(256, bool)
    breaks[[10, 33, 46, 58, 63]] = True  # \n ! . : ?
    count = np.concatenate([[0], np.cumsum(breaks[data] & ~inner)])
    opens = np.ones(len(start), bool)
    opens[1:] = count[start[1:]] != count[end[:-1]]
    document_first = (np.cumsum(per_doc) - per_doc)[per_doc > 0]
    opens[document_first] = True
    capital = (of == 1) & capital_at[start]
    name = capital & ~opens
    number = of == 2
    after_number = np.zeros(len(start), bool)
    after_number[1:] = number[:-1] & (start[1:] - end[:-1] <= 1)
    after_number[document_first] = False
    unit = np.zeros(len(start), bool)
    maybe = np.flatnonzero(after_number & (of == 1))
    if len(maybe):
        unit[maybe] = np.isin(raw[maybe], _hash(UNITS, codes))
    canonical = raw.copy()
    canonical[name] = NAME_CODE
    canonical[number] = NUMBER_CODE
    canonical[unit] = UNIT_CODE
    return canonical, raw, name | number | unit, capital & opens & ~unit, per_doc


#: Sets of places of a window that are read as names though their capitals may only open a sentence.
READINGS = [[k for k in range(WINDOW) if m >> k & 1] for m in range(1, 1 << WINDOW) if m.bit_count() <= WINDOW - LITERALS]


def template_windows(canonical, slot, opening, per_doc):
    """(hash, document, place, first token, places read as names) of all windows with enough literals.

    The places are bits; a window comes once per reading of the capitals that open a sentence.
    """
    n = len(canonical) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    doc = np.repeat(np.arange(len(per_doc), dtype=np.int64), per_doc)
    filled = np.concatenate([[0], np.cumsum(slot)])
    left = WINDOW - LITERALS - (filled[WINDOW:] - filled[:n])
    good = (doc[:n] == doc[WINDOW - 1 :]) & (left >= 0)
    at = np.flatnonzero(good)
    opens = np.zeros(n, np.int64)
    with np.errstate(over="ignore"):
        code = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            code = code * BASE + canonical[k : k + n]
            opens += opening[k : k + n].astype(np.int64) << k
        found = [(code[at], at, np.zeros(len(at), np.int64))]
        some = np.flatnonzero(good & (opens > 0) & (left > 0))
        weights = [np.uint64(pow(int(BASE), WINDOW - 1 - k, 1 << 64)) for k in range(WINDOW)]
        for places in READINGS if len(some) else ():
            bits = sum(1 << k for k in places)
            here = some[((opens[some] & bits) == bits) & (left[some] >= len(places))]
            if len(here):
                found.append((code[here] + sum((NAME_CODE - canonical[here + k]) * weights[k] for k in places), here,
                              np.full(len(here), bits, np.int64)))
    code, at, read = (np.concatenate(x) for x in zip(*found, strict=True))
    return mixed(code), doc[at], at - (np.cumsum(per_doc) - per_doc)[doc[at]], at, read


def written_windows(raw, per_doc, lengths):
    """(hash, document) of the runs of as many tokens as written as ``lengths`` says; None: RUN, or all of a shorter text."""
    doc = np.repeat(np.arange(len(per_doc), dtype=np.int64), per_doc)
    hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    code = np.zeros(len(raw), np.uint64)
    for k in range(min(RUN, len(raw))):
        with np.errstate(over="ignore"):
            n = len(raw) - k
            code = code[:n] * BASE + raw[k:]
            if lengths is not None and k + 1 not in lengths:
                continue
            good = doc[:n] == doc[k:]
            if lengths is None and k + 1 < RUN:
                good &= per_doc[doc[:n]] == k + 1
            hashes.append(mixed(code[good] + np.uint64(k + 1) * MIX_B))
        docs.append(doc[:n][good])
    return np.concatenate(hashes), np.concatenate(docs)


def _windows(wanted, lengths):
    """Rows (key, h, kind, pos, slots, n_tokens): slots are the written tokens of the window's placeholders, 8 bytes each.

    Kinds: WRITTEN, once per document (no place, no slots); AS_IS; OPENED, where a capital that opens a sentence is a name.
    """

    def run(batches):
        import pyarrow as pa

        tables = _classes()
        filter_ = wanted.value if wanted is not None else None
        bits = None
        if filter_ is not None:
            bits = np.zeros(1 << 22, bool)
            bits[(filter_ & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

        def kept(h):
            if filter_ is None:
                return np.arange(len(h))
            near = np.flatnonzero(bits[(h & np.uint64((1 << 22) - 1)).astype(np.int64)])
            return near[np.isin(h[near], filter_)]

        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for i, j in blocks(np.diff(offsets)):
                canonical, raw, slot, opening, per_doc = tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tables)
                h, doc, pos, at, read = template_windows(canonical, slot, opening, per_doc)
                near = kept(h)
                h, doc, pos, at, read = h[near], doc[near], pos[near], at[near], read[near]
                slots = [raw[a : a + WINDOW][slot[a : a + WINDOW] | (r >> np.arange(WINDOW) & 1).astype(bool)].tobytes()
                         for a, r in zip(at.tolist(), read.tolist(), strict=True)]
                g, of = written_windows(raw, per_doc, lengths)
                near = kept(g)
                g, of = g[near], of[near]
                order = np.lexsort((g, of))
                g, of = g[order], of[order]
                new = np.ones(len(g), bool)
                new[1:] = (g[1:] != g[:-1]) | (of[1:] != of[:-1])
                g, of = g[new], of[new]
                if not len(h) + len(g):
                    continue
                doc, kind = np.concatenate([doc, of]), np.concatenate([np.where(read > 0, OPENED, AS_IS), np.full(len(g), WRITTEN)])
                yield pa.record_batch(
                    [pa.array(keys[i:j][doc], pa.int64()), pa.array(np.concatenate([h, g]).view(np.int64)), pa.array(kind.astype(np.int32)),
                     pa.array(np.concatenate([pos, np.zeros(len(g), np.int64)]).astype(np.int64)),
                     pa.array(slots + [b""] * len(g), pa.binary()), pa.array(per_doc[doc].astype(np.int64))],
                    names=["key", "h", "kind", "pos", "slots", "n_tokens"])

    return run


WRITTEN, AS_IS, OPENED = -1, 0, 1
SCHEMA = "key long, h long, kind int, pos long, slots binary, n_tokens long"


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(rid, item_id): which rows of ``docs`` (their place, ``monotonically_increasing_id``) hold a passage of which item.

    ``benchmark`` has ``item_id`` and ``text``; items without tokens, and NULL texts, match nothing, and items of fewer than
    WINDOW tokens only as they are written.  Each pair comes once however often the passage is repeated.
    """
    spark = docs.sparkSession
    rows = rows_of(docs, F.monotonically_increasing_id().alias("key")).select("key", "text")
    items = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = save_table(items.withColumn("key", F.monotonically_increasing_id()), "benchmark")
    templates = save_table(items.select("key", "text").mapInArrow(_windows(None, None), SCHEMA), "templates")
    lengths = {min(r[0], RUN) for r in templates.filter(F.col("kind") == WRITTEN).select("n_tokens").distinct().collect()}
    wanted = None
    if templates.count() <= FILTER_WINDOWS:
        found = templates.select("h").distinct().toArrow().column("h").to_numpy()  # 8 bytes each
        wanted = spark.sparkContext.broadcast(np.sort(found.view(np.uint64)))
    theirs = templates.select("h", F.col("kind").alias("item_kind"), F.col("key").alias("item"), F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"),
                              F.least(F.col("n_tokens"), F.lit(RUN)).alias("need"))
    ours = rows.mapInArrow(_windows(wanted, lengths), SCHEMA).select(F.col("key").alias("rid"), "h", "kind", "pos", "slots")
    # runs are judged without the second readings too: what these add to a run must not make it inconsistent
    least, most = F.least("kind", "item_kind"), F.greatest("kind", "item_kind")
    readings = F.when(most == AS_IS, F.array(F.lit(AS_IS), F.lit(OPENED))).otherwise(F.array(most))
    hits = ours.join(theirs, "h").filter((least > WRITTEN) | (most == WRITTEN)).withColumn("reading", F.explode(readings))
    hits = hits.withColumn("shift", F.col("pos") - F.col("item_pos"))
    # of one place's readings that match, the one with the fewest names
    aligned = Window.partitionBy("rid", "item", "reading", "shift").orderBy("pos", F.octet_length("slots"), "slots")
    hits = hits.withColumn("before", F.lag("pos").over(aligned)).filter("before IS NULL OR before <> pos")
    cut = lambda c: F.when(F.octet_length(c) > 0, F.transform(
        F.sequence(F.lit(0), (F.octet_length(c) / 8 - 1).cast("int")), lambda k: F.hex(F.col(c).substr(k * 8 + 1, F.lit(8)))))
    empty = F.array().cast("array<string>")
    pairs = F.arrays_zip(F.coalesce(cut("item_slots"), empty).alias("b"), F.coalesce(cut("slots"), empty).alias("d"))
    # a stretch of ``need`` tokens is ``need - WINDOW + 1`` windows in a row, RUN - WINDOW + 1 at most
    ahead = Window.partitionBy("rid", "item", "reading", "shift").orderBy("pos").rowsBetween(0, RUN - WINDOW)
    length = F.col("need") - (WINDOW - 1)
    windows = hits.select("rid", "item", "reading", "shift", "pos", "need", pairs.alias("pairs"))
    stretch = windows.withColumn("ahead", F.collect_list(F.struct("pos", "pairs")).over(ahead))
    stretch = stretch.withColumn("ahead", F.when(length > 0, F.slice("ahead", F.lit(1), F.greatest(length, F.lit(1)))))
    slots = stretch.withColumn("pairs", F.array_distinct(F.flatten("ahead.pairs")))
    sides = [F.size(F.array_distinct(F.col(f"pairs.{side}"))) for side in ("b", "d")]
    unbroken = (F.size("ahead") == length) & (F.element_at("ahead.pos", -1) == F.col("pos") + length - 1)
    consistent = (sides[0] == F.size("pairs")) & (sides[1] == F.size("pairs"))
    good = slots.filter((F.col("reading") == WRITTEN) | (unbroken & consistent))
    return good.select("rid", "item").distinct().join(
        items.select(F.col("key").alias("item"), "item_id"), "item").select("rid", "item_id").distinct()


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, n_items, items (ids of the benchmark items found, ascending)."""
    hits = contamination(docs, benchmark).groupBy("rid").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"))
    items = F.coalesce("items", F.array().cast("array<long>"))
    return rows.join(hits, "rid", "left").select(
        "doc_id", (F.size(items) > 0).alias("contaminated"), F.size(items).alias("n_items"), items.alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage.

    NULL and empty texts hold none; repeated rows stay or go together; other columns may have any names.  Up to BROADCAST_IDS
    row numbers (8 bytes each, counted first) are sent to the rows, so that texts are not moved; beyond that both are shuffled.
    """
    whole = docs.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("rid"))
    gone = save_table(contamination(docs, benchmark).select("rid").distinct(), "contaminated")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return whole.join(gone, "rid", "left_anti").select("_row.*")
