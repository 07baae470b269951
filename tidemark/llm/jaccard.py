"""Texts whose sets of word n-grams are alike: prefix filtering over n-grams ordered from rare to frequent.

Two sets of a Jaccard similarity of at least PERCENT share an n-gram of their prefixes, the rarest tenth of each.  How many
sets hold an n-gram is counted over all of them: blocks of texts send their sorted fingerprints as quotient filters by key
range, a range adds them up and answers each block in the order it asked.  An n-gram of one set only can join nothing and is
left out of the prefixes.  What shares a prefix n-gram passes length, positional and suffix filters before the sets are compared.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import quotient
from tidemark.llm.blocks import block_answers, document_runs, expanded, met_again, numbered, squeezed
from tidemark.llm.common import BASE, block_words, byte_codes, mixed, rows_of, save_table, text_buffers, windows
from tidemark.llm.graph import components

SHINGLE = 3
PERCENT = 90
#: Fingerprints have so many bits more than the number of n-grams; equal ones of different n-grams only make these look less rare.
SPARE_BITS = 12
#: Fingerprints a key range holds, about.
RANGE = 1 << 20
#: Up to so many ids (8 bytes each, counted first) are broadcast to pick rows; beyond it they are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Sets of one bucket are compared in blocks of about so many n-grams, and in runs of so many.
CELL = 1 << 21
COMPARED = 1 << 18
#: Hash ranges whose sizes the suffix filter compares.
PIVOTS = 64


def _codes() -> np.ndarray:
    table = byte_codes()
    table[65:91] = table[97:123]
    return table


def needed(n, m):
    """The least intersection of linked sets of sizes ``n`` and ``m``: 100 i >= PERCENT (n + m - i)."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def prefix_size(n):
    """So many of a set's n-grams in any fixed order hold one of every linked set's prefix."""
    return n - (-(-PERCENT * n // 100)) + 1


def text_sets(data: np.ndarray, offsets: np.ndarray):
    """For blocks of documents: (first, last, n-gram hashes ordered by document and hash, document of each); distinct in a
    document.  A text of fewer words than an n-gram has one, all its words; a text without words has none."""
    for i, j, hashes, per_doc in block_words(data, offsets, _codes()):
        gram, doc, _ = windows(hashes, per_doc, SHINGLE)
        short = np.flatnonzero((per_doc > 0) & (per_doc < SHINGLE))
        if len(short):
            first = (np.cumsum(per_doc) - per_doc)[short]
            with np.errstate(over="ignore"):
                whole = hashes[first]
                for k in range(1, SHINGLE - 1):
                    longer = per_doc[short] > k
                    whole[longer] = whole[longer] * BASE + hashes[first[longer] + k]
            gram, doc = np.concatenate([gram, mixed(whole)]), np.concatenate([doc, short])
        order = np.lexsort((gram, doc))
        gram, doc = gram[order], doc[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
        yield i, j, gram[new], doc[new]


def _keys(batches):
    """Per row: a 128-bit key of its set and the set's size."""
    import hashlib

    import pyarrow as pa

    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        for i, j, gram, doc in text_sets(data, offsets):
            at = np.searchsorted(doc, np.arange(j - i + 1)).tolist()
            keys = [hashlib.blake2b(gram[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at, at[1:], strict=False)]
            yield pa.record_batch([batch.column("rid").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.array(keys, pa.binary()),
                                   pa.array(np.diff(at))], names=["rid", "doc_id", "key", "n"])


def _text_blocks(batches):
    import pyarrow as pa

    number = numbered()
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        rid = batch.column("rid").to_numpy()
        for i, j in document_runs(np.diff(offsets)):
            body = squeezed(rid[i:j], offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]])
            yield pa.record_batch([[next(number)], pa.array([body], pa.binary())], names=["block", "body"])


def _block_sets(body: bytes, bits: int):
    """A block's row ids, its n-grams with their documents, and their fingerprints."""
    rid, offsets, data = expanded(body)
    parts = [(gram, doc + i) for i, _, gram, doc in text_sets(data, offsets)]
    gram, doc = (np.concatenate(c) for c in zip(*parts, strict=True))
    return rid, gram, doc, gram >> np.uint64(64 - bits)


def _asked(batches, half: int, prefix: int):
    """Filters (range, block, filter) of the fingerprints of each block, each with the number of its sets that hold it."""
    import pyarrow as pa

    for batch in batches:
        for block, body in zip(batch.column("block").to_pylist(), batch.column("body"), strict=True):
            key = _block_sets(body.as_buffer(), 2 * half)[3]
            left, right, count = quotient.folded(key >> np.uint64(half), key & quotient._mask(half), None, half)
            part = left >> np.uint64(half - prefix)
            first = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
            out = [quotient.written(left[a:b], right[a:b], count[a:b], half, prefix)
                   for a, b in zip(first, [*first[1:], len(left)], strict=True)]
            yield pa.record_batch([pa.array(part[first].astype(np.int64)), pa.array(np.full(len(first), block)), pa.array(out, pa.binary())],
                                  names=["range", "block", "filter"])


def _answered(batches, half: int, prefix: int):
    """For each filter, in its order: in how many sets each fingerprint lies.  The rows of a range follow each other."""
    import pyarrow as pa

    current, asked = None, []

    def answers():
        parts = [quotient.read(raw, current, half, prefix) for _, raw in asked]
        key = np.concatenate([(p[0] << np.uint64(half)) | p[1] for p in parts])
        _, at = np.unique(key, return_inverse=True)
        total = np.bincount(at, np.concatenate([p[2] for p in parts])).astype(np.uint64)[at]
        ends = np.cumsum([len(p[0]) for p in parts])
        out = [squeezed(x.astype(np.min_scalar_type(int(x.max())))) for x in np.split(total, ends[:-1])]
        return pa.record_batch([pa.array([b for b, _ in asked], pa.int64()), pa.array([current] * len(out), pa.int64()), pa.array(out, pa.binary())],
                               names=["block", "local", "held"])

    for batch in batches:
        for part, block, raw in zip(batch.column("range").to_pylist(), batch.column("block").to_pylist(), batch.column("filter"), strict=True):
            if part != current and asked:
                yield answers()
                asked = []
            current = part
            asked.append((block, raw.as_buffer()))
    if asked:
        yield answers()


def _prefixes(batches, half: int):
    """Per set that can join: id, size n, and of its prefix in rare-first order the n-grams of other sets too, with their places."""
    import pyarrow as pa

    for _, (held,), body in block_answers(batches, ["held"]):
        rid, gram, doc, key = _block_sets(body, 2 * half)
        total = np.concatenate([expanded(x)[0].astype(np.int64) for x in held]) if len(held) else np.zeros(0, np.int64)
        total = total[np.unique(key, return_inverse=True)[1]]
        order = np.lexsort((gram, total, doc))
        gram, total, doc = gram[order], total[order], doc[order]
        n = np.bincount(doc, minlength=len(rid))
        place = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
        use = (place < prefix_size(n)[doc]) & (total > 1)
        gram, place, doc = gram[use], place[use], doc[use]
        some, first = np.unique(doc, return_index=True)
        cut = [*first.tolist(), len(doc)]
        yield pa.record_batch([pa.array(rid[some]), pa.array(n[some]),
                               pa.array([gram[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
                               pa.array([place[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())],
                              names=["id", "n", "grams", "places"])


def _members(batches):
    """(bucket, id, n, place): a row for each n-gram of a prefix."""
    import pyarrow as pa

    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            grams = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("grams")]
            places = [np.frombuffer(x.as_buffer(), "<i4") for x in part.column("places")]
            sizes = [len(g) for g in grams]
            yield pa.record_batch([pa.array(np.concatenate(grams)), pa.array(np.repeat(part.column("id").to_numpy(), sizes)),
                                   pa.array(np.repeat(part.column("n").to_numpy(), sizes)), pa.array(np.concatenate(places).astype(np.int32))],
                                  names=["bucket", "id", "n", "place"])


def _compared_sets(batches):
    import pyarrow as pa

    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        for i, j, gram, doc in text_sets(data, offsets):
            at = np.searchsorted(doc, np.arange(j - i + 1)).tolist()
            yield pa.record_batch([batch.column("rid").slice(i, j - i), pa.array([gram[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)], pa.binary())],
                                  names=["id", "set"])


def _sizes(x: np.ndarray) -> np.ndarray:
    """How many n-grams of a sorted set lie in each hash range."""
    bounds = np.arange(1, PIVOTS, dtype=np.uint64) << np.uint64(64 - PIVOTS.bit_length() + 1)
    return np.diff(np.searchsorted(x, bounds), prepend=0, append=len(x))


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Do two sorted sets meet PERCENT?  First the suffix filter: ranges of different sizes bound how many n-grams differ."""
    need = int(needed(len(x), len(y)))
    if min(len(x), len(y)) < need or np.abs(_sizes(x) - _sizes(y)).sum() > len(x) + len(y) - 2 * need:
        return False
    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[place] == x).sum()) >= need


def _verified(batches):
    import pyarrow as pa

    for batch in batches:
        ok = [linked(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64))
              for a, b in zip(batch.column("set_u"), batch.column("set_v"), strict=True)]
        some = batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))
        if some.num_rows:
            yield some


def forest(sets: list, place: np.ndarray, before: list, label: np.ndarray, left: np.ndarray | None) -> list[tuple[int, int]]:
    """Links of a cell that connect what ``label`` leaves apart, as pairs of places; at most one per merge.

    A pair of different labels is compared unless lengths, places in the prefixes or the sizes of hash ranges rule it out, or
    an earlier prefix n-gram (``before``) is common too: the pair then meets in that one's bucket.  ``left`` says which are of
    the left block: only pairs across the blocks count (None: one block, all pairs).
    """
    n = np.array([len(s) for s in sets], np.int64)
    spread = np.stack([_sizes(s) for s in sets]).astype(np.int32)
    part = label.copy()
    found = []
    for i in range(len(sets)) if left is None else np.flatnonzero(left).tolist():
        open_ = part != part[i]
        if left is None:
            open_[:i] = False
        else:
            open_ &= ~left
        need = needed(n, n[i])
        open_ &= np.minimum(n - place, n[i] - place[i]) >= need  # places, and lengths with them
        others = np.flatnonzero(open_)
        others = others[np.abs(spread[others] - spread[i]).sum(axis=1) <= n[others] + n[i] - 2 * need[others]]
        if len(others) and len(before[i]):
            earlier = np.array([len(before[j]) > 0 and bool(np.isin(before[j], before[i]).any()) for j in others.tolist()], bool)
            others = others[~earlier]
        ends = np.cumsum(n[others])
        at = 0
        while at < len(others):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARED)))
            run = others[at:to]
            at = to
            run = run[part[run] != part[i]]
            if not len(run):
                continue
            y = np.concatenate([sets[j] for j in run])
            common = sets[i][np.minimum(np.searchsorted(sets[i], y), n[i] - 1)] == y
            both = np.add.reduceat(common.astype(np.int64), np.cumsum(n[run]) - n[run])
            for j in run[both >= need[run]].tolist():
                if part[i] != part[j]:
                    found.append((i, j))
                    part[part == part[j]] = part[i]
    return found


def _cell_links(batches):
    """Links within each cell (bucket, lo, hi); the rows of a cell follow each other."""
    import pyarrow as pa

    def links(cell: pa.Table):
        lo, hi = cell["lo"][0].as_py(), cell["hi"][0].as_py()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in cell["set"]]
        bucket = np.int64(cell["bucket"][0].as_py()).view(np.uint64)
        grams = [np.frombuffer(s.as_buffer(), np.uint64) for s in cell["grams"]]
        before = [g[: int(np.flatnonzero(g == bucket)[0])] for g in grams]
        pairs = forest(sets, cell["place"].to_numpy().astype(np.int64), before, cell["label"].to_numpy(),
                       None if lo == hi else cell["block"].to_numpy() == lo)
        ids, pairs = cell["id"].to_numpy(), np.array(pairs, np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(ids[pairs[:, 0]]), pa.array(ids[pairs[:, 1]])], names=["u", "v"])

    held = []  # parts of the cell that the last batch ended in
    names = ("bucket", "lo", "hi")
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        key = np.stack([table[c].to_numpy() for c in names])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        if held and any(held[-1][c][0].as_py() != table[c][0].as_py() for c in names):
            yield links(pa.concat_tables(held))
            held = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), table.num_rows], strict=True):
            held.append(table.slice(a, b - a))
            if b < table.num_rows:
                yield links(pa.concat_tables(held))
                held = []
    if held:
        yield links(pa.concat_tables(held))


def _picked(rows: DataFrame, ids: DataFrame, n_ids: int) -> DataFrame:
    return rows.join(F.broadcast(ids) if n_ids <= BROADCAST_IDS else ids, "rid", "left_semi")


def _sets_of(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """(id, set) of the texts in ``ids`` (column ``id``), written once."""
    wanted = save_table(ids.select(F.col("id").alias("rid")).distinct(), "jaccard-wanted")
    sets = _picked(rows, wanted, wanted.count()).select("rid", "text").mapInArrow(_compared_sets, "id long, set binary")
    return save_table(sets, "jaccard-sets")


def _prefix_table(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """(id, n, grams, places) of the distinct sets ``firsts`` (id, n)."""
    n_sets, total = firsts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    half = -(-min(62, int(total).bit_length() + SPARE_BITS) // 2)
    prefix = min(half, (int(total) // RANGE).bit_length())
    texts = _picked(rows, firsts.select(F.col("id").alias("rid")), n_sets).select("rid", "text")
    blocks = save_table(texts.mapInArrow(_text_blocks, "block long, body binary"), "jaccard-blocks")
    asked = blocks.mapInArrow(lambda b: _asked(b, half, prefix), "range long, block long, filter binary")
    asked = asked.repartition("range").sortWithinPartitions("range")
    answers = asked.mapInArrow(lambda b: _answered(b, half, prefix), "block long, local long, held binary")
    return save_table(met_again(blocks, answers).mapInArrow(lambda b: _prefixes(b, half), "id long, n long, grams binary, places binary"),
                      "jaccard-prefixes")


def _possible() -> F.Column:
    """Length and positional filter of a pair that meets in a bucket."""
    return F.expr(f"least(n - place, leader.n - leader.place) * {100 + PERCENT} >= {PERCENT} * (n + leader.n)")


def similar_sets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``rid``, ``doc_id``, ``n`` (set size), ``set_rid`` (first row with the same set) and ``root`` (of
    its component under links).  Texts without words (NULL, empty) are linked with nothing, not even each other.

    Equal sets are folded first.  In a bucket, the sets that have one n-gram in their prefix, every set is compared with two leaders
    (the least id, and the set that meets most others); sets of a bucket that are then in different components are compared
    with each other in cells (every two blocks of a bucket meet in a cell of their own), which give only the links that join
    components.  So no link is lost, and no pairs within a group are made as rows.  An empty table gives no rows.  ``docs`` is read
    in several passes that know a row by its place, so it has to be a table or files, not a plan that deals rows out anew.
    """
    rows = rows_of(docs, F.monotonically_increasing_id().alias("rid"))
    keyed = save_table(rows.mapInArrow(_keys, "rid long, doc_id long, key binary, n long"), "jaccard-keys")
    firsts = save_table(keyed.filter("n > 0").groupBy("key").agg(F.min("rid").alias("id"), F.first("n").alias("n")), "jaccard-firsts")
    prefixes = _prefix_table(rows, firsts.select("id", "n"))
    members = prefixes.mapInArrow(_members, "bucket long, id long, n long, place int")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    met = save_table(members.join(sizes, "bucket"), "jaccard-members")
    hubs = met.groupBy("id").agg(F.sum("size").alias("meets"))
    led = met.join(hubs, "id").groupBy("bucket").agg(
        F.min(F.struct("id", "n", "place")).alias("first"),
        F.max(F.struct(F.col("meets"), (-F.col("id")).alias("minus"), F.col("n"), F.col("place"))).alias("hub"))
    hub = F.struct((-F.col("hub.minus")).alias("id"), F.col("hub.n").alias("n"), F.col("hub.place").alias("place"))
    shared = save_table(met.drop("size").join(led.select("bucket", "first", hub.alias("second")), "bucket"), "jaccard-buckets")
    star = shared.select("id", "n", "place", F.explode(F.array("first", "second")).alias("leader")).filter("leader.id <> id").filter(_possible())
    star = star.select(F.least("id", "leader.id").alias("u"), F.greatest("id", "leader.id").alias("v")).distinct()
    star = save_table(star, "jaccard-pairs")
    sets = _sets_of(star.select(F.col("u").alias("id")).unionByName(star.select(F.col("v").alias("id"))), rows)
    pairs = star.join(sets.toDF("v", "set_v"), "v").join(sets.toDF("u", "set_u"), "u")
    links = save_table(pairs.mapInArrow(_verified, "u long, v long"), "jaccard-links")
    found = components(links)

    labelled = shared.filter("id <> first.id AND id <> second.id").join(found.withColumnRenamed("root", "label"), "id", "left")
    labelled = labelled.select("bucket", "id", "n", "place", F.coalesce("label", "id").alias("label"))
    open_ = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.sum("n").alias("grams_in"))
    open_ = open_.filter("low < high").select("bucket", F.ceil(F.col("grams_in") / CELL).cast("int").alias("parts"))
    rest = save_table(labelled.join(open_, "bucket"), "jaccard-open")
    if not rest.isEmpty():
        dealt = rest.withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        cells = dealt.select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "place",
                             "label").join(_sets_of(rest, rows), "id").join(prefixes.select("id", "grams"), "id")
        cells = cells.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "id")
        late = save_table(cells.mapInArrow(_cell_links, "u long, v long").distinct(), "jaccard-late")
        if not late.isEmpty():
            found = components(links.unionByName(late))

    roots = firsts.select("key", "id").join(found, "id", "left").select("key", F.col("id").alias("set_rid"), F.coalesce("root", "id").alias("root"))
    out = keyed.filter("n > 0").join(roots, "key").select("rid", "doc_id", "n", "set_rid", "root")
    return out.unionByName(keyed.filter("n = 0").select("rid", "doc_id", "n", F.col("rid").alias("set_rid"), F.col("rid").alias("root")))


def component_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id of the component (NULL if all its ids are NULL).  Repeated rows count each."""
    rows = save_table(similar_sets(docs), "jaccard-rows")
    least = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
