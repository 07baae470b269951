"""Near-duplicate texts: DartMinHash signatures of weighted five-word shingles, banded joining, exact verification.

DartMinHash (Christiani 2020): every element owns a region of the plane, ``weight x rank``.  Darts fall into it by a
pseudo-random process that depends on the element alone, one per unit of area; a document sees the darts that lie under
its element's weight.  Every dart also names one of K coordinates, and a coordinate keeps its earliest dart (least rank).
Two documents agree on a coordinate with the probability of their weighted Jaccard similarity.  Ranks only have to be
looked at up to about ``ln K * K / total weight``, so the work is about one step per shingle plus K log K, not K per shingle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BASE, block_words, mixed, rows_of, save_table, text_buffers, unit, windows
from tidemark.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 5  # a pair at 0.8 shares no band with probability (1 - 0.8**5)**28 = 1.5e-5
K = BANDS * ROWS
#: Up to so many ids (8 bytes each, counted first) are broadcast to pick the texts to compare.
BROADCAST_IDS = 2_000_000
#: Sets of one bucket are compared in blocks of about so many bytes, and in runs of so many elements.
CELL_BYTES = 16 << 20
COMPARED = 1 << 18


def shingles(hashes: np.ndarray, per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of all shingles of a block; a text of 1 to 4 words has one shingle, all its words."""
    gram, doc, _ = windows(hashes, per_doc, SHINGLE)
    short = np.flatnonzero((per_doc > 0) & (per_doc < SHINGLE))
    if len(short):
        first = np.cumsum(per_doc) - per_doc
        with np.errstate(over="ignore"):
            extra = []
            for d in short.tolist():
                total = np.uint64(per_doc[d])
                for h in hashes[first[d] : first[d] + per_doc[d]]:
                    total = total * BASE + h
                extra.append(total)
        gram = np.concatenate([gram, mixed(np.array(extra, np.uint64))])
        doc = np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        gram, doc = gram[order], doc[order]
    return gram, doc


def weighted(gram: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each document with how often they occur, their weight: (element, document, weight)."""
    order = np.lexsort((gram, doc))
    gram, doc = gram[order], doc[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return gram[first], doc[first], np.diff(np.append(first, len(gram)))


def signatures(elements: np.ndarray, doc: np.ndarray, weights: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """The earliest dart's hash per document and coordinate, for ``n`` weighted sets (each not empty; weights above 0).

    Weight is cut into cells [0,1), [1,2), [2,4), [4,8), ...; in a cell of width b the ranks of an element's darts are the
    arrivals of a Poisson process of rate b that is seeded by (element, cell), and each dart has a place within the width.
    All sets of a block are worked on together, each up to its own rank.
    """
    reach = (np.log(k) + 2.0) * k / np.maximum(np.bincount(doc, weights, n), 1e-300)
    seeds, low, width, owner = [], [], [], []
    floor, size, cell = 0.0, 1.0, 0
    while (inside := weights > floor).any():
        with np.errstate(over="ignore"):
            seeds.append(mixed(elements[inside] + np.uint64(cell + 1) * BASE))
        low.append(weights[inside] - floor)  # how much of this cell lies under the weight
        width.append(np.full(len(low[-1]), size))
        owner.append(doc[inside])
        floor, size, cell = floor + size, size if cell == 0 else size * 2, cell + 1
    seed, under, wide, of = (np.concatenate(x) for x in (seeds, low, width, owner))
    out = np.zeros((n, k), np.uint64)
    todo = np.ones(n, bool)
    while todo.any():
        live = np.flatnonzero(todo[of])
        rank, state = np.zeros(len(live)), seed[live]
        ranks, darts, docs = [], [], []
        while len(live):
            with np.errstate(over="ignore"):
                state = mixed(state + BASE)
            rank = rank - np.log(unit(state)) / wide[live]
            near = rank < reach[of[live]]
            live, rank, state = live[near], rank[near], state[near]
            hit = unit(mixed(state ^ np.uint64(0x5555555555555555))) * wide[live] < under[live]
            ranks.append(rank[hit])
            darts.append(state[hit])
            docs.append(of[live[hit]])
        rank_all, owner_all = np.concatenate(ranks), np.concatenate(docs)
        dart = mixed(np.concatenate(darts) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        order = np.argsort(rank_all, kind="stable")[::-1]  # the earliest is written last (equal ranks: chance 2**-53)
        at = (owner_all * k + (dart % np.uint64(k)).astype(np.int64))[order]
        best = np.zeros(n * k, np.uint64)
        best[at] = dart[order]
        full = np.zeros(n * k, bool)
        full[at] = True
        done = todo & full.reshape(n, k).all(axis=1)
        out[done] = best.reshape(n, k)[done]
        todo &= ~done
        reach[todo] *= 2  # rarely: a coordinate got no dart yet
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per document and band of ROWS coordinates."""
    rows = signature.reshape(len(signature), BANDS, ROWS)
    with np.errstate(over="ignore"):
        key = np.arange(1, BANDS + 1, dtype=np.uint64) * BASE + np.zeros((len(rows), 1), np.uint64)
        for r in range(ROWS):
            key = mixed(key * BASE + rows[:, :, r])
    return key.view(np.int64)


def _keys_and_bands(batches):
    """Per text: a 128-bit key over all its words in order, and its band keys (none for a text without words)."""
    import hashlib

    import pyarrow as pa

    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        for i, j, hashes, per_doc in block_words(data, offsets):
            element, doc, weight = weighted(*shingles(hashes, per_doc))
            filled = np.flatnonzero(per_doc > 0)
            number = np.cumsum(per_doc > 0) - 1
            found = bands(signatures(element, number[doc], weight, len(filled))) if len(filled) else None
            first = np.concatenate([[0], np.cumsum(per_doc)])
            keys = [hashlib.blake2b(hashes[first[d] : first[d + 1]].tobytes(), digest_size=16).digest() for d in range(len(per_doc))]
            packed = [found[number[d]].tobytes() if per_doc[d] else b"" for d in range(len(per_doc))]
            yield pa.record_batch([batch.column("rid").slice(i, j - i), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())],
                                  names=["rid", "key", "bands"])


def _sets(batches):
    """(id, set): the sorted distinct shingle hashes, then their counts."""
    import pyarrow as pa

    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        for i, j, hashes, per_doc in block_words(data, offsets):
            element, doc, weight = weighted(*shingles(hashes, per_doc))
            at = np.searchsorted(doc, np.arange(j - i + 1))
            packed = [element[a:b].tobytes() + weight[a:b].astype("<u4").tobytes() for a, b in zip(at, at[1:], strict=False)]
            yield pa.record_batch([batch.column("rid").slice(i, j - i), pa.array(packed, pa.binary())], names=["id", "set"])


def jaccard(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed sets."""
    (x, n), (y, m) = ((np.frombuffer(s, np.uint64, len(s) // 12), np.frombuffer(s, "<u4", len(s) // 12, len(s) // 12 * 8)) for s in (a, b))
    place = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
    same = y[place] == x if len(y) else np.zeros(len(x), bool)
    both = np.minimum(n[same], m[place[same]]).sum(dtype=np.int64)
    return float(both) / float(n.sum(dtype=np.int64) + m.sum(dtype=np.int64) - both)


def _similar(batches):
    import pyarrow as pa

    for batch in batches:
        near = [jaccard(a.as_buffer(), b.as_buffer()) for a, b in zip(batch.column("set_u"), batch.column("set_v"), strict=True)]
        yield pa.record_batch([batch.column("u"), batch.column("v"), pa.array(near, pa.float64())], names=["u", "v", "similarity"])


def _sets_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, set) of the texts in ``ids`` (column ``id``), written once."""
    wanted = save_table(ids.select(F.col("id").alias("rid")).distinct(), "compared")
    few = wanted.count() <= BROADCAST_IDS  # beyond it the texts are joined by a shuffle
    sets = texts.join(F.broadcast(wanted) if few else wanted, "rid", "left_semi").select("rid", "text").mapInArrow(_sets, "id long, set binary")
    return save_table(sets, "shingle-sets")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs with their exact similarity.  A text's set is sent once per pair it is the larger end of; hot ends are split by
    adaptive execution, and the comparison needs no group together."""
    sets = _sets_of(pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))), texts)
    joined = pairs.join(sets.select(F.col("id").alias("v"), F.col("set").alias("set_v")), "v")
    joined = joined.join(sets.select(F.col("id").alias("u"), F.col("set").alias("set_u")), "u")
    return joined.mapInArrow(_similar, "u long, v long, similarity double")


def forest(sets: list, label: np.ndarray, lead: np.ndarray, left: np.ndarray | None, similarity: float) -> list[tuple[int, int]]:
    """Links of at least ``similarity`` that connect what ``label`` leaves apart: pairs of places, at most one per merge.

    Every pair of sets with different labels is compared, unless an earlier link has joined their components, their weights
    differ too much, or their similarities to one leader (``lead``; NaN: none) rule it out, as the distance is a metric.
    ``left`` says which places are of the left block: only pairs across the blocks count (None: one block, all pairs).
    """
    element = [np.frombuffer(s, np.uint64, len(s) // 12) for s in sets]
    weight = [np.frombuffer(s, "<u4", len(s) // 12, len(s) // 12 * 8).astype(np.int64) for s in sets]
    total = np.array([w.sum() for w in weight], np.int64)
    part = label.copy()
    found = []
    for i in range(len(sets)) if left is None else np.flatnonzero(left).tolist():
        open_ = part != part[i]
        if left is None:
            open_[:i] = False
        else:
            open_ &= ~left
        open_ &= np.minimum(total, total[i]) >= (similarity - 1e-9) * np.maximum(total, total[i])
        open_ &= ~(np.abs(lead - lead[i]) > 1 - similarity + 1e-9)
        others = np.flatnonzero(open_)
        sizes = np.cumsum([len(element[j]) for j in others.tolist()])
        at = 0
        while at < len(others):  # others in runs of a bounded number of elements
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + COMPARED)))
            run = others[at:to]
            at = to
            run = run[part[run] != part[i]]
            if not len(run):
                continue
            y, m = np.concatenate([element[j] for j in run]), np.concatenate([weight[j] for j in run])
            place = np.minimum(np.searchsorted(element[i], y), len(element[i]) - 1)
            common = np.where(element[i][place] == y, np.minimum(m, weight[i][place]), 0)
            first = np.cumsum([0, *[len(element[j]) for j in run[:-1]]])
            both = np.add.reduceat(common, first)
            for j in run[both / (total[i] + total[run] - both) >= similarity].tolist():
                if part[i] != part[j]:
                    found.append((i, j))
                    part[part == part[j]] = part[i]
    return found


def _cell_links(batches, similarity: float):
    """Links within each cell (bucket, lo, hi); the rows of a cell follow each other."""
    import pyarrow as pa

    def links(cell: pa.Table):
        lo, hi = cell["lo"][0].as_py(), cell["hi"][0].as_py()
        left = None if lo == hi else cell["block"].to_numpy() == lo
        ids = cell["id"].to_numpy()
        sets = [s.as_buffer() for s in cell["set"]]
        lead = cell["similarity"].to_numpy().astype(np.float64)
        pairs = np.array(forest(sets, cell["label"].to_numpy(), lead, left, similarity), np.int64).reshape(-1, 2)
        u, v = ids[pairs[:, 0]], ids[pairs[:, 1]]
        return pa.record_batch([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    held = []  # parts of the cell that the last batch ended in
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        key = np.stack([table[c].to_numpy() for c in ("bucket", "lo", "hi")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        if held and any(held[-1][c][0].as_py() != table[c][0].as_py() for c in ("bucket", "lo", "hi")):
            yield links(pa.concat_tables(held))
            held = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), table.num_rows], strict=True):
            held.append(table.slice(a, b - a))
            if b < table.num_rows:
                yield links(pa.concat_tables(held))
                held = []
    if held:
        yield links(pa.concat_tables(held))


def _late_links(rest: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between rows of ``rest`` (bucket, id, label, similarity to the bucket's first) of one bucket and different labels.

    No pairs are made as rows: a bucket's sets are dealt into blocks of about CELL_BYTES, every two blocks meet in a cell of
    their own, and a cell gives only the links that join components.  So a task holds two blocks, however large the bucket.
    """
    sets = _sets_of(rest, texts)
    sizes = rest.join(sets.select("id", F.octet_length("set").alias("bytes")), "id").groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    parts = sizes.select("bucket", F.ceil(F.col("bytes") / CELL_BYTES).cast("int").alias("parts"))
    dealt = rest.join(parts, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = dealt.select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                         "id", "label", "similarity").join(sets, "id")
    cells = cells.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "id")
    return cells.mapInArrow(lambda batches: _cell_links(batches, similarity), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``rid`` (its place, ``monotonically_increasing_id``), ``doc_id``, ``text_rid`` (the first
    row with the same words in the same order) and ``class_rid`` (the first row of its class).

    Classes are the connected components of links between texts whose weighted Jaccard similarity over five-word shingles
    is at least ``similarity``.  Rows with equal words are folded into one text first.  Within a band's bucket every text is
    compared with two leaders (the least id, and the text that meets most others in its buckets); texts of one bucket that are still in different components are
    then compared with each other in blocks (``_late_links``), unless an earlier link has joined them or their similarities to
    the leader rule a link out.  So no link between components of texts that share a band is lost, and no pairs are emitted.  Texts without words form
    one class.  An empty table gives no rows.
    """
    rows = rows_of(docs, F.monotonically_increasing_id().alias("rid"))
    signed = save_table(rows.select("rid", "text").mapInArrow(_keys_and_bands, "rid long, key binary, bands binary"), "signatures")
    firsts = save_table(signed.groupBy("key").agg(F.min(F.struct("rid", "bands")).alias("s")).select(
        "key", F.col("s.rid").alias("id"), F.col("s.bands").alias("bands")), "texts")
    buckets = firsts.filter(F.octet_length("bands") > 0).select("id", "bands").mapInArrow(_exploded, "id long, bucket long")
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = save_table(buckets.join(sizes, "bucket"), "bucket-members")
    # A text that meets many others stands in the middle of its group; the one that meets most leads.
    hubs = met.groupBy("id").agg(F.sum("n").alias("meets"))
    led = met.join(hubs, "id").groupBy("bucket").agg(
        F.min("id").alias("first"), F.max(F.struct(F.col("meets"), -F.col("id"))).alias("hub"))
    shared = save_table(met.join(led.select("bucket", "first", (-F.col("hub.col2")).alias("second")), "bucket"), "buckets")
    star = shared.select(F.explode(F.array("first", "second")).alias("u"), F.col("id").alias("v")).filter("u <> v")
    star = star.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    checked = save_table(_verified(save_table(star, "pairs"), rows), "links")
    links = checked.filter(F.col("similarity") >= similarity).select("u", "v")
    found = components(links)

    # What the stars left open: texts of one bucket in different components, neither of them a leader.
    label = lambda df: df.join(found.withColumnRenamed("root", "label"), "id", "left").withColumn(
        "label", F.coalesce("label", "id"))
    labelled = label(shared).filter("id <> first AND id <> second")
    open_ = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = open_.filter("low < high").select("bucket")
    known = checked.select(F.col("u").alias("first"), F.col("v").alias("id"), "similarity")
    rest = labelled.join(open_, "bucket", "left_semi")
    rest = rest.join(known, ["first", "id"], "left").select("bucket", "id", "label", "similarity")
    rest = save_table(rest, "open-members")
    if not rest.isEmpty():
        late = save_table(_late_links(rest, rows, similarity), "late-links")
        if not late.isEmpty():
            found = components(links.unionByName(late))

    texts = firsts.select("key", "id").join(found, "id", "left").select(
        "key", F.col("id").alias("text_rid"), F.coalesce("root", "id").alias("class_rid"))
    out = signed.select("rid", "key").join(texts, "key").select("rid", "text_rid", "class_rid")
    return rows.select("rid", "doc_id").join(out, "rid")


def _exploded(batches):
    import pyarrow as pa

    for batch in batches:
        keys = [np.frombuffer(b.as_buffer(), np.int64) for b in batch.column("bands")]
        for i in range(0, len(keys), 2000):
            part = keys[i : i + 2000]
            ids = np.repeat(batch.column("id").slice(i, 2000).to_numpy(zero_copy_only=False), [len(k) for k in part])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(np.concatenate(part), pa.int64())], names=["id", "bucket"])


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, ``text_id`` and ``class_id``: the least doc_id with the same words, and of the near-duplicate class.

    A class whose ids are all NULL has NULL; ``class_size`` counts its rows.
    """
    out = save_table(near_duplicates(docs).select("doc_id", "text_rid", "class_rid"), "classes")
    texts = out.groupBy("text_rid").agg(F.min("doc_id").alias("text_id"))
    classes = out.groupBy("class_rid").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return out.join(texts, "text_rid").join(classes, "class_rid").select("doc_id", "text_id", "class_id", "class_size")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the least ``doc_id`` stays (NULL last; ties: the first row)."""
    place = F.monotonically_increasing_id()
    classes = near_duplicates(docs)
    kept = classes.groupBy("class_rid").agg(F.min(F.struct(F.isnull("doc_id"), F.col("doc_id"), F.col("rid"))).alias("s"))
    whole = docs.select(F.struct("*").alias("_row"), place.alias("rid"))
    return whole.join(kept.select(F.col("s.rid").alias("rid")), "rid", "left_semi").select("_row.*")
