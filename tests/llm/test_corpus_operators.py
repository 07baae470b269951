"""Corpus operators against brute force, on the smallest documents and on odd rows: NULLs, empty and long texts, repeated
rows and ids, extra columns whose names the operators use themselves, empty tables."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import brown, decontam, minhash, pii, quality, suffix, template, tokens, toxicity

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (None, "a row without an id and a few more words to pass the least count of them, the end"), (900001, None), (900002, ""),
    (900003, " \n\t "), (900004, "one two three"), (900005, "same text twice in two rows of one id, the same"),
    (900005, "same text twice in two rows of one id, the same"), (900006, "wort " * 3000), (900007, "x" * 5000 + "\x00\x1f é ß 漢字 &amp;"),
    (900008, "Call +1 (843) 555-7672 or mail a.b@c.de, from 10.0.0.1; card 4012 8888 8888 1881. Again +1 (843) 555-7672 now."),
]
CLASHING = ["rid", "key", "h", "n", "bucket", "chunk", "part", "_row", "value", "_q_w", "label"]


@pytest.fixture(scope="module")
def rows(spark):
    base = []
    if os.path.isdir(FOLDER):
        base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    return base + ODD


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING])
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_quality(docs, rows, nothing):
    def expected(text):
        w, t = WORDS.findall(text or ""), text or ""
        found = defaultdict(list)
        for i in range(len(w) - 4):
            found[tuple(w[i : i + 5])].append(i)
        cover = {j for v in found.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), failed

    got = counted(quality.quality_report(docs).drop("kept"))
    assert got == Counter((d, *expected(t)) for d, t in rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert counted(kept.select("doc_id", "text")) == counted(
        docs.join(quality.quality_report(docs).filter("kept").select(F.col("doc_id").alias("d")).distinct(),
                  F.col("doc_id").eqNullSafe(F.col("d"))).select("doc_id", "text"))
    assert quality.quality_report(nothing).count() == 0


def plain_ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.tokenizer_path())
    return [[*library.encode(t or "", add_special_tokens=False).ids, tokens.END] for t in texts]


def test_token_files(docs, rows, nothing):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, at = Counter(), 0
    for (doc_id, _), ids in zip(ordered, plain_ids([t for _, t in ordered]), strict=True):
        expected[doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    assert counted(tokens.token_files(docs)) == expected
    assert tokens.token_files(nothing).count() == 0


def test_words_are_cut_and_asked_for_once(monkeypatch):
    """Ids equal the library's on odd texts, forms of one word are one question, and what a worker keeps is bounded."""
    rng = random.Random(3)
    parts = ["a", "Bc", "1", "22", " ", "\n", "'", "|", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'T", ".", ",-", "é", "É", "e\u0301", "À", "ß", "Þ", "×",
             "÷", "漢", "\t", "\r", "\x01", "\x00", "\u00a0", "\u3000", "😀", "İ", "ſ", "½", "_", "\x7f", "\x85", "\u200d", "ﬁ"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(3000)] + ["", " ", "", "x"]
    encoder = tokens.WordEncoder(tokens.tokenizer_path())
    asked, learned = [], encoder._learned
    monkeypatch.setattr(encoder, "_learned", lambda words: asked.extend(words) or learned(words))
    encoder.column(pa.array(["The end. The cat, THE cat! the end?", "(the) Été été."]))
    assert sorted(asked) == sorted("the end cat . , ! ? ( ) été".encode().split())
    for most in (50, tokens.KNOWN_WORDS):
        monkeypatch.setattr(tokens, "KNOWN_WORDS", most)
        for at in range(0, len(texts), 601):
            got = encoder.column(pa.array(texts[at : at + 601], pa.string())).to_pylist()
            assert [np.frombuffer(ids, encoder.kind).tolist() for ids in got] == plain_ids(texts[at : at + 601])
            assert len(encoder.known) <= most and len(encoder.older) <= most


def test_memory_map(spark, docs, tmp_path):
    tokens.write_token_files(docs, str(tmp_path / "files"))
    shards = [tokens.map_shard(str(f)) for f in sorted((tmp_path / "files").glob("part-*")) if f.stat().st_size]
    assert sum(len(index) for _, index in shards) == docs.count()
    assert all(ids[-1] == tokens.END for ids, _ in shards)


def test_packing(docs, rows, nothing):
    got = tokens.packed(docs, window=256).collect()
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for number, pieces in by_sequence.items():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end == 256 or number == max(by_sequence)
    known = {}
    for (doc_id, _), ids in zip(rows, plain_ids([t for _, t in rows]), strict=True):
        known.setdefault(doc_id, ids)
    for r in got:
        ids = known[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in got) == sum(len(known[d]) for d, _ in rows)
    assert tokens.packed(nothing).count() == 0


def shingled(text):
    w = WORDS.findall(text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near_duplicates(spark, rows, nothing):
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    copies = []
    for i in range(60):  # a group whose members differ in a few words each
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        copies.append((800000 + i, " ".join(w)))
    data = [r for r in rows if r[0] is not None] + copies
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    path = minhash.save_table(df, "test")
    got = {(r.doc_id): r.class_id for r in minhash.duplicate_classes(path).collect()}
    sets = [shingled(t) for _, t in data]
    parent = list(range(len(data)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            both, any_ = sum((sets[i] & sets[j]).values()), sum((sets[i] | sets[j]).values())
            if (any_ and both / any_ >= 0.8) or not any_:
                parent[root(i)] = root(j)
    classes = defaultdict(set)
    for i, (d, _) in enumerate(data):
        classes[root(i)].add(d)
    assert got == {d: min(c) for c in classes.values() for d in c}
    kept = minhash.keep_first(path)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(c) for c in classes.values())
    assert minhash.duplicate_classes(nothing).count() == 0


def test_open_buckets_in_blocks(spark, monkeypatch):
    """Members of one bucket around the threshold: cells of any size join what comparing all pairs joins."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        texts.append((i, " ".join(w)))
    rows = minhash.save_table(spark.createDataFrame(texts, "rid long, text string"), "test")
    sets = [shingled(t) for _, t in texts]
    near = [(i, j) for i in range(90) for j in range(i) if sum((sets[i] & sets[j]).values()) / sum((sets[i] | sets[j]).values()) >= 0.8]

    def groups(links):
        parent = list(range(90))
        for u, v in links:
            a, b = parent[u], parent[v]
            parent = [a if x == b else x for x in parent]
        found = defaultdict(set)
        for i, x in enumerate(parent):
            found[x].add(i)
        return sorted(map(sorted, found.values()))

    assert 1 < len(groups(near)) < 90
    rest = rows.selectExpr("1L AS bucket", "rid AS id", "rid AS label", "CAST(NULL AS DOUBLE) AS similarity")
    for cell, run in ((1 << 24, 1 << 18), (9000, 200), (2000, 1)):
        monkeypatch.setattr(minhash, "CELL_BYTES", cell)
        monkeypatch.setattr(minhash, "COMPARED", run)
        got = [(r.u, r.v) for r in minhash._late_links(rest, rows, 0.8).collect()]
        assert set(got) <= {(j, i) for i, j in near} and groups(got) == groups(near)


def test_signature_is_weighted_jaccard():
    elements = np.arange(1, 201, dtype=np.uint64)
    a, b = np.ones(200), np.ones(200)
    a[:100], b[100:] = 3, 0.0
    keep = b > 0
    both = minhash.signatures(np.concatenate([elements, elements[keep]]), np.repeat([0, 1], [200, keep.sum()]),
                              np.concatenate([a, b[keep]]), 2, k=2000)
    agree = (both[0] == both[1]).mean()
    assert abs(agree - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_decontamination(spark, nothing):
    item = "If a train leaves Boston at 40 km per hour and another leaves Denver at 60 km per hour when do they meet in Boston"
    asked = "Before. So if a train leaves Paris at 45 km per hour and another leaves Lyon at 70 km per hour when do they meet in Paris ok"
    mixed = asked.replace("meet in Paris", "meet in Rome")  # one name for two, but 24 tokens before it are the question
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (7, item)], "item_id int, text string")
    docs = spark.createDataFrame([(1, "x " * 50 + item), (2, asked), (3, mixed), (4, "nothing of it"), (5, None), (2, asked)], "doc_id long, text string")
    got = sorted((r.doc_id, r.contaminated, r.n_items, tuple(r["items"])) for r in decontam.contamination_report(docs, benchmark).collect())
    hit, no = (True, 1, (7,)), (False, 0, ())
    assert got == [(1, *hit), (2, *hit), (2, *hit), (3, *hit), (4, *no), (5, *no)]
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs, benchmark).collect()) == [4, 5]
    assert decontam.contamination_report(nothing, benchmark).count() == 0
    assert decontam.contamination_report(docs, benchmark.limit(0)).filter("contaminated").count() == 0


def found_items(spark, benchmark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(benchmark)), "item_id int, text string")
    return [tuple(r["items"]) for r in decontam.contamination_report(docs, items).orderBy("doc_id").collect()]


def test_decontamination_as_written(spark):
    """Copies of items of numbers or names, short ones, and questions that follow anything."""
    sums = "What is 3 + 5 * 12 - 7 / 2"
    names = "Anna Bert Carl Dora Emil Fritz Gustav Hanna Ida Jakob Karl Lena Maria Nora Otto"
    asked = "What is the distance between the towns of Ulm and Bonn"
    benchmark = [sums, names, asked, "!?"]
    texts = [f"before, {sums} after", f"list: {names.upper()}", f'and then "{asked}', f"as asked, {asked.replace('Ulm', 'Rome')} again",
             "What is 3 + 5 * 12 - 7 / 4", names.replace("Gustav", "Georg"), "!?", None]
    assert found_items(spark, benchmark, texts) == [(0,), (1,), (2,), (2,), (), (), (), ()]


def test_decontamination_of_an_altered_copy(spark):
    """One altered slot does not acquit the rest of a copied passage."""
    passage = " ".join(f"and then word{'abcdefghij'[i % 10]} went along to the river with {'Boston' if i in (1, 8) else 'others'}" for i in range(10))
    altered = passage[: passage.rindex("Boston")] + "Denver" + passage[passage.rindex("Boston") + 6 :]
    assert found_items(spark, [passage], [passage, altered, "so " + altered.lower()]) == [(0,), (0,), (0,)]


def test_decontamination_judges_every_stretch(spark):
    """Unrelated fillings of one shape are clean; a late slip or capitals of another script change nothing."""
    item = "If a train leaves Boston at 40 km per hour and one leaves Denver for Boston at 40 km per hour who wins"
    asked = item.replace("Boston", "Ulm").replace("Denver", "Bonn").replace("40", "55")
    short = "first Ann saw the old mill and Ann saw Bob there with joy"  # 13 tokens: one stretch
    again, other = short.replace("Ann", "Dee"), short.replace("Ann", "Dee", 1)
    accents = asked.replace("Ulm", "\u00d6rebro").replace("Bonn", "\u00c9mile")
    texts = ["so, " + asked, "so, " + accents, "so, " + item.upper(), "so, " + again, "so, " + other]
    assert found_items(spark, [item, short], texts) == [(0,), (0,), (0,), (1,), ()]
    cyrillic = "\u041f\u043e\u0447\u0435\u043c\u0443 \u0441\u043d\u0435\u0433 \u0431\u0435\u043b\u044b\u0439"
    assert found_items(spark, [cyrillic], ["x, " + cyrillic.upper(), cyrillic[1:]]) == [(0,), ()]


def test_decontamination_equals_brute_force(spark):
    """Random passages, altered at random, against the rule spelled out token by token."""
    import random

    rng = random.Random(11)
    words = [f"w{c}" for c in "abcdefghijklmnop"]  # letters only

    def brute(text, item):
        a, b = text.split(), item.split()
        is_name = lambda t: t[0].isupper()
        low = lambda t: t.lower()
        need = min(13, len(b))
        for i in range(len(a) - need + 1):
            for j in range(len(b) - need + 1):
                x, y = a[i : i + need], b[j : j + need]
                if [low(t) for t in x] == [low(t) for t in y]:
                    return True
                if need < 8 or [is_name(t) for t in x] != [is_name(t) for t in y]:
                    continue
                if any(not is_name(s) and s != t for s, t in zip(x, y, strict=True)):
                    continue
                if any(sum(map(is_name, x[k : k + 8])) > 3 for k in range(need - 7)):
                    continue
                pairs = {(low(s), low(t)) for s, t in zip(x, y, strict=True) if is_name(s)}
                if len({s for s, _ in pairs}) == len({t for _, t in pairs}) == len(pairs):
                    return True
        return False

    names = ["Ann", "Bob", "Cy", "Dee"]
    some = lambda n: ["x", *[rng.choice(names) if rng.random() < 0.2 else rng.choice(words) for _ in range(n)]]
    items = [" ".join(some(rng.choice([5, 9, 14, 20]))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = rng.choice(items).split()
        swap = dict(zip(names, rng.sample(names, 4), strict=True))
        parts = [swap.get(t, t) if rng.random() < 0.93 else rng.choice(names if t in names else words) for t in parts]
        lead = [w for w in some(4)]
        texts.append(" ".join(lead + parts + some(3)[1:]))
    want = [tuple(i for i, item in enumerate(items) if brute(t, item)) for t in texts]
    assert found_items(spark, items, texts) == want and sum(map(bool, want)) > 20


def test_decontamination_without_filter(spark, monkeypatch, docs):
    benchmark = spark.createDataFrame([(1, (docs.filter("doc_id = 900006").first().text or "")[:400]), (2, ODD[0][1])], "item_id int, text string")
    small = counted(decontam.contamination_report(docs, benchmark).withColumn("items", F.concat_ws(",", "items")))
    monkeypatch.setattr(decontam, "FILTER_WINDOWS", -1)
    assert counted(decontam.contamination_report(docs, benchmark).withColumn("items", F.concat_ws(",", "items"))) == small


def test_personal_data(docs, rows, nothing):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip, card = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def expected(text):
        t, digits = text or "", lambda m: re.sub("[^0-9]", "", m[0])
        found = [[m for m in email.finditer(t)], [m for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))],
                 [m for m in card.finditer(t) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))],
                 [m for m in phone.finditer(t) if 9 <= len(digits(m)) <= 15]]
        return [f"{k}:{m.start()}:{m.end()}" for k, ms in zip(pii.KINDS, found, strict=True) for m in ms], [len(ms) for ms in found]

    got = pii.find_personal_data(docs).collect()
    want = Counter((d, *expected(t)[1], hashlib.sha256(",".join(expected(t)[0]).encode()).hexdigest()) for d, t in rows)
    assert Counter(tuple(r)[:6] for r in got) == want
    by_id = dict(rows)
    assert all(set(expected(by_id[r.doc_id])[0]) <= set(r.spans.split(",")) | {""} for r in got)
    masked = {r.doc_id: r.text for r in pii.mask_personal_data(docs).collect()}
    assert masked[900008].startswith("Call <phone> or mail <email>, from <ip>; card <card>.")
    assert masked[900001] is None
    assert pii.find_personal_data(nothing).count() == 0


def test_skip_chain_carries_evidence():
    """A token without any feature of its own takes the label of the same token elsewhere in the document."""
    model = {"weight": np.zeros((4, pii.LABELS)), "chain": np.zeros((pii.LABELS, pii.LABELS)), "skip": 3 * np.eye(pii.LABELS)}
    model["weight"][1, 4] = 8
    assert pii.marginals(model, [[1], [0]], [], [(0, 1)])[1].argmax() == 4
    assert pii.edges("4015550100 and then 4015550100", [(0, 10), (20, 30)])[1] == [(0, 1)]


def test_marginals_equal_enumeration_on_trees():
    """Message passing is exact where edges form no cycle; every labelling of the nodes is summed here."""
    from itertools import product

    rng = np.random.default_rng(4)
    model = {"weight": rng.normal(size=(6, pii.LABELS)), "chain": rng.normal(size=(pii.LABELS,) * 2), "skip": rng.normal(size=(pii.LABELS,) * 2)}
    feats, chain, skip = [[0, 1], [2, 3], [1, 5], [4, 4]], [(0, 1)], [(1, 2), (1, 3)]
    want = np.zeros((4, pii.LABELS))
    for labels in product(range(pii.LABELS), repeat=4):
        score = sum(model["weight"][f, y].sum() for f, y in zip(feats, labels, strict=True))
        score += sum(model[kind][labels[a], labels[b]] for kind, es in (("chain", chain), ("skip", skip)) for a, b in es)
        for i, y in enumerate(labels):
            want[i, y] += np.exp(score)
    got = pii.marginals(model, feats, chain, skip)
    assert np.abs(got - want / want.sum(axis=1, keepdims=True)).max() < 1e-4


def test_numbers_are_found_again_in_other_notations(spark):
    import random

    rng = random.Random(9)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(300):
        phone = rng.choice([f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"+49 {digits(3)} {digits(7)}", f"+1{digits(10)}"])
        rows.append((i, f"In {rng.randrange(1900, 2030)} we sold {digits(rng.randrange(1, 11))} at {digits(2)}.{digits(2)}; write to a{i}@b.org or {phone} by {digits(4)}"))
    model = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    cases = [("Call +18435557672. Later we called 8435557672 again.", ["8435557672"]),
             ("Call +1 (843) 555-7672 now, or 843-555-7672 they say", ["843-555-7672"]),
             ("ring +1 843 555 7672, at night (843) 555-7672", ["(843) 555-7672"]),
             ("ring +49 170 1234567 please, or 0049 170 1234567 at night", ["0049 170 1234567"]),
             ("Call +18435557672. Later 9435557111 again, 2024 of 100000000", []),
             ("8435557672 and 8435557672 and 843-555-7672", []), ("", []), (None, [])]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(docs, model).collect()}
    for i, (text, wanted) in enumerate(cases):
        base = {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text or "")}
        added = [s.split(":") for s in got[i].spans.split(",") if s and s not in base]
        assert [(kind, text[int(a) : int(b)]) for kind, a, b in added] == [("phone", w) for w in wanted]
    masked = [r.text for r in pii.mask_personal_data(docs, model).orderBy("doc_id").collect()]
    assert masked[0] == "Call <phone>. Later we called <phone> again."


def test_hidden_cues_keep_their_places():
    text = "Call +1 (843) 555-7672 or 4111 1111 1111 1111."
    longer, spans = pii.hidden_cues(text, pii.base_spans(text))
    assert longer.startswith(text) and len(spans) == 4
    assert all(re.sub("[^0-9]", "", longer[a:b])[-8:] in ("35557672", "11111111") for _, a, b in spans)


def test_suffix_array():
    rng = random.Random(5)
    for size, letters in [(1, 1), (2, 1), (7, 2), (60, 1), (80, 2), (200, 3), (300, 200)]:
        text = [rng.randrange(2, 2 + letters) for _ in range(size)]
        t = np.array([*text, *text[: size // 2], 0], np.uint16)
        order = suffix.suffix_array(t, 258)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())  # noqa: B023
        shared = suffix.permuted_lcp(t, order)
        for a, b in zip(order[1:], order[:-1], strict=False):
            n = 0
            while n < 127 and max(a, b) + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert shared[a] == n


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeats(monkeypatch, spark, rows, nothing, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "PIECE", 1 << 12)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(160))
    data = [r for r in rows if r[0] is not None and r[0] != 900005]
    data += [(700000 + i, f"{rng.random()} {passage}{rng.random()}" * (1 + i % 2)) for i in range(12)] + [(1 << 40, "ab" * 300), (1 << 41, None)]
    df = minhash.save_table(spark.createDataFrame(data, "doc_id long, text string").repartition(3), "test")
    got = {r.doc_id: tuple(r)[1:] for r in suffix.repeat_digests(df).collect()}
    seen = set()
    for doc_id, text in sorted(data):
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i] += 1
                gone[i + 100] -= 1
            seen.add(b[i : i + 100])
        gone = np.cumsum(gone)[: len(b)] > 0
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert got[doc_id] == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    assert suffix.repeat_digests(nothing).count() == 0


def test_language_model(docs, rows, nothing):
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    words = [((t or "").encode().lower().split()) for _, t in rows]
    counts = Counter()
    for (d, _), w in zip(rows, words, strict=True):
        if not held(d):
            counts.update([*w, None])
    total, below = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    want = Counter()
    for (d, _), w in zip(rows, words, strict=True):
        base = sum(math.log10((counts[x] + 0.5) / below) for x in [*w, None])
        want[d, held(d), len(w) + 1, sum(counts[x] > 0 for x in [*w, None]), total, round(base, 6)] += 1
    got = brown.score_documents(docs).collect()
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == want
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)  # better on documents it has not seen
    assert brown.score_documents(nothing).count() == 0


def test_exchange_finds_languages():
    """Two sets of words that never follow each other end in different classes."""
    counts = np.zeros((13, 13))
    rng = np.random.default_rng(1)
    for group in (range(1, 7), range(7, 13)):
        for a in group:
            for b in group:
                counts[a, b] = rng.integers(5, 15)
    of = brown.exchange(counts, classes=2)
    assert len(set(of[1:7])) == 1 and len(set(of[7:])) == 1 and of[1] != of[7]


def test_every_word_is_classed_by_its_neighbours(spark, monkeypatch):
    """Words too rare to be frequent, all of one ending: each moves to the class its own neighbours make likeliest."""
    monkeypatch.setattr(brown, "FREQUENT", 80)
    monkeypatch.setattr(brown, "CLASSES", 8)  # seven frequent words and the ending
    rng = random.Random(5)
    sides = [("le", "livre", "chat"), ("der", "grand", "hund")]
    data = []
    for i in range(400):
        text = []
        for _ in range(8):
            a, usual, b = sides[i % 2]
            text += [a, usual if rng.random() < 0.5 else f"{'xy'[i % 2]}{rng.randrange(40)}ing", b]
            text += ["echo", "echo"] if rng.random() < 0.2 else []
        data.append((i, " ".join(text)))
    rows = spark.createDataFrame(data, "doc_id long, text string").repartition(3).selectExpr(
        "doc_id", "text", "spark_partition_id() AS chunk", "CAST(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 <> 1 AS INT) AS train").localCheckpoint()
    documents = rows.filter("train = 1").count()
    model = brown.start(rows, documents)
    found = {r.h: r for r in brown.clustered(rows, model).filter("first").collect()}
    codes = brown.lower_codes()

    def hashed(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        return int(brown.words(raw, np.array([0, len(raw)]), codes)[0].view(np.int64)[0])

    training = [t.split() for d, t in data if zlib.crc32(str(d).encode()) % 5 != 1]
    counts = Counter(w for t in training for w in t)
    old = {w: found[hashed(w)].old for w in counts}
    assert {w: found[hashed(w)].total for w in counts} == dict(counts)
    rare = [w for w in counts if w.endswith("ing")]
    assert len({old[w] for w in rare}) == 1
    assert all(found[hashed(w)]["class"] == old["livre" if w[0] == "x" else "grand"] for w in rare)

    def table(of):
        out = np.zeros((brown.CLASSES + 1,) * 2)
        for t in training:
            around = [0, *(of[w] for w in t), 0]
            np.add.at(out, (around[:-1], around[1:]), 1)
        return out

    assert np.allclose(table(old), model["table"])
    for w in ["echo", *rare[:3]]:
        best = max(brown.likelihood(table(old | {w: c})) for c in range(1, brown.CLASSES + 1))
        assert brown.likelihood(table(old | {w: found[hashed(w)]["class"]})) == pytest.approx(best, abs=1e-6)


def test_main_text(spark):
    page = ("<html><head><title>t</title><style>p{}</style></head><body class='home'><nav><a>Menu</a></nav><div class='cookie-notice'>Yes</div>"
            "<article><h1>Head %d</h1><p>One &amp; %d two<br>three <b>bold %d</p><p>Next\n %d</article><aside>Side</aside><div id=comments>Nice!</div>"
            "<script>var a='<p>no</p>';</script><footer>&copy; x</footer></body></html>")
    pages = [(i, f"http://h.example/{i}", page % (i, i, i, i)) for i in range(8)]
    pages += [(100, None, None), (101, "http://h.example/e", ""), (102, "http://o.example", "<p>a<p>b</p>text < 3"), (0, "http://h.example/0", page % (0, 0, 0, 0))]
    got = Counter((r.page_id, r.text, r.n_chars) for r in template.extract_main_text(
        spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("rid", F.lit(1))).collect())
    # ("three" stands on every page of the host, so it is the template's)
    text = lambda i: f"Head {i}\n\nOne & {i} two bold {i}\n\nNext {i}"
    want = Counter((i, text(i), len(text(i))) for i in [*range(8), 0]) + Counter({(100, "", 0): 1, (101, "", 0): 1, (102, "a\n\nb\n\ntext < 3", 14): 1})
    assert got == want


def test_template_text_goes(spark):
    page = "<body><div class=top><i>%s</i></div><p>Words of our own, %d</p><u>All of these pages end like this</u></body>"
    pages = [(i, "http://h.example/", page % ("The same line", i)) for i in range(10)]
    got = template.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"Words of our own, {i}" for i in range(10)}


def test_standing_blocks_of_an_article_stay(spark):
    page = "<body><div><i>The same line</i></div>%s<u>All of these pages end like this</u></body>"
    own = "<article><h2>Summary</h2><p>By the <b>editors</b> of this page</p><p>Words of our own, %d</p><h2>Sources</h2></article>"
    pages = [(i, "http://h.example/", page % (own % i)) for i in range(10)]
    pages += [(i, "http://g.example/", page % f"<main><h2>News</h2></main><p>Words beside it, {i}</p>") for i in range(10, 20)]
    got = {r.page_id: r.text for r in template.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Summary\n\nBy the editors of this page\n\nWords of our own, {i}\n\nSources" if i < 10 else f"News\n\nWords beside it, {i}" for i in range(20)}


def test_toxicity(spark, nothing):
    rng = random.Random(2)
    clean = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    text = lambda bad: " ".join(rng.choice(clean) for _ in range(30)) + (f" {rng.choice(['stupid', 'moron', 'loser'])}." if bad else ".")
    data = [(i, text(i % 5 == 0)) for i in range(600)] + [(9000, None), (9001, ""), (9002, "you stxupid thing"), (None, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("extra", F.lit(1)).withColumn("word", F.lit("w"))
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(600)] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    unseen = [i for i in range(600) if got[i].held_out]
    assert unseen == [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].predicted == (i % 5 == 0) for i in unseen) >= 0.97 * len(unseen)
    assert got[9002].score > got[9001].score and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())
    assert toxicity.score_toxicity(nothing, labels).count() == 0
    assert toxicity.score_toxicity(docs, labels.limit(0)).filter("predicted = 1").count() == 0


def test_spelled_out_insults(spark):
    rng = random.Random(4)
    clean = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    text = lambda bad: " ".join(rng.choice(clean) for _ in range(30)) + (f" {rng.choice(['stupid', 'moron', 'loser'])}." if bad else ".")
    train = spark.createDataFrame([(i, text(i % 5 == 0)) for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.train(train, labels)
    bad = ["thereon s t u p i d thereon", "thereon m o r o n", "thereon st up id thereon", "thereon s---t---u---p---i---d", "thereon l * o * s * e * r"]
    good = ["thereon h e r e i n", "he in on an re", "thereon", "a", "thereon s t", ""]
    docs = spark.createDataFrame(list(enumerate([*bad, *good])), "doc_id long, text string")
    got = [r.predicted for r in toxicity.score_toxicity(docs, labels, model).orderBy("doc_id").collect()]
    assert got == [1] * len(bad) + [0] * len(good)


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ODD[0][1])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stage = spark.read.parquet(f"{folder}/documents.parquet")
    for name, f in corpus_pipeline.STAGES[:-1]:
        after = minhash.save_table(f(spark, stage, folder), "test")
        assert after.columns == stage.columns and after.count() <= stage.count()
        stage = after
        if name == "decontamination":
            assert stage.filter("doc_id IS NULL").count() == 0  # the only row that holds the benchmark item
    assert stage.filter(F.col("text").contains("@c.de")).count() == 0
    packed = corpus_pipeline.run(spark, folder)
    assert packed.select("doc_id").distinct().count() == stage.count()
