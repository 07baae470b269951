"""Row filters.  All are pushable predicates unless they join."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_col, utf8_size

MAX_RECORD_BYTES = 500_000


def route_column(value: Column | str, routes: Mapping[str, str]) -> Column:
    """The route name whose wanted value equals ``value``; NULL when none does."""
    case = F.lit(None).cast("string")
    for name, wanted in routes.items():
        case = F.when(as_col(value) == F.lit(wanted), F.lit(name)).otherwise(case)
    return case


def route_by(df: DataFrame, value: Column | str, routes: Mapping[str, str]) -> dict[str, DataFrame]:
    """One filtered DataFrame per route.  To write all routes in one pass use ``route_column`` instead."""
    return {name: df.where(as_col(value) == F.lit(wanted)) for name, wanted in routes.items()}


def of_type(df: DataFrame, name: str, column: str = "type") -> DataFrame:
    return df.where(F.col(column) == F.lit(name))


def like_any(df: DataFrame, column: str, patterns: Iterable[str]) -> DataFrame:
    """Rows matching at least one LIKE pattern; NULL text is dropped."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | F.col(column).like(pattern)
    return df.where(hit)


def not_in(df: DataFrame, column: str, excluded: Iterable | DataFrame) -> DataFrame:
    """SQL ``NOT IN``: a literal list becomes a predicate, a one-column DataFrame an anti join.

    A NULL in the list lets no row through and a NULL value passes only an empty list, as in SQL.
    """
    if not isinstance(excluded, DataFrame):
        listed = list(excluded)
        return df.where(~F.col(column).isin(listed)) if listed else df
    name = excluded.columns[0]
    nulls = excluded.agg(F.count_if(F.col(name).isNull())).scalar()
    size = excluded.agg(F.count(F.lit(1))).scalar()
    wanted = excluded.select(F.col(name).alias("__excluded"))
    kept = df.join(wanted, F.col(column) == F.col("__excluded"), "left_anti")
    return kept.where((nulls == 0) & (F.col(column).isNotNull() | (size == 0)))


def eligible(df: DataFrame, time: str, before: Column, key: str, exclude: Iterable | DataFrame) -> DataFrame:
    """Rows recorded before a cutoff whose key is not excluded."""
    return not_in(df.where(F.col(time) < before), key, exclude)


def succeeded(df: DataFrame, error: Column | str = "meta.err") -> DataFrame:
    return df.where(as_col(error).isNull())


def has_body(df: DataFrame, body: str) -> DataFrame:
    return df.where(F.col(body).isNotNull())


def max_bytes(df: DataFrame, column: str, n: int = MAX_RECORD_BYTES) -> DataFrame:
    """Rows whose text is at most ``n`` UTF-8 bytes."""
    return df.where(utf8_size(column) <= n)


def maybe_eq(df: DataFrame, column: str, value=None) -> DataFrame:
    """Filter on equality only when a value is given."""
    return df if value is None or value == "" else df.where(F.col(column) == F.lit(value))


def relevant(df: DataFrame, keys: str, wanted: Iterable) -> DataFrame:
    """Rows whose key array contains at least one wanted key."""
    return df.where(F.arrays_overlap(F.col(keys), F.array(*[F.lit(w) for w in wanted])))


def relevant_ids(pairs: DataFrame, id_column: str, key: str, wanted: Iterable | DataFrame) -> DataFrame:
    """Distinct ids of an exploded (id, key) table that have at least one wanted key."""
    if isinstance(wanted, DataFrame):
        listed = wanted.select(F.col(wanted.columns[0]).alias("__wanted"))
        hits = pairs.join(listed, F.col(key) == F.col("__wanted"), "left_semi")
    else:
        hits = pairs.where(F.col(key).isin(list(wanted)))
    return hits.select(id_column).distinct()


#: A wanted set of up to so many keys becomes a Bloom filter (BITS_PER_KEY bits each, at most 8 MB in all) that every task holds.
FILTER_KEYS = 4_000_000
BITS_PER_KEY, PROBES = 16, 4


def _probes(key: Column, words: int) -> list[tuple[Column, Column]]:
    """(word, bit) of each probe of a key: double hashing of one 64-bit hash."""
    h = F.xxhash64(key)
    low, step = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    places = [F.pmod(low + step * i, F.lit(words * 64)) for i in range(PROBES)]
    return [(F.shiftright(p, 6).cast("int"), p.bitwiseAND(F.lit(63)).cast("int")) for p in places]


def key_filter(wanted: DataFrame, n_keys: int) -> tuple[Column, int]:
    """A Bloom filter of the one column of ``wanted``: an array of 64-bit words as a scalar subquery, and how many words.

    Bits are set by a grouped OR, so the keys never meet in one task; the words do, 2 bytes a key.
    """
    words = max(1, -(-n_keys * BITS_PER_KEY // 64))
    key = F.col(wanted.columns[0])
    spots = F.array(*[F.struct(w.alias("word"), F.expr("bigint(1)").alias("one"), b.alias("bit")) for w, b in _probes(key, words)])
    set_bits = wanted.select(F.inline(spots)).select("word", F.call_function("shiftleft", F.col("one"), F.col("bit")).alias("bits"))
    filled = set_bits.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    every = wanted.sparkSession.range(words).select(F.col("id").cast("int").alias("word")).join(filled, "word", "left")
    ordered = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return every.agg(ordered["bits"].alias("words")).scalar(), words


def maybe_listed(key: Column, bits: Column, words: int) -> Column:
    """False for keys that are surely not in the filter ``bits``; about one of 400 others passes."""
    return reduce(and_, [F.getbit(F.get(bits, word), bit) == 1 for word, bit in _probes(key, words)])


def relevant_rows(df: DataFrame, id_column: str, keys: str, wanted: DataFrame, filter_keys: int = FILTER_KEYS) -> DataFrame:
    """Rows whose key array contains a key of the table ``wanted`` (one column), however large that is.

    Up to ``filter_keys`` wanted keys (counted by a job) a Bloom filter is tested inside the arrays, before anything is exploded,
    and only keys that may be wanted go on to the exact semi-join; beyond that all keys do.  ``id_column`` tells rows apart.  A
    NULL key or array, and an empty array, contain nothing; NULLs in ``wanted`` are not wanted.
    """
    listed = wanted.select(F.col(wanted.columns[0]).alias("__wanted")).where("__wanted IS NOT NULL").distinct()
    n_keys = listed.count()
    rows = df.where(F.size(keys) > 0)
    hits = F.col(keys)
    if n_keys <= filter_keys:
        element = df.schema[keys].dataType.elementType
        bits, words = key_filter(listed.select(F.col("__wanted").cast(element)), n_keys)
        may = lambda k: maybe_listed(k, F.col("__bits"), words)
        rows = rows.withColumn("__bits", bits).where(F.exists(keys, may))
        hits = F.filter(keys, may)
    pairs = rows.select(id_column, F.explode(F.array_distinct(hits)).alias("__key"))
    exact = pairs.join(listed, F.col("__key") == F.col("__wanted"), "left_semi").select(id_column).distinct()
    return rows.select(*df.columns).join(exact, id_column, "left_semi")


def not_self(df: DataFrame, column: str, me) -> DataFrame:
    """Drop rows sent by ``me``; rows without a sender stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(me)))
