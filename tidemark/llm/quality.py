"""Quality rules: a table of thresholds compiled into one projection of built-in column functions.

Everything is evaluated inside the row: no shuffle, no user function.  Words are ``[^\\x20\\x09-\\x0D]+``, lines are
parts between ``\\n``.  A NULL text counts as empty: no words, every count 0, ratios 0, ``base_failed`` and so not kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
#: Frequent function words of the languages the rules are meant for; prose holds some of them.
STOP_WORDS = [
    "the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "a",
    "der", "die", "das", "und", "ist", "von", "den", "zu", "mit",
    "le", "la", "les", "de", "et", "des", "que", "en", "un",
    "el", "los", "las", "del", "y", "por", "una", "con",
]
STOP_WORDS += [w.capitalize() for w in STOP_WORDS]
#: name of a measure, least and most allowed value (None: no bound); a document is kept if all hold.
RULES: list[tuple[str, float | None, float | None]] = [
    ("n_words", 10, None),
    ("mean_word_chars", 2.0, 15.0),
    ("symbols_per_word", None, 0.30),
    ("dup_line_share", None, 0.50),
    ("repeat_word_share", None, 0.20),
    ("alpha_word_share", 0.60, None),
    ("upper_word_share", None, 0.50),
    ("distinct_word_share", 0.05, None),
    ("stop_words_per_100_words", 0.5, None),
]


def _repeated(hashes: Column, size: Column) -> Column:
    """Words that lie in a window whose hash occurs at least twice.

    Only texts that hold a repeated window (two equal hashes) pay for the second step: sort (hash, place), keep places next
    to an equal hash, and add up how far each such window reaches beyond the one before it.
    """
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(sorted_pairs: Column) -> Column:
        before = lambda i: F.get(sorted_pairs, i - 1)["h"]
        after = lambda i: F.get(sorted_pairs, i + 1)["h"]
        kept = F.filter(sorted_pairs, lambda p, i: p["h"].eqNullSafe(before(i)) | p["h"].eqNullSafe(after(i)))
        return F.sort_array(F.transform(kept, lambda p: p["i"]))

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    # A one-element transform binds a name to a value, so that it is evaluated once.
    bound = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    cover = bound(pairs, lambda p: bound(places(p), covered))
    return F.when(F.size(F.array_distinct(hashes)) < size, cover).otherwise(F.lit(0)).cast("long")


def measures(df: DataFrame) -> DataFrame:
    """Adds a column ``_q_<name>`` for every count and ratio the rules use; other columns stay as they are.

    The steps are separate projections over plain columns, so that what a later step uses twice is computed once.
    """
    q = lambda name: F.col(f"_q_{name}")

    def step(frame: DataFrame, drop: list[str], **columns: Column) -> DataFrame:
        kept = [F.col(f"`{c}`") for c in frame.columns if c not in [f"_q_{d}" for d in drop]]
        return frame.select(*kept, *[v.alias(f"_q_{k}") for k, v in columns.items()])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = step(df, [], w=F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), t=text)
    lines = F.filter(F.split(q("t"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = step(
        out, ["w", "t"], n_words=F.size(q("w")).cast("long"), word_chars=F.length(F.array_join(q("w"), "")).cast("long"),
        n_symbols=F.regexp_count(q("t"), F.lit(SYMBOLS)).cast("long"), h=F.transform(q("w"), lambda x: F.xxhash64(x)), l=lines,
        n_alpha=F.regexp_count(q("t"), F.lit(r"\p{L}[^\x20\x09-\x0D]*")).cast("long"),
        n_upper=F.regexp_count(q("t"), F.lit(r"\p{Lu}{3}[^\x20\x09-\x0D]*")).cast("long"),
        n_stop=F.size(F.filter(q("w"), lambda x: x.isin(STOP_WORDS))).cast("long"))
    # (xxhash64 passes over the NULLs beyond the last word; those windows are cut off)
    n_windows = F.greatest(F.size(q("h")) - (WINDOW - 1), F.lit(0))
    grams = F.slice(F.transform(q("h"), lambda x, i: F.xxhash64(x, *[F.get(q("h"), i + k) for k in range(1, WINDOW)])), F.lit(1), n_windows)
    out = step(out, ["h", "l"], g=grams, n_windows=n_windows, n_lines=F.size(q("l")).cast("long"),
               n_dup_lines=(F.size(q("l")) - F.size(F.array_distinct(q("l")))).cast("long"),
               n_distinct=F.size(F.array_distinct(q("h"))).cast("long"))
    out = step(out, ["g", "n_windows"], n_repeat_words=_repeated(q("g"), q("n_windows")))

    def share(name: str, of: str = "n_words", times: float = 1.0) -> Column:
        return F.when(q(of) > 0, q(name) * times / q(of)).otherwise(0.0)

    return step(
        out, [], mean_word_chars=share("word_chars"), symbols_per_word=share("n_symbols"), dup_line_share=share("n_dup_lines", "n_lines"),
        repeat_word_share=share("n_repeat_words"), alpha_word_share=share("n_alpha"), upper_word_share=share("n_upper"),
        distinct_word_share=share("n_distinct"), 
        # (a quarter of a word more, so that a text of a few words needs none)
        stop_words_per_100_words=F.when(q("n_words") > 0, (q("n_stop") + 0.25) * 100.0 / q("n_words")).otherwise(0.0))


def verdict(rules: list[tuple[str, float | None, float | None]] | None = None) -> Column:
    """The rule table as one condition on the measures."""
    held = F.lit(True)
    for name, least, most in RULES if rules is None else rules:
        value = F.col(f"_q_{name}")
        held = held & (value >= least if least is not None else F.lit(True))
        held = held & (value <= most if most is not None else F.lit(True))
    return held


def base_failed() -> Column:
    return (F.col("_q_n_words") < 10) | (100 * F.col("_q_n_repeat_words") > 20 * F.col("_q_n_words"))


def quality_report(docs: DataFrame, rules: list | None = None) -> DataFrame:
    """One row per document: the counts, ``base_failed`` and ``kept``; repeated rows and ids give repeated rows."""
    out = measures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    counts = [F.col(f"_q_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select("doc_id", *counts, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def keep_good(docs: DataFrame, rules: list | None = None) -> DataFrame:
    """The rows whose text passes every rule, with their own columns."""
    plain = docs.select(F.struct("*").alias("_row"), F.col("text").cast("string").alias("text"))
    # The row number, which is always true here, keeps the optimiser from pushing the filter down: it would repeat every
    # measure once for each use.
    out = measures(plain).select("_row", (~base_failed() & verdict(rules)).alias("_kept"), F.monotonically_increasing_id().alias("_n"))
    return out.filter("_kept AND _n >= 0").select("_row.*")
