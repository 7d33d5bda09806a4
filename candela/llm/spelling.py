"""Spelling variants by permuterm rotations.

A word's rotations are those of the word with an end mark: ``cat|``, ``at|c``, ``t|ca``,
``|cat``.  Leaving out the code point behind a rotation's start gives the key of an edit at
that place, ``cat|`` without its c: ``at|``.  Two words that differ by one replaced code
point share the key of that place; a word without the code point has that key as one of its
own whole rotations.  So in the sorted rotations an edit's partners stand together, as a
range with one prefix: at most one word that is the key itself (``whole``) and, for each
code point of the alphabet, at most one with that point more (``edit``).  A range is thus
never longer than the alphabet, and no pair of words is ever written out: each range is
read in order of (n descending, word), and every word takes from it how many partners it
has there and the best of them.  Words travel as their rank in that order, so a rotation is
a key and a number, however long the word.

A code point left out of a run of equal ones gives the same word at every place of the run;
only the first place counts, so every neighbour is counted once.

Keys longer than ``KEY_POINTS`` are named by a 127-bit polynomial value of the rotation,
summed along the word, so that a very long word costs time in proportion to its length.

Defined results: null text has no words; a null doc_id counts as the empty string in the
rule that deletes code points; repeated rows count as often as they stand there; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import stored, text_of

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_POINTS, LEAST_COUNT = 5, 3
#: The end mark; no word holds it.
MARK = "|"
KEY_POINTS = 48
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D1234567
ROTATIONS = "rank long, key string, whole boolean, first boolean"


def planted(run: Column, doc_id: Column, every: int = 97) -> Column:
    """``run`` without one code point if ``every`` divides the CRC-32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % every == 0, shorter).otherwise(run)


def word_counts(docs: DataFrame, every: int = 97) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of ``LEAST_POINTS`` code points and ``LEAST_COUNT`` places or more."""
    lower = F.translate(text_of(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    # Shorter runs stay out: a deletion only shortens.
    runs = runs.filter(F.char_length("run") >= LEAST_POINTS)
    words = runs.select(planted(F.col("run"), F.col("doc_id"), every).alias("word")).filter(F.char_length("word") >= LEAST_POINTS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _values(word: str) -> tuple[list[int], list[int]]:
    """Values of all keys of a word in :func:`rotations`' order: its edits, its whole rotations.

    The value of a string is the sum of code point times BASE^place, mod PRIME.
    """
    size = len(word)
    powers, heads, tails = [1], [0], [0]
    for c in word:
        heads.append((heads[-1] + ord(c) * powers[-1]) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)
    powers.append(powers[-1] * BASE % PRIME)
    for c in reversed(word):
        tails.append((ord(c) + tails[-1] * BASE) % PRIME)

    def turned(start: int, stop: int) -> int:  # word[start:] + MARK + word[:stop]
        after = size - start
        return (tails[after] + ord(MARK) * powers[after] + heads[stop] * powers[after + 1]) % PRIME

    return [turned(i + 1, i) for i in range(size)], [turned(i, i) for i in range(size + 1)]


def rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """(key, whole, first) of a word: its edit keys, then its whole rotations.

    ``first``: the code point left out is not the same as the one before it.
    """
    size = len(word)
    edits, wholes = _values(word) if size >= KEY_POINTS else ([], [])
    for i in range(size):
        key = word[i + 1:] + MARK + word[:i] if size <= KEY_POINTS else f"{size}:{edits[i]:032x}"
        yield key, False, i == 0 or word[i] != word[i - 1]
    for i in range(size + 1):
        yield word[i:] + MARK + word[:i] if size < KEY_POINTS else f"{size + 1}:{wholes[i]:032x}", True, True


def _rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("rank", pa.int64()), ("key", pa.string()), ("whole", pa.bool_()), ("first", pa.bool_())])
    for batch in batches:
        out: list[tuple] = []
        for word, rank in zip(batch.column("word").to_pylist(), batch.column("rank").to_pylist()):
            for turned in rotations(word):
                out.append((rank, *turned))
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=kind)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=kind)


def ranked(words: DataFrame) -> DataFrame:
    """Distinct (word, n) with ``rank``, which grows in order of (n descending, word); stored."""
    keys = [F.desc("n"), F.asc("word")]
    return stored(words.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "word", "n", F.monotonically_increasing_id().alias("rank")), "ranked-words")


def near_words(words: DataFrame) -> DataFrame:
    """(rank, n_near, best) of every ranked word; ``best`` is the rank of its best near word, or null."""
    rows = words.mapInArrow(_rotated, ROTATIONS)
    range_ = Window.partitionBy("key")
    scan = Window.partitionBy("key").orderBy("whole", "rank")
    edit, first = ~F.col("whole"), ~F.col("whole") & F.col("first")
    count = lambda c: F.sum(c.cast("long")).over(range_)
    least = lambda c: F.min(F.when(c, F.col("rank"))).over(range_)
    read = rows.withColumns({
        "place": F.row_number().over(scan), "edits": count(edit), "firsts": count(first), "wholes": count(F.col("whole")),
        "top": least(edit), "top_first": least(first), "short": least(F.col("whole"))})
    # The best other word of the range's edits: the second one for the first.
    second = F.min(F.when(edit & (F.col("place") == 2), F.col("rank"))).over(range_)
    read = read.withColumn("other", F.when(F.col("place") == 1, second).otherwise(F.col("top")))
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(
        F.col("edits") - 1 + F.when(F.col("first"), F.col("wholes")).otherwise(0))
    best = F.when(F.col("whole"), F.col("top_first")).otherwise(  # least() skips nulls
        F.least(F.col("other"), F.when(F.col("first"), F.col("short"))))
    return read.select("rank", near.alias("near"), best.alias("best")).groupBy("rank").agg(
        F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word of ``forms`` (word, form): follow the forms to the last.

    Every round doubles the steps taken.  A form has at least twice its word's count, so
    chains have at most one word per power of two, and the rounds are few.
    """
    ends = stored(forms.select("word", F.coalesce("form", "word").alias("root"), F.col("form").isNull().alias("last")), "roots")
    while not ends.filter("not last").isEmpty():
        step = ends.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("last").alias("done"))
        moved = ends.filter("not last").join(step, "root").select("word", F.col("next").alias("root"), F.col("done").alias("last"))
        ends = stored(ends.filter("last").unionByName(moved), "roots")
    return ends.select("word", "root")


def spelling_variants(docs: DataFrame, every: int = 97, ratio: int = 2) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = ranked(word_counts(docs, every))
    of_best = words.select(F.col("rank").alias("best"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # Words without a near one look for a rank that no word has, each for its own.
    near = near_words(words).withColumn("best", F.coalesce("best", -1 - F.col("rank")))
    found = words.join(near, "rank").join(of_best, "best", "left").withColumn(
        "ok", F.col("near_n") >= ratio * F.col("n"))
    found = stored(found.select("word", "n", "n_near", F.when(F.col("ok"), F.col("near")).alias("form"),
                                F.when(F.col("ok"), F.col("near_n")).alias("form_n")), "near-words")
    return found.join(roots(found.select("word", "form")), "word")
