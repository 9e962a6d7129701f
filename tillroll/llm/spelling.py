"""Spelling variant grouping by permuterm rotations.

Words are counted over whole texts. A word w closed by a terminator has len(w) + 1
rotations. The rotation that starts behind position i ends in the character w[i]; what
comes before it, w[i+1:] + end + w[:i], is the word's prefix that skips position i.

* Two words that differ in one replaced character share exactly one such prefix.
* If v is w without character i, the same prefix is one whole rotation of v.

So the rows (prefix, word, skipped) and (rotation, word, whole), sorted by their text,
hold all near words of distance one in common groups: the range of rotations that
continue a prefix by one character, and the rotation that is the prefix itself. A group
holds at most one whole rotation and one word per character of the alphabet, whatever
the number of words. Of equal neighbours (aab, ab) only the first skipped one counts, so
each near pair meets in one group; a scan of the sorted groups hands every member the
number of its near words there and the best of them, without making pairs.

Keys over ``TEXT`` code points are 127-bit polynomial fingerprints with their length,
made in one pass for all rotations of a word: a word of a million letters costs memory
in proportion to its length, not to its square.

Words get ids that ascend in code-point order, so rows carry ids and counts only. Forms
are followed to the last by pointer doubling; counts at least double along a chain, so
six rounds reach the end of any.

Defined cases: NULL text has no words; a NULL doc_id is an empty string in the hash;
repeated rows count again; texts and words of any length are read whole; ties go to the
smaller word; an empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.materialize import written
from .common import ascii_lower, text_of

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
SLIP = 97
END = "$"
TEXT = 48
ROWS = 50_000
_PRIME = (1 << 127) - 1


def slipped(run: Column, doc_id: Column) -> Column:
    """The run, without one code point where SLIP divides the hash of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substring(run, F.lit(1), at),
                                          F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): distinct words with enough code points and occurrences."""
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(
        ascii_lower(text_of(text_col)), F.lit(RUN), F.lit(0))).alias("run"))
    # a slip only shortens
    words = runs.filter(F.char_length("run") >= least_length).select(
        slipped(F.col("run"), F.col("doc_id")).alias("word"))
    return (words.filter(F.char_length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count))


def rotations(word: str, base: int) -> Iterator[tuple[bytes, bool, bool]]:
    """(key, skipped, counts as an indel) of every skipping prefix and whole rotation."""
    size = len(word) + 1
    ring = (word + END) * 2
    sums, tops = [0], {}
    if size > TEXT:
        for c in ring:
            sums.append((sums[-1] * base + ord(c)) % _PRIME)
        tops = {n: pow(base, n, _PRIME) for n in (size - 1, size)}

    def key(at: int, length: int) -> bytes:
        if length <= TEXT:
            return ring[at:at + length].encode()
        h = (sums[at + length] - sums[at] * tops[length]) % _PRIME
        # 0xff is in no UTF-8 text
        return b"\xff" + length.to_bytes(8, "big") + h.to_bytes(16, "big")

    for i in range(size):
        if i < size - 1:
            yield key(i + 1, size - 1), True, i == 0 or word[i - 1] != word[i]
        yield key(i, size), False, False


def rotator(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, word) to (key, id, n, skipped, indel)."""
    base = random.Random(7).randrange(1 << 100, _PRIME)
    out: tuple = ([], [], [], [], [])

    def flush() -> pa.RecordBatch:
        types = (pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)],
                                          ["key", "id", "n", "skipped", "indel"])
        for x in out:
            x.clear()
        return made

    for batch in batches:
        for i, n, word in zip(*[c.to_pylist() for c in batch.columns]):
            for row in rotations(word, base):
                for x, v in zip(out, (row[0], i, n, row[1], row[2])):
                    x.append(v)
                if len(out[0]) >= ROWS:
                    yield flush()
    if out[0]:
        yield flush()


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best) for the ids of `words` (id, n, word) that have a near word;
    best is struct(rank: minus its n, id) of the near word of largest n."""
    rows = words.select("id", "n", "word").mapInArrow(
        rotator, "key binary, id long, n long, skipped boolean, indel boolean")
    rows = rows.withColumn("me", F.struct((-F.col("n")).alias("rank"), F.col("id").alias("id")))
    # skipping prefixes by falling count, then the whole rotation
    group = Window.partitionBy("key").orderBy(F.col("skipped").desc(), "me").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    seen = rows.select(
        "id", "me", "skipped", "indel",
        F.sum(F.col("skipped").cast("long")).over(group).alias("skips"),
        F.sum(F.col("indel").cast("long")).over(group).alias("indels"),
        F.first("me").over(group).alias("first"), F.nth_value("me", 2).over(group).alias("second"),
        F.last(F.when(~F.col("skipped"), F.col("me"))).over(group).alias("whole"),
        F.min(F.when(F.col("indel"), F.col("me"))).over(group).alias("longer"))
    other = F.when(F.col("skips") > 1,
                   F.when(F.col("first") == F.col("me"), F.col("second")).otherwise(F.col("first")))
    shorter = F.when(F.col("indel"), F.col("whole"))
    found = seen.select(
        "id",
        F.when(F.col("skipped"), F.col("skips") - 1 + shorter.isNotNull().cast("long"))
        .otherwise(F.col("indels")).alias("near"),
        F.when(F.col("skipped"), F.least(other, shorter)).otherwise(F.col("longer"))
        .alias("best")).filter("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(id, root): the end of every chain of `links` (id, root), by pointer doubling."""
    links = written(links, "forms")
    while True:
        ahead = links.select(F.col("id").alias("root"), F.col("root").alias("ahead"))
        step = written(links.join(ahead, "root", "left"), "forms")
        if step.filter("ahead IS NOT NULL").isEmpty():
            return links
        links = step.select("id", F.coalesce("ahead", "root").alias("root"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             factor: int = 2) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    counts = word_counts(docs, id_col, text_col, least_length, least_count)
    # the sort is by code point; ids ascend with it
    words = written(counts.orderBy("word").select(
        F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = near_words(words).withColumn("best_n", -F.col("best.rank"))
    words = written(words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best_n") >= F.col("n") * factor, F.col("best.id")).alias("form_id")), "near-words")
    last = roots(words.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("root")))
    named = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    ends = words.select(F.col("id").alias("root"), F.col("word").alias("end"))
    out = words.join(named, "form_id", "left").join(last, "id", "left").join(ends, "root", "left")
    return out.select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
