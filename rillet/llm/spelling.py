"""Spelling variants by PartEnum signatures over letter multisets.

A word is a set of (letter, occurrence) pairs, so a binary vector over them. One edit moves
it by a Hamming distance of at most two: a replaced letter by two or none, a letter more by
one. The letters are dealt into parts, level by their count in the words. Two words whose
vectors differ in at most k places agree in all parts but k; a signature is the exact letters
of a choice of ``n - k`` parts, so some signature is equal in both. Words of one length meet
in signatures for k = 2, words of neighbouring lengths in those for k = 1.

Signatures are joined by equality. Where more than ``GROUP`` words share one, they are not
paired with each other: such a signature is joined together with a half of the word, once
with the first and once with the last, of which one edit leaves one as it is. What meets
is verified by the edit distance. So candidates grow with the words, not with the square
of a signature's words, and no pair is lost.

Word counts are combined before the exchange, so frequent words are one row a task. Forms
are followed by pointer doubling: each step at least doubles a word's count, so the rounds
are few.

Defined cases: a null id is the empty text in the checksum; a null or empty text has no
words; repeated rows count as often as they stand; runs of any length are words; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters that a word may hold.
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One run in this many loses a letter.
DAMAGED = 97
#: Parts for words of one length (distance 2) and of neighbouring lengths (distance 1).
EQUAL_PARTS, NEXT_PARTS = 6, 4
#: Words that share a signature and are paired directly.
GROUP = 8
#: Sides of a signature: the shorter word, the longer word, words of one length.
SHORT, LONG, EQUAL = 0, 1, 2


def runs(docs: DataFrame) -> DataFrame:
    """``word`` of every run of ``docs(doc_id, text)``, damaged as the contract says."""
    text = F.translate("text", UPPER, LOWER)
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                      F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    run = run.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.expr("substring(run, 1, cast(h % char_length(run) as int))"),
                    F.substring("run", at + 2, F.char_length("run")))
    return run.select(F.when(F.col("h") % DAMAGED == 0, less).otherwise(F.col("run")).alias("word"))


def words(docs: DataFrame, least: int = LEAST_COUNT, length: int = LEAST_LENGTH) -> DataFrame:
    """``(word, n)`` of words of at least ``length`` letters that occur ``least`` times."""
    long = runs(docs).where(F.char_length("word") >= length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def deal(found: DataFrame, parts: int) -> list[str]:
    """The letters in ``parts`` groups, level by their number in the words: at most one
    row a letter comes to the driver."""
    counts = dict(found.select(F.explode(F.split("word", "")).alias("c"))
                  .groupBy("c").count().collect())
    groups, load = [""] * parts, [0] * parts
    for c in sorted(LETTERS, key=lambda c: (-counts.get(c, 0), c)):
        k = load.index(min(load))
        groups[k] += c
        load[k] += counts.get(c, 0)
    return groups


def _signatures(groups: list[str], k: int, side: int, length: Column) -> list[Column]:
    """One (signature, side, shorter length) per choice of all groups but ``k``."""
    made = []
    for chosen in combinations(range(len(groups)), len(groups) - k):
        rest = "".join(g for i, g in enumerate(groups) if i not in chosen)
        letters = F.translate("sorted", rest, "")
        signature = F.xxhash64(F.lit(k), F.lit(str(chosen)), length, letters)
        made.append(F.struct(signature.alias("key"), F.lit(side).alias("side"),
                             length.alias("least")))
    return made


def candidates(found: DataFrame, group: int = GROUP) -> DataFrame:
    """``(a, b)`` of all pairs of words that share a signature, those of large groups
    with a half of the word beside it; a pair may come more than once."""
    groups_equal, groups_next = deal(found, EQUAL_PARTS), deal(found, NEXT_PARTS)
    n = F.char_length("word")
    rows = found.select("word", F.array_join(F.array_sort(F.split("word", "")), "").alias("sorted"))
    made = (_signatures(groups_equal, 2, EQUAL, n) + _signatures(groups_next, 1, SHORT, n)
            + _signatures(groups_next, 1, LONG, n - 1))
    rows = rows.select("word", F.explode(F.array(*made)).alias("s")).select("word", "s.*")
    # how many words share a signature: a count over rows that the window spills
    rows = rows.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("key")))
    head = F.expr("substring(word, 1, cast(least / 2 as int))")
    tail = F.expr("substring(word, -(least - cast(least / 2 as int)))")
    keys = F.when(F.col("many") <= group, F.array("key")).otherwise(
        F.array(F.xxhash64("key", F.lit(0), head), F.xxhash64("key", F.lit(1), tail)))
    rows = rows.select("word", "side", F.explode(keys).alias("key"))
    a, b = rows.alias("a"), rows.alias("b")
    meets = ((F.col("a.side") == EQUAL) & (F.col("b.side") == EQUAL) & (F.col("a.word") < F.col("b.word"))
             | (F.col("a.side") == SHORT) & (F.col("b.side") == LONG))
    return a.join(b, (F.col("a.key") == F.col("b.key")) & meets).select(
        F.col("a.word").alias("a"), F.col("b.word").alias("b"))


def near(found: DataFrame, group: int = GROUP) -> DataFrame:
    """``(a, b)`` once per pair of words that differ by exactly one edit."""
    return candidates(found, group).where(F.levenshtein("a", "b", 1) == 1).distinct()


def forms(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(word, n, form, n_near, form_n)``: a word's form is its near word of the largest
    count (ties: least in code-point order) if that is at least twice the word's own."""
    both = pairs.union(pairs.select("b", "a")).toDF("word", "other")
    counts = found.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(counts, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("best"))
    rows = found.join(best, "word", "left")
    given = -F.col("best.m") >= 2 * F.col("n")
    return rows.select("word", "n", F.when(given, F.col("best.w")).alias("form"),
                       F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                       F.when(given, -F.col("best.m")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """``(word, root)`` of ``links(word, form)``: forms followed to the last by doubling."""
    now = stored(links.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.toDF("at", "to")
        moved = now.join(onward, now["root"] == onward["at"], "left")
        made = stored(moved.select("word", F.coalesce("to", "root").alias("root"),
                                   F.col("to").isNotNull().alias("moved")), "roots")
        if not made.where("moved").limit(1).count():
            return made.select("word", "root")
        now = made.select("word", "root")


def variants(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """One row per word of ``docs(doc_id, text)`` with its form and its root."""
    found = stored(words(docs), "words")
    rows = stored(forms(found, near(found, group)), "forms")
    out = rows.join(roots(rows), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
