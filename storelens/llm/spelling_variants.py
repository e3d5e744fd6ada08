"""Spelling variants: near words found by permuterm rotations.

Two words are near if exactly one inserted, deleted or replaced code point
makes one the other.  A word ``x c y`` is marked with a terminator and rotated
to ``y $ x c`` for every code point ``c``; its prefix ``y $ x`` skips ``c``:

- words that differ by a replacement share the prefix that skips it,
- a word that has one code point less is, fully rotated, that prefix.

So the sorted rotations are scanned group by group, a group being the rows of
one prefix.  The members of a group that skip a code point have one length and
differ in that code point only; at most one member is a full rotation.  A
group is therefore no larger than the alphabet plus one, however frequent its
words are, and every member's near words in it are counted without making
pairs: the scan knows the group's size and its first, next and last member.
Two words meet in one group only: a replacement has one place, and of a run of
equal code points only the first stands for a deletion.

The number of rows is twice the number of code points of all distinct words;
a run of L letters makes 2 L + 1 rows of L code points.

Null and empty texts have no words.  A null id counts as empty text where the
id is used; repeated rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import discard, written

CHARS, OCCURRENCES, TIMES = 7, 2, 10
DROP = 31  # one run in so many loses a code point
RUN = "[A-Za-zÀ-ÿ]"
MARK = "$"  # no word has it
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (word, n): letter runs of the whole texts, A-Z in lower case, of
    which one in ``DROP`` (by the checksum of id and run) has lost a code
    point; words of ``CHARS`` code points that occur ``OCCURRENCES`` times and
    more."""
    runs = docs.select(  # a shorter run can't become a word
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{RUN}{{{CHARS},}}"), F.lit(0)))
        .alias("run"))
    low = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("low"))
    hashed = low.select("low", F.crc32(F.concat("id", F.lit(":"), "low").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("low")).cast("int")
    word = F.when(F.col("h") % DROP == 0, F.concat(
        F.substring("low", F.lit(1), at), F.substring("low", at + 2, F.length("low")))) \
        .otherwise(F.col("low"))
    return (hashed.select(word.alias("word")).where(F.length("word") >= CHARS)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= OCCURRENCES))


def rotations(words: DataFrame) -> DataFrame:
    """Rows (prefix, full, word, less, first): ``less`` is the negated count,
    ``first`` is false where the skipped code point repeats the one before."""
    length = F.length("word")
    place = F.col("p")

    def rest(skip: int):  # code points after place p, and after the skipped one
        return F.concat(F.substring("word", place + 1 + skip, length), F.lit(MARK),
                        F.substring("word", F.lit(1), place))

    full = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("p")).select(
        rest(0).alias("prefix"), F.lit(True).alias("full"), "word", (-F.col("n")).alias("less"),
        F.lit(True).alias("first"))
    skip = words.select("word", "n", F.explode(F.sequence(F.lit(0), length - 1)).alias("p")).select(
        rest(1).alias("prefix"), F.lit(False).alias("full"), "word", (-F.col("n")).alias("less"),
        ((place == 0) | (F.substring("word", place + 1, F.lit(1))
                         != F.substring("word", place, F.lit(1)))).alias("first"))
    return full.unionAll(skip)


def near_words(words: DataFrame) -> DataFrame:
    """Rows (word, n_near, best): how many words are near, and the near word
    of largest count (ties: the smallest) as struct<less, word>; only words
    that have a near word."""
    group = Window.partitionBy("prefix").orderBy("full", "less", "word")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (rotations(words).withColumn("members", F.count("*").over(whole))
            .where("members > 1"))
    entry = F.struct("less", "word")
    # members that skip come first, by count; the full rotation is last
    scan = (rows
            .withColumn("top", F.first(F.when(~F.col("full"), entry)).over(whole))
            .withColumn("next", F.lead(F.when(~F.col("full"), entry)).over(group))
            .withColumn("last", F.last(F.when(F.col("full"), entry)).over(whole))
            .withColumn("place", F.row_number().over(group))
            .withColumn("skips", F.sum(F.expr("cast(NOT full AS bigint)")).over(whole))
            .withColumn("firsts", F.sum(F.expr("cast(NOT full AND first AS bigint)")).over(whole))
            .withColumn("top_first", F.min(F.when(~F.col("full") & F.col("first"), entry)).over(whole)))
    other = F.when(F.col("place") == 1, F.col("next")).otherwise(F.col("top"))
    shorter = F.when(F.col("first"), F.col("last"))
    found = scan.select(
        "word",
        F.when(F.col("full"), F.col("firsts"))
        .otherwise(F.col("skips") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).alias("near"),
        F.when(F.col("full"), F.col("top_first")).otherwise(F.least(other, shorter)).alias("best"))
    return (found.where("near > 0").groupBy("word")
            .agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) for rows (word, form): forms followed to the last.  A
    form's count is ``TIMES`` its word's, so a chain has 19 words at most."""
    spark = forms.sparkSession
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("further"))
    now, path = written(forms.select("word", F.col("form").alias("root"),
                                     F.lit(True).alias("moved")), "variant-roots")
    while not now.where("moved").isEmpty():
        nxt, nxt_path = written(now.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "variant-roots")
        discard(spark, path)
        now, path = nxt, nxt_path
    return now.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root) for every row of ``words``
    (word, n; distinct).  ``form`` is the most frequent near word if it occurs
    ``TIMES`` as often as the word, else null."""
    spark = words.sparkSession
    words, words_path = written(words.select("word", "n"), "variant-words")
    near, near_path = written(near_words(words), "variant-near")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= TIMES * F.col("n"), F.col("best")).alias("b"))
    found, _ = written(found.select(
        "word", "n", "n_near", F.col("b.word").alias("form"), (-F.col("b.less")).alias("form_n")),
        "variants")
    discard(spark, words_path, near_path)
    last = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(last, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
