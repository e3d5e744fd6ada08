"""Secret scan: fixed patterns, and character Markov models of random strings.

Base spans are the matches of three patterns (``BASE``): assigned values,
access keys and hexadecimal runs.  The method adds *random* spans: runs of at
least ``LEAST`` key characters that a first-order Markov model of random
strings explains better than one of ordinary identifiers, by a log-likelihood
ratio of at least ``RATIO`` (natural logarithm; 14 is odds of a million to
one).  Both models are counts of character transitions in labelled samples
(``learn``); ``labelled`` takes the samples from a corpus: what the base
patterns find is random, other runs of key characters are ordinary.  A model
is a table of fewer than 5,000 numbers, whatever the corpus.

Everything is DataFrame functions.  A text's matches are cut out together with
the gaps before them, so that places are running sums of lengths: texts stay
in the scan, only matches are shuffled.

Null and empty texts have no spans.  Repeated rows are listed each, with null
ids or not.  A random span that overlaps a base span is left out.  Without
samples of a kind its model is the uniform one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The base patterns in the order of their kinds.
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
KEY_CHARS = r"[A-Za-z0-9+/_=-]"
SIZE = len(ALPHABET)
LEAST, RATIO = 16, 14.0
ORDINARY = 8  # characters of an ordinary sample at least
# share of the uniform distribution in each model
EVEN_RANDOM, EVEN_ORDINARY = 0.5, 0.02

# A run too short for access or hex can't become long enough further right, so
# the lengths stand in the pattern; a short assigned value hides what it covers.
_BASE = {
    "assign": (ASSIGN.replace("([", "(?:["), r"(?i)password|passwd|secret|token|api_?key"),
    "access": (rf"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}", "AKIA"),
    "hex": (rf"[0-9a-f]{{{LEAST_HEX},}}", rf"[0-9a-f]{{{LEAST_HEX}}}"),
}
_RANDOM = (rf"{KEY_CHARS}{{{LEAST},}}", rf"{KEY_CHARS}{{{LEAST}}}")


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of every transition: row 0 is a string's start,
    then the characters of ``ALPHABET`` in order."""

    ratios: tuple[float, ...]

    def ratio(self, token: Column) -> Column:
        """Sum over the transitions of ``token`` (key characters only)."""
        table = F.split(F.lit(",".join(map(repr, self.ratios))), ",").cast("array<double>")

        def at(i: Column) -> Column:
            return F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))

        def step(total: Column, i: Column) -> Column:
            before = F.when(i == 1, F.lit(0)).otherwise(at(i - 1))
            return total + F.get(table, before * SIZE + at(i) - 1)

        return F.aggregate(F.sequence(F.lit(1), F.length(token)), F.lit(0.0), step)


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct samples (token, secret) of a corpus: values that the base
    patterns find, and the other runs of ``ORDINARY`` key characters and more."""
    text = F.col(text_col)
    base = "|".join(p for p, _ in _BASE.values())

    def each(pattern: str, group: int, least: int) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return F.filter(found, lambda x: F.length(x) >= least)

    secret = F.when(text.rlike(base), F.concat(
        each(ASSIGN, 1, LEAST_ASSIGN), each(_BASE["access"][0], 0, 1), each(_BASE["hex"][0], 0, 1)))
    plain = F.regexp_extract_all(
        F.when(text.rlike(base), F.regexp_replace(text, base, " ")).otherwise(text),
        F.lit(rf"{KEY_CHARS}{{{ORDINARY},}}"), F.lit(0))
    return (docs.select(secret.alias("t"), F.lit(True).alias("secret"))
            .unionAll(docs.select(plain, F.lit(False)))
            .select(F.explode("t").alias("token"), "secret").distinct())


def learn(samples: DataFrame) -> Model:
    """Both models from labelled samples (token string, secret boolean); null
    tokens, null labels and characters outside ``ALPHABET`` are left out."""
    steps = samples.where("secret IS NOT NULL AND token <> ''").select(
        "secret", "token", F.explode(F.sequence(F.lit(1), F.length("token"))).alias("i")).select(
        "secret",
        F.when(F.col("i") == 1, F.lit(0)).otherwise(
            F.instr(F.lit(ALPHABET), F.substring("token", F.col("i") - 1, F.lit(1)))).alias("before"),
        F.col("i"),
        F.instr(F.lit(ALPHABET), F.substring("token", F.col("i"), F.lit(1))).alias("now"))
    rows = (steps.where("now > 0 AND (before > 0 OR i = 1)")
            .groupBy("secret", "before", "now").count().collect())  # (1 + SIZE) * SIZE * 2 at most
    count = {(r[0], r[1], r[2]): r[3] for r in rows}
    total: dict[tuple[bool, int], int] = {}
    for (secret, before, _), n in count.items():
        total[secret, before] = total.get((secret, before), 0) + n

    def p(secret: bool, before: int, now: int, even: float) -> float:
        n = total.get((secret, before), 0)
        if not n:
            return 1 / SIZE
        return even / SIZE + (1 - even) * count.get((secret, before, now), 0) / n

    return Model(tuple(round(math.log(p(True, b, c, EVEN_RANDOM) / p(False, b, c, EVEN_ORDINARY)), 6)
                       for b in range(SIZE + 1) for c in range(1, SIZE + 1)))


def _cut(text: Column, kind: int, pattern: str, need: str) -> Column:
    """array<struct<kind, gap, hit>> of a text: the characters before every
    match, and the match (empty after the last)."""
    cut = rf"(?s)(.*?)(?:({pattern})|\z)"
    gap, hit = (F.regexp_extract_all(text, F.lit(cut), F.lit(g)) for g in (1, 2))
    return F.when(text.rlike(need), F.transform(
        F.arrays_zip(gap.alias("gap"), hit.alias("hit")),
        lambda x: F.struct(F.lit(kind).alias("kind"), F.length(x["gap"]).alias("gap"),
                           x["hit"].alias("hit"))))


def find_spans(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text column, and ``secrets`` array<struct<kind
    string, start int, end int, value string, ratio double>> by place: code
    points, the end exclusive; ``ratio`` only of random spans."""
    others = [c for c in docs.columns if c != text_col]
    text = F.col("t")
    kinds = [*_BASE.values(), _RANDOM]
    cuts = [F.coalesce(_cut(text, k, *p), F.array()) for k, p in enumerate(kinds)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("r"),
                       F.col(text_col).alias("t"),
                       F.monotonically_increasing_id().alias("row"))
    # every row is there at least once, with or without a match
    cut = rows.select("row", "r", F.posexplode_outer(F.concat(*cuts)).alias("i", "m")).select(
        "row", F.when(F.col("i").isNull() | (F.col("i") == 0), F.col("r")).alias("r"), "i", "m.*")
    by_kind = Window.partitionBy("row", "kind").orderBy("i")
    placed = (cut.repartition("row")
              .withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(by_kind))
              .withColumn("start", F.col("end") - F.length("hit")))
    value = F.when(F.col("kind") == 0, F.regexp_extract("hit", ASSIGN, 1)).otherwise(F.col("hit"))
    good = F.when(F.col("kind") == 0, F.length("value") >= LEAST_ASSIGN) \
        .when(F.col("kind") == 3, F.col("ratio") >= RATIO).otherwise(F.col("hit") != "")
    placed = (placed.withColumn("value", value)
              .withColumn("ratio", F.when((F.col("kind") == 3) & (F.col("hit") != ""),
                                          model.ratio(F.col("hit"))))
              .withColumn("good", F.coalesce(good, F.lit(False)))
              .where("good OR r IS NOT NULL"))
    base = F.col("good") & (F.col("kind") < 3)
    order = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(base, F.col("end"))).over(
        order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(
        order.rowsBetween(1, Window.unboundedFollowing))
    clear = placed.withColumn("before", before).withColumn("after", after).withColumn(
        "good", F.expr("good AND (kind < 3 OR NOT (coalesce(before > start, false)"
                       " OR coalesce(after < end, false)))"))
    names = F.array(*map(F.lit, KINDS))
    span = F.struct(F.col("start").cast("int").alias("start"), "kind", F.col("end").cast("int").alias("end"),
                    "value", "ratio")
    found = clear.groupBy("row").agg(
        F.first("r", ignorenulls=True).alias("r"),
        F.array_sort(F.collect_list(F.when(F.col("good"), span))).alias("s"))
    secrets = F.transform("s", lambda x: F.struct(
        F.get(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        x["value"].alias("value"), x["ratio"].alias("ratio")))
    return found.select(*[F.col(f"r.`{c}`").alias(c) for c in others], secrets.alias("secrets"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
