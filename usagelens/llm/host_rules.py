"""Quality rules of a document and of its host (built-in expressions only).

A document fails the base rules on its own counts.  Failures are summed per
host, and a host's failure rate is shrunk towards all hosts' by an empirical
beta prior: a host of two documents says little about the third.  Hosts
whose shrunken rate is over ``max_rate`` are rejected with all their
documents.

The prior comes from the moments of the beta-binomial: with n documents and
k failures a host, N and K in all, H hosts and m = K / N, the intra-host
correlation is

    g = (sum(k^2 / n) - K^2 / N - m (1 - m) (H - 1))
        / (m (1 - m) (N - sum(n^2) / N - (H - 1)))

clipped to [1e-6, 1 - 1e-6], the prior's strength is s = (1 - g) / g, and a
host's rate is (k + m s) / (n + s).  k^2 / n is summed in whole millionths,
so the sum does not depend on its order.

Defined cases: null text is empty, has no words and fails; a document
without a source has no host and stands on its own counts; repeated rows
count as often as they occur; no hosts or one host give no correlation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.shared import let, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RATE = 0.5
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
LEAST, MOST = 1e-6, 1 - 1e-6


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more (64-bit window hashes)."""
    hashes = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                     1, F.greatest(F.size(words) - 2, F.lit(0)))

    def starts(order: Column) -> Column:  # of the repeated windows, ascending
        own = lambda j: F.get(order, j)["h"]
        return F.sort_array(F.transform(
            F.filter(order, lambda x, j: F.coalesce(x["h"] == own(j - 1), F.lit(False))
                     | F.coalesce(x["h"] == own(j + 1), F.lit(False))), lambda x: x["i"]))

    def covered(at: Column) -> Column:  # windows of three overlap
        zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at"))
        return F.aggregate(at, zero, lambda a, x: F.struct(
            (a["n"] + F.least(F.lit(3), x - a["at"])).alias("n"), x.alias("at")), lambda a: a["n"])

    def count(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(order, lambda o: covered(starts(o))))

    return let(hashes, count)


def measures(text: Column) -> Column:
    """A struct of the counts the base rules use."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(words).cast("long").alias("n_repeat_words")))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def host_verdicts(hosts: DataFrame, max_rate: float) -> DataFrame:
    """(host, n, failed) -> the same with ``rate``, the shrunken rate, and ``host_kept``."""
    n, k = F.col("n"), F.col("failed")
    total = hosts.agg(F.count(F.lit(1)), F.sum(n), F.sum(k), F.sum(n.cast("decimal(38,0)") * n),
                      F.sum(F.floor(k.cast("decimal(20,0)") * k * 1_000_000 / n).cast("decimal(38,0)"))).first()
    h, big_n, big_k, squares, parts = (float(x or 0) for x in total)
    mean = big_k / big_n if big_n else 0.0
    spread = mean * (1 - mean)
    below = spread * (big_n - squares / big_n - (h - 1)) if big_n else 0.0
    above = parts / 1e6 - big_k * big_k / big_n - spread * (h - 1) if big_n else 0.0
    g = min(max(above / below, LEAST), MOST) if below > 0 else LEAST
    strength = (1 - g) / g
    rate = (k + F.lit(mean * strength)) / (n + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("host_kept", rate <= max_rate)


def quality(docs: DataFrame, carry: list[str] | None = None, host: str = "source",
            max_rate: float = MAX_RATE) -> DataFrame:
    """(doc, counts, base_failed, host_n, host_failed, kept): ``doc`` is a
    struct of the columns to ``carry`` (all by default), so that no name can clash."""
    m = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("doc"),
                    F.col(host).cast("string").alias("host"), measures(F.col("text")).alias("counts"))
    counts = F.col("counts")
    failed = ((counts["n_words"] < MIN_WORDS)
              | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]))
    measured = stored(m.withColumn("base_failed", failed), "quality")
    hosts = stored(measured.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts")
    verdicts = host_verdicts(hosts, max_rate).select(
        F.col("host").alias("of"), F.col("n").alias("host_n"), F.col("failed").alias("host_failed"), "host_kept")
    return (measured.join(verdicts, F.col("host") == F.col("of"), "left")
            .select("doc", "counts", "base_failed", "host_n", "host_failed",
                    (~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))).alias("kept")))
