"""URL verdicts: host and path rules, and a character language-model ratio
for the URLs no rule fits (built-in expressions only).

Distinct URLs that a rule accepts or rejects train one smoothed
variable-order Markov model each.  A character c after the context x of k
characters has

    P(c | x) = (n(xc) + M * P(c | x without its first character)) / (n(x) + M)

down to the uniform 1 / ALPHABET below the empty context, so a context the
class has not seen falls back to the longest one it has.  A URL's score is
the mean over its characters (and its end) of ln P_accepted - ln P_rejected,
in whole millionths a character.  The whole URL is read: scheme, query and
fragment too.

The threshold is calibrated on labelled URLs that the model has not seen: a
hash fold (``held_out``, first hex digits of a URL's md5) is left out of a
first count, and the threshold is the score step at which its accepted and
rejected URLs separate best (largest difference of the shares at or above
it; the lowest of equals).  The scores of unlabelled URLs come from the
counts of all labelled ones, the fold included.

Counts and scores cover all URLs.  Copies of a URL count once.  All tables
are per n-gram or per URL; counts are combined before they shuffle.

Defined cases: a null url or one without ``://`` has empty host and path and
fits no rule; the model reads a null url as the empty text; no accepted or
no rejected fold leaves the threshold at 0; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.shared import stored

ORDER = 4       # characters of context at most
M = 1.0         # weight of the shorter context
ALPHABET = 256.0
HELD_OUT = ("0", "1", "2")  # default fold: 3 of 16 labelled URLs
SETS = ("a", "r", "all_a", "all_r")  # accepted and rejected, without the fold and with it
STEP = 10_000   # millionths a score step has
START, END = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else nulls.  One
    branch a rule: meant for lists written by hand."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def grams(text: Column) -> Column:
    """Every character and the end, each with the ORDER characters before it."""
    chars = F.regexp_extract_all(F.concat(F.lit(START * ORDER), text, F.lit(END)), F.lit("(?s)."), F.lit(0))
    return F.get(F.transform(F.array(chars), lambda c: F.transform(
        F.slice(c, ORDER + 1, F.size(c)),
        lambda _, i: F.array_join(F.slice(c, i + 1, F.lit(ORDER + 1)), ""))), F.lit(0))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, a, r, all_a, all_r): counts of full grams in accepted and
    rejected URLs, zero included -> (gram, ratio, all_ratio): ln P_accepted -
    ln P_rejected in millionths, without the fold and with it."""
    sums = lambda prefix: [F.sum(c).alias(prefix + c) for c in SETS]
    levels = [counts]
    for _ in range(ORDER):  # the same counts for every shorter context
        shorter = F.substring("gram", 2, ORDER + 1).alias("gram")
        levels.append(stored(levels[-1].groupBy(shorter).agg(*sums("")), "grams"))
    known = None
    for level in reversed(levels):
        context = F.expr("substring(gram, 1, length(gram) - 1)")
        total = level.groupBy(context.alias("context")).agg(*sums("of_"))
        rows = level.withColumn("context", context).join(total, "context")
        if known is None:
            rows = rows.withColumns({f"lower_{c}": F.lit(1 / ALPHABET) for c in SETS})
        else:
            lower = known.select(F.col("gram").alias("end"), *[F.col(f"p_{c}").alias(f"lower_{c}") for c in SETS])
            rows = rows.withColumn("end", F.expr("substring(gram, 2)")).join(lower, "end")
        known = rows.select("gram", *[((F.col(c) + M * F.col(f"lower_{c}")) / (F.col(f"of_{c}") + M)).alias(f"p_{c}")
                                      for c in SETS])
    ratio = lambda a, r: F.round(1e6 * (F.log(f"p_{a}") - F.log(f"p_{r}"))).cast("long")
    return known.select("gram", ratio("a", "r").alias("ratio"), ratio("all_a", "all_r").alias("all_ratio"))


def _threshold(scored: DataFrame) -> int:
    """The separating step; steps are few (a score is bounded by the least
    probability), so one small table is ordered."""
    steps = scored.groupBy("step").agg(F.count_if(F.col("label") == "allow").alias("a"),
                                       F.count_if(F.col("label") == "block").alias("r"))
    down = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(1))
    gain = F.sum("a").over(down) * F.sum("r").over(every) - F.sum("r").over(down) * F.sum("a").over(every)
    best = steps.withColumn("gain", gain).agg(F.max(F.struct("gain", -F.col("step"))).alias("best")).first()["best"]
    return -best[1] if best is not None and best[0] > 0 else 0


def judge(pages: DataFrame, rules: list[Rule], held_out: tuple[str, ...] = HELD_OUT) -> DataFrame:
    """Pages (page_id, url) -> (page_id, host, path, rule, verdict)."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url").cast("string"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"),
                         F.coalesce(F.col("url").cast("string"), F.lit("")).alias("text"))
    rule, label = fitting_rule(F.col("host"), F.col("path"), rules)
    split = split.withColumn("rule", rule).withColumn("label", label)
    # an exchange of its own number of partitions: one task must not explode all URLs because they are short
    urls = (split.groupBy(F.col("text").alias("url")).agg(F.min("label").alias("label"))
            .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "url"))
    urls = urls.withColumn("held", F.substring(F.md5(F.col("url").cast("binary")), 1, 1).isin(*held_out))
    urls = stored(urls, "urls")
    places = urls.withColumn("gram", F.explode(grams(F.col("url"))))
    is_ = lambda v: F.col("label") == v
    counts = stored(places.groupBy("gram").agg(
        F.count_if(is_("allow") & ~F.col("held")).alias("a"), F.count_if(is_("block") & ~F.col("held")).alias("r"),
        F.count_if(is_("allow")).alias("all_a"), F.count_if(is_("block")).alias("all_r")), "grams")
    ratios = stored(log_ratios(counts), "ratios")
    mean = F.sum(F.when(F.col("label").isNull(), F.col("all_ratio")).otherwise(F.col("ratio"))) / F.count(F.lit(1))
    # (by sorting: the size of the URLs says nothing about that of their grams, so these must not be broadcast)
    scored = stored(places.where("label is null or held").select("url", "label", "gram").hint("merge").join(ratios, "gram")
                    .groupBy("url").agg(F.min("label").alias("label"),
                                        F.floor(mean / STEP).cast("long").alias("step")), "scores")
    threshold = _threshold(scored.where("label is not null"))
    own = scored.where("label is null").select(
        F.col("url").alias("scored"), F.when(F.col("step") >= threshold, "allow").otherwise("block").alias("model"))
    return (split.join(own, (F.col("text") == F.col("scored")) & F.col("label").isNull(), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("label", "model").alias("verdict")))
