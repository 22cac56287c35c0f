"""URL filters: host and path rules, and a character language-model ratio for URLs that no rule decides.

Variable-order Markov models of accepted and of rejected URLs: the probability of a character after its context of up to three
characters is interpolated with that after the shorter context, down to a uniform one. A URL's score is the mean log ratio of
both models over its characters, each taken at its longest context that was seen. As a longer context only adds a difference
to a shorter one's ratio, a score is the sum of one number per n-gram of the URL: one join and one sum.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from docflow.llm.common import kept
from docflow.llm.line_dedup import LOWER, UPPER

ORDER = 3
# Weight of the shorter context's probability, in characters seen; and the alphabet of the uniform one.
SMOOTHING, ALPHABET = 2.0, 256
# Scores are calibrated on a grid of so many steps per nat.
STEPS = 64
# The table of grams is broadcast if it is counted to have at most so many rows, else shuffled.
MOST_BROADCAST = 500_000


@dataclass(frozen=True)
class Rule:
    """A verdict on all URLs of a host and its subdomains whose path starts with `path`."""

    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: from there up to ?, # or the end.

    A null URL and one without :// have an empty host and path.
    """
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(str(rule)).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def grams(lines: DataFrame, *keep: str) -> DataFrame:
    """A row (keep, gram) for each character of `line` and each context of 0 to ORDER characters before it.

    "^" begins a line and is a context only; "$" ends it and is a character.
    """
    # `chars` is used several times below, so it stays a column of its own and is split once.
    chars = lines.select(*keep, F.split(F.concat(F.lit("^"), "line", F.lit("$")), "").alias("chars"))

    def at(i: Column) -> Column:
        return F.array(*[F.when(i >= o, F.array_join(F.slice("chars", i + 1 - o, o + 1), "")) for o in range(ORDER + 1)])

    found = F.flatten(F.transform(F.sequence(F.lit(1), F.size("chars") - 1), at))
    return chars.select(*keep, F.explode(found).alias("gram")).filter("gram IS NOT NULL")


def log_ratios(lines: DataFrame, least: int = 2) -> DataFrame:
    """gram, delta: what a gram adds to the log ratio that its suffix gives.

    lines: line, accepted and rejected (how often). Grams seen fewer than `least` times are left to their suffixes; the
    suffix of a gram is seen at least as often.
    """
    counts = grams(lines, "accepted", "rejected").groupBy("gram").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    counts = kept(counts.withColumn("context", F.expr("left(gram, length(gram) - 1)")), "url-grams")
    totals = kept(counts.groupBy("context").agg(F.sum("a").alias("all_a"), F.sum("r").alias("all_r")), "url-contexts")
    counts = counts.filter(F.col("a") + F.col("r") >= least).join(totals, "context")
    shorter, levels = None, []
    for length in range(1, ORDER + 2):
        own = counts.filter(F.length("gram") == length)
        if shorter is None:
            own = own.withColumn("sa", F.lit(1 / ALPHABET)).withColumn("sr", F.lit(1 / ALPHABET))
        else:
            suffix = shorter.select(F.col("gram").alias("suffix"), F.col("pa").alias("sa"), F.col("pr").alias("sr"))
            own = own.withColumn("suffix", F.expr("substring(gram, 2)")).join(suffix, "suffix")
        pa = (F.col("a") + SMOOTHING * F.col("sa")) / (F.col("all_a") + SMOOTHING)
        pr = (F.col("r") + SMOOTHING * F.col("sr")) / (F.col("all_r") + SMOOTHING)
        own = own.select("gram", "sa", "sr", pa.alias("pa"), pr.alias("pr"))
        shorter = kept(own, "url-level")
        levels.append(shorter)
    delta = (F.log("pa") - F.log("pr")) - (F.log("sa") - F.log("sr"))
    rows = levels[0]
    for level in levels[1:]:
        rows = rows.union(level)
    return rows.select("gram", delta.alias("delta"))


def scored(lines: DataFrame, deltas: DataFrame) -> DataFrame:
    """h1, h2 of each line and its score: the mean log ratio over its characters."""
    deltas = kept(deltas, "url-deltas")
    if deltas.count() <= MOST_BROADCAST:
        deltas = F.broadcast(deltas)
    sums = grams(lines, "h1", "h2", "line_chars").join(deltas, "gram").groupBy("h1", "h2", "line_chars").agg(F.sum("delta").alias("sum"))
    return sums.select("h1", "h2", F.round(F.col("sum") / F.col("line_chars"), 9).alias("score"))


def threshold(known: DataFrame) -> float:
    """The least score to accept: of the grid, where the shares of accepted and rejected lines judged right add up to most.

    known: score, accepted, rejected. Ties: the one nearest to 0, then the lower. Without rejected lines all are accepted, without accepted
    ones none.
    """
    bins = known.groupBy(F.floor(F.col("score") * STEPS).alias("bin")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    totals = bins.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("r"), F.lit(0))).first()
    if not totals[1]:
        return float("-inf")
    if not totals[0]:
        return float("inf")
    up = Window.orderBy(F.desc("bin"))  # a row per step of the grid
    right = F.sum("a").over(up) / totals[0] + 1 - F.sum("r").over(up) / totals[1]
    best = bins.select("bin", F.round(right, 9).alias("right")).orderBy(F.desc("right"), F.abs("bin"), "bin").first()
    return best[0] / STEPS


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Add host, path, rule (null if none fits) and verdict (allow or block) to pages; columns of these names are replaced.

    The longest rule that fits decides. The other URLs are judged by models learned from all URLs that rules decide. A null URL, or one
    without ://, has an empty host and path and is judged like any other. Repeated URLs count each time; without URLs that rules block, or without
    rules, all others are allowed, and without URLs that rules allow, all others are blocked.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "_line")
    host, path = host_and_path(F.col(url))
    judged = pages.withColumn("host", host).withColumn("path", path).withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    line = F.concat("host", "path").alias("line")
    by_rule = F.col("_rule.verdict")
    lines = judged.select(line, by_rule.alias("by_rule")).groupBy("line").agg(
        F.count_if(F.col("by_rule") == "allow").alias("accepted"), F.count_if(F.col("by_rule") == "block").alias("rejected"),
        F.count_if(F.col("by_rule").isNull()).alias("open"),
    )
    hashes = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")]
    lines = kept(lines.select("*", *hashes, (F.length("line") + 1).alias("line_chars")), "url-lines")
    known = lines.filter("accepted + rejected > 0")
    scores = kept(scored(lines, log_ratios(known)), "url-scores")
    # A line none of whose characters was ever seen has no row: its ratio is 1.
    least = threshold(known.join(scores, ["h1", "h2"], "left").select(F.coalesce("score", F.lit(0.0)).alias("score"), "accepted", "rejected"))
    own = F.concat("host", "path")
    judged = judged.withColumn("_h1", F.xxhash64(own)).withColumn("_h2", F.xxhash64(F.lit(7), own))
    scores = scores.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("score").alias("_score"))
    judged = judged.join(scores, ["_h1", "_h2"], "left")
    by_model = F.when(F.coalesce("_score", F.lit(0.0)) >= least, "allow").otherwise("block")
    return judged.select(
        *pages.columns, "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), by_model).alias("verdict")
    )
