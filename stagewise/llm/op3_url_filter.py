"""URL filter: rules first, then a ratio of two character language models.

Every URL that a rule decides is an example of accepted or rejected text. Two Markov
models of variable order (two characters of context, then one, then none, mixed by
Witten-Bell smoothing) are counted over all examples; a URL that no rule decides is
judged by the difference of its log-likelihoods per character. Only DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path prefix); a rule holds for its host and all subdomains.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Symbols of the models: start, end, letters, any digit, marks, anything else. Their number
#: bounds the models: at most len(SYMBOLS) ** 3 grams, one double each.
SYMBOLS = "^$abcdefghijklmnopqrstuvwxyz0./-_?=&%#:~*"
SIZE = len(SYMBOLS)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; both empty for a null URL or one without ``://``."""
    part = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return (pages.withColumn("host", F.translate(part(r"(?s)^.*?://([^/?#]*)"), _UPPER, _LOWER))
            .withColumn("path", part(r"(?s)^.*?://[^/?#]*([^?#]*)")))


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """Add ``rule`` and ``ruled`` (its verdict) of the longest rule that fits, else null."""
    rule = verdict = F.lit(None).cast("string")
    for said, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("ruled", verdict)


def _codes(url: str) -> F.Column:
    """The URL's symbols as numbers, with two starts and one end."""
    lower = F.translate(F.coalesce(F.col(url), F.lit("")), _UPPER + "123456789", _LOWER + "0" * 9)
    known = F.regexp_replace(lower, r"(?s)[^a-z0./\-_?=&%#:~]", "*")
    return F.transform(F.split(F.concat(F.lit("^^"), known, F.lit("$")), ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1)


def _grams(url: str) -> F.Column:
    """Numbers of the 3-grams of the URL."""
    codes = F.filter(_codes(url), lambda c: c >= 0)
    at = lambda i: F.element_at("_codes", i)
    return codes, F.transform(F.sequence(F.lit(1), F.size("_codes") - 2),
                              lambda i: (at(i) * SIZE + at(i + 1)) * SIZE + at(i + 2))


def with_grams(pages: DataFrame, url: str = "url") -> DataFrame:
    codes, grams = _grams(url)
    return pages.withColumn("_codes", codes).withColumn("_grams", grams).drop("_codes")


def model(examples: DataFrame) -> DataFrame:
    """One row with ``ratio``: log P(accepted) - log P(rejected) by 3-gram number.

    ``examples`` has ``_grams`` and ``ruled``. Counts are summed before the shuffle. A
    gram, context or symbol never seen falls back to the shorter context; the shortest
    is add-one smoothed, so every gram has a finite value.
    """
    spark = examples.sparkSession
    counts = (examples.where("ruled is not null").select("ruled", F.explode("_grams").alias("gram"))
              .groupBy("gram").agg(F.count_if(F.col("ruled") == "allow").alias("allow"),
                                   F.count_if(F.col("ruled") == "block").alias("block")))
    every = (spark.range(SIZE**3).withColumnRenamed("id", "gram").join(counts, "gram", "left").na.fill(0)
             .withColumn("_ab", F.expr(f"gram div {SIZE}")).withColumn("_bc", F.expr(f"gram % {SIZE * SIZE}"))
             .withColumn("_b", F.expr(f"_ab % {SIZE}")).withColumn("_c", F.expr(f"gram % {SIZE}")))

    def agg(df, key, suffix):
        return [F.expr(e) for s in ("allow", "block") for e in (f"sum({s}) as {s}{suffix}", f"count_if({s} > 0) as {s}{suffix}t")]

    pairs = every.groupBy("_bc", "_b", "_c").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    singles = pairs.groupBy("_c").agg(F.sum("allow").alias("allow1"), F.sum("block").alias("block1"))
    totals = singles.agg(F.sum("allow1").alias("allow0"), F.sum("block1").alias("block0"))
    contexts = pairs.groupBy("_b").agg(*agg(pairs, "_b", "2"))
    longest = every.groupBy("_ab").agg(*agg(every, "_ab", "3"))
    n = {s: F.lit(totals.select(f"{s}0").scalar()) for s in ("allow", "block")}
    one = singles.select("_c", *[((F.col(f"{s}1") + 1) / (n[s] + SIZE)).alias(f"{s}p1") for s in n])
    mix = lambda s, k, below: F.when(F.col(f"{s}{k}") > 0, (F.col(s) + F.col(f"{s}{k}t") * F.col(below)) / (F.col(f"{s}{k}") + F.col(f"{s}{k}t"))).otherwise(F.col(below))
    two = pairs.join(one, "_c").join(contexts, "_b").select("_bc", *[mix(s, 2, f"{s}p1").alias(f"{s}p2") for s in n])
    three = every.join(two, "_bc").join(longest, "_ab").select(
        "gram", (F.log(mix("allow", 3, "allowp2")) - F.log(mix("block", 3, "blockp2"))).alias("ratio"))
    return three.agg(F.transform(F.array_sort(F.collect_list(F.struct("gram", "ratio"))), lambda x: x["ratio"]).alias("ratio"))


def judge_urls(pages: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule, verdict and ``score`` (log-ratio per symbol) to ``pages``.

    Calibration: the threshold lies between the mean scores of accepted and rejected
    examples, nearer to the one whose scores spread less; without examples of either
    kind it is 0. A score at the threshold is allowed. Null, empty and very long URLs
    are scored alike (an empty one by its end alone); rows are kept one for one.
    """
    judged = with_grams(with_rule(with_parts(pages, url), rules), url)
    ratio = model(judged).scalar()
    total = F.aggregate("_grams", F.lit(0.0), lambda s, g: s + F.element_at(F.col("_ratio"), (g + 1).cast("int")))
    scored = judged.withColumn("_ratio", ratio).withColumn("score", total / F.size("_grams")).drop("_ratio", "_grams")
    side = lambda f, v: f(F.when(F.col("ruled") == v, F.col("score")))
    calibration = scored.agg(side(F.avg, "allow").alias("a"), side(F.avg, "block").alias("b"),
                             side(F.stddev_pop, "allow").alias("sa"), side(F.stddev_pop, "block").alias("sb"))
    threshold = calibration.select(F.expr(
        "coalesce(case when sa + sb > 0 then (a * sb + b * sa) / (sa + sb) else (a + b) / 2 end, 0D)")).scalar()
    return scored.withColumn("verdict", F.coalesce("ruled", F.when(F.col("score") >= threshold, "allow").otherwise("block"))).drop("ruled")


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


_RULE = "NULL", "NULL"
for _said, _host, _path in sorted(RULES, key=lambda r: len(r[1] + r[2])):
    _fits = f"CASE WHEN (host = '{_host}' OR suffix(host, '.{_host}')) AND prefix(path, '{_path}') THEN"
    _RULE = f"{_fits} '{_host}{_path}' ELSE {_RULE[0]} END", f"{_fits} '{_said}' ELSE {_RULE[1]} END"
_MIX = "CASE WHEN {n} > 0 THEN ({c} + {t} * {p}) / ({n} + {t}) ELSE {p} END"
SQL = f"""
WITH parts AS (
  SELECT page_id, url, row_number() OVER () AS r,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS MATERIALIZED (SELECT *, {_RULE[0]} AS rule, {_RULE[1]} AS ruled,
  '^^' || regexp_replace(translate(coalesce(url, ''), '{_UPPER}123456789', '{_LOWER}000000000'), '[^a-z0./\\-_?=&%#:~]', '*', 'gs') || '$' AS s FROM parts),
grams AS MATERIALIZED (SELECT r, ruled, substr(s, i, 3) AS g FROM (SELECT r, ruled, s, unnest(range(1, length(s) - 1)) AS i FROM ruled)),
c3 AS (SELECT substr(g, 1, 2) AS ab, substr(g, 2, 1) AS b, substr(g, 3, 1) AS c, substr(g, 2, 2) AS bc, g,
  count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS k FROM grams GROUP BY g),
x3 AS (SELECT ab, sum(a) AS an, count(*) FILTER (a > 0) AS at, sum(k) AS kn, count(*) FILTER (k > 0) AS kt FROM c3 GROUP BY ab),
c2 AS (SELECT bc, b, c, sum(a) AS a, sum(k) AS k FROM c3 GROUP BY bc, b, c),
x2 AS (SELECT b, sum(a) AS an, count(*) FILTER (a > 0) AS at, sum(k) AS kn, count(*) FILTER (k > 0) AS kt FROM c2 GROUP BY b),
p1 AS (SELECT c, (sum(a) + 1) / ((SELECT sum(a) FROM c3) + {SIZE}) AS a, (sum(k) + 1) / ((SELECT sum(k) FROM c3) + {SIZE}) AS k FROM c2 GROUP BY c),
p2 AS (SELECT bc, {_MIX.format(n='x2.an', c='c2.a', t='x2.at', p='p1.a')} AS a, {_MIX.format(n='x2.kn', c='c2.k', t='x2.kt', p='p1.k')} AS k
  FROM c2 JOIN x2 USING (b) JOIN p1 USING (c)),
p3 AS (SELECT g, ln({_MIX.format(n='x3.an', c='c3.a', t='x3.at', p='p2.a')}) - ln({_MIX.format(n='x3.kn', c='c3.k', t='x3.kt', p='p2.k')}) AS ratio
  FROM c3 JOIN x3 USING (ab) JOIN p2 USING (bc)),
score AS (SELECT r, avg(ratio) AS score FROM grams JOIN p3 USING (g) GROUP BY r),
cut AS (SELECT coalesce(CASE WHEN sa + sb > 0 THEN (a * sb + b * sa) / (sa + sb) ELSE (a + b) / 2 END, 0) AS t FROM (
  SELECT avg(score) FILTER (ruled = 'allow') AS a, avg(score) FILTER (ruled = 'block') AS b,
    stddev_pop(score) FILTER (ruled = 'allow') AS sa, stddev_pop(score) FILTER (ruled = 'block') AS sb
  FROM ruled JOIN score USING (r)))
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= t THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled JOIN score USING (r), cut
"""
