"""URL filters: host and path rules, and a logistic regression for the rest.

The regression reads hashed character n-grams of host and of path.  It is trained by
gradient descent on a small labelled table of URLs (MOST_LABELLED rows at most),
labelled_urls() unless another is given.  All steps run inside one SQL expression over one
row, so training is one query.  Everything is DataFrame and SQL functions.

A null url, or one without ``://``, has an empty host and path; no rule fits it,
and the regression judges its empty text.  Very long urls are read whole.  With no
labelled URL all weights are 0 and the verdict is allow.  Of rules of equal length
the later one holds.  Repeated rows are judged alike; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: (verdict, host, path); a rule fits its host, all subdomains, and paths that start with its own.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
BITS, GRAMS = 12, (3, 4)
#: Steps, rate and weight decay of the training, and most labelled rows.
STEPS, RATE, DECAY, MOST_LABELLED = 40, 48.0, 1e-4, 10_000
#: A URL that no rule decides is blocked above this probability, which does best on words left out of the training.
THRESHOLD = 0.5
#: What the labelled table is made from: words of junk trade (block) and of ordinary
#: pages (allow), and paths of either kind.  Hosts of both kinds have the same forms.
JUNK = (
    "casino", "poker", "slots", "jackpot", "betting", "roulette", "lottery", "bingo", "viagra", "cialis", "pharmacy", "pills", "steroids", "tablets", "loans", "payday", "forex", "refinance", "mortgage", "debt",
    "replica", "rolex", "handbags", "outlet", "cheap", "discount", "coupons", "clearance", "free", "bonus", "prizes", "winner", "giveaway", "reward", "adult", "xxx", "porn", "cams", "escort", "hookup",
    "torrent", "warez", "keygen", "crack", "serials", "malware", "phishing", "spam", "linkfarm", "backlinks", "clickbait", "popunder", "tracker", "miracle", "slimming", "detox", "getrich", "doubler", "moneyback", "hotdeal",
)
ORDINARY = (
    "university", "college", "school", "library", "museum", "archive", "gazette", "herald", "journal", "weather", "climate", "forest", "garden", "kitchen", "recipes", "bakery", "travel", "railway", "airport", "harbour",
    "hospital", "clinic", "physics", "biology", "chemistry", "history", "geography", "council", "parliament", "ministry", "embassy", "court", "theatre", "orchestra", "cinema", "gallery", "football", "cycling", "chess", "sailing",
    "linux", "python", "compiler", "database", "encyclopedia", "dictionary", "grammar", "letters", "photos", "maps", "charity", "church", "village", "mountain", "river", "astronomy", "pottery", "knitting", "teachers", "engineers",
)
JUNK_PATHS = ("/buy/{0}", "/{0}/bonus", "/free-{0}", "/order-now", "/go/{1}", "/promo/{0}-50-off", "/win/{1}", "/aff/{0}/click", "/download-{1}-crack", "/cheap/{0}.php")
ORDINARY_PATHS = ("/about", "/news/2019/04/{0}", "/wiki/{0}", "/articles/{0}-{1}", "/docs/{0}.html", "/{0}/contact", "/en/{1}", "/blog/{0}", "/history/{1}", "/events/{0}.html")
NEUTRAL_PATHS = ("/", "/index.html", "")
HOSTS = ("{0}.com", "www.{0}-{1}.net", "{0}{1}.org", "{1}.{0}.info", "my-{0}.net", "www.{0}.org", "{0}-{1}.com", "the{0}.info")


def labelled_urls(junk=JUNK, ordinary=ORDINARY) -> list[tuple[str, str, int]]:
    """(host, path, 1 for block): every word in a host of its own, with two paths of its kind and a neutral one."""
    out = []
    for words, paths, y in ((junk, JUNK_PATHS, 1), (ordinary, ORDINARY_PATHS, 0)):
        for i, word in enumerate(words):
            other = words[(7 * i + 3) % len(words)]
            host = HOSTS[i % len(HOSTS)].format(word, other)
            for path in (paths[i % len(paths)], paths[(3 * i + 1) % len(paths)], NEUTRAL_PATHS[i % len(NEUTRAL_PATHS)]):
                out.append((host, path.format(word, other), y))
    return out


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    text = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer rule overrules a shorter one
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def features(host: str, path: str) -> Column:
    """Buckets of the distinct character n-grams of host and of path, and the bias bucket."""
    parts = []
    for kind, text in (("h", f"concat('^', {host}, '$')"), ("p", f"concat('^', {path}, '$')")):
        parts += [f"transform(sequence(1, greatest(char_length({text}) - {n - 1}, 1)), i -> cast(pmod(xxhash64('{kind}', substr({text}, i, {n})), {1 << BITS}) as int))" for n in GRAMS]
    return F.array_append(F.array_distinct(F.expr(f"concat({', '.join(parts)})")), F.lit(1 << BITS))


def train(labelled: DataFrame, steps: int = STEPS) -> list[float]:
    """Weights of the 2^BITS buckets, then the bias, from labelled (host, path, y).
    The table is packed into one row, as URLs with their buckets and as buckets with
    their URLs; a step is two passes over it, the gradient's sums in a fixed order,
    so reruns agree to the last bit."""
    if labelled.limit(MOST_LABELLED + 1).count() > MOST_LABELLED:
        raise ValueError(f"at most {MOST_LABELLED} labelled URLs")
    place = F.row_number().over(W.orderBy("host", "path", "y")) - 1
    urls = labelled.select(place.alias("o"), features("host", "path").alias("l"), F.col("y").cast("double").alias("y"))
    buckets = urls.select(F.explode("l").alias("b"), "o").groupBy("b").agg(F.sort_array(F.collect_list("o")).alias("l"))
    every = labelled.sparkSession.range((1 << BITS) + 1).select(F.col("id").cast("int").alias("o"))
    buckets = every.join(buckets, every["o"] == buckets["b"], "left").select("o", F.coalesce("l", F.array().cast("array<int>")).alias("l"), F.lit(None).cast("double").alias("y"))
    both = urls.withColumn("url", F.lit(True)).unionByName(buckets.withColumn("url", F.lit(False)))
    pack = lambda test: F.sort_array(F.collect_list(F.when(test, F.struct("o", "l", "y"))))
    row = both.agg(pack(F.col("url")).alias("us"), pack(~F.col("url")).alias("bs"))
    margin = "aggregate(u.l, 0D, (a, i) -> a + w[i]) / sqrt(size(u.l))"
    errors = f"transform(us, u -> (u.y - 1 / (1 + exp(-{margin}))) / sqrt(size(u.l)))"
    moved = f"transform(bs, (b, i) -> (w[i] + {RATE}D / (1 + k / 40D) / greatest(size(us), 1) * aggregate(b.l, 0D, (a, j) -> a + e[j])) * {1 - DECAY}D)"
    # e is bound by a list of one, so each step's errors are computed once
    fit = F.expr(f"aggregate(sequence(1, {steps}), array_repeat(0D, {(1 << BITS) + 1}), (w, k) -> element_at(transform(array({errors}), e -> {moved}), 1))")
    return list(row.select(fit.alias("w")).first()["w"])


def probability(f: str, w: list[float]) -> Column:
    """Probability of block, from the bucket array in column f."""
    weights = F.split(F.lit(",".join(map(repr, w))), ",").cast("array<double>")  # folds to one literal
    total = F.aggregate(F.col(f), F.lit(0.0), lambda acc, b: acc + F.get(weights, b))
    return 1 / (1 + F.exp(-total / F.sqrt(F.size(f).cast("double"))))


def judge_urls(pages: DataFrame, url_col: str = "url", id_col: str = "page_id", labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """id_col, host, path, rule, verdict and p_block of every row.  labelled may
    give another small table (host, path, y)."""
    split = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": text, "ruled": verdict})
    if labelled is None:
        labelled = pages.sparkSession.createDataFrame(labelled_urls(), "host string, path string, y int")
    w = train(labelled)
    p = probability("f", w)
    judged = ruled.withColumn("f", features("host", "path")).withColumn("p_block", p)
    return judged.select(id_col, "host", "path", "rule", F.coalesce("ruled", F.when(F.col("p_block") > THRESHOLD, "block").otherwise("allow")).alias("verdict"), "p_block")
