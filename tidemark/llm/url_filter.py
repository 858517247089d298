"""URL filters by pattern rules that are indexed by their rarest literal token.

A rule has a host (it and all its subdomains fit), a path prefix, an optional regular expression over the whole url and a
verdict. Its literal tokens are the labels of its host and the complete segments of its path; it is indexed
by the one that the fewest urls hold, counted over all urls. A url's tokens fetch candidate rules by an
equi-join, and only candidates run host, path and expression tests. Rules without a literal token are
tested against every url, in blocks of ``BLOCK`` rules, each one pass of expressions over the urls and no join. Only built-in column expressions are used.

The index is broadcast only if it holds at most ``BROADCAST_RULES`` rules, which is counted; beyond that the
join shuffles by token, and adaptive execution splits hot tokens.

Base rules outrank pattern rules; of fitting base rules the longest wins. Without one, a fitting pattern
rule gives the verdict (block outranks allow), else ``default``. Null urls, and urls without ``://``, have empty host and path and get the
default. Repeated rows are judged alike; empty tables give an empty result; other columns are ignored, whatever their names.

``load_rules`` reads filter lists of any size, in the common text form: ``||host^`` or ``||host/path`` blocks, ``@@`` before it allows, ``/expression/`` is tested on the whole url,
``||host/path$expression`` on the urls of a host and path; lines that begin with ``!`` or ``#``, and blank ones, say nothing. ``OWN_LIST`` is a small list of that form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace

BROADCAST_RULES = 100_000
BLOCK = 200
RULE_SCHEMA = "host string, path string, pattern string, verdict string, base boolean"
#: Rules of the query's contract.
BASE_RULES = [
    ("org", "/", None, "allow", True),
    ("example.org", "/es/", None, "block", True),
    ("example.org", "/en/1", None, "block", True),
    ("com", "/fr/", None, "allow", True),
    ("com", "/de/", None, "block", True),
]
#: Rules of the method's own: networks of adverts and trackers, link shorteners, link farms, and paths that hold no documents.
OWN_LIST = """
||doubleclick.net^
||googlesyndication.com^
||googleadservices.com^
||google-analytics.com^
||googletagmanager.com^
||adnxs.com^
||adsrvr.org^
||amazon-adsystem.com^
||taboola.com^
||outbrain.com^
||criteo.com^
||scorecardresearch.com^
||quantserve.com^
||hotjar.com^
||rubiconproject.com^
||pubmatic.com^
||openx.net^
||bit.ly^
||tinyurl.com^
||t.co^
||goo.gl^
||ow.ly^
||spam-farm.example.net^
||spam-farm.example.com^
||facebook.com/sharer/
||twitter.com/intent/
||wikipedia.org/wiki/Special:
||wikipedia.org/w/index.php$[?&]action=(edit|history)
@@||wikipedia.org/wiki/
/wp-login[.]php([?#]|$)
/:[/][/][^/]*[/](cart|checkout|login|signup|cgi-bin)([/?#]|$)
/[?&](sessionid|phpsessid|jsessionid)=/
"""

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), *LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens(host: Column, path: Column, whole_path: Column) -> Column:
    """Distinct literal tokens: host labels ``h:``, and path segments ``p:`` that are complete."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.split(path, "/")
    parts = F.when(whole_path, parts).otherwise(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))
    parts = F.transform(parts, lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.filter(F.concat(labels, parts), lambda x: F.length(x) > 2))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    ws = Workspace(spark, "url_filter")
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn("row", F.monotonically_increasing_id())
    urls = ws.put(urls.withColumn("tokens", tokens(F.col("host"), F.col("path"), F.lit(True))), "urls")

    rules = rules.select("*", F.xxhash64("host", "path", "pattern", "verdict", "base").alias("rule_id")).dropDuplicates(["rule_id"])
    held = rules.select("rule_id", F.explode(tokens(F.col("host"), F.col("path"), F.lit(False))).alias("token"))
    seen = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    held = held.join(seen, "token", "left").select("rule_id", "token", F.coalesce("n", F.lit(0)).alias("n"))
    rarest = held.groupBy("rule_id").agg(F.min(F.struct("n", "token")).alias("x")).select("rule_id", F.col("x.token").alias("token"))
    index = ws.put(rules.join(rarest, "rule_id", "left"), "index")
    sized = (lambda x: F.broadcast(x)) if index.count() <= BROADCAST_RULES else (lambda x: x)

    own = index.drop("rule_id").withColumnsRenamed({"host": "r_host", "path": "r_path", "token": "r_token"})
    fetched = urls.select("row", "url", "host", "path", F.explode("tokens").alias("token")).join(sized(own.where("r_token is not null")), F.col("token") == F.col("r_token"))
    cols = ["row", "url", "host", "path", "r_host", "r_path", "pattern", "verdict", "base"]
    fits = (
        ((F.col("host") == F.col("r_host")) | F.col("host").endswith(F.concat(F.lit("."), F.col("r_host"))) | (F.col("r_host") == ""))
        & F.col("path").startswith(F.col("r_path")) & (F.col("pattern").isNull() | F.rlike("url", F.col("pattern")))
    )
    fit = fetched.select(*cols).where(fits)
    for block in _blocks(own.where("r_token is null").orderBy(*cols[4:])):
        fit = fit.union(_scanned(urls, block).select(*cols))
    name = F.concat("r_host", "r_path")
    order = F.struct(F.col("base").cast("int").alias("b"), F.when(F.col("base"), F.length(name)).otherwise(F.lit(0)).alias("l"), (F.col("verdict") == "block").cast("int").alias("k"), name.alias("rule"), "verdict")
    best = fit.groupBy("row").agg(F.max(order).alias("best"))
    out = ws.put(urls.select("page_id", "host", "path", "row").join(best, "row", "left").select(
        "page_id", "host", "path",
        F.when(F.col("best.b") == 1, F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    ), "result")
    ws.keep("result")
    return out


def _blocks(rules: DataFrame):
    """Lists of at most ``BLOCK`` rules, one after the other."""
    block = []
    for r in rules.toLocalIterator():
        block.append(r)
        if len(block) == BLOCK:
            yield block
            block = []
    if block:
        yield block


def _scanned(urls: DataFrame, rules: list) -> DataFrame:
    """Urls with each of these rules (without a token: of no host, and of no complete path segment) that fits."""
    each = []
    for r in rules:
        fits = F.col("path").startswith(r["r_path"])
        if r["pattern"] is not None:
            fits = fits & F.rlike("url", F.lit(r["pattern"]))
        if r["r_host"]:
            fits = fits & ((F.col("host") == r["r_host"]) | F.col("host").endswith("." + r["r_host"]))
        each.append(F.when(fits, F.struct(*[F.lit(r[c]).cast("boolean" if c == "base" else "string").alias(c) for c in ("r_host", "r_path", "pattern", "verdict", "base")])))
    hits = F.filter(F.array(*each), lambda x: x.isNotNull())
    return urls.select("row", "url", "host", "path", F.inline(hits))


#: Parts of a line of a filter list: sign of an allowing rule, host, path and expression, or an expression alone.
LINE = r"^(@@)?(?:\|\|([^/^$|]+)(?:\^|(/[^$]*))?(?:\$(.+))?|/(.+?)/?)$"


def parse_rules(lines: DataFrame) -> DataFrame:
    """Rules of a filter list's lines (value string). Lines of any other form are left out."""
    x = lines.select(F.trim("value").alias("v")).where(~F.col("v").rlike("^(?:$|[!#])") & F.col("v").rlike(LINE))
    part = lambda i: F.regexp_extract("v", LINE, i)
    pattern = F.coalesce(F.nullif(part(4), F.lit("")), F.nullif(part(5), F.lit("")))
    verdict = F.when(part(1) == "@@", "allow").otherwise("block")
    return x.select(F.translate(part(2), *LOWER).alias("host"), part(3).alias("path"), pattern.alias("pattern"), verdict.alias("verdict"), F.lit(False).alias("base"))


def load_rules(spark, path: str) -> DataFrame:
    """Rules of a filter list, from any place that Spark reads."""
    return parse_rules(spark.read.text(path))


def contract_rules(spark) -> DataFrame:
    own = parse_rules(spark.createDataFrame([(x,) for x in OWN_LIST.splitlines()], "value string"))
    return spark.createDataFrame(BASE_RULES, RULE_SCHEMA).unionByName(own)


def own_rules() -> list[tuple]:
    """``OWN_LIST`` as rows of rules."""
    import re

    found = [re.match(LINE, x.strip()) for x in OWN_LIST.splitlines() if x.strip() and x.strip()[0] not in "!#"]
    return [((m[2] or "").lower(), m[3] or "", m[4] or m[5] or None, "allow" if m[1] else "block", False) for m in found if m]


def oracle() -> str:
    """The query in DuckDB's SQL."""
    values = ", ".join("(" + ", ".join("NULL" if x is None else str(x).lower() if isinstance(x, bool) else "'" + x.replace("'", "''") + "'" for x in r) + ")" for r in BASE_RULES + own_rules())
    return f"""
WITH rules(r_host, r_path, pattern, verdict, base) AS (VALUES {values}),
u AS (SELECT row_number() OVER () AS rid, page_id, url,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{LOWER[0]}', '{LOWER[1]}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fit AS (SELECT u.rid, r.*, row_number() OVER (PARTITION BY u.rid ORDER BY r.base DESC,
        CASE WHEN r.base THEN length(r_host || r_path) ELSE 0 END DESC, (r.verdict = 'block') DESC, r_host || r_path DESC) AS place
        FROM u JOIN rules r ON (u.host = r.r_host OR ends_with(u.host, '.' || r.r_host)) AND starts_with(u.path, r.r_path)
        AND (r.pattern IS NULL OR regexp_matches(u.url, r.pattern)))
SELECT u.page_id, u.host, u.path, CASE WHEN f.base THEN f.r_host || f.r_path END AS rule, coalesce(f.verdict, 'allow') AS verdict
FROM u LEFT JOIN fit f ON u.rid = f.rid AND f.place = 1"""
