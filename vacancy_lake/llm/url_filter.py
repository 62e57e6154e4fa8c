"""URL rules found through their rarest literal token; only candidate rules run their expression.

DataFrame functions only.  Every rule has literal tokens (runs of letters and digits between
separators) that any URL it matches must hold.  The index stores a rule under the one of them that
the fewest URLs hold; a URL's own tokens fetch the rules, and those alone are tried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Up to so many rules the index is broadcast (a rule takes well under 1 KB); beyond, Spark shuffles.
BROADCAST_RULES = 10_000
#: Characters that end a token.
SEPARATOR = "[^a-z0-9]"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported, ``regex`` must match ``target`` (site: host and path; url: all of it, in
    lower case), ``tokens`` are literals of every match, the highest ``rank`` wins."""

    name: str
    verdict: str
    regex: str
    target: str
    tokens: tuple[str, ...]
    rank: int


def prefix_rule(prefix: str, verdict: str) -> Rule:
    """``host/path``: fits the host and all its subdomains where the URL's path starts with the rule's."""
    host, slash, path = prefix.partition("/")
    whole = f".{host}{slash}{path}"  # a token counts only between separators; the path's end is open
    tokens = re.findall(r"(?<=[^a-z0-9])[a-z0-9]+(?=[^A-Za-z0-9])", whole)
    regex = rf"^([^/]*\.)?{re.escape(host + slash + path)}"
    return Rule(prefix, verdict, regex, "site", tuple(dict.fromkeys(tokens)), 1_000_000 + len(prefix))


#: Rank of exceptions, above all blocking patterns and below prefix rules.
EXCEPTION = 500_000


def pattern_rule(pattern: str) -> Rule:
    """``*`` stands for anything, ``^`` for a separator or the end; ``||`` in front is the start of the
    host or of one of its labels, ``|`` in front or behind the URL's start or end; the rest is literal,
    in lower case.  ``@@`` before all that makes it an exception: it allows, whatever blocks."""
    body = pattern.removeprefix("@@")
    literal = body.removeprefix("||") if body.startswith("||") else body.removeprefix("|")
    front = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#]*\.)?" if body.startswith("||") else "^" if body.startswith("|") else ""
    ends = literal.endswith("|")
    parts = {"*": ".*", "^": f"(?:^|{SEPARATOR}|$)"}
    regex = "(?s)" + front + "".join(parts.get(c, re.escape(c)) for c in literal.removesuffix("|")) + ("$" if ends else "")
    tokens = re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", body)
    if not tokens:
        raise ValueError(f"no literal token between separators in {pattern!r}")
    exception = pattern.startswith("@@")
    rank = len(pattern) + (EXCEPTION if exception else 0)
    return Rule(pattern, "allow" if exception else "block", regex, "url", tuple(dict.fromkeys(tokens)), rank)


def site_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr({u}, instr({u}, '://') + 3)".format(u="__url")))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_index(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule, under the literal token that the fewest of ``urls`` (column tokens) hold."""
    schema = T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("verdict", T.StringType()),
            T.StructField("regex", T.StringType()),
            T.StructField("target", T.StringType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("token", T.StringType()),
        ]
    )
    spark = urls.sparkSession
    rows = [(r.name, r.verdict, r.regex, r.target, r.rank, t) for r in rules for t in r.tokens]
    literals = spark.createDataFrame(rows, schema)
    wanted = literals.select("token").distinct()
    if len(rules) <= BROADCAST_RULES:
        wanted = F.broadcast(wanted)
    seen = (
        urls.select(F.explode("tokens").alias("token"))
        .join(wanted, "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    # A token that no URL holds has no row here: its rule cannot match and leaves the index.
    counted = literals.join(seen, "token", "left").fillna(0, ["n"])
    return (
        counted.groupBy("name", "verdict", "regex", "target", "rank")
        .agg(F.min_by("token", F.struct("n", "token")).alias("token"), F.min("n").alias("n"))
        .filter("n > 0")
        .drop("n")
    )


def filter_urls(
    pages: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Per row of ``pages``: id, host, path, rule (of the winning prefix rule), verdict, pattern.

    Null, empty or malformed URLs have an empty host and path, no rule and the default verdict.
    Of several rules the highest rank wins (prefix rules by length, then exceptions, then blocking
    patterns, by length), then the last name.  Rows repeat as in ``pages``;
    each distinct URL is judged once.  Other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"))
    host, path = site_parts(F.col("__url"))
    urls = rows.select("__url").filter(F.col("__url").isNotNull()).distinct().select(
        "__url",
        F.concat(host, path).alias("site"),
        F.array_distinct(F.split(F.lower("__url"), f"{SEPARATOR}+")).alias("tokens"),
    )
    index = rule_index(urls, rules)
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    tried = urls.select("__url", "site", F.explode("tokens").alias("token")).join(index, "token")
    fits = F.expr("if(target = 'site', site, lower(__url)) rlike regex")
    best = (
        tried.filter(fits)
        .groupBy("__url")
        .agg(F.max_by(F.struct("name", "verdict", "target"), F.struct("rank", "name")).alias("best"))
    )
    return rows.join(best, "__url", "left").select(
        F.col("__id").alias(id_col),
        host.alias("host"),
        path.alias("path"),
        F.when(F.col("best.target") == "site", F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("best.target") == "url", F.col("best.name")).alias("pattern"),
    )


#: Our own patterns, by kind (words of public block lists' categories): what no page of prose has in its URL
#: as a word, kinds of files, pages that hold no text of their own, parameters that name a visit,
#: hosts that serve no pages, and exceptions.
WORDS = (
    "casino casinos poker slots roulette betting bookmaker jackpot lottery porn porno xxx sex sexy nude nudes "
    "escort escorts camgirl hentai milf viagra cialis levitra payday warez keygen torrent torrents crack"
).split()
ENDINGS = (
    "zip rar gz tgz bz2 7z exe msi dmg iso apk jar deb rpm bin jpg jpeg png gif webp svg ico bmp tif mp3 mp4 avi mkv mov wav "
    "flac ogg webm css js json xml rss atom woff woff2 ttf pdf doc docx xls xlsx ppt pptx"
).split()
PATHS = (
    "wp-login wp-admin wp-json login logout signin signup register cart checkout basket wishlist account password captcha "
    "unsubscribe subscribe search tag tags feed print share compare calendar cgi-bin xmlrpc trackback sitemap"
).split()
PARAMS = (
    "sessionid phpsessid jsessionid sid gclid fbclid msclkid dclid yclid mc_eid mc_cid igshid ref_src replytocom share "
    "action add-to-cart print output"
).split()
HOSTS = "ads ad adserver banner banners track tracker tracking click clicks pixel stats metrics analytics cdn static img images mail ftp".split()
EXCEPTIONS = "@@||wiki. @@||docs. @@||archive. @@/wiki/ @@/docs/ @@/article/ @@/articles/ @@/blog/".split()
PATTERNS = [
    "^utm_source=feed^",
    "^page=*&ref=x^",
    *[f"^{x}^" for x in WORDS],
    *[f".{x}|" for x in ENDINGS],
    *[f"/{x}^" for x in PATHS],
    *[f"^{x}=" for x in PARAMS],
    *[f"||{x}." for x in HOSTS],
    *EXCEPTIONS,
]
#: The contract's rules, then the patterns.
RULES = [
    prefix_rule("org/", "allow"),
    prefix_rule("example.org/es/", "block"),
    prefix_rule("example.org/en/1", "block"),
    prefix_rule("com/fr/", "allow"),
    prefix_rule("com/de/", "block"),
    *map(pattern_rule, PATTERNS),
]


def _sql_test(pattern: str) -> str:
    """A pattern as SQL over u (the URL in lower case), its words, and its host."""
    body = pattern.removeprefix("@@")
    if body.startswith("||"):
        return f"(starts_with(h, '{body[2:]}') OR contains(h, '.{body[2:]}'))"
    if body.endswith("|"):
        return f"ends_with(u, '{body[:-1]}')"
    if body == "^page=*&ref=x^":
        return "regexp_matches(u, '(^|[^a-z0-9])page=.*&ref=x([^a-z0-9]|$)')"
    if body[0] == "^" and body[-1] == "^" and body[1:-1].isalnum():
        return f"list_contains(words, '{body[1:-1]}')"
    if body[0] == "^":
        return f"regexp_matches(u, '(^|[^a-z0-9]){body[1:].replace('^', '([^a-z0-9]|$)')}')"
    if body[-1] == "^":
        return f"regexp_matches(u, '{body[:-1]}([^a-z0-9]|$)')"
    return f"contains(u, '{body}')"


_BEST_FIRST = sorted(PATTERNS, key=lambda p: (p.startswith("@@"), len(p), p), reverse=True)
_FIT = "\n".join(f"      WHEN {_sql_test(p)} THEN '{p}'" for p in _BEST_FIRST)

ORACLE = r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, lower(url) AS u, regexp_split_to_array(lower(url), '[^a-z0-9]+') AS words,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS h,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    CASE
@FIT@ END AS fit
  FROM split
)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'org/' THEN 'allow' WHEN 'com/fr/' THEN 'allow'
                 WHEN 'example.org/es/' THEN 'block' WHEN 'example.org/en/1' THEN 'block' WHEN 'com/de/' THEN 'block'
                 ELSE CASE WHEN fit IS NULL OR starts_with(fit, '@@') THEN 'allow' ELSE 'block' END END AS verdict,
       CASE WHEN rule IS NULL THEN fit END AS pattern
FROM ruled
""".replace("@FIT@", _FIT)
