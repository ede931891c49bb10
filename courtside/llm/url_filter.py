"""Operator 12: URL filters by a blocked Bloom filter and an exact hash join (native).

A list holds rules (a host and the beginning of a path) and whole canonical URLs.  Every entry is a
key, and the keys make a blocked Bloom filter: a key picks one block of eight 64-bit words and sets
one bit in each.  A page's URL yields the keys it could be listed under: its canonical URL, and its
host's suffixes times its path's beginnings in the shapes (labels of the host, length of the path)
that the rules have.  Keys whose bits are all set are possible hits; an exact hash join with the
listed keys removes the false ones, and of a page's rules the longest wins.

The filter has at most ``MAX_BLOCKS`` blocks (4 MB), which bounds its broadcast; a longer list lets
more false hits pass, never fewer true ones.  Keys of many pages (``net/`` may fit a third of all)
are broadcast, the others shuffled (``common.join_facts``).

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there
up to ``?``, ``#`` or the end; a URL that is null or has no ``://`` has both empty and no canonical
form.  A canonical URL has no scheme, ``www.``, port 80 or 443, final slash, fragment or tracking
parameter, and its parameters are sorted.  A rule fits its host and all subdomains where the path
starts with the rule's; among several the one with the longest text wins, then the longest host.
An entry listed as both block and allow blocks.  A page without a rule is blocked where its
canonical URL is listed, else allowed.

Every page gives one row, also with a null or repeated page_id; empty pages: no rows; an empty list
allows all.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import join_facts, staged, table

WORDS, WORD_BITS = 8, 64  # a block's words
KEY_BITS = 16  # bits of the filter for each listed key
MAX_BLOCKS = 65_536
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = "^(utm_[a-z_]+|ref|gclid|fbclid)(=|$)"

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# Host labels under which unsolicited pages are published; their URLs make the query's list.
SPAM_LABELS = ["spam-farm", "cheap-pills", "casino-win"]


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, canonical URL); the last is null where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    plain = F.regexp_replace(host, r"^www\.|:(80|443)\z", "")
    canonical = F.concat(plain, F.regexp_replace(path, r"/\z", ""),
                         F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return host, path, F.when(at > 0, canonical)


def listed_keys(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(key, rule, rule_host, verdict), one row a key, of rules (host, path, verdict) and listed
    canonical URLs (canonical); entries with nulls take no part."""
    host = F.translate("host", UPPER, LOWER)
    ruled = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
             .select(F.concat(F.lit("r:"), host, "path").alias("key"), F.concat(host, "path").alias("rule"),
                     host.alias("rule_host"), "verdict"))
    whole = (urls.where(F.col("canonical").isNotNull())
             .select(F.concat(F.lit("u:"), "canonical").alias("key"), F.lit(None).cast("string").alias("rule"),
                     F.lit(None).cast("string").alias("rule_host"), F.lit("block").alias("verdict")))
    return (ruled.unionByName(whole).groupBy("key")
            .agg(F.min("rule").alias("rule"), F.min("rule_host").alias("rule_host"), F.max("verdict").alias("verdict")))


def rule_shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct (labels of the host, length of the path) of the rules: as many as their texts
    have lengths, however many rules there are."""
    shapes = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")).distinct()
    return sorted((r.labels, r.length) for r in shapes.collect())


def possible_keys(host: Column, path: Column, canonical: Column, shapes: list[tuple[int, int]]) -> Column:
    """Array of the keys that a page could be listed under."""
    labels = F.split(host, r"\.")
    keys = [F.when(canonical.isNotNull(), F.concat(F.lit("u:"), canonical))]
    for count, length in shapes:
        suffix = F.array_join(F.slice(labels, -count, count), ".")
        fits = canonical.isNotNull() & (F.size(labels) >= count) & (F.length(path) >= length)
        keys.append(F.when(fits, F.concat(F.lit("r:"), suffix, F.substring(path, 1, length))))
    return F.array_compact(F.array(*keys))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bit(key: Column, word: int) -> Column:
    """The bit that a key sets in a word of its block."""
    step = F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 6 * word)
    return step.bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7): the non-empty blocks of the filter over ``key``."""
    one = F.lit(1).cast("long")
    words = [F.bit_or(F.call_function("shiftleft", one, _bit(F.col("key"), i))).alias(f"w{i}") for i in range(WORDS)]
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*words)


def possible_hits(keys: DataFrame, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keys`` whose key's bits are all set."""
    set_bits = F.lit(True)
    for i in range(WORDS):
        set_bits = set_bits & (F.bit_get(F.col(f"w{i}"), _bit(F.col("key"), i)) == 1)
    return (keys.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(filter_blocks), "block")
            .where(set_bits).select(*keys.columns))


def block_count(listed: int, max_blocks: int = MAX_BLOCKS) -> int:
    """Blocks of a filter over so many keys: a power of two, at most ``max_blocks``."""
    wanted = max(1, -(-listed * KEY_BITS // (WORDS * WORD_BITS)))
    return min(max_blocks, 1 << (wanted - 1).bit_length())


def judge(pages: DataFrame, rules: DataFrame, urls: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) of every row of ``pages`` (page_id, url).

    ``rules``: (host, path, verdict); ``urls``: (canonical), blocked one by one."""
    host, path, canonical = url_parts(F.col("url"))
    rows = staged(pages.select("page_id", host.alias("host"), path.alias("path"), canonical.alias("canonical"))
                  .withColumn("row", F.monotonically_increasing_id()))
    listing = staged(listed_keys(rules, urls))
    blocks = block_count(listing.count(), max_blocks)
    keys = rows.select("row", F.explode(possible_keys(F.col("host"), F.col("path"), F.col("canonical"),
                                                      rule_shapes(rules))).alias("key"))
    hits = staged(possible_hits(keys, bloom_blocks(listing, blocks), blocks))
    met = hits.groupBy("key").agg(F.count(F.lit(1)).alias("pages")).join(listing, "key")
    met = staged(met.withColumnRenamed("verdict", "ruling"))
    longest = F.max(F.when(F.col("rule").isNotNull(), F.struct(
        F.length("rule").alias("length"), F.length("rule_host").alias("host_length"), "rule", "ruling")))
    found = (join_facts(hits, met, "key", "pages", "inner").groupBy("row")
             .agg(longest.alias("best"), F.max(F.col("rule").isNull()).alias("listed")))
    listed = F.coalesce("listed", F.lit(False))
    method = F.when(listed, "block").otherwise("allow")
    return rows.join(found, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.ruling", method).alias("verdict"), listed.alias("listed"))


def spam_urls(pages: DataFrame) -> DataFrame:
    """(canonical) of the pages on hosts with one of ``SPAM_LABELS``, each once."""
    host, _, canonical = url_parts(F.col("url"))
    spam = F.arrays_overlap(F.split(host, r"\."), F.array(*[F.lit(x) for x in SPAM_LABELS]))
    return pages.where(spam).select(canonical.alias("canonical")).distinct()


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every row of ``pages`` by the rules and the canonical URLs of spam hosts."""
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(pages, rules, spam_urls(pages))


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
_SPAM = ", ".join(f"'{x}'" for x in SPAM_LABELS)
ORACLE_SQL = f"""
WITH rules(rule_host, rule_path, ruling) AS (VALUES {_VALUES}),
p AS (
  SELECT page_id, contains(coalesce(url, ''), '://') AS has,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\\?([^#]*)', 1) AS query
  FROM pages),
k AS (
  SELECT *, row_number() OVER () AS n,
         list_sort(list_filter(string_split(query, '&'),
                               lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))) AS kept
  FROM p),
c AS (
  SELECT *, CASE WHEN has THEN regexp_replace(host, '^www\\.|:(80|443)\\z', '', 'g') || regexp_replace(path, '/\\z', '')
                 || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM k),
urls AS (SELECT DISTINCT canonical FROM c WHERE list_has_any(string_split(host, '.'), [{_SPAM}])),
fits AS (
  SELECT n, rule_host || rule_path AS rule, ruling,
         row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM c JOIN rules ON has AND (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.ruling, CASE WHEN u.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       u.canonical IS NOT NULL AS listed
FROM c LEFT JOIN fits f ON f.n = c.n AND f.place = 1 LEFT JOIN urls u ON u.canonical = c.canonical
"""
