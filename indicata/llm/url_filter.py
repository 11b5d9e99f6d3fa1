"""URL filtering: host and path rules, and a listed set behind a blocked Bloom filter.

The listed canonical URLs set bits in a blocked Bloom filter: each URL's hash picks one block of four
64-bit words and one bit in each word. The filter is an aggregate (bitwise or per block) of at most
``max_blocks`` rows of 48 bytes, so it can be broadcast whatever the list's size; a fuller filter only
passes more URLs on. URLs whose bits are all set go to an exact join with the list, which removes false
positives; the others are not shuffled at all.

A null URL, or one without ``://``, has an empty host and path and an empty canonical form, fits no rule and
is never listed. Repeated rows each get the same verdict; empty tables give no rows; an empty list blocks
nothing. Columns of the input stay; an output column whose name is taken gets a leading underscore.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm import common as C
from indicata.llm.bloom import MAX_BLOCKS, blocked_bloom, blocks_for, mark

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
#: Labels of hosts whose pages make up the list of the registered query.
LISTED_LABELS = ("spam-farm", "cheap-pills")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without a last ``/`` or ``.html``, and the sorted query without
    ``utm_`` parameters; scheme and fragment are left out. Empty without a host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(/|\.html)$", "")
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.startswith("utm_")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail)).otherwise("")


def longest_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls; of equally long ones a blocking one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block")):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def mark_listed(df: DataFrame, key: str, listed: DataFrame, listed_key: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``df`` with ``possible`` (the filter's answer) and ``listed`` (the exact one) for the text in ``key``.

    ``listed`` may repeat URLs; null and empty keys are never listed. It is counted, put into the filter
    and joined, so it should be cheap to read three times or cut before.
    """
    names = C.fresh(df, "possible", "listed")
    wanted = F.when(F.col(listed_key) != "", F.col(listed_key)).alias("url")
    urls = listed.select(wanted).where("url IS NOT NULL").distinct()
    blocks = blocks_for(urls.count(), max_blocks)
    hit, found = names
    marked = mark(df, F.col(f"`{key}`"), blocked_bloom(urls, "url", blocks), blocks, hit)
    (url,) = C.fresh(marked, "url")
    exact = marked.where(F.col(hit)).join(urls.withColumnRenamed("url", url), F.col(f"`{key}`") == F.col(url), "left")
    rest = marked.where(~F.col(hit)).withColumn(url, F.lit(None).cast("string"))
    both = exact.select(*[f"`{c}`" for c in marked.columns], url).unionByName(rest)
    return both.withColumn(found, F.col(url).isNotNull()).drop(url)


def judge_urls(
    df: DataFrame, listed: DataFrame, listed_key: str = "canonical", url: str = "url", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``canonical``, ``possible``, ``listed``, ``rule`` and ``verdict``.

    The longest fitting rule decides; where none fits, listed URLs are blocked and others allowed.
    """
    names = C.fresh(df, "host", "path", "canonical", "rule", "verdict")
    host, path, key, rule, verdict = names
    text = F.col(f"`{url}`")
    parts = df.withColumns({host: host_of(text), path: path_of(text), key: canonical(text)})
    marked = mark_listed(parts, key, listed, listed_key)
    answer = marked.columns[-1]
    found, said = longest_rule(F.col(host), F.col(path), rules)
    method = F.when(F.col(answer), F.lit("block")).otherwise(F.lit("allow"))
    return marked.withColumns({rule: found, verdict: F.coalesce(said, method)})


def listed_pages(pages: DataFrame) -> DataFrame:
    """Canonical URLs of the pages on hosts with a listed label."""
    label = F.array_contains(F.split(host_of(F.col("url")), r"\."), F.lit(LISTED_LABELS[0]))
    for name in LISTED_LABELS[1:]:
        label = label | F.array_contains(F.split(host_of(F.col("url")), r"\."), F.lit(name))
    return pages.where(label).select(canonical(F.col("url")).alias("canonical"))


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    listed = C.cut(listed_pages(pages).distinct())
    judged = judge_urls(pages, listed)
    return judged.select("page_id", "host", "path", "rule", "verdict", "canonical", "listed")


OP4_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') AS query
  FROM pages
), keyed AS (
  SELECT page_id, host, path,
    list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))) AS q
  FROM parts
), canon AS (
  SELECT page_id, host, path,
    CASE WHEN regexp_replace(host, '^(www|m)\.', '') = '' THEN ''
      ELSE regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|\.html)$', '')
        || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS canonical
  FROM keyed
), listed AS (
  SELECT DISTINCT canonical FROM canon
  WHERE canonical <> ''
    AND (list_contains(string_split(host, '.'), 'spam-farm') OR list_contains(string_split(host, '.'), 'cheap-pills'))
), marked AS (
  SELECT *, canonical IN (SELECT canonical FROM listed) AS listed FROM canon
), fits AS (
  SELECT *,
    (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' AS r1,
    (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' AS r2,
    (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' AS r3,
    (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' AS r4
  FROM marked
)
SELECT page_id, host, path,
  CASE WHEN r2 THEN 'example.net/en/' WHEN r3 THEN 'example.com/de/' WHEN r4 THEN 'org/fr/' WHEN r1 THEN 'net/' END AS rule,
  CASE WHEN r2 THEN 'allow' WHEN r3 THEN 'block' WHEN r4 THEN 'allow' WHEN r1 THEN 'block'
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict,
  canonical, listed
FROM fits
"""
