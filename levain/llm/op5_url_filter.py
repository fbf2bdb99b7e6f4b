"""URL filters: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

Only DataFrame functions.  Rules are few and given as (verdict, host, path): a rule fits its host and all
subdomains if the URL's path starts with the rule's; the longest fitting host + path wins (ties: the
first by name).  A URL without a fitting rule is blocked if its canonical form is listed, else allowed.

List.  The listed canonical URLs fill a blocked Bloom filter: a hash picks a block of 8 words of 64 bits and sets one
bit in each word.  The filter has at most MAX_BYTES, so it may be broadcast; a longer list only passes
more false hits.  URLs that miss the filter are not listed.  Possible hits go to an exact hash
join with the distinct list, which removes false positives.

Canonical form: no scheme, user, default port, leading ``www.``, fragment or tracking parameters (``utm_*``
and those in TRACKING); host in lower case; the other parameters sorted; no slash at the end of the path.

Cases.  Null URLs and those without ``://`` have empty host and path, fit no rule, are not listed and so
allowed.  Repeated rows are judged alike and kept; a URL that a third of all rows share is a skewed
side of the hash join, which Spark splits.  An empty list allows all.  Null and repeated list entries do
no harm.  Empty tables give empty results.  Only the id and the URL are read; URLs of any length are whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not name a page.
TRACKING = ("ref", "fbclid", "gclid")
BITS_PER_KEY, BLOCK_BITS, MAX_BYTES = 16, 512, 16 << 20
Rule = tuple[str, str, str]


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "#", 1)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without it."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """The canonical form; null without a scheme or host."""
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host_of(url), r"(?s)^.*@", ""), r":(80|443)$", ""), r"^www\.", "")
    query = F.regexp_extract(_after_scheme(url), r"(?s)^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"^(utm_[^=]*|{'|'.join(TRACKING)})(=|$)")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), tail))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    by_length = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in by_length]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _block(name: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(blocks).cast("long"))


def _bit(name: Column, word: int) -> Column:
    """The bit of a word as a mask."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(F.xxhash64(name, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63).cast("long")).cast("int"))


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of the canonical URLs ``name`` in ``listed``; a row for each block that is hit."""
    words = [F.bit_or(_bit(F.col("name"), k)).alias(f"w{k}") for k in range(8)]
    return listed.groupBy(_block(F.col("name"), blocks).alias("block")).agg(*words)


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(id, host, path, rule, verdict, canonical) for each row of ``pages``; ``listed`` has the listed URLs in any form."""
    names = listed.select(canonical(F.col(listed_col)).alias("name")).filter("name is not null").distinct()
    n = names.count()
    blocks = max(1, min(math.ceil(n * BITS_PER_KEY / BLOCK_BITS), max_bytes // (BLOCK_BITS // 8 + 8)))
    url = F.col(url_col)
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rows = rows.withColumn("fits", rule_of(F.col("host"), F.col("path"), rules)).withColumn("block", _block(F.col("canonical"), blocks))
    hit = F.lit(True)
    for k in range(8):
        mask = _bit(F.col("canonical"), k)
        hit = hit & (F.col(f"w{k}").bitwiseAND(mask) == mask)
    maybe = F.coalesce(F.col("fits").isNull() & F.col("canonical").isNotNull() & hit, F.lit(False))
    probed = rows.join(F.broadcast(bloom(names, blocks)), "block", "left").withColumn("maybe", maybe).select(id_col, "host", "path", "fits", "canonical", "maybe")
    exact = names.select(F.col("name"), F.lit(True).alias("is_listed"))
    hits = probed.filter("maybe").join(exact, F.col("canonical") == F.col("name"), "left").drop("name")
    others = probed.filter("not maybe").withColumn("is_listed", F.lit(False))
    verdict = F.coalesce("fits.verdict", F.when(F.col("is_listed"), "block").otherwise("allow"))
    return hits.unionByName(others).select(id_col, "host", "path", F.col("fits.rule").alias("rule"), verdict.alias("verdict"), "canonical")
