"""Verdicts for urls: rules by host and path, then a list of urls behind a blocked Bloom filter.

Listed urls are compared in canonical form. Each listed url sets eight bits in one block of the filter; a page's url
reads the one block its hash names. Blocks are rows of a table that is at most ``blocks`` rows long, so broadcasting
it has a fixed bound, and no page is shuffled for it. Pages that the filter lets through are possible hits; an exact
hash join with the list removes the false ones.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is never listed, so it is
allowed; repeated pages give repeated rows; ties between rules of the same length go to block; empty inputs give
empty results; columns other than ``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.tables import ascii_lower

#: Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BLOCKS = 65536
WORDS = 8


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def canonical(host_: Column, path_: Column) -> Column:
    """Host without ``www.``, path without trailing slashes and ``.html``; null for an empty host."""
    site = F.regexp_replace(host_, r"^www\.", "")
    return F.when(host_ != "", F.concat(site, F.regexp_replace(F.rtrim(path_, F.lit("/")), r"\.html\z", "")))


def rule_for(host_: Column, path_: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, both null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    for said, on, below in reversed(ordered):
        fits = ((host_ == on) | host_.endswith("." + on)) & path_.startswith(below)
        text, verdict = F.when(fits, on + below).otherwise(text), F.when(fits, said).otherwise(verdict)
    return text, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    """One bit in each word of the block, from a second hash."""
    bits = F.xxhash64(F.lit(1), url)
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(WORDS)]


def bloom_blocks(listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0..w7): the filter of a table with the column ``listed_url``."""
    words = [F.bit_or(m).alias(f"w{i}") for i, m in enumerate(_masks(F.col("listed_url")))]
    return listed.where("listed_url is not null").groupBy(_block(F.col("listed_url"), blocks).alias("block")).agg(*words)


def judge(pages: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, blocks: int = BLOCKS) -> DataFrame:
    """(page_id, host, path, rule, verdict, canonical_url, listed) of every page.

    ``listed`` has the column ``listed_url`` in canonical form. A rule's verdict wins; else a listed url is blocked
    and any other allowed.
    """
    listed = listed.select("listed_url").where("listed_url is not null").distinct()
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    keyed = parts.withColumn("canonical_url", canonical(F.col("host"), F.col("path")))
    probed = keyed.withColumn("block", _block(F.col("canonical_url"), blocks)).join(F.broadcast(bloom_blocks(listed, blocks)), "block", "left")
    all_set = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col("canonical_url")))]
    possible = F.coalesce(F.col("canonical_url").isNotNull() & functools.reduce(operator.and_, all_set), F.lit(False))
    probed = probed.select(*keyed.columns, possible.alias("possible"))
    clear = probed.where("not possible").withColumn("listed", F.lit(False))
    exact = listed.select(F.col("listed_url").alias("exact_url"))
    hits = probed.where("possible").join(exact, F.col("canonical_url") == F.col("exact_url"), "left")
    hits = hits.select(*probed.columns, F.col("exact_url").isNotNull().alias("listed"))
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return clear.unionByName(hits).select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, by_list).alias("verdict"), "canonical_url", "listed")


#: Words that make a host one whose urls the registered query lists.
LISTED_HOST_WORDS = ("ads", "spam", "casino", "adult", "pills", "bets")


def listed_urls(pages: DataFrame, words: tuple[str, ...] = LISTED_HOST_WORDS) -> DataFrame:
    """``listed_url``: canonical urls of the pages whose host has one of ``words`` between hyphens or dots."""
    at, below = host(F.col("url")), path(F.col("url"))
    unwanted = at.rlike(r"(^|[.-])(" + "|".join(words) + r")([.-]|$)")
    return pages.where(unwanted).select(canonical(at, below).alias("listed_url")).distinct()


def oracle(words: tuple[str, ...] = LISTED_HOST_WORDS) -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then " + "'{}'" for _, h, p in ordered]
    text = " ".join(f.format(h + p) for f, (_, h, p) in zip(fits, ordered))
    said = " ".join(f.format(v) for f, (v, _, _) in zip(fits, ordered))
    return f"""with rest as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as r from pages),
parts as (select page_id, {lower.format("regexp_extract(r, '^[^/?#]*')")} as host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest),
keyed as (select *, case when host <> '' then regexp_replace(host, '^www\\.', '') || regexp_replace(rtrim(path, '/'), '\\.html$', '') end as canonical_url from parts),
listed as (select distinct canonical_url from keyed where regexp_matches(host, '(^|[.-])({"|".join(words)})([.-]|$)')),
judged as (select *, canonical_url in (select canonical_url from listed) is true as listed from keyed)
select page_id, host, path, case {text} end as rule,
  coalesce(case {said} end, case when listed then 'block' else 'allow' end) as verdict, canonical_url, listed from judged"""
