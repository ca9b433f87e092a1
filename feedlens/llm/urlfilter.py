"""Operator 9, URL filter: blocked Bloom filter, then an exact join (DataFrame functions only).

A list has entries (host, path, exact, verdict). An entry that is not exact
fits its host and all subdomains, for paths that start with its path, which
ends in ``/``; an exact one fits the canonical URL (host and path) alone.
A URL's candidate keys are the suffixes of its host times the directories of
its path, no deeper than the deepest entry, and its canonical URL.

The filter is blocked: a key's hash picks one 64-bit word, and a second hash
three bits of it. The words are a table of at most ``WORDS`` rows, a fixed
bound, so it is broadcast. Keys that pass are joined with the list itself,
which removes false positives; of the entries that fit, the longest wins.

Judgement is made once per distinct (host, path), then joined back to the
rows; adaptive execution splits that join when one URL holds many rows.

Defined cases: a null url, or one without ``://``, has empty host and path and
fits no entry; repeated rows are judged each; an empty list or table works;
two entries with one key: block wins; other columns of the input are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 1 << 17
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The base rules as (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# A canonical URL of this many rows or more is listed by the method, to block.
REPEATS = 2


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_list(spark: SparkSession, rules=RULES) -> DataFrame:
    """Prefix entries as a list; every path must end in ``/``."""
    if any(not p.endswith("/") for _, p, _ in rules):
        raise ValueError("the path of a rule ends in /")
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(False).alias("exact"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def repeated_urls(urls: DataFrame, *, repeats: int = REPEATS) -> DataFrame:
    """Exact entries, verdict block, for the canonical URLs of ``repeats`` rows or more of ``urls`` (host, path)."""
    counted = urls.where("host <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= repeats)
    return counted.select("host", "path", F.lit(True).alias("exact"), F.lit("block").alias("verdict"))


def _key(host: str, path: str, exact: str) -> Column:
    # A path holds no '#', so exact and prefix keys never meet.
    return F.expr(f"concat({host}, {path}, if({exact}, '#', ''))")


def _word(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(WORDS)).cast("int")


def _bits(key: Column) -> Column:
    h = F.xxhash64(key, F.lit(7))
    bit = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(3)]
    one = [F.call_function("shiftleft", F.lit(1).cast("bigint"), b) for b in bit]
    return one[0].bitwiseOR(one[1]).bitwiseOR(one[2])


def bloom(entries: DataFrame) -> DataFrame:
    """``word, bits`` of the keys of ``entries``: at most WORDS rows."""
    return entries.select(_word(F.col("key")).alias("word"), _bits(F.col("key")).alias("b")).groupBy("word").agg(F.expr("bit_or(b)").alias("bits"))


def judged(urls: DataFrame, entries: DataFrame) -> DataFrame:
    """``host, path, rule, rule_verdict, listed``: for every distinct (host, path) that an entry of the list fits.

    ``rule`` is the key of the longest prefix entry (null if none), ``listed``
    the verdict of its exact entry (null if none).
    """
    entries = entries.select("host", "path", "exact", "verdict", _key("host", "path", "exact").alias("key"))
    entries = entries.groupBy("key").agg(F.max("verdict").alias("verdict"), F.first("exact").alias("exact"),
                                         F.max(F.expr("size(split(host, '[.]'))")).alias("labels"),
                                         F.max(F.expr("length(path) - length(replace(path, '/', ''))")).alias("depth"))
    deepest = entries.where("not exact").agg(F.coalesce(F.max("labels"), F.lit(0)), F.coalesce(F.max("depth"), F.lit(0))).first()
    labels, depth = int(deepest[0]), int(deepest[1])
    distinct = urls.select("host", "path").distinct().where("host <> ''")
    # Suffixes of the host and directories of the path, no more than the deepest entry has.
    hosts = f"transform(filter(sequence(1, {max(labels, 1)}), k -> k <= size(split(host, '[.]'))), k -> substring_index(host, '.', -k))"
    paths = (
        f"transform(filter(sequence(1, {max(depth, 1)}), k -> k <= length(path) - length(replace(path, '/', ''))),"
        " k -> concat(substring_index(path, '/', k), '/'))"
    )
    keys = f"concat(array(concat(host, path, '#')), flatten(transform({hosts}, h -> transform({paths}, p -> concat(h, p)))))"
    probes = distinct.select("host", "path", F.explode(F.expr(keys)).alias("key"))
    probes = probes.select("host", "path", "key", _word(F.col("key")).alias("word"), _bits(F.col("key")).alias("want"))
    possible = probes.join(F.broadcast(bloom(entries)), "word").where(F.col("bits").bitwiseAND(F.col("want")) == F.col("want"))
    hits = possible.select("host", "path", "key").join(entries.select("key", "verdict", "exact"), "key")
    best = F.max(F.when(~F.col("exact"), F.struct(F.length("key").alias("long"), "key", "verdict")))
    return hits.groupBy("host", "path").agg(best.alias("best"), F.max(F.when(F.col("exact"), F.col("verdict"))).alias("listed")).select(
        "host", "path", F.col("best.key").alias("rule"), F.col("best.verdict").alias("rule_verdict"), "listed"
    )


def filter_urls(pages: DataFrame, entries: DataFrame | None = None, *, repeats: int = REPEATS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (page_id, url).

    ``entries`` are the listed prefixes (the base rules if None); the canonical
    URLs of ``repeats`` rows or more are listed besides. A prefix entry decides; else an
    exact one; else ``allow``.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    entries = rule_list(pages.sparkSession) if entries is None else entries.select("host", "path", "exact", "verdict")
    verdicts = judged(rows, entries.unionByName(repeated_urls(rows, repeats=repeats)))
    out = rows.join(verdicts, ["host", "path"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "listed", F.lit("allow")).alias("verdict"))
