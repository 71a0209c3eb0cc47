"""URL filter: rules by host and path, and a list of canonical URLs.

A URL is looked up by its host and every parent domain, each with every path
prefix of a listed length: for the rules as host and path stand in it, for the
list in canonical form, as are the listed keys (``canonical``). A blocked Bloom filter (one 512-bit block per key)
over the listed keys lets possible hits through; an exact hash join on the
key drops the false ones. The longest listed key decides.

Defined results: a null URL, or one without ``://``, has empty host and path
and is allowed; equal URLs get equal verdicts on every row; an empty list
allows all; of two equally long keys the one that sorts last decides; columns
besides those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import ascii_lower, of_columns

# The rules of the query (host and path, verdict).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
# The list of the registered query, four hosts of the page tables; not the same names under other domains.
# A list of one's own is a table (key) for ``filter_urls``.
LISTED = ["ads-track.example.com/", "casino-win.example.com/", "cheap-pills.example.com/", "free-bets.example.com/"]
DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21"}
PROBES = 6
BITS_PER_KEY = 16
#: Largest filter and list that are sent to every task; beyond it they are shuffled.
BROADCAST_ROWS = 200_000


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))


def with_host_path(urls: DataFrame) -> DataFrame:
    rest = F.coalesce(_rest(F.col("url")), F.lit(""))
    return urls.select("url", ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)).alias("host"),
                       F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))


def canonical(scheme: Column, authority: Column, path: Column) -> tuple[Column, Column, Column]:
    """Host, port and path as the list has them: the host in lower case,
    without user info and trailing dots; a default port empty (of an empty
    scheme, any scheme's); the path of a host at least '/'."""
    place = F.substring_index(ascii_lower(authority), "@", -1)
    tail = F.regexp_extract(place, r":[0-9]*$", 0)
    host = F.rtrim(F.substring(place, F.lit(1), F.length(place) - F.length(tail)), F.lit("."))
    number = F.ltrim(F.substring(tail, F.lit(2), F.length(tail)), F.lit("0"))
    usual = F.lit(False)
    for name, port in DEFAULT_PORTS.items():
        usual = usual | (scheme.isin(name, "") & (number == port))
    return host, F.when(usual, F.lit("")).otherwise(number), F.when((path == "") & (host != ""), F.lit("/")).otherwise(path)


def canonical_key(key: Column) -> Column:
    """``key``, a host with or without path or a whole URL, in canonical form.
    One without a port covers every port."""
    scheme = F.regexp_extract(key, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    rest = F.when(scheme != "", F.substring(key, F.length(scheme) + 4, F.length(key))).otherwise(key)
    host, port, path = canonical(ascii_lower(scheme), F.regexp_extract(rest, r"^[^/?#]*", 0), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))
    return F.concat(host, F.when(port != "", F.concat(F.lit(":"), port)).otherwise(F.lit("")), path)


def with_canonical(seen: DataFrame) -> DataFrame:
    """``seen`` (url, host, path) with list_host, list_port and list_path."""
    scheme = F.when(F.instr("url", "://") > 0, ascii_lower(F.substring_index("url", "://", 1))).otherwise(F.lit(""))
    host, port, path = canonical(scheme, F.col("host"), F.col("path"))
    return seen.select("*", host.alias("list_host"), port.alias("list_port"), path.alias("list_path"))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _bit(key: Column, probe: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(2 + probe)), F.lit(512)).cast("int")


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, words): the filter's blocks that have a bit set, 8 longs each."""
    bit = keys.select(_block(F.col("key"), blocks).alias("block"),
                      F.explode(F.array(*[_bit(F.col("key"), j) for j in range(PROBES)])).alias("bit"))
    word = [F.bit_or(F.when(F.floor(F.col("bit") / 64) == w, F.expr("shiftleft(1L, bit % 64)")).otherwise(F.lit(0)))
            for w in range(8)]
    return bit.groupBy("block").agg(*[x.alias(f"w{w}") for w, x in enumerate(word)]).select(
        "block", F.array(*[f"w{w}" for w in range(8)]).alias("words"))


def may_hold(key: Column) -> Column:
    """Whether every probed bit of ``key`` is set in its block's ``words``."""
    out = F.lit(True)
    for j in range(PROBES):
        bit = _bit(key, j)
        word = F.element_at("words", F.floor(bit / 64).cast("int") + 1)
        out = out & (F.call_function("shiftrightunsigned", word, bit % 64).bitwiseAND(F.lit(1)) == 1)
    return out


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def lookup_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every host suffix at a dot, with every path prefix of a listed length."""
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels) - i + 1)))
    fit = F.filter(F.array(*[F.lit(k) for k in lengths]).cast("array<int>"), lambda k: k <= F.length(path))
    prefixes = F.transform(fit, lambda k: F.substring(path, F.lit(1), k))
    return F.flatten(F.transform(parents, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, url, host, path, rule, verdict, listed. A rule (key, verdict)
    outranks the list (key); where no rule fits, a listed key, in canonical
    form, blocks."""
    keys = (of_columns(rules, "key", "verdict").withColumn("is_rule", F.lit(True))
            .unionByName(of_columns(listed, "key").select(canonical_key(F.col("key")).alias("key"), F.lit("block").alias("verdict"),
                                                          F.lit(False).alias("is_rule")).where("key <> ''")))
    keys = keys.groupBy("key", "is_rule").agg(F.max("verdict").alias("verdict"))
    path_length = F.length("key") - F.instr("key", "/") + 1
    shape = {r["is_rule"]: r for r in keys.groupBy("is_rule").agg(
        F.count("*").alias("n"), F.collect_set(path_length.cast("int")).alias("lengths")).collect()}  # two rows at most
    lengths = {k: sorted(shape[k]["lengths"]) if k in shape else [] for k in (True, False)}
    n = sum(r["n"] for r in shape.values())
    blocks = max(1, n * BITS_PER_KEY // 512)
    # rows of one URL are judged once, so a URL that a third of all rows share costs one lookup
    seen = with_host_path(of_columns(pages, "url").distinct())

    def probes(keys: Column, is_rule: bool) -> Column:
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(is_rule).alias("is_rule")))
    of_list = lookup_keys(F.col("list_host"), F.col("list_path"), lengths[False])
    with_port = lookup_keys(F.concat_ws(":", "list_host", "list_port"), F.col("list_path"), lengths[False])
    of_list = F.when(F.col("list_port") == "", of_list).otherwise(F.concat(of_list, with_port))
    found = F.concat(probes(lookup_keys(F.col("host"), F.col("path"), lengths[True]), True), probes(of_list, False))
    probe = with_canonical(seen).select("url", F.inline(found))
    passed = (probe.withColumn("block", _block(F.col("key"), blocks))
              .join(_bounded(bloom(keys.select("key"), blocks), blocks), "block").where(may_hold(F.col("key"))))
    best = F.max(F.struct("is_rule", F.length("key").alias("size"), "key", "verdict")).alias("hit")
    hits = passed.select("url", "key", "is_rule").join(_bounded(keys, n), ["key", "is_rule"]).groupBy("url").agg(best)
    verdicts = seen.join(hits.withColumnRenamed("url", "hit_url"), F.col("url") == F.col("hit_url"), "left").select(
        F.col("url").alias("of"), "host", "path", F.when(F.col("hit.is_rule"), F.col("hit.key")).alias("rule"),
        F.coalesce("hit.verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("hit.is_rule"), F.col("hit.key")).alias("listed"))
    p = of_columns(pages, "page_id", "url")
    return p.join(verdicts, p["url"].eqNullSafe(verdicts["of"])).drop("of")


def default_rules(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return (spark.createDataFrame(RULES, "key string, verdict string"),
            spark.createDataFrame([(k,) for k in LISTED], "key string"))
