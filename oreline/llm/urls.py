"""URL rules and host lists by a Bloom filter cascade, with DataFrame functions only.

Level 0 encodes the listed keys, level 1 the keys of the corpus that level 0 takes for listed, level 2
the listed keys that level 1 takes for such, and so on until a level takes nothing wrongly. Within the
universe of keys the cascade was built on, the first level that does not know a key tells exactly
whether it is listed. A level is a literal in the plan, so judging a url needs no join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap_literal, table, test_bit, written

BITS_PER_KEY = 12
HASHES = 4
#: Keys per cascade; longer lists are split by hash, and each part is judged in a pass of its own.
KEYS_PER_PART = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _slots(key: Column, level: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(level), F.lit(i)) for i in range(HASHES)]


@dataclass(frozen=True)
class Level:
    bitmap: Column
    bits: int
    number: int

    def knows(self, key: Column) -> Column:
        return reduce(lambda a, b: a & b, (test_bit(self.bitmap, h, self.bits) for h in _slots(key, self.number)))


def _level(keys: DataFrame, count: int, number: int) -> Level:
    bits = 1 << max(10, (count * BITS_PER_KEY - 1).bit_length())
    hashed = keys.select(F.explode(F.array(*_slots(F.col("key"), number))).alias("h"))
    return Level(bitmap_literal(hashed, bits), bits, number)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            verdict = F.when(~level.knows(key), F.lit(level.number % 2 == 1)).otherwise(verdict)
        return F.coalesce(verdict, F.lit(False))


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of the ``key`` column of ``listed`` that is exact on the ``key`` column of ``universe``.

    Missing keys are left out, repeated ones count once, listed keys outside the universe do no harm.
    """
    mine = written(listed.where("key is not null").select("key").distinct(), "cascade-listed")
    count = mine.count()
    if not count:
        return Cascade(())
    levels = [_level(mine, count, 0)]
    suspects = universe.where(F.col("key").isNotNull()).where(levels[0].knows(F.col("key"))).select("key").distinct()
    other = written(suspects.join(mine, "key", "left_anti"), "cascade-false")
    while not other.isEmpty():
        levels.append(_level(other, other.count(), len(levels)))
        mine, other = other, written(mine.where(levels[-1].knows(F.col("key"))), "cascade-false")
    return Cascade(tuple(levels))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def host_suffixes(host: Column) -> Column:
    """The host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _judged(rows: DataFrame, name: str, keys: Column, listed: DataFrame) -> DataFrame:
    """``rows`` with a column ``name``: those of ``keys`` that are listed, longest first."""
    parts = max(1, -(-listed.count() // KEYS_PER_PART))
    part_of = lambda key: F.pmod(F.xxhash64(key), F.lit(parts))
    universe = rows.select(F.explode(keys).alias("key"))
    out = rows.withColumn(name, F.array().cast("array<string>"))
    for part in range(parts):
        if parts == 1:
            cascade = build_cascade(listed, universe)
            return _longest(out.withColumn(name, F.filter(keys, cascade.contains)), name)
        cascade = build_cascade(listed.where(part_of(F.col("key")) == part), universe.where(part_of(F.col("key")) == part))
        found = F.filter(keys, lambda key: (part_of(key) == part) & cascade.contains(key))  # noqa: B023
        out = written(out.withColumn(name, F.concat(F.col(name), found)), "cascade-part")
    return _longest(out, name)


def _longest(rows: DataFrame, name: str) -> DataFrame:
    return rows.withColumn(name, F.array_sort(name, lambda a, b: F.length(b) - F.length(a)))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], listed_hosts: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every row of ``pages``.

    ``rules`` are (host, path, verdict): a rule fits its host and all subdomains if the path starts with the
    rule's; the longest fits best. Without a rule a url is blocked if its host or a domain above is a
    ``key`` of ``listed_hosts`` and allowed otherwise. A missing url has empty host and path and is allowed.
    """
    spark = pages.sparkSession
    host, path = split_url(pages[url_col])
    rows = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    lengths = sorted({len(p) for _, p, _ in rules})
    suffixes = host_suffixes(F.col("host"))
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]).cast("array<string>")
    by_rule = F.flatten(F.transform(suffixes, lambda s: F.transform(F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.concat(s, p))))
    out = rows
    for verdict in ("allow", "block"):
        keys = spark.createDataFrame([(h + p,) for h, p, v in rules if v == verdict], "key string")
        out = _judged(out, f"_{verdict}", by_rule, keys)
    out = _judged(out, "_listed", suffixes, listed_hosts)
    best = lambda v: F.get(f"_{v}", 0)
    longer = F.coalesce(F.length(best("allow")), F.lit(-1)) >= F.coalesce(F.length(best("block")), F.lit(-1))
    rule = F.when(longer, best("allow")).otherwise(best("block"))
    listed = F.size("_listed") > 0
    verdict = F.when(rule.isNotNull(), F.when(longer, F.lit("allow")).otherwise(F.lit("block"))).otherwise(F.when(listed, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), listed.alias("listed"))


#: Rules of the registered query.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: A host is listed from its leftmost label that has one of these words in it.
JUNK_WORDS = ("spam", "pills", "casino", "viagra", "xxx", "poker")
_JUNK = f"^[^.]*({'|'.join(JUNK_WORDS)})"


def junk_hosts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Host list of the registered query, one ``key`` for each junk domain among the urls."""
    host, _ = split_url(pages[url_col])
    keys = F.filter(host_suffixes(host), lambda s: F.regexp_like(s, F.lit(_JUNK)))
    return pages.select(F.explode(keys).alias("key")).distinct()


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, RULES, junk_hosts(pages))


OP7_SQL = f"""
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a),
c AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
r(h, p, v) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
m AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
      FROM c JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
j AS (SELECT page_id, regexp_matches(host, '({'|'.join(JUNK_WORDS)})') AS listed FROM c)
SELECT c.page_id, host, path, rule, coalesce(v, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM c LEFT JOIN m USING (page_id) JOIN j USING (page_id)
"""
