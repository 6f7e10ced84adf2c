"""URL rules by a sorted sweep over reversed hosts."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = chr(0x10FFFF)  # no host holds it: the end of an interval of keys
PER_PART = 32  # sampled keys for each boundary between partitions

EVENTS = "part int, key string, kind int, salt long, row_id long, path string, host string, verdict string"


def host_of(url: Column) -> Column:
    """From behind the first :// to / ? # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_behind(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.regexp_extract(_behind(url), "^[^/?#]*([^?#]*)", 1)


def _behind(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each with a dot behind it.

    The key of a host is a prefix of the keys of its subdomains, which therefore make
    one interval of the sorted keys.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class ActiveRules:
    """The rules whose interval holds the current key, one level per host, nested."""

    def __init__(self) -> None:
        # key, and {path: (verdict, rule)} with the lengths of the paths
        self.levels: list[tuple[str, dict[str, tuple[str, str]], set[int]]] = []

    def leave(self, key: str) -> None:
        while self.levels and not key.startswith(self.levels[-1][0]):
            self.levels.pop()

    def enter(self, key: str, host: str, path: str, verdict: str) -> None:
        if not self.levels or self.levels[-1][0] != key:
            self.levels.append((key, {}, set()))
        _, rules, sizes = self.levels[-1]
        if path not in rules or verdict == "block":
            rules[path] = verdict, host + path
        sizes.add(len(path))

    def longest(self, path: str) -> tuple[str, str] | None:
        """The (verdict, rule) that fits with most characters; of equals the longer host."""
        best = None
        for _, rules, sizes in self.levels:
            for size in sizes:
                found = rules.get(path[:size]) if size <= len(path) else None
                if found and (best is None or len(found[1]) >= len(best[1])):
                    best = found
        return best


def _boundaries(urls: DataFrame, parts: int) -> list[tuple[str, int]]:
    """Keys that divide the urls into about equal parts, from a sample that a hash chooses.

    A key is a pair with a hash of the row, so that a host with very many urls is divided too.
    """
    sample = (
        urls.select("key", "salt").orderBy("salt", "key").limit(PER_PART * parts).collect()
    )
    # the smallest hashes choose the sample, so a place is dealt anew within it
    keys = sorted((row["key"], _mixed(row["salt"])) for row in sample)
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _mixed(salt: int) -> int:
    """Another order of the same hashes."""
    return salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF


def apply_url_rules(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of urls(page_id, url) under rules(host, path, verdict).

    A rule fits its host and all subdomains if the url's path starts with the rule's. The longest
    rule, host and path together, decides; of two equally long ones that with
    the longer host, of two equal rules `block`. Without a rule, `rule` is null and
    the verdict `default`. Urls that are null or without :// have an empty host and
    path. Rules with a null or empty host, or a null path or verdict, fit nothing. One row per
    input row, also for repeated rows; other columns are ignored.

    Urls and rules are sorted by the reversed host in one range partitioning, whose boundaries
    come from a sample. A rule is sent to each part that its interval meets, of which nested
    rules alone reach more than one. A sweep over each sorted part keeps the rules that
    hold at the current key on a stack.
    """
    spark = urls.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = urls.select(
        F.col("page_id").cast("long").alias("row_id"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.xxhash64("page_id", "url").alias("salt"),
    ).withColumn("key", host_key(F.col("host")))
    bounds = _boundaries(placed, parts)

    def deal_urls(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, salts = column(batch, "key"), column(batch, "salt")
        part = [bisect_right(bounds, (k, _mixed(s))) for k, s in zip(keys, salts)]
        return _event_batch(
            part, keys, [1] * len(part), salts, column(batch, "row_id"),
            column(batch, "path"), column(batch, "host"), [None] * len(part),
        )

    def deal_rules(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for key, host, path, verdict in zip(
            *(column(batch, n) for n in ("key", "host", "path", "verdict"))
        ):
            first = bisect_right(bounds, (key, -1))
            last = bisect_right(bounds, (key + LAST, -1))
            rows += [
                (part, key, 0, 0, None, path, host, verdict) for part in range(first, last + 1)
            ]
        return _event_batch(*(zip(*rows) if rows else [[]] * 8))

    usable = rules.where(
        F.col("host").isNotNull() & (F.col("host") != "")
        & F.col("path").isNotNull() & F.col("verdict").isNotNull()
    ).select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", F.col("verdict").cast("string")
    )
    events = map_batches(placed, deal_urls, EVENTS).union(
        map_batches(usable.withColumn("key", host_key(F.col("host"))), deal_rules, EVENTS)
    )
    swept = (
        events.repartitionById(len(bounds) + 1, F.col("part"))
        .sortWithinPartitions("part", "key", "kind", "path", "verdict")
        .mapInArrow(
            lambda batches: _sweep(batches, default),
            "page_id long, host string, path string, rule string, verdict string",
        )
    )
    return swept


def _event_batch(*values) -> pa.RecordBatch:
    kinds = (
        pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
    )
    names = ["part", "key", "kind", "salt", "row_id", "path", "host", "verdict"]
    return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(values, kinds)], names=names)


def _sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """One sorted part: rules of a key come before its urls."""
    active, part = ActiveRules(), None
    names = ("part", "key", "kind", "row_id", "path", "host", "verdict")
    for batch in batches:
        out = []
        for place, key, kind, row_id, path, host, verdict in zip(
            *(column(batch, n) for n in names)
        ):
            if place != part:
                active, part = ActiveRules(), place
            active.leave(key)
            if kind == 0:
                active.enter(key, host, path, verdict)
                continue
            found = active.longest(path)
            out.append((row_id, host, path, *(found[::-1] if found else (None, default))))
        if out:
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=k) for v, k in zip(columns, kinds)],
                names=["page_id", "host", "path", "rule", "verdict"],
            )
