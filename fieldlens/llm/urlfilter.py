"""URL filters by a sort-merge range join.

A host is written with its labels reversed, so a rule's host and path become one interval of keys: every key that
begins with the rule's. A page asks with one key for its host and each parent domain. Rules and questions are sorted
together over range partitions; a sweep keeps the stack of rules whose intervals are open, which are nested, so the
top of the stack is the longest rule that fits. Rules that are open at the end of a partition are handed to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"


def _until(text: Column, signs: str) -> Column:
    """The text before the first of the signs."""
    for sign in signs:
        text = F.substring_index(text, sign, 1)
    return text


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#``, A-Z lower-cased; path: then up to ``?``, ``#``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = _until(rest, "/?#")
    return F.translate(host, _UPPER, _LOWER), _until(F.substr(rest, F.char_length(host) + 1), "?#")


def _questions(host: Column, most: int) -> Column:
    """Reversed keys of the host and of its parent domains, as far as any rule has labels."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))), lambda n: F.array_join(F.slice(labels, 1, n), "."))


def _sweep(carried: dict[int, list] | None):
    """With ``carried`` the answers; without, what is open at the end of each partition and the partition's last key."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        stack = list((carried or {}).get(part, []))  # (host, path, rule number), each within the one before
        last = None
        for batch in batches:
            out = []
            for n, (host, path, number) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "path", "rule")))):
                while stack and not (stack[-1][0] == host and path.startswith(stack[-1][1])):
                    stack.pop()
                if number is not None:
                    stack.append((host, path, number))
                elif carried is not None and stack:
                    out.append((n, stack[-1][2]))
                last = (host, path)
            if out:
                at = pa.array([n for n, _ in out], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("row").take(at), pa.array([r for _, r in out], pa.int64())], ["row", "rule"])
        if carried is None and last is not None:
            yield pa.RecordBatch.from_pylist([{"part": part, "host": last[0], "path": last[1], "open": [{"h": h, "p": p, "n": n} for h, p, n in stack]}], _OPEN)

    return each


_OPEN = pa.schema([("part", pa.int32()), ("host", pa.string()), ("path", pa.string()),
                   ("open", pa.list_(pa.struct([("h", pa.string()), ("p", pa.string()), ("n", pa.int64())])))])


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``pages``; rules: (host, path, verdict).

    A rule fits its host and all subdomains of it if the path begins with the rule's; the longest rule, host and path
    together, wins, and of equally long ones that with the longer host. A rule listed twice counts once and blocks if either says so.
    Null urls and urls without ``://`` have an empty host and path and fit no rule; where no rule fits, the verdict is
    ``default`` and the rule null. Repeated rows are judged each; empty tables give empty results or the default.
    """
    host, path = host_and_path(F.col(url))
    asked = pages.select(F.col(key).alias("id"), host.alias("host"), path.alias("path"))
    asked = materialise(asked.groupBy("id", "host", "path").agg(F.count(F.lit(1)).alias("copies")).withColumn("row", F.monotonically_increasing_id()))
    known = rules.where("host is not null and path is not null and host <> ''").groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("bad"))
    known = materialise(known.withColumn("rule", F.monotonically_increasing_id()))
    most = known.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    reverse = F.array_join(F.reverse(F.split("host", r"\.")), ".")
    as_rules = known.select(reverse.alias("key"), "path", F.lit(None).cast("long").alias("row"), "rule")
    as_pages = asked.where("host <> ''").select(F.explode(_questions(F.col("host"), most)).alias("key"), "path", "row", F.lit(None).cast("long").alias("rule"))
    # rules come before the questions of the same key; the row number splits a key that many pages share
    order = ["key", "path", F.col("rule").isNull().alias("asks"), "row"]
    both = as_rules.unionByName(as_pages).select("key", "path", "row", "rule", *order[2:3])
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sweep = materialise(both.repartitionByRange(n, "key", "path", "asks", "row").sortWithinPartitions("key", "path", "asks", "row").select("key", "path", "row", "rule"))
    ends = sweep.mapInArrow(_sweep(None), "part int, host string, path string, open array<struct<h string, p string, n long>>")
    carried, held, at_end = {}, [], sorted(ends.collect(), key=lambda r: r["part"])  # a row of nested rules per partition
    for i, end in enumerate(at_end):
        still = [s for s in held if s[0] == end["host"] and end["path"].startswith(s[1])]
        held = still + [(s["h"], s["p"], s["n"]) for s in end["open"]]
        if i + 1 < len(at_end):
            carried[at_end[i + 1]["part"]] = held
    found = sweep.mapInArrow(_sweep(carried), "row long, rule long")
    weight = F.struct((F.char_length("rule_host") + F.char_length("rule_path")).alias("n"), F.char_length("rule_host").alias("m"), "rule_host", "rule_path", "bad")
    named = found.join(known.select("rule", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "bad"), "rule")
    best = materialise(named.groupBy("row").agg(F.max(weight).alias("best")))
    out = asked.join(best, "row", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    verdict = F.when(F.col("best").isNull(), default).when(F.col("best.bad"), "block").otherwise("allow")
    return out.select(F.col("id").alias(key), "host", "path", F.concat("best.rule_host", "best.rule_path").alias("rule"), verdict.alias("verdict"))
