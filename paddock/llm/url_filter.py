"""Op 6: URL rules, indexed by their rarest literal token.

A rule has a host, a path and a verdict; it fits its host and all subdomains when the
URL's path starts with the rule's.  The rule is a regular expression over host and path.  Its
literal tokens (host labels, and whole path segments) occur in every URL that it fits, so it is
filed under the one that the fewest URLs of the table have.  A URL's tokens fetch the candidate
rules, and only their expressions run.  The longest rule that fits gives the verdict; a URL
that none fits is judged by the default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def tokens(self) -> list[str]:
        segments = self.path.split("/")[:-1]  # what follows the last slash may go on in the URL
        return [f"h:{x}" for x in self.host.split(".") if x] + [f"p:{x}" for x in segments if x]

    def patterns(self) -> tuple[re.Pattern, re.Pattern]:
        """Of the whole host, which may hold any character, and of the path's beginning."""
        return re.compile(rf"(?s:.*\.)?{re.escape(self.host)}"), re.compile(re.escape(self.path))


def rule(text: str, verdict: str) -> Rule:
    """``example.org/es/``: the host ends at the first slash."""
    host, _, path = text.partition("/")
    return Rule(verdict, host, "/" + path)


def tokens(host: str, path: str) -> set[str]:
    return {f"h:{x}" for x in host.split(".") if x} | {f"p:{x}" for x in path.split("/") if x}


class Index:
    """Rules by their rarest token; rules without a token are candidates of every URL."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]) -> None:
        self.by: dict[str, list[tuple[Rule, re.Pattern, re.Pattern]]] = {}
        self.always: list[tuple[Rule, re.Pattern, re.Pattern]] = []
        for r in rules:
            rarest = min(r.tokens(), key=lambda t: (counts.get(t, 0), t), default=None)
            into = self.always if rarest is None else self.by.setdefault(rarest, [])
            into.append((r, *r.patterns()))

    def best(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits (of equal ones the first by name and verdict)."""
        fits: list[Rule] = []
        for found in (self.always, *[self.by[t] for t in tokens(host, path) if t in self.by]):
            fits += [r for r, of_host, of_path in found if of_host.fullmatch(host) and of_path.match(path)]
        return min(fits, key=lambda r: (-len(r.name), r.name, r.verdict), default=None)


def with_parts(df: DataFrame) -> DataFrame:
    """host and path of ``url``; both empty when it is null or has no ``://``."""
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1))


def url_filter(spark: SparkSession, df: DataFrame, rules: Sequence[Rule], default: str = DEFAULT, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict``.

    Null URLs, and those without ``://``, have an empty host and path and fit no rule with a host.  Repeated
    rows get equal results, an empty table an empty one; other columns are ignored.  Rules are a
    list of the caller, so their number is bounded by the driver; it does not grow with the table.
    """
    rows = with_parts(common.pick(df, page_id=page_id, url=url)).select("page_id", "host", "path")
    wanted = sorted({t for r in rules for t in r.tokens()})
    place = {t: i for i, t in enumerate(wanted)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(max(1, len(wanted)), np.int64)
        for batch in batches:
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                for t in tokens(host, path):
                    if t in place:
                        total[place[t]] += 1
        got = list(common.table_rows(total))
        yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.binary())], ["part", "body"])

    counts = common.add_tables(rows.mapInArrow(count, common.SUM_SCHEMA), max(1, len(wanted)), "int64")
    index = Index(rules, dict(zip(wanted, counts.tolist())))
    kind = rows.schema["page_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            best = [index.best(h, p) for h, p in zip(hosts, paths)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("host"), batch.column("path"),
                    pa.array([r.name if r else None for r in best], pa.string()), pa.array([r.verdict if r else default for r in best], pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return rows.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
