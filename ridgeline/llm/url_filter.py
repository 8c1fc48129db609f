"""URL filter: a trie over reversed host labels and then path segments, broadcast to the tasks.

A rule (host, path, verdict) fits a URL whose host is the rule's host or a
subdomain of it and whose path starts with the rule's path.  The match that uses
most host labels wins, then the one with the longest path; of equal rules a block
wins over an allow.  Broadcast slices of the rule table are bounded in size; more
rules take further slices, whose best matches are compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_RULES = 200_000
DEFAULT_VERDICT = "allow"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules that the query is stated with.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


class _Node:
    __slots__ = ("next", "paths")

    def __init__(self):
        self.next: dict[str, _Node] = {}
        self.paths: _Path | None = None


class _Path:
    """A node after some whole path segments: a rule that ends here, and rules that end in
    part of the next segment."""
    __slots__ = ("next", "rule", "partial")

    def __init__(self):
        self.next: dict[str, _Path] = {}
        self.rule: Rule | None = None
        self.partial: dict[str, Rule] = {}


def _stronger(new: Rule, old: Rule | None) -> Rule:
    return new if old is None or new.verdict == "block" else old


class Trie:
    def __init__(self, rules):
        self.root = _Node()
        for r in rules:
            node = self.root
            for label in reversed(r.host.split(".")):
                node = node.next.setdefault(label, _Node())
            node.paths = node.paths or _Path()
            *whole, rest = r.path.split("/")
            at = node.paths
            for segment in whole:
                at = at.next.setdefault(segment, _Path())
            if rest:
                at.partial[rest] = _stronger(r, at.partial.get(rest))
            else:
                at.rule = _stronger(r, at.rule)

    @staticmethod
    def _longest(at: _Path, path: str) -> Rule | None:
        best = at.rule
        segments = path.split("/")
        for k, segment in enumerate(segments):
            for end in range(len(segment), 0, -1) if at.partial else ():
                if segment[:end] in at.partial:
                    best = at.partial[segment[:end]]
                    break
            if k == len(segments) - 1 or segment not in at.next:
                return best
            at = at.next[segment]
            best = at.rule or best
        return best

    def match(self, host: str, path: str) -> tuple[int, Rule] | None:
        """(host labels used, rule) of the longest match."""
        node, best = self.root, None
        for depth, label in enumerate(reversed(host.split(".")), 1):
            node = node.next.get(label)
            if node is None:
                break
            if node.paths is not None and (rule := self._longest(node.paths, path)) is not None:
                best = (depth, rule)
        return best


def host_of(url: Column) -> Column:
    after = F.substring_index(_after_scheme(url), "/", 1)
    host = F.substring_index(F.substring_index(after, "?", 1), "#", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    plain = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    at = F.instr(plain, "/")
    return F.coalesce(F.when(at > 0, F.substr(plain, at)), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def _matcher(shared):
    @F.pandas_udf("labels int, rule string, verdict string")
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        trie = shared.value
        found = [trie.match(h, p) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame({"labels": [f[0] if f else 0 for f in found],
                             "rule": [f[1].name if f else None for f in found],
                             "verdict": [f[1].verdict if f else None for f in found]})
    return match


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT_VERDICT, slice_rules: int = SLICE_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url, ...).

    A null url, or one without ``://``, has an empty host and path and gets the
    default verdict with a null rule, like any url that no rule fits.  Ids may repeat
    or be null; other columns are ignored; an empty table or rule list is allowed.
    """
    spark = pages.sparkSession
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rules = sorted(set(rules), key=lambda r: (r.name, r.verdict))
    names = []
    for k in range(0, max(len(rules), 1), slice_rules):
        shared = spark.sparkContext.broadcast(Trie(rules[k:k + slice_rules]))
        names.append(f"_m{len(names)}")
        rows = rows.withColumn(names[-1], _matcher(shared)("host", "path"))
    ranked = [F.struct(F.col(n)["labels"].alias("labels"), F.coalesce(F.char_length(F.col(n)["rule"]), F.lit(0)).alias("size"),
                       (F.col(n)["verdict"] == "block").alias("block"), F.col(n)["rule"].alias("rule"),
                       F.col(n)["verdict"].alias("verdict")) for n in names]
    best = ranked[0] if len(ranked) == 1 else F.greatest(*ranked)
    return rows.withColumn("_best", best).select("page_id", "host", "path", F.col("_best")["rule"].alias("rule"),
                                                 F.coalesce(F.col("_best")["verdict"], F.lit(default)).alias("verdict"))
