"""URL allow and block rules, matched through a trie of reversed host labels and path segments.

A rule is a host and a path prefix. It fits a url whose host is the rule's or a subdomain of
it and whose path starts with the rule's. The longest fitting rule wins, host and path counted
together; of two equally long ones the one with the longer host; of an allow and a block entry
for the same host and path, block. Where no rule fits, the verdict is the default.

The rules go to the tasks as a broadcast list; a Python worker builds its trie once. A url costs
its host labels and path segments, and for the end of a rule's path the lengths that such ends
have below one node, however many rules there are.

Defined results: host and path are empty for a null url and one without "://"; ports and user
names stay part of the host, so they keep a rule from fitting; urls of any length are matched
whole; repeated rows get equal verdicts; an empty table gives an empty result; an empty rule set
gives the default throughout; columns other than page_id and url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import worker_store

ALLOW, BLOCK = "allow", "block"

#: Characters of all rules together up to which a trie is broadcast; beyond, rules are joined.
TRIE_CHARS = 16_000_000


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    UrlRule(ALLOW, "org", "/"),
    UrlRule(BLOCK, "example.org", "/es/"),
    UrlRule(BLOCK, "example.org", "/en/1"),
    UrlRule(ALLOW, "com", "/fr/"),
    UrlRule(BLOCK, "com", "/de/"),
)


class Node:
    """A trie node: the nodes below it, the rules that end here, and unfinished path tails.

    `lengths` are those of the tails, the longest first.
    """

    __slots__ = ("below", "lengths", "paths", "rule", "tails")

    def __init__(self) -> None:
        self.below: dict[str, Node] = {}
        self.paths: Node | None = None
        self.rule: UrlRule | None = None
        self.tails: dict[str, UrlRule] = {}
        self.lengths: list[int] = []


def _stronger(old: UrlRule | None, new: UrlRule) -> UrlRule:
    return old if old is not None and old.verdict == BLOCK else new


def build_trie(rules: Sequence[UrlRule]) -> Node:
    """Host labels from the last to the first, then whole path segments, then a tail."""
    root = Node()
    for rule in rules:
        node = root
        for name in reversed(rule.host.split(".")):
            node = node.below.setdefault(name, Node())
        node.paths = node.paths or Node()
        node = node.paths
        *whole, tail = rule.path.split("/")
        for segment in whole:
            node = node.below.setdefault(segment, Node())
        if tail:
            node.tails[tail] = _stronger(node.tails.get(tail), rule)
            if len(tail) not in node.lengths:
                node.lengths = sorted([*node.lengths, len(tail)], reverse=True)
        else:
            node.rule = _stronger(node.rule, rule)
    return root


def _longest_path(node: Node, path: str) -> UrlRule | None:
    """The longest rule of one host that the path starts with."""
    best = None
    for segment in path.split("/"):
        best = node.rule or best
        for length in node.lengths:
            tail = node.tails.get(segment[:length]) if length <= len(segment) else None
            if tail is not None:
                best = tail
                break
        following = node.below.get(segment)
        if following is None:
            return best
        node = following
    return best


def find_rule(root: Node, host: str, path: str) -> UrlRule | None:
    """Walk down the host labels; the longest rule that fits on the way wins."""
    best, node = None, root
    for name in reversed(host.split(".")):
        node = node.below.get(name)
        if node is None:
            break
        if node.paths is not None:
            found = _longest_path(node.paths, path)
            if found is not None and (best is None or len(found.text) >= len(best.text)):
                best = found
    return best


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; A-Z of the host in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 0)
    tail = F.substring(rest, F.instr(rest, "://") + 3, F.length(rest))
    host = F.regexp_extract(tail, r"^[^/?#]*", 0)
    path = F.substring(tail, F.length(host) + 1, F.length(tail))
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def _by_trie(pages: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    flat = [(r.verdict, r.host, r.path) for r in rules]
    name = sha256(repr(flat).encode()).hexdigest()
    shared = pages.sparkSession.sparkContext.broadcast(flat)

    @F.arrow_udf("struct<rule:string,ruled:string>")
    def match(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        # One trie, of the last rules: the worker's tasks share it.
        store = worker_store()
        if store.get("url_trie", ("",))[0] != name:
            store["url_trie"] = (name, build_trie([UrlRule(*r) for r in shared.value]))
        root = store["url_trie"][1]
        found = [
            find_rule(root, h, p)
            for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)
        ]
        return pa.StructArray.from_arrays(
            [
                pa.array([r and r.text for r in found], pa.string()),
                pa.array([r and r.verdict for r in found], pa.string()),
            ],
            ["rule", "ruled"],
        )

    return pages.withColumn("__match", match("host", "path")).select(
        *pages.columns, "__match.rule", "__match.ruled"
    )


def _by_join(pages: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """The same for rule sets too large to broadcast: equal keys in place of a trie.

    Every page asks for its host suffixes with its path cut at the lengths that rule paths
    have; AQE splits the hot keys of the join.
    """
    spark = pages.sparkSession
    table = spark.createDataFrame(
        [(r.host, r.path, r.verdict) for r in rules], "r_host string, r_path string, ruled string"
    )
    lengths = sorted({len(r.path) for r in rules})
    best_rules = table.groupBy("r_host", "r_path").agg(F.max("ruled").alias("ruled"))
    parts = F.split("host", r"\.")
    urls = pages.select("host", "path").distinct()
    asked = (
        urls.withColumn("__depth", F.explode(F.sequence(F.lit(1), F.size(parts))))
        .withColumn("__cut", F.explode(F.array(*[F.lit(n) for n in lengths])))
        .filter(F.col("__cut") <= F.length("path"))
        .withColumn(
            "r_host", F.array_join(F.slice(parts, F.size(parts) - F.col("__depth") + 1, F.col("__depth")), ".")
        )
        .withColumn("r_path", F.expr("substring(path, 1, __cut)"))
    )
    winners = (
        asked.join(best_rules, ["r_host", "r_path"])
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct(F.concat("r_host", "r_path").alias("rule"), "ruled"),
                F.struct(F.length("r_host") + F.length("r_path"), "__depth"),
            ).alias("__match")
        )
    )
    return pages.join(winners, ["host", "path"], "left").select(
        *pages.columns, "__match.rule", "__match.ruled"
    )


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[UrlRule] = RULES,
    default: str = ALLOW,
    trie_chars: int = TRIE_CHARS,
) -> DataFrame:
    """page_id, host, path, rule (null where none fits) and verdict of every row."""
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    small = sum(len(r.text) for r in rules) <= trie_chars
    matched = _by_trie(parts, rules) if small else _by_join(parts, rules)
    return matched.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(default)).alias("verdict")
    )
