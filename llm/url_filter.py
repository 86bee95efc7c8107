"""Allow and block rules for URLs: a trie over reversed host labels, then path segments.

A rule ``host/path`` fits a URL whose host is the rule's or below it and whose path
starts with the rule's path. Of all rules that fit, the one with most host labels
wins, then the one with the longest path; of equal rules that both allow and block,
block wins. A URL that no rule fits gets the operator's default, and one without a
host is blocked, since nothing can be fetched from it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Rules up to this number travel as one trie to every task (some 300 bytes each);
#: more are matched by a join on the host.
MAX_TRIE_RULES = 200_000

RULES = "rule string, verdict string"


class Trie:
    """Host labels from the last to the first; at a host, path segments; at their end, unfinished segments.

    A rule's path need not end at a segment: its last, open segment fits as a prefix,
    looked up by its length among the few lengths that occur at that node.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]) -> None:
        self._root: dict = {}
        for rule, verdict in rules:
            host, slash, path = rule.partition("/")
            node = self._root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("/", {}) if slash else node
            # Segments closed by a slash are edges; what follows the last slash is open.
            *closed, open_end = path.split("/") if slash else [""]
            for segment in closed:
                node = node.setdefault("/" + segment, {})
            ends = node.setdefault("//ends" if slash else "//host", {})
            if ends.get(open_end, ("", ""))[1] != "block":
                ends[open_end] = (rule, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule that wins, and its verdict."""
        best, node = None, self._root
        if not host:
            return None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            best = self._path(node, path) or best
        return best

    def _path(self, node: dict, path: str) -> tuple[str, str] | None:
        best = node.get("//host", {}).get("")
        node = node.get("/")
        if node is None or not path.startswith("/"):
            return best
        segments = path[1:].split("/")
        for k, segment in enumerate(segments):
            ends = node.get("//ends", {})
            for n in sorted({len(e) for e in ends if len(e) <= len(segment)}, reverse=True):
                if segment[:n] in ends:
                    best = ends[segment[:n]]
                    break
            if k == len(segments) - 1:
                break
            node = node.get("/" + segment)
            if node is None:
                break
        return best


def url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``; both empty where there is no ``://``."""
    rest = F.when(F.locate("://", F.col(url)) > 0, F.expr(f"substring({url}, locate('://', {url}) + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return pages.withColumn("host", F.translate(host, upper, lower)).withColumn("path", path)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``pages`` needs ``url``; it keeps its other columns, of which any named like a
    result is replaced. ``rules`` has ``rule`` (``host/path``) and ``verdict``
    (``allow`` or ``block``). No rules, null rules and null URLs are fine; repeated
    rows come back repeated.
    """
    if default not in ("allow", "block"):
        raise ValueError("default is allow or block")
    results = ("host", "path", "rule", "verdict")
    parts = url_parts(pages.drop(*results))
    known = rules.select("rule", "verdict").where("rule IS NOT NULL AND verdict IN ('allow', 'block')")
    held = [(r["rule"], r["verdict"]) for r in known.limit(MAX_TRIE_RULES + 1).collect()]
    found = _by_trie(parts, held) if len(held) <= MAX_TRIE_RULES else _by_join(parts, known)
    verdict = F.coalesce(F.col("_found.verdict"), F.when(F.col("host") == "", "block").otherwise(default))
    return found.withColumn("rule", F.col("_found.rule")).withColumn("verdict", verdict).drop("_found")


def _by_trie(parts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    sent = parts.sparkSession.sparkContext.broadcast(rules)

    @F.pandas_udf(RULES)
    def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = Trie(sent.value)
        for hosts, paths in batches:
            found = [trie.find(h, p) or (None, None) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    return parts.withColumn("_found", match("host", "path"))


def _by_join(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by joins on the host, for rule tables of any size.

    Hosts and paths are judged once each: ``(host, path)`` pairs are distinct here, and
    rules meet only the pairs whose host ends in theirs.
    """
    rule_host = F.substring_index("rule", "/", 1)
    keyed = rules.select(
        F.lower(rule_host).alias("suffix"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("start"), "rule", "verdict"
    )
    asked = parts.select("host", "path").distinct()
    suffixes = F.expr(r"transform(sequence(1, size(split(host, '\\.'))), k -> substring_index(host, '.', -k))")
    met = asked.withColumn("suffix", F.explode(suffixes)).join(keyed, "suffix").where("startswith(path, start)")
    rank = F.struct(
        F.size(F.split("suffix", r"\.")).alias("labels"), F.length("start").alias("n"), (F.col("verdict") == "block").alias("b"), "rule", "verdict"
    )
    best = met.groupBy("host", "path").agg(F.max(rank).alias("_found")).select("host", "path", F.struct("_found.rule", "_found.verdict").alias("_found"))
    return parts.join(best, ["host", "path"], "left")
