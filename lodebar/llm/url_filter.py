"""URL allow and block lists as a trie over reversed host labels and path segments.

A rule is a host and a path prefix. It fits its host and every subdomain of it, on urls whose path starts with the
rule's path. Of the rules that fit a url the longest wins (characters of host and path together; among equally long
ones that with the longer host, and a block entry before an allow entry for the same host and path). The rule list
lives on the driver anyway; its trie is broadcast once per executor and is refused above ``MAX_RULES`` entries.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and gets the default
verdict. Repeated rows are judged alike and all stay. Columns named like the operator's outputs are replaced; all
others pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodebar.llm.common import without

#: A trie of so many rules takes about 1 GB at most; larger lists are refused instead of broadcast.
MAX_RULES = 2_000_000

_RULE, _PATHS = "\0rule", "\0paths"  # cannot be host labels that a url's host holds between dots

JUDGED = T.StructType(
    [T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
)


class UrlTrie:
    """Host labels from the right, then path segments; the last, unfinished segment of a rule is a prefix."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]) -> None:
        """rules: (verdict, host, path) with verdict ``allow`` or ``block``."""
        self.root: dict[str, Any] = {}
        for n, (verdict, host, path) in enumerate(rules, 1):
            if n > MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} url rules")
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            host = host.lower()
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(_PATHS, {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault(segment + "/", {})
            entries = node.setdefault(_RULE, {})
            if entries.get(rest, ("", "", "allow"))[2] == "allow":  # block wins over allow for the same entry
                entries[rest] = (host, path, verdict)

    def _in_paths(self, node: dict[str, Any], path: str) -> Iterator[tuple[str, str, str]]:
        at = 0
        while True:
            tail = path[at:]
            for rest, entry in node.get(_RULE, {}).items():
                if tail.startswith(rest):
                    yield entry
            end = path.find("/", at)
            node = node.get(path[at : end + 1]) if end >= 0 else None  # type: ignore[assignment]
            if node is None:
                return
            at = end + 1

    def match(self, host: str, path: str) -> tuple[str, str, str] | None:
        """The longest rule (host, path, verdict) that fits, or none."""
        best, node = None, self.root
        if not host:
            return None
        for label in reversed(host.split(".")):
            node = node.get(label)  # type: ignore[assignment]
            if node is None:
                break
            if _PATHS in node:
                for entry in self._in_paths(node[_PATHS], path):
                    if best is None or (len(entry[0]) + len(entry[1]), len(entry[0])) > (len(best[0]) + len(best[1]), len(best[0])):
                        best = entry
        return best


def split_url(column: str) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path of a url column; both empty without ``://``."""
    url = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))
    scheme_end = F.instr(url, "://")
    rest = F.when(scheme_end > 0, url.substr(scheme_end + 3, F.length(url))).otherwise(F.lit(""))
    before = F.substring_index(F.substring_index(rest, "#", 1), "?", 1)
    raw = F.substring_index(before, "/", 1)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, before.substr(F.length(raw) + 1, F.length(before))


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with columns host, path, rule (null if none fits) and verdict (``default`` if no rule fits)."""
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf(JUDGED)
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [trie.value.match(h, p) for h, p in zip(hosts, paths, strict=True)]
        return pd.DataFrame({"host": hosts, "path": paths, "rule": [x and x[0] + x[1] for x in found], "verdict": [x[2] if x else default for x in found]})

    judged = pages.withColumn("__judged", judge(*split_url(url_col)))
    return without(judged, *JUDGED.names).select("*", "__judged.*").drop("__judged")
