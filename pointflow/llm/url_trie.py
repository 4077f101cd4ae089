"""URL filters: allow and block rules in a trie over reversed host labels and path segments.

A rule fits its host and all subdomains if the path starts with the rule's
path. Of the rules that fit the most specific wins: more host labels first,
then the longer path; a rule list must not hold the same host and path twice.

The trie is built on the driver from a list whose size is checked, and
broadcast. A larger rule table is joined instead: the hosts' suffixes meet the
rules' hosts, with equal results.

Defined results: the host is what follows the first `://` up to `/`, `?`, `#`
or the end, A-Z in lower case; the path follows up to `?`, `#` or the end. A
NULL url and one without `://` have an empty host and path. Where no rule fits,
`rule` is NULL and the verdict is the default. Every row is judged, repeated
ones too; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointflow.llm.heavy_dedup import LOWER, UPPER
from pointflow.llm.tables import need_columns

ALLOW, BLOCK = "allow", "block"
# text of the rules up to which they go to every task as a trie, whose dictionaries take about 50 times as much
MAX_RULE_BYTES = 1 << 20
RULE_SCHEMA = "host string, path string, verdict string"


def url_parts(url: str | Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    text = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    start = F.instr(text, "://")
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


class PathNode:
    __slots__ = ("next", "ends")

    def __init__(self):
        self.next: dict[str, PathNode] = {}
        # the rules that end in or before the next segment: its beginning, and the decision
        self.ends: list[tuple[str, tuple[str, str]]] = []


class HostNode:
    __slots__ = ("next", "paths")

    def __init__(self):
        self.next: dict[str, HostNode] = {}
        self.paths: PathNode | None = None


class Trie:
    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        self.root = HostNode()
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.next.setdefault(label, HostNode())
            node.paths = node.paths or PathNode()
            at = node.paths
            *whole, last = path.split("/")
            for segment in whole:
                at = at.next.setdefault(segment, PathNode())
            at.ends.append((last, (host + path, verdict)))
            at.ends.sort(key=lambda end: len(end[0]))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule and verdict of the most specific rule that fits."""
        node, best, segments = self.root, None, path.split("/")
        for label in reversed(host.split(".")):
            node = node.next.get(label)
            if node is None:
                break
            if node.paths is not None:
                best = self._longest(node.paths, segments) or best
        return best

    @staticmethod
    def _longest(at: PathNode, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for depth, segment in enumerate(segments):
            for begin, decision in at.ends:
                if segment.startswith(begin):
                    best = decision
            # a segment is whole only if a slash follows it
            if depth + 1 == len(segments) or segment not in at.next:
                break
            at = at.next[segment]
        return best


def _by_trie(pages: DataFrame, rules: list[tuple[str, str, str]], default: str) -> DataFrame:
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        find = trie.value.find
        for host, path in batches:
            found = [find(h, p) or (None, default) for h, p in zip(host.to_pylist(), path.to_pylist())]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())],
                names=["rule", "verdict"],
            )

    return pages.withColumn("decision", run("host", "path"))


def _by_join(pages: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    places = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    each = places.select("host", "path", F.explode(suffixes).alias("suffix"))
    ruled = rules.select(F.col("host").alias("suffix"), F.col("path").alias("begin"), "verdict")
    fitting = each.join(ruled, "suffix").where(F.col("path").startswith(F.col("begin")))
    rank = F.struct(F.size(F.split("suffix", r"\.")), F.length("begin"))
    decision = F.struct(F.concat("suffix", "begin").alias("rule"), "verdict")
    best = fitting.groupBy("host", "path").agg(F.max_by(decision, rank).alias("found"))
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    joined = pages.join(best.withColumnsRenamed({"host": "h", "path": "p"}), (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return joined.withColumn("decision", F.coalesce("found", none)).drop("h", "p", "found")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] | DataFrame,
    url: str = "url",
    default: str = ALLOW,
    max_rule_bytes: int = MAX_RULE_BYTES,
) -> DataFrame:
    """`row`, a struct of the columns of `pages`, with `host`, `path` and `decision`, a struct of rule and verdict.

    `rules` are (host, path, verdict) rows, as a list or a frame.
    """
    need_columns(pages, url)
    host, path = url_parts(F.col(url))
    parsed = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    if not isinstance(rules, DataFrame):
        rules = pages.sparkSession.createDataFrame(list(rules), RULE_SCHEMA)
    size = rules.agg(F.sum(F.length("host") + F.length("path") + F.length("verdict"))).first()[0] or 0
    if size > max_rule_bytes:
        return _by_join(parsed, rules, default)
    return _by_trie(parsed, [tuple(r) for r in rules.select("host", "path", "verdict").collect()], default)
