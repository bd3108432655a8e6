"""URL filters: a trie over reversed host labels and path segments, broadcast, longest match wins.

A rule (verdict, host, path) fits its host and all subdomains where the URL's
path starts with the rule's.  Among the rules that fit, more host labels win,
then the longer path; of two rules for the same host and path, block wins.
Without a rule that fits, the verdict is ``default``.

The trie's edges are host labels from the top-level domain down, then whole path
segments; what follows the last slash of a rule's path is compared as a prefix.
Rules come from the caller and are checked against ``MAX_RULE_BYTES`` before the
broadcast.  Judging is a map over the URL column: no shuffle, and a host that
holds most rows stays where its rows are.

Defined results: a null URL or one without ``://`` has an empty host and path, and
no rule fits it.  Extra columns pass through; columns named as results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelkit.llm.common import released, without

MAX_RULE_BYTES = 64_000_000
Rule = tuple[str, str, str]

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST_END, _PATH_END = re.compile("[/?#]"), re.compile("[?#]")


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = _HOST_END.search(rest)
    host, rest = (rest[: end.start()], rest[end.start() :]) if end else (rest, "")
    return host.translate(_UPPER), _PATH_END.split(rest, maxsplit=1)[0]


class UrlTrie:
    """Nodes are dicts: labels or segments to nodes; under None the path trie of a host, under "" the tails of a node."""

    def __init__(self, rules: Sequence[Rule]):
        if sum(len(h) + len(p) for _, h, p in rules) > MAX_RULE_BYTES:
            raise ValueError(f"rules take more than {MAX_RULE_BYTES} bytes")
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r}")
            node = self.root
            for label in reversed(host.translate(_UPPER).split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, tail = path.split("/")
            for segment in whole:
                node = node.setdefault(("/", segment), {})
            tails = node.setdefault("", {})
            if tails.get(tail, ("",))[0] != "block":
                tails[tail] = (verdict, f"{host}{path}")

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest rule that fits."""
        node, hosts = self.root, []
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                hosts.append(node[None])
        segments = path.split("/") if hosts else []
        for paths in reversed(hosts):
            found, node = None, paths
            for k, segment in enumerate(segments):
                # The rest of the path from here on, against what rules have after their last slash.
                fits = [t for t in node.get("", ()) if "/".join(segments[k:]).startswith(t)]
                found = node[""][max(fits, key=len)] if fits else found
                node = node.get(("/", segment)) if k + 1 < len(segments) else None
                if node is None:
                    break
            if found:
                return found
        return None


def judge(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict for every URL."""
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    made = ("host", "path", "rule", "verdict")
    schema = T.StructType([*without(pages, made)] + [T.StructField(c, T.StringType()) for c in made])
    kept = schema.names[:-4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url in batch.column(url_col):
                host, path = split_url(url.as_py())
                verdict, rule = trie.value.find(host, path) or (default, None)
                rows.append((host, path, rule, verdict))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array([r[k] for r in rows], pa.string()) for k in range(4))], names=schema.names)

    return pages.mapInArrow(released(run), schema)
