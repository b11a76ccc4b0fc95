"""URL filter: a trie over reversed host labels and path segments, the longest matching rule's verdict."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of rule text that may be broadcast; more is an error, not a silent cut.
MAX_RULE_BYTES = 64 << 20

_UPPER = re.compile("[A-Z]+")
_HOST_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (``A-Z`` lower-cased) and path; both empty for null or without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    end = _HOST_END.search(url, at + 3)
    stop = end.start() if end else len(url)
    host = _UPPER.sub(lambda m: m[0].lower(), url[at + 3 : stop])
    end = _PATH_END.search(url, stop)
    return host, url[stop : end.start() if end else len(url)]


class RuleTrie:
    """Rules by host label from the right, then by path segment (each with its slash) from the left.

    A rule fits its host and all subdomains if the path starts with the rule's path, be it within a segment.
    Of several that fit the longest text (host and path) wins, of equally long ones the longer host; of an
    allow and a block rule with the same text, allow.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        # A node: [child by host label, path node or None]; a path node: [child by whole segment, trie of beginnings of a segment];
        # such a trie: child by character, and under "" what ends there.
        self.root: list = [{}, None]
        size = 0
        for verdict, rule in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r} of rule {rule!r}")
            size += len(rule.encode())
            if size > MAX_RULE_BYTES:
                raise ValueError(f"the rules hold more than {MAX_RULE_BYTES} bytes")
            slash = rule.find("/")
            host, path = (rule, "") if slash < 0 else (rule[:slash].lower(), rule[slash:])
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node[0].setdefault(label, [{}, None])
            if node[1] is None:
                node[1] = [{}, {}]
            place = node[1]
            *whole, rest = re.findall(r"[^/]*/", path) + [path[path.rfind("/") + 1 :]]
            for segment in whole:
                place = place[0].setdefault(segment, [{}, {}])
            last = place[1]
            for character in rest:
                last = last.setdefault(character, {})
            if last.get("", ("block",))[0] != "allow":
                last[""] = (verdict, rule)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest rule that fits."""
        best, length = None, (-1, -1)
        node, labels = self.root, host.split(".")
        hosted = -1
        for label in reversed(labels):
            node = node[0].get(label)
            if node is None:
                break
            hosted += 1 + len(label)
            place, done = node[1], 0
            while place is not None:
                last, at = place[1], done
                while last is not None:
                    if "" in last and (hosted + at, hosted) > length:
                        best, length = last[""], (hosted + at, hosted)
                    last, at = last.get(path[at]) if at < len(path) else None, at + 1
                slash = path.find("/", done)
                if slash < 0:
                    break
                place, done = place[0].get(path[done : slash + 1]), slash + 1
        return best


def judge(rows: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", default: str = "allow", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    The trie of all rules, of which the size is checked, is broadcast; rows stay where they are. Null urls and urls without ``://`` have an empty host, fit no rule and get ``default``. Empty
    tables give empty results; rows that repeat get the same verdict. A kept column named like a new one is
    an error.
    """
    held = rows.sparkSession.sparkContext.broadcast(RuleTrie(rules))
    keep = rows.columns if keep is None else keep
    new = ["host", "path", "rule", "verdict"]
    if clash := set(new) & {c.lower() for c in keep}:
        raise ValueError(f"columns {sorted(clash)} would appear twice")
    kept = rows.select(*[rows[c] for c in keep])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), *(f"{c} string" for c in new)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = held.value
        for b in batches:
            parts = [split_url(u) for u in b.column(len(keep)).to_pylist()]
            found = [trie.match(*p) or (default, None) for p in parts]
            new_columns = [[h for h, _ in parts], [p for _, p in parts], [r for _, r in found], [v for v, _ in found]]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *(pa.array(c, pa.string()) for c in new_columns)], names=[*keep, *new])

    return rows.select(*[rows[c] for c in keep], rows[url_col].cast("string").alias("__url")).mapInArrow(run, schema)
