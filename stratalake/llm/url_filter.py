"""Allow and block lists over URLs, held in a broadcast trie.

The trie goes down the host's labels from the last to the first, and from there down the segments of the path. A URL
walks it once, whatever the number of rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A list of rules is sent to every executor; beyond this many it is refused rather than broadcast.
MAX_RULES = 1_000_000
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


#: A place in the trie: the places below by label or segment, the root of the host's paths (if any), and the
#: rules that end here, as (rest of the path, rule, verdict) with the longest rest first. Plain types, to be broadcast.
Node = tuple[dict, list, list]


def _place() -> Node:
    return {}, [], []


def build_trie(rules: Iterable[tuple[str, str]]) -> Node:
    """A trie of (verdict, host and path) such as ``("block", "example.com/en/")``.

    The host ends at the first slash and counts for its subdomains too. If a rule is both allowed and blocked it blocks.
    """
    root, known = _place(), {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r} of {rule!r}")
        host, slash, path = rule.partition("/")
        rule = host.translate(_LOWER) + slash + path
        if known.get(rule) != "block":
            known[rule] = verdict
    if len(known) > MAX_RULES:
        raise ValueError(f"{len(known)} rules are more than {MAX_RULES}")
    for rule, verdict in known.items():
        host, slash, path = rule.partition("/")
        children, paths, _ = root
        for label in reversed(host.split(".")):
            children, paths, _ = children.setdefault(label, _place())
        if not paths:
            paths.append(_place())
        below, _, ends = paths[0]
        *segments, rest = (slash + path).split("/")
        for segment in segments:
            below, _, ends = below.setdefault(segment, _place())
        ends.append((rest, rule, verdict))
        ends.sort(key=lambda r: -len(r[0]))
    return root


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    found = _URL.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


def _in_path(place: Node, path: str) -> tuple[str, str] | None:
    """The rule with the longest path that ``path`` starts with."""
    best, at = None, 0
    while True:
        below, _, ends = place
        for rest, rule, verdict in ends:
            if path.startswith(rest, at):
                best = rule, verdict
                break
        slash = path.find("/", at)
        if slash < 0 or path[at:slash] not in below:
            return best
        place = below[path[at:slash]]
        at = slash + 1


def judge(root: Node, host: str, path: str, default: str) -> tuple[str | None, str]:
    """The rule that decides, and the verdict: the most host labels win, then the longest path."""
    best, (children, _, _) = None, root
    for label in reversed(host.split(".")):
        if label not in children:
            break
        children, paths, _ = children[label]
        if paths:
            best = _in_path(paths[0], path) or best
    return best or (None, default)


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]],
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict (``default`` then).

    Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#``
    or the end. A rule fits its host and all subdomains if the path starts with the rule's; the longest wins.

    A null url, or one without ``://``, has an empty host and path. Repeated rows and null ids are rows like others, other
    columns are ignored, an empty table gives no rows.
    """
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [judge(trie.value, host, path, default) for host, path in places]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([p[0] for p in places], pa.string()),
                    pa.array([p[1] for p in places], pa.string()),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string")).mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string"
    )
