"""URL filters over a sorted digest array.

Rules and blocked names are strings (``host`` or ``host/path``).  Their 64-bit xxhash
digests are written, sorted, to one index file together with the strings.  The file goes to the shared
folder and from there to every executor once; tasks map it into memory, so the workers of a
machine share its pages.  A batch of URLs is probed at once: the digests of all candidates
(every host suffix with every path prefix of a length that the list has) are searched with one vectorised binary search, and
a hit counts only if the stored string equals the candidate, so collisions of digests do no harm.

Defined cases
  null URL, no ``://``   host and path empty, no rule, allowed
  host                   after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered
  path                   then up to ``?``, ``#`` or the end (may be empty)
  rules                  fit the host and its subdomains, if the path starts with the rule's; the longest wins
                         (of equal length the longer host)
  no rule                blocked if the host, a domain above it, or a path prefix ending at ``/`` or at the end is in the list
  very long URL          judged whole; candidates are made only for the path lengths that the list has
  ties                   equal digests are told apart by the stored strings
  empty table            no rows
  repeated rows, extra columns   judged each; kept, a column with the name of an output column is replaced
"""

from __future__ import annotations

import hashlib
import mmap
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daylake.session import new_work_dir

# Production rules (action, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Production list of blocked names: hosts (with their subdomains), or hosts with a path.
BLOCKED = tuple(
    f"{name}.example.{top}"
    for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
)
# The index is built on the driver and shipped as one file of so many bytes at most.
MAX_INDEX_BYTES = 2 << 30
MAGIC = b"URLIDX1\n"


def build_index(entries: Iterable[tuple[str, str]]) -> bytes:
    """(string, value) pairs -> the index file: sorted digests, string ends, path lengths in use, strings.

    Header: magic, number of entries, number of path lengths.  Equal digests lie side by side."""
    known: dict[str, str] = {}
    for text, value in entries:
        known.setdefault(text, value)
    texts = [t.encode() + b"\t" + v.encode() for t, v in known.items()]
    keys = np.array([xxhash.xxh64_intdigest(t) for t in known], np.uint64)
    order = np.argsort(keys, kind="stable")
    texts = [texts[i] for i in order]
    ends = np.cumsum([len(t) for t in texts], dtype=np.uint64)
    paths = np.array(sorted({len(t) - len(t.split("/", 1)[0]) for t in known}), np.uint64)
    head = MAGIC + np.array([len(texts), len(paths)], np.uint64).tobytes()
    content = b"".join([head, keys[order].tobytes(), ends.tobytes(), paths.tobytes(), *texts])
    if len(content) > MAX_INDEX_BYTES:
        raise ValueError(f"the index has over {MAX_INDEX_BYTES} bytes")
    return content


class DigestIndex:
    """An index file, mapped (or held) in memory."""

    def __init__(self, content: bytes | mmap.mmap):
        if content[: len(MAGIC)] != MAGIC:
            raise ValueError("not an index file")
        n, p = (int(x) for x in np.frombuffer(content, np.uint64, 2, len(MAGIC)))
        at = len(MAGIC) + 16
        self.keys = np.frombuffer(content, np.uint64, n, at)
        self.ends = np.frombuffer(content, np.uint64, n, at + 8 * n)
        self.path_lengths = np.frombuffer(content, np.uint64, p, at + 16 * n).astype(int).tolist()
        self.content, self.start = content, at + 16 * n + 8 * p

    def entry(self, i: int) -> tuple[str, str]:
        a = self.start + (int(self.ends[i - 1]) if i else 0)
        text, value = self.content[a : self.start + int(self.ends[i])].decode().rsplit("\t", 1)
        return text, value

    def find(self, candidates: list[str]) -> list[str | None]:
        """The value stored for each candidate, or None."""
        found: list[str | None] = [None] * len(candidates)
        if not candidates or not len(self.keys):
            return found
        probes = np.fromiter((xxhash.xxh64_intdigest(c) for c in candidates), np.uint64, len(candidates))
        first = np.searchsorted(self.keys, probes)
        inside = np.minimum(first, len(self.keys) - 1)
        for i in np.flatnonzero(self.keys[inside] == probes):
            at = int(first[i])
            while at < len(self.keys) and self.keys[at] == probes[i]:
                text, value = self.entry(at)
                if text == candidates[i]:
                    found[i] = value
                    break
                at += 1  # another string with this digest
        return found


_MAPPED: dict[str, DigestIndex] = {}


def _mapped(name: str) -> DigestIndex:
    if name not in _MAPPED:
        with open(SparkFiles.get(name), "rb") as f:
            _MAPPED[name] = DigestIndex(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    return _MAPPED[name]


def ship_index(spark: SparkSession, content: bytes) -> str:
    """Put an index file into the shared folder and register it for all executors; returns its name."""
    name = f"urls-{hashlib.sha256(content).hexdigest()[:24]}.idx"
    sc = spark.sparkContext
    if any(f.endswith("/" + name) for f in sc.listFiles):
        return name
    folder = new_work_dir(spark, "url-index")
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    try:
        for at in range(0, len(content), 8 << 20):
            out.write(bytearray(content[at : at + (8 << 20)]))
    finally:
        out.close()
    sc.addFile(f"{folder}/{name}")
    return name


def split_url(url: str | None) -> tuple[str, str]:
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host.translate(_LOWER), rest[:end]


_LOWER = {c: c + 32 for c in range(65, 91)}


def _suffixes(host: str) -> list[str]:
    """The host and all domains above it, longest first."""
    out, at = [], 0
    while host:
        out.append(host[at:])
        at = host.find(".", at) + 1
        if not at:
            return out
    return out


def _rule_candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    return [s + path[:n] for s in _suffixes(host) for n in lengths if n <= len(path)]


def _list_candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """The host and its domains, alone and with path prefixes that end at ``/`` or with the path."""
    cuts = [n for n in lengths if n <= len(path) and (n == 0 or n == len(path) or path[n - 1] == "/" or path[n : n + 1] == "/")]
    return [s + path[:n] for s in _suffixes(host) for n in cuts]


def _probe(index: DigestIndex, candidates: list[list[str]]) -> list[list[tuple[str, str]]]:
    """One binary search for the candidates of many URLs; per URL the (candidate, value) pairs found."""
    flat = [c for cs in candidates for c in cs]
    values = iter(index.find(flat))
    return [[(c, v) for c in cs if (v := next(values)) is not None] for cs in candidates]


def judge(
    pages: DataFrame,
    url_col: str = "url",
    rules: Iterable[tuple[str, str, str]] = RULES,
    blocked: Iterable[str] = BLOCKED,
) -> DataFrame:
    """The columns of ``pages`` with ``host, path, rule, verdict``."""
    spark = pages.sparkSession
    rule_file = ship_index(spark, build_index((host + path, f"{action} {len(host)}") for action, host, path in rules))
    list_file = ship_index(spark, build_index((name, "block") for name in blocked))
    added = ["host", "path", "rule", "verdict"]
    kept = [f for f in pages.schema.fields if f.name not in added]
    schema = T.StructType(kept + [T.StructField(c, T.StringType()) for c in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule_index, list_index = _mapped(rule_file), _mapped(list_file)
        for batch in batches:
            urls = [split_url(u) for u in batch.column(url_col).to_pylist()]
            fits = _probe(rule_index, [_rule_candidates(h, p, rule_index.path_lengths) for h, p in urls])
            best = [max(f, key=lambda x: (len(x[0]), int(x[1].split(" ")[1])), default=None) for f in fits]
            listed = _probe(
                list_index,
                [[] if b else _list_candidates(h, p, list_index.path_lengths) for b, (h, p) in zip(best, urls)],
            )
            columns = [
                [h for h, _ in urls],
                [p for _, p in urls],
                [b[0] if b else None for b in best],
                [b[1].split(" ")[0] if b else "block" if x else "allow" for b, x in zip(best, listed)],
            ]
            arrays = [batch.column(f.name) for f in kept] + [pa.array(c, pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in kept] + added)

    return pages.mapInArrow(run, schema)


def _oracle() -> str:
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)
    names = ", ".join(f"('{b}')" for b in BLOCKED)
    return rf"""
WITH r AS (SELECT * FROM (VALUES {rules}) t(action, rhost, rpath)),
b AS (SELECT * FROM (VALUES {names}) t(name)),
u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM u),
fit AS (SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(action, length(rhost || rpath)) AS action
        FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
hit AS (SELECT DISTINCT page_id FROM h JOIN b ON host = name OR ends_with(host, '.' || name))
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN hit.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM h LEFT JOIN fit USING (page_id) LEFT JOIN hit USING (page_id)
"""


ORACLE = _oracle()
