"""URL rules in a sorted digest array.

Every rule is stored under the 64-bit xxHash of host and path. An executor maps the sorted
array into memory, looks all candidates of a slice of URLs up in one binary search, and
compares the stored string of every hit, so that a collision decides nothing.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import map_slices
from tagloom.session import scratch_path

# Rules of the registered query: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# Names that mark a host as one to be listed, under any ending.
BLOCKED_NAMES = ("spam-farm", "cheap-pills", "free-bets", "casino-win")

# Most hosts of a list that is made from a table.
MAX_HOSTS = 1_000_000

_BEFORE_HOST = re.compile("://")
_HOST_END = re.compile("[/?#]")
_PATH_END = re.compile("[?#]")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    start = _BEFORE_HOST.search(url or "")
    if not start:
        return "", ""
    rest = url[start.end() :]
    end = _HOST_END.search(rest)
    host, rest = (rest[: end.start()], rest[end.start() :]) if end else (rest, "")
    stop = _PATH_END.search(rest)
    return host.translate(_UPPER), rest[: stop.start()] if stop else rest


def index_bytes(rules: Sequence[tuple[str, str, str]], hosts: Sequence[str]) -> bytes:
    """The index file: a line of JSON, then digests, string ends, kinds and strings.

    Kinds are 0 for a blocking rule, 1 for an allowing one and 2 for a listed host.
    """
    entries = [(h.lower() + p, int(v == "allow")) for v, h, p in rules]
    entries += [(h.lower(), 2) for h in hosts]
    if len({s for s, _ in entries}) != len(entries):
        raise ValueError("a rule or host is given twice")
    keyed = sorted((xxhash.xxh64_intdigest(s.encode()), s.encode(), kind) for s, kind in entries)
    strings = [s for _, s, _ in keyed]
    lengths = {len(p) for _, _, p in rules} | ({0} if hosts else set())
    labels = max((h.count(".") + 1 for h in [*hosts, *(h for _, h, _ in rules)]), default=1)
    head = json.dumps({"n": len(keyed), "lengths": sorted(lengths), "labels": labels}).encode() + b"\n"
    head = head.rjust(-(-len(head) // 8) * 8)
    parts = [
        np.array([d for d, _, _ in keyed], np.uint64),
        np.cumsum([0, *map(len, strings)]).astype(np.uint64),
        np.array([k for _, _, k in keyed], np.uint8),
    ]
    return head + b"".join(p.tobytes() for p in parts) + b"".join(strings)


class Index:
    """The index file mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            line = file.readline()
        head, at = json.loads(line), len(line)
        self.n, self.lengths, self.labels = head["n"], head["lengths"], head["labels"]
        whole = np.memmap(path, np.uint8, "r")
        self.digests = whole[at : at + 8 * self.n].view(np.uint64)
        at += 8 * self.n
        self.ends = whole[at : at + 8 * (self.n + 1)].view(np.uint64)
        at += 8 * (self.n + 1)
        self.kinds = whole[at : at + self.n]
        self.strings = whole[at + self.n :]

    def candidates(self, host: str, path: str) -> list[str]:
        """All strings under which a fitting rule can be stored: the host's endings of as many
        labels as some rule has, each with the starts of the path that are as long as some
        rule's."""
        labels = host.rsplit(".", self.labels)[-self.labels :]
        hosts = [".".join(labels[i:]) for i in range(len(labels))]
        starts = [path[:n] for n in self.lengths if n <= len(path)]
        return [h + s for h in hosts for s in starts]

    def kinds_of(self, strings: list[str]) -> dict[str, int]:
        """The kind of each string that is stored."""
        digest = xxhash.xxh64_intdigest
        coded = [s.encode() for s in strings]
        wanted = np.fromiter((digest(s) for s in coded), np.uint64, len(coded))
        first = np.searchsorted(self.digests, wanted)
        found: dict[str, int] = {}
        hit = first < self.n
        hit[hit] = self.digests[first[hit]] == wanted[hit]
        for i in np.flatnonzero(hit).tolist():
            place = int(first[i])
            while place < self.n and self.digests[place] == wanted[i]:
                start, end = int(self.ends[place]), int(self.ends[place + 1])
                if self.strings[start:end].tobytes() == coded[i]:
                    found[strings[i]] = int(self.kinds[place])
                    break
                place += 1
        return found

    def judge(self, urls: list[str | None]) -> dict[str, list]:
        parts = [host_and_path(u) for u in urls]
        tried = [self.candidates(*p) for p in parts]
        kinds = self.kinds_of(list({s for t in tried for s in t}))
        rules, verdicts = [], []
        for (host, _), strings in zip(parts, tried):
            fitting = [s for s in strings if kinds.get(s, 2) < 2]
            best = max(fitting, key=lambda s: (len(s), s.find("/")), default=None)
            listed = any(kinds.get(s) == 2 for s in strings)
            rules.append(best)
            if best is not None:
                verdicts.append("allow" if kinds[best] else "block")
            else:
                verdicts.append("block" if listed else "allow")
        hosts, paths = [h for h, _ in parts], [p for _, p in parts]
        return {"host": hosts, "path": paths, "rule": rules, "verdict": verdicts}


def publish(spark: SparkSession, data: bytes) -> str:
    """Writes the index to the shared folder and has every executor fetch it, also those that
    replace a lost one. Returns the name of the file."""
    name = f"rules-{uuid.uuid4().hex}.idx"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    out = store.create(path)
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at : at + (1 << 20)]))
    out.close()
    context.addFile(store.makeQualified(path).toString())
    return os.path.basename(name)


def hosts_named(
    pages: DataFrame, names: Sequence[str] = BLOCKED_NAMES, url: str = "url", most: int = MAX_HOSTS
) -> list[str]:
    """The hosts of the URLs that have one of ``names`` between their dots, for a list; more than ``most``
    are an error."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(pages[f"`{url}`"], r"(?s)^.*?://([^/?#]*)", 1), upper, lower)
    marked = F.arrays_overlap(F.split(host, r"\."), F.array(*[F.lit(n) for n in names]))
    found = pages.select(host.alias("host"), marked.alias("marked")).filter("marked").select("host").distinct()
    hosts = [r["host"] for r in found.limit(most + 1).collect()]
    if len(hosts) > most:
        raise ValueError(f"more than {most} hosts to be listed")
    return sorted(hosts)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    blocked_hosts: Sequence[str] = (),
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest
    rule wins, of equally long ones that with the longer host. Where none fits, ``rule`` is
    null and listed hosts are blocked, all others allowed. A null URL, or one without
    ``://``, has an empty host and path, so no rule fits. Repeated rows are judged alike.
    """
    name = publish(pages.sparkSession, index_bytes(rules, blocked_hosts))

    def prepare():
        index = Index(SparkFiles.get(name))
        return lambda part: {"page_id": part["page_id"], **index.judge(part["url"])}

    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    schema = "page_id long, host string, path string, rule string, verdict string"
    return map_slices(chosen, None, schema, prepare)
