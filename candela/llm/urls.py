"""URL filters by a memory-mapped array of sorted digests.

A rule names a host and a path prefix, written together like ``net/`` or
``example.net/en/``, and a verdict. The index file holds the 64-bit xxhash
keys of all rules in ascending order, with the rules' strings behind them.
Workers map the file (its pages are shared by all workers of a machine), probe
all candidates of a batch by one vectorised binary search, and compare the
stored string with the candidate before a rule counts, so two strings with one
digest can't be mistaken. The file reaches executors through ``addFile``.

Candidates of a url: each suffix of its host at a label boundary, with each
prefix of its path whose length some rule has. Hosts that no rule has are
dropped by a first probe. Of all rules that fit, the longest string wins; of
equally long ones (different split of host and path) the longer host. With no
rule the verdict is ``allow``: the method lists what is refused.

Null urls and urls without ``://`` have an empty host and path. Repeated urls
are judged one by one. An empty table gives an empty result; input columns
named like the added ones are replaced.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.textops import map_batches

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def build_index(rules: list[tuple[str, str]], path: str) -> None:
    """Write the index file of ``(rule, verdict)`` pairs; a later pair replaces an equal rule."""
    last = {}
    for rule, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r} of rule {rule!r} is neither allow nor block")
        host, slash, rest = rule.partition("/")
        last[host.translate(str.maketrans(UPPER, UPPER.lower())) + slash + rest] = verdict
    hosts = sorted({r.partition("/")[0].encode() for r in last})
    entries = [(xxhash.xxh64_intdigest(h), h, 0) for h in hosts]
    keys = [(xxhash.xxh64_intdigest(r.encode()), r.encode(), v == "block") for r, v in last.items()]
    lengths = sorted({len(r) - len(r.partition(b"/")[0]) for _, r, _ in keys})
    with open(path, "wb") as f:
        header = json.dumps({"hosts": len(entries), "rules": len(keys), "lengths": lengths}).encode()
        f.write(len(header).to_bytes(8, "little") + header + b" " * (-len(header) % 8))
        for part in (sorted(entries), sorted(keys)):
            ends = np.cumsum([0] + [len(s) for _, s, _ in part])
            strings = b"".join(s for _, s, _ in part)
            f.write(np.array([d for d, _, _ in part], np.uint64).tobytes())
            f.write(ends.astype(np.int64).tobytes())
            f.write(np.array([v for _, _, v in part], np.int64).tobytes())
            f.write(strings + b"\0" * (-len(strings) % 8))


class DigestArray:
    """Sorted digests, their strings and values in a mapped file, from byte ``at``."""

    def __init__(self, mapped: np.memmap, at: int, n: int):
        self.digests = mapped[at:at + 8 * n].view(np.uint64)
        self.ends = mapped[at + 8 * n:at + 16 * n + 8].view(np.int64)
        self.values = mapped[at + 16 * n + 8:at + 24 * n + 8].view(np.int64)
        start = at + 24 * n + 8
        size = int(self.ends[-1])
        self.strings = mapped[start:start + size]
        self.after = start + size + (-size % 8)

    def find(self, strings: list[bytes]) -> np.ndarray:
        """The strings' places, -1 where the array has no such string."""
        probes = np.array([xxhash.xxh64_intdigest(s) for s in strings], np.uint64)
        lo = np.searchsorted(self.digests, probes, "left")
        hi = np.searchsorted(self.digests, probes, "right")
        out = np.full(len(strings), -1, np.int64)
        for i in np.flatnonzero(hi > lo):
            for k in range(lo[i], hi[i]):
                if self.strings[self.ends[k]:self.ends[k + 1]].tobytes() == strings[i]:
                    out[i] = k
        return out


class UrlIndex:
    def __init__(self, path: str):
        mapped = np.memmap(path, np.uint8, "r")
        n = int(mapped[:8].view(np.int64)[0])
        self.header = json.loads(mapped[8:8 + n].tobytes())
        self.hosts = DigestArray(mapped, 8 + n + (-n % 8), self.header["hosts"])
        self.rules = DigestArray(mapped, self.hosts.after, self.header["rules"])

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list, list]:
        suffixes, owners = [], []
        for i, host in enumerate(hosts):
            raw = host.encode()
            at = 0
            while raw and at >= 0:
                suffixes.append(raw[at:])
                owners.append(i)
                dot = raw.find(b".", at)
                at = dot + 1 if dot >= 0 else -1
        known = self.hosts.find(suffixes)
        keys, of = [], []
        for j in np.flatnonzero(known >= 0):
            i = owners[j]
            path = paths[i].encode()
            for n in self.header["lengths"]:
                if n <= len(path):
                    keys.append(suffixes[j] + path[:n])
                    of.append((i, len(suffixes[j])))
        best: dict[int, tuple] = {}
        for k, key, (i, n) in zip(self.rules.find(keys).tolist(), keys, of):
            if k >= 0 and (i not in best or (len(key), n) > best[i][:2]):
                best[i] = (len(key), n, key.decode(), "block" if self.rules.values[k] else "allow")
        found = [best.get(i, (0, 0, None, "allow")) for i in range(len(hosts))]
        return [x[2] for x in found], [x[3] for x in found]


_open: dict[str, UrlIndex] = {}


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict of each url."""
    spark = pages.sparkSession
    name = f"url-rules-{uuid.uuid4().hex}.idx"
    local = os.path.join(tempfile.mkdtemp(prefix="candela-rules-"), name)
    build_index(rules, local)
    spark.sparkContext.addFile(local)
    clash = [c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict")]
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.expr(f"substring(coalesce(`{url}`, ''), instr(coalesce(`{url}`, ''), '://') + 3)")).otherwise("")
    parts = r"^([^/?#]*)([^?#]*)"
    split = pages.withColumns({
        "__host": F.translate(F.regexp_extract(rest, parts, 1), UPPER, UPPER.lower()),
        "__path": F.regexp_extract(rest, parts, 2)}).drop(*clash)
    split = split.select(*[c for c in split.columns if c not in ("__host", "__path")],
                         F.col("__host").alias("host"), F.col("__path").alias("path"))
    host, path = split.columns.index("host"), split.columns.index("path")

    def judge(batch):
        if name not in _open:
            _open.clear()
            _open[name] = UrlIndex(SparkFiles.get(name))
        import pyarrow as pa
        rule, verdict = _open[name].judge(batch.column(host).to_pylist(), batch.column(path).to_pylist())
        return [pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
    return map_batches(split, judge, [("rule", "string"), ("verdict", "string")])
