"""URL filter: a trie over reversed host labels and path segments, longest match first.

A rule is (host, path, verdict) with verdict ``allow`` or ``block``. It fits a url whose host is the
rule's host or a subdomain of it and whose path starts with the rule's path, as text. Of all rules
that fit, the one with the most host labels wins, among those the one with the longest path, and
where both verdicts are given for one host and path, ``block``. A url that no rule fits gets the
``default`` verdict.

A url's host is what follows its first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path goes on up to ``?``, ``#`` or the end. Host and path are cut by Spark; only
they go to Python. The trie has one edge a label, from the last label to the first; a host node may
carry a trie of path segments, each with its closing slash; the rest of a rule's path behind its
last slash is looked up by its length. A url costs its labels and segments, however many rules
there are.

The rules are counted first. Up to ``MOST_RULES`` rules and ``MOST_BYTES`` characters they are sent
to all tasks, and each worker builds the trie once. A larger list is never collected: distinct
(host, path) pairs are joined with the rules on (host suffix, path up to a slash), at most as many
of either as the deepest rule has, and the best match is a maximum, combined before the shuffle.
Both ways give the same.

Defined cases: a null url, or one without ``://``, has empty host and path; so only rules with
empty host and path fit. An empty rule host fits every host; a null rule path counts as empty; rules
without host are left out; other verdicts are refused. Host labels may be empty; ports and user
names belong to the host. Every row is judged by itself, so repeated rows are kept; other columns
pass through in ``row``, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
MOST_RULES = 200_000
MOST_BYTES = 16 << 20
RULES = [("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK),
         ("org", "/fr/", ALLOW)]
RULE_SCHEMA = "host string, path string, verdict string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Paths:
    """A node of the path trie."""

    __slots__ = ("lengths", "rests", "rule", "segments")

    def __init__(self) -> None:
        self.segments: dict[str, Paths] = {}
        self.rests: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []
        self.rule: tuple[str, str] | None = None

    def add(self, path: str, rule: tuple[str, str]) -> None:
        node, at = self, 0
        while end := path.find("/", at) + 1:
            node = node.segments.setdefault(path[at:end], Paths())
            at = end
        if rest := path[at:]:
            node.rests[rest] = _stronger(node.rests.get(rest), rule)
            node.lengths = sorted({len(x) for x in node.rests}, reverse=True)
        else:
            node.rule = _stronger(node.rule, rule)

    def longest(self, path: str) -> tuple[str, str] | None:
        node, at, best = self, 0, self.rule
        while True:
            for n in node.lengths:
                if found := node.rests.get(path[at:at + n]):
                    best = found
                    break
            end = path.find("/", at) + 1
            node = node.segments.get(path[at:end]) if end else None
            if node is None:
                return best
            at, best = end, node.rule or best


def _stronger(old: tuple[str, str] | None, new: tuple[str, str]) -> tuple[str, str]:
    return old if old and old[1] == BLOCK else new


class Trie:
    """Rules by reversed host labels, then by path."""

    __slots__ = ("labels", "paths")

    def __init__(self, rules: Iterable[tuple[str, str, str]] = ()) -> None:
        self.labels: dict[str, Trie] = {}
        self.paths: Paths | None = None
        for host, path, verdict in rules:
            node = self
            for label in _reversed_labels(host):
                node = node.labels.setdefault(label, Trie())
            node.paths = node.paths or Paths()
            node.paths.add(path, (host + path, verdict))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        node, met = self, [self.paths]
        for label in _reversed_labels(host):
            node = node.labels.get(label)
            if node is None:
                break
            met.append(node.paths)
        for paths in reversed(met):
            if paths and (found := paths.longest(path)):
                return found
        return None


def _reversed_labels(host: str) -> list[str]:
    return host.split(".")[::-1] if host else []


_BUILT: dict[str, Trie] = {}


def _trie(name: str, rules: list[tuple[str, str, str]]) -> Trie:
    """The trie of this rule list; a worker keeps the last one it built."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Trie(rules)
    return _BUILT[name]


def host_and_path(url: Column) -> tuple[Column, Column]:
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def _rule_table(spark: SparkSession, rules: DataFrame | Iterable[tuple]) -> DataFrame:
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), RULE_SCHEMA)
    return rules.where("host is not null").select(
        F.translate("host", UPPER, LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"), "verdict")


def judge(pages: DataFrame, rules: DataFrame | Iterable[tuple] = RULES, default: str = ALLOW,
          most_rules: int = MOST_RULES) -> DataFrame:
    """(row, host, path, rule, verdict): ``row`` is a struct of the pages' columns."""
    spark = pages.sparkSession
    known = _rule_table(spark, rules)
    n, size, bad = known.agg(F.count("*"), F.sum(F.length("host") + F.length("path")),
                             F.count_if(~F.coalesce(F.col("verdict").isin(ALLOW, BLOCK),
                                                    F.lit(False)))).first()
    if bad:
        raise ValueError(f"{bad} rules are neither {ALLOW} nor {BLOCK}")
    host, path = host_and_path(F.col("url"))
    row = F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row")
    cut = pages.select(row, host.alias("host"), path.alias("path"))
    if n <= most_rules and (size or 0) <= MOST_BYTES:
        found = F.col("found")
        out = cut.withColumn("found", _by_trie(known)("host", "path"))
    else:
        pairs = cut.select("host", "path").distinct()
        found = F.col("found")
        out = cut.join(_by_join(pairs, known), ["host", "path"], "left")
    return out.select("row", "host", "path", found["rule"].alias("rule"),
                      F.coalesce(found["verdict"], F.lit(default)).alias("verdict"))


def _by_trie(known: DataFrame):  # noqa: ANN202
    sent = known.sparkSession.sparkContext.broadcast([tuple(r) for r in known.collect()])
    name = uuid.uuid4().hex

    @F.arrow_udf("rule string, verdict string")
    def match(host: pa.Array, path: pa.Array) -> pa.Array:
        trie = _trie(name, sent.value)
        return pa.array([m and {"rule": m[0], "verdict": m[1]} for m in map(
            trie.match, host.to_pylist(), path.to_pylist())],
            pa.struct([("rule", pa.string()), ("verdict", pa.string())]))

    return match


def _by_join(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(host, path, found) of the pairs that a rule fits."""
    head = F.regexp_extract("path", "^(?s:.*/)?", 0)
    depth = F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\.", -1)))
    ruled = known.select(
        F.col("host").alias("suffix"), head.alias("head"), depth.alias("depth"),
        F.substring("path", F.length(head) + 1, F.length("path")).alias("rest"),
        F.length("path").alias("length"), "verdict",
        F.concat("host", "path").alias("rule"))
    labels, slashes = known.agg(
        F.max(depth), F.max(F.length(F.regexp_replace("path", "[^/]", "")))).first()
    name, piece = F.split("host", r"\.", -1), F.split("path", "/", -1)
    suffixes = F.when(F.col("host") == "", F.array(F.lit(""))).otherwise(F.concat(
        F.array(F.lit("")), F.transform(
            F.sequence(F.lit(1), F.least(F.size(name), F.lit(max(labels or 0, 1)))),
            lambda k: F.array_join(F.slice(name, F.size(name) - k + 1, k), "."))))
    heads = F.transform(
        F.sequence(F.lit(0), F.least(F.size(piece) - 1, F.lit(slashes or 0))),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(piece, 1, k), "/"),
                                                        F.lit("/"))))
    keys = pairs.select("host", "path", F.explode(suffixes).alias("suffix")).select(
        "*", F.explode(heads).alias("head"))
    fits = F.substring("path", F.length("head") + 1, F.length("path")).startswith(F.col("rest"))
    return keys.join(ruled, ["suffix", "head"]).where(fits).groupBy("host", "path").agg(
        F.max(F.struct("depth", "length", "verdict", "rule")).alias("found"))


def allowed(pages: DataFrame, rules: DataFrame | Iterable[tuple] = RULES,
            default: str = ALLOW) -> DataFrame:
    """The pages that may be used, all columns."""
    return judge(pages, rules, default).where(F.col("verdict") == ALLOW).select("row.*")


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


SQL = """
with u as (select page_id, case when strpos(url, '://') > 0
                  then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from u),
r(h, p, verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                     ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
b as (select p.*, (select {'rule': h || r.p, 'verdict': verdict} from r
                   where (p.host = h or ends_with(p.host, '.' || h)) and starts_with(p.path, r.p)
                   order by length(h) desc, length(r.p) desc limit 1) as found from p)
select page_id, host, path, found.rule as rule, coalesce(found.verdict, 'allow') as verdict from b
"""
