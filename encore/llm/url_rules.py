"""URL filter with rules indexed by their rarest literal token.

Two kinds of rules are matched by the same index:

* *site rules* such as ``example.org/es/`` with an action; a rule fits its host and
  all subdomains if the url's path starts with the rule's path.  The longest
  fitting rule decides; of equally long ones block before allow, then the smaller
  string.
* *block patterns* such as ``/cgi-bin/`` (``*`` matches anything, letters in any
  case), which decide urls that no site rule fits: blocked if any pattern occurs.

Each rule becomes a regular expression and a set of literal tokens, runs of ASCII
letters and digits that any matching url must contain as whole tokens.  The rule is
filed under the one of them that is rarest in the urls at hand (ties: the first in
the alphabet).  A url's tokens fetch the rules filed under them, and only those
expressions run; rules without a whole token are tried on every url.

Rules are a parameter held by the driver; the index is broadcast, and ``max_rule_bytes``
bounds it (larger lists raise).  Token counts cover all urls: the urls' tokens meet the
rules' tokens in a broadcast join and are added up, so plans do not grow with the rules.  A task
compiles an expression when a url first fetches its rule.  Judging is a narrow
transformation without a shuffle, so hot hosts do not matter.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no
site rule, and is judged by the patterns alone (null: allowed).  Rows are judged one
by one: repeated rows and null ids are kept, other columns are dropped.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_TOKEN = re.compile("[0-9a-z]+")


@dataclass(frozen=True)
class SiteRule:
    text: str
    action: str  # allow or block

    def regex(self) -> str:
        """Against host and path, joined."""
        return r"(?:[^/]*\.)?" + re.escape(self.text)

    def tokens(self) -> set[str]:
        # the host starts a token; the end of a path need not end one
        return {m[0] for m in _TOKEN.finditer(self.text.translate(_LOWER))
                if m.end() < len(self.text) or "/" not in self.text}


@dataclass(frozen=True)
class BlockPattern:
    text: str

    def regex(self) -> str:
        """Against the whole url."""
        # the first place of each part after the one before is as good as any, so nothing is tried again
        return "".join(f"(?>.*?{re.escape(p)})" for p in self.text.translate(_LOWER).split("*"))

    def tokens(self) -> set[str]:
        return {m[0] for part in self.text.translate(_LOWER).split("*") for m in _TOKEN.finditer(part)
                if m.start() > 0 and m.end() < len(part)}


def host_and_path(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = re.match(r"[^?#]*", rest)[0]
    at = rest.find("/")
    return (rest, "") if at < 0 else (rest[:at], rest[at:])


def _split(url: str | None) -> tuple[str, str]:
    host, path = host_and_path(url)
    return host.translate(_LOWER), path


def token_counts(df: DataFrame, url_col: str, tokens: Sequence[str]) -> dict[str, int]:
    """How many urls have each of ``tokens`` (at most as many rows as there are rule tokens)."""
    if not tokens:
        return {}
    lowered = F.translate(F.col(url_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.array_distinct(F.regexp_extract_all(lowered, F.lit("([0-9a-z]+)"), 1))
    wanted = df.sparkSession.createDataFrame(pa.table({"rule_token": list(tokens)}))  # bounded by ``max_rule_bytes``
    rows = (df.select(F.explode(found).alias("token")).join(F.broadcast(wanted), F.col("token") == F.col("rule_token"))
              .groupBy("token").count().collect())
    return {r["token"]: r["count"] for r in rows}


def judge_urls(df: DataFrame, site_rules: Sequence[SiteRule], patterns: Sequence[BlockPattern] = (),
               id_col: str = "page_id", url_col: str = "url", max_rule_bytes: int = 64 << 20) -> DataFrame:
    """Columns: the id, ``host``, ``path``, ``rule`` (the deciding site rule or null), ``verdict``,
    ``pattern`` (the deciding block pattern or null) and ``n_tried`` (expressions run)."""
    rules = [*site_rules, *patterns]
    if sum(len(r.text.encode()) for r in rules) > max_rule_bytes:
        raise ValueError(f"the rules take more than max_rule_bytes = {max_rule_bytes}")
    tokens = [r.tokens() for r in rules]
    counts = token_counts(df, url_col, sorted(set().union(*tokens)))
    filed: dict[str | None, list[int]] = defaultdict(list)
    for i, own in enumerate(tokens):
        filed[min(own, key=lambda t: (counts.get(t, 0), t)) if own else None].append(i)
    filed = dict(filed)
    # as plain values: a broadcast class would have to be installed on the executors
    shared = df.sparkSession.sparkContext.broadcast((
        [r.text for r in rules], [r.action if isinstance(r, SiteRule) else None for r in rules], filed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, actions, filed = shared.value
        always = filed.get(None, [])
        compiled: dict[int, re.Pattern] = {}

        def fits(i: int, site: str, lowered: str) -> bool:
            if i not in compiled:
                rule = BlockPattern(texts[i]) if actions[i] is None else SiteRule(texts[i], actions[i])
                compiled[i] = re.compile(rule.regex(), re.DOTALL)
            return compiled[i].match(lowered if actions[i] is None else site) is not None

        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = _split(url)
                lowered = (url or "").translate(_LOWER)
                tried = [*always, *(i for t in set(_TOKEN.findall(lowered)) for i in filed.get(t, ()))]
                site = host + path
                hits = [i for i in tried if fits(i, site, lowered)]
                rule = min((i for i in hits if actions[i] is not None), key=lambda i: (-len(texts[i]), actions[i] == "allow", texts[i]), default=None)
                pattern = min((texts[i] for i in hits if actions[i] is None), default=None)
                verdict = actions[rule] if rule is not None else "block" if pattern is not None else "allow"
                out.append((host, path, None if rule is None else texts[rule], verdict,
                            pattern if rule is None else None, len(tried)))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in columns[:5]), pa.array(columns[5], pa.int64())],
                names=["id", "host", "path", "rule", "verdict", "pattern", "n_tried"])

    source = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"id {kind}, host string, path string, rule string, verdict string, pattern string, n_tried long"
    ).withColumnRenamed("id", id_col)
