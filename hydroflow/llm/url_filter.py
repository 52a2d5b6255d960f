"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a pattern with an action. ``||`` anchors it at a host or a subdomain of it, ``|`` at either end of the
url, ``*`` stands for any run and ``^`` for a separator or the end; ``@@`` in front makes it an allow rule,
``$match-case`` behind it switches the ASCII case folding off. Patterns are matched against the url behind its
first ``://``, with the host's A-Z lower-cased.

Each rule is filed under the rarest of its literal tokens; rarity is counted over all urls by a Spark job. A url's
tokens fetch the rules filed under them, and only those run their regular expressions. Rules without a token of
their own are tried on every url.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroflow.llm.common import ascii_lower, fresh, text_or_empty

ALLOW, BLOCK = "allow", "block"
#: Rules whose index is shipped to the tasks at once. A longer list is applied in blocks of this many.
RULES_AT_ONCE = 50_000
#: Tokens of rules that are broadcast to be counted: a few MB.
TOKENS_AT_ONCE = 100_000
_TOKEN = re.compile("[a-z0-9]+")
_MATCH = "host_rule string, host_length int, host_action string, pattern string, pattern_length int, pattern_action string"


@dataclass(frozen=True)
class Rule:
    """``label`` marks a host rule: host and path as its author wrote them."""

    pattern: str
    action: str = BLOCK
    label: str | None = None

    @classmethod
    def parse(cls, line: str) -> Rule:
        return cls(line[2:], ALLOW) if line.startswith("@@") else cls(line)

    @classmethod
    def host(cls, host: str, path: str, action: str) -> Rule:
        """A host with its subdomains, and the beginning of the path."""
        return cls(f"||{host}{path or '^'}$match-case", action, f"{host}{path}")


def _parts(rule: Rule) -> tuple[str, str, str, bool]:
    body, cased = rule.pattern, False
    if body.endswith("$match-case"):
        body, cased = body.removesuffix("$match-case"), True
    start = "||" if body.startswith("||") else "|" if body.startswith("|") else ""
    body = body[len(start) :]
    end = "|" if body.endswith("|") else ""
    return start, body[: len(body) - len(end)], end, cased


def to_regex(rule: Rule) -> re.Pattern[str]:
    start, body, end, cased = _parts(rule)
    wild = {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|\Z)"}
    middle = "".join(wild.get(c) or re.escape(c) for c in body)
    head = {"||": r"^(?:[^/?#]*\.)?", "|": "^", "": ""}[start]
    return re.compile(head + middle + (r"\Z" if end else ""), re.DOTALL | re.ASCII | (0 if cased else re.IGNORECASE))


def literal_tokens(rule: Rule) -> list[str]:
    """Tokens that every matching url has as whole tokens: those with a fixed neighbour on both sides."""
    start, body, end, _ = _parts(rule)
    body = ascii_lower_text(body)
    found = []
    for m in _TOKEN.finditer(body):
        left = bool(start) if m.start() == 0 else body[m.start() - 1] != "*"
        right = bool(end) if m.end() == len(body) else body[m.end()] != "*"
        if left and right:
            found.append(m.group())
    return found


def ascii_lower_text(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


class RuleIndex:
    """Rules filed under their rarest token."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]):
        self.rules = [(r, to_regex(r)) for r in rules]
        self.by_token: dict[str, list[int]] = defaultdict(list)
        self.always: list[int] = []
        for i, rule in enumerate(rules):
            if tokens := literal_tokens(rule):
                self.by_token[min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t))].append(i)
            else:
                self.always.append(i)

    def candidates(self, target: str) -> list[int]:
        filed = self.by_token
        return self.always + [i for t in set(_TOKEN.findall(ascii_lower_text(target))) if t in filed for i in filed[t]]

    def match(self, target: str) -> tuple:
        """The longest matching host rule and the longest other rule; ties: block first, then by text."""
        best: dict[bool, tuple] = {}
        for i in self.candidates(target):
            rule, regex = self.rules[i]
            if regex.search(target):
                shown = rule.label if rule.label is not None else rule.pattern
                rank = (-len(shown), rule.action != BLOCK, shown)
                key = rule.label is not None
                if key not in best or rank < best[key]:
                    best[key] = rank
        out: list = []
        for key in (True, False):
            rank = best.get(key)
            out += [rank[2], -rank[0], ALLOW if rank[1] else BLOCK] if rank else [None, None, None]
        return tuple(out)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and the whole url behind the first ``://``; empty without one."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(rest, r"^[^/?#]*([\s\S]*)", 1)
    return host, path, F.concat(host, tail)


def token_counts(targets: DataFrame, column: str, tokens: Iterable[str]) -> dict[str, int]:
    """How many urls have each of the rules' tokens. The result has one entry per token asked for.

    Up to TOKENS_AT_ONCE of them the token table goes to every task, and only counts are shuffled; beyond, tokens are
    counted before they are joined, so that a frequent one is never gathered either.
    """
    rows = [(t,) for t in set(tokens)]
    wanted = targets.sparkSession.createDataFrame(rows, "token string")
    found = targets.select(
        F.explode(F.array_distinct(F.regexp_extract_all(ascii_lower(F.col(column)), F.lit("([a-z0-9]+)"), 1))).alias("token")
    )
    if len(rows) <= TOKENS_AT_ONCE:
        counts = found.join(F.broadcast(wanted), "token").groupBy("token").count()
    else:
        counts = found.groupBy("token").count().join(wanted, "token")
    return {r["token"]: r["count"] for r in counts.collect()}


def _matcher(index: RuleIndex):
    @F.pandas_udf(_MATCH)
    def match(targets: pd.Series) -> pd.DataFrame:
        names = [part.split()[0] for part in _MATCH.split(", ")]
        return pd.DataFrame([index.match(t) for t in targets], columns=names).astype(
            {"host_length": "Int32", "pattern_length": "Int32"}
        )

    return match


def filter_urls(df: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = ALLOW) -> DataFrame:
    """Add struct ``judged`` (host, path, rule, pattern, verdict) to every row.

    The longest fitting host rule decides; without one the longest matching pattern; without either ``default``.
    NULL urls and urls without ``://`` have empty host and path, match no anchored rule and are judged like any
    other. Rows are kept as they are, repeated ones too; a column already called ``judged`` makes the new one
    ``_judged``. An empty rule list gives the default everywhere.
    """
    host, path, target = url_parts(text_or_empty(url))
    part, out = fresh(df, "url_parts"), fresh(df, "judged")
    parts = df.withColumn(part, F.struct(host.alias("host"), path.alias("path"), target.alias("target")))
    urls = df.select(target.alias("target"))
    counts = token_counts(urls, "target", [t for r in rules for t in literal_tokens(r)]) if rules else {}
    hits = []
    for start in range(0, len(rules), RULES_AT_ONCE):
        name = fresh(parts, f"match{start}")
        index = RuleIndex(rules[start : start + RULES_AT_ONCE], counts)
        parts = parts.withColumn(name, _matcher(index)(F.col(part)["target"]))
        hits.append(name)

    def best(kind: str, shown: str) -> Column:
        # Smallest first: longest, then block before allow, then by text.
        ranked = F.array(
            *[
                F.struct(
                    (-F.col(h)[f"{kind}_length"]).alias("rank"),
                    (F.col(h)[f"{kind}_action"] != BLOCK).alias("allows"),
                    F.col(h)[shown].alias("shown"),
                )
                for h in hits
            ]
        )
        return F.array_min(F.filter(ranked, lambda x: x["shown"].isNotNull()))

    if not hits:
        nothing = F.lit(None).cast("struct<rank:int,allows:boolean,shown:string>")
        of_host = of_pattern = nothing
    else:
        of_host, of_pattern = best("host", "host_rule"), best("pattern", "pattern")
    chosen = F.coalesce(of_host["allows"], of_pattern["allows"], F.lit(default == ALLOW))
    judged = F.struct(
        F.col(part)["host"].alias("host"),
        F.col(part)["path"].alias("path"),
        of_host["shown"].alias("rule"),
        of_pattern["shown"].alias("pattern"),
        F.when(chosen, ALLOW).otherwise(BLOCK).alias("verdict"),
    )
    return parts.withColumn(out, judged).drop(part, *hits)
