"""URL filters: pattern rules indexed by their rarest literal token.

A rule is written ``action pattern``. Patterns are literal text with ``*`` (anything) and ``^`` (a separator or
the end); ``||`` at the start anchors at a host label. Host rules ``host/path`` fit a host, its subdomains and all
paths that start with theirs. Every rule compiles to a regular expression, and is filed under the one of its
whole literal tokens that is rarest among all URLs judged. A URL's tokens fetch the rules filed under them, and
only those run their expressions; rules without a whole token are always candidates. The longest fitting host rule
decides; without one, the first fitting pattern, then ``allow``.

Defined cases: a null URL or one without ``://`` has empty host and path, no rule, verdict ``allow``; repeated rows
are judged alike; extra columns pass through unless they have the names of the result's.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed values of the task: (action, host/path).
HOST_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Default pattern rules, a parameter of the operator.
PATTERN_RULES = (
    ("block", "^utm_source=feed^"),
    ("block", "^utm_medium=*^utm_campaign="),
    ("block", "^sessionid="),
    ("block", "^phpsessid="),
    ("block", "/wp-login.php"),
    ("block", "/cgi-bin/*.exe"),
    ("block", "||ads.*/banner/"),
    ("block", "||adserver."),
    ("block", ".casino^"),
    ("block", "-casino-"),
    ("block", "/porn/"),
    ("block", "^xxx^"),
    ("block", "/viagra^"),
    ("block", "/warez/"),
)
_LOWER = {c: c + 32 for c in range(65, 91)}
_TOKEN = re.compile("[a-z0-9]+")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(_LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()


@dataclass(frozen=True)
class Rule:
    action: str
    text: str
    is_host: bool
    regex: str
    tokens: tuple[str, ...]


def host_rule(action: str, text: str) -> Rule:
    """Run against host + path."""
    host, slash, path = text.partition("/")
    regex = r"(?:[^/?#]*\.)?" + re.escape(host) + re.escape(slash + path)
    whole = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", (host + slash + path).translate(_LOWER))
    return Rule(action, text, True, regex, tuple(dict.fromkeys(whole)))


def pattern_rule(action: str, text: str) -> Rule:
    """Run anywhere in the URL, A-Z lower-cased."""
    body, anchor = (text[2:], "://(?:[^/?#]*\\.)?") if text.startswith("||") else (text, "")
    parts = {"*": ".*", "^": r"(?:[^a-z0-9_.%-]|$)"}
    regex = anchor + "".join(parts.get(c) or re.escape(c) for c in body.translate(_LOWER))
    shape = ("|" if anchor else "*") + body.translate(_LOWER) + "*"  # both ends may go on, unless anchored
    whole = [m.group() for m in re.finditer(r"(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])", shape)]
    return Rule(action, text, False, regex, tuple(dict.fromkeys(whole)))


@dataclass
class RuleIndex:
    """Rules filed under one token each."""

    rules: list[Rule]
    by_token: dict[str, list[int]] = field(default_factory=dict)
    always: list[int] = field(default_factory=list)

    @classmethod
    def build(cls, rules: Iterable[Rule], counts: dict[str, int]) -> RuleIndex:
        index = cls(list(rules))
        for k, rule in enumerate(index.rules):
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
                index.by_token.setdefault(rarest, []).append(k)
            else:
                index.always.append(k)
        return index

    def candidates(self, url: str) -> list[int]:
        """Numbers of the rules whose expressions must run, in order."""
        found = set(self.always)
        for token in set(_TOKEN.findall(url.translate(_LOWER))):
            found.update(self.by_token.get(token, ()))
        return sorted(found)


def token_counts(urls: DataFrame, tokens: Iterable[str], url_col: str = "url") -> dict[str, int]:
    """In how many URLs each of the rules' tokens is: one pass, at most one row a token comes back."""
    wanted = sorted(set(tokens))
    found = F.array_distinct(F.regexp_extract_all(lower_ascii(text_or_empty(url_col)), F.lit("([a-z0-9]+)"), F.lit(1)))
    rows = urls.select(F.explode(found).alias("token")).where(F.col("token").isin(wanted))
    return {r["token"]: r["count"] for r in rows.groupBy("token").count().collect()}


def _judge(index: RuleIndex):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compiled = [re.compile(r.regex, re.S) for r in index.rules]
        for urls in batches:
            out = []
            for url in urls:
                host, path = split_url(url)
                best = pattern = None
                tried = 0
                if url is not None and host + path:
                    lowered = url.translate(_LOWER)
                    for k in index.candidates(url):
                        rule = index.rules[k]
                        tried += 1
                        if rule.is_host:
                            if compiled[k].match(host + path) and (best is None or len(rule.text) > len(best.text)):
                                best = rule
                        elif pattern is None and compiled[k].search(lowered):
                            pattern = rule
                hit = best or pattern
                out.append((host, path, best and best.text, pattern and pattern.text, hit.action if hit else "allow", tried))
            yield pd.DataFrame(out, columns=["host", "path", "rule", "pattern", "verdict", "n_tried"])

    return run


def url_filter(pages: DataFrame, url_col: str = "url", host_rules=HOST_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the host rule that fits best, else null), ``pattern`` (the first
    pattern that fits, else null), ``verdict`` and ``n_tried`` (expressions run)."""
    rules = [host_rule(a, t) for a, t in host_rules] + [pattern_rule(a, t) for a, t in patterns]
    counts = token_counts(pages, (t for r in rules for t in r.tokens), url_col)
    judge = F.pandas_udf(
        _judge(RuleIndex.build(rules, counts)),
        "host string, path string, rule string, pattern string, verdict string, n_tried long",
    )
    names = ["host", "path", "rule", "pattern", "verdict", "n_tried"]
    return (
        pages.withColumn("__uf", judge(F.col(url_col)))
        .withColumns({n: F.col("__uf")[n] for n in names})
        .drop("__uf")
    )
