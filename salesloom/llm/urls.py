"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that any match must contain as whole tokens.
Each rule is filed under the one of its tokens that the fewest URLs hold, counted over all rows. The
tokens of a URL fetch its candidate rules, and only those run their expressions.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)  # of tokens and expressions alike: other letters stay as they are
_TOKEN = re.compile(r"[a-z0-9]+")
MAX_RULES = 200_000


class Rule(NamedTuple):
    name: str
    verdict: str
    fits: Callable[[str, str], bool]  # of host and path
    tokens: frozenset[str]  # none: the rule is tried on every URL
    priority: tuple[int, int]  # the highest that fits wins
    listed: bool = True  # reported by name


def _ends_and_starts(ending: re.Pattern, start: str, host: str, path: str) -> bool:
    return path.startswith(start) and ending.search(host) is not None


def _holds(found: re.Pattern, host: str, path: str) -> bool:
    return found.search(host) is not None or found.search(path) is not None


def host_rule(name: str, verdict: str) -> Rule:
    """`host/path`: fits the host, its subdomains, and paths that start with the rule's path."""
    host, slash, rest = name.partition("/")
    path = slash + rest
    ending = re.compile(rf"(?:\A|\.){re.escape(host)}\Z")
    # a token at the very end of the path may go on in a URL
    tokens = _TOKEN.findall(host) + [
        m.group() for m in _TOKEN.finditer(path.translate(_FOLD)) if m.end() < len(path)]
    return Rule(name, verdict, partial(_ends_and_starts, ending, path), frozenset(tokens), (1, len(name)))


def pattern_rule(word: str, verdict: str = "block") -> Rule:
    """A host label or path segment that is the word (A-Z and a-z are alike), or has it between hyphens
    or underscores; a line break ends a label or segment too."""
    found = re.compile(rf"(?:\A|[./\n_-]){re.escape(word)}(?:[./\n_-]|\Z)", re.ASCII | re.IGNORECASE)
    return Rule(word, verdict, partial(_holds, found), frozenset(_TOKEN.findall(word)), (0, len(word)), False)


#: Rules of the filter itself, for URLs that no listed rule fits. Everything else is allowed.
PATTERN_RULES = [pattern_rule(word) for word in (
    "adserver", "adult", "affiliate", "banner", "bet", "casino", "doubleclick", "escort", "hentai",
    "malware", "phishing", "poker", "porn", "sex", "spam", "torrent", "tracker", "viagra", "warez",
    "xxx",
)]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty without `://` or for NULL."""
    whole = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(whole, r"(?s)\A.*?://(.*)\z", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return host, path


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """URLs that hold each of the given tokens; one row per token comes back."""
    address = F.translate(F.concat_ws("/", "host", "path"), _UPPER, _LOWER)
    held = urls.select(F.explode(F.array_distinct(
        F.regexp_extract_all(address, F.lit("([a-z0-9]+)"), 1))).alias("token"))
    rows = held.where(F.col("token").isin(tokens)).groupBy("token").count().collect()
    return {row["token"]: row["count"] for row in rows}


def index_rules(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[Rule]], list[Rule]]:
    """Rules by their rarest token (ties: the longest, then the first), and rules without tokens."""
    by_token, always = defaultdict(list), []
    for rule in rules:
        if rule.tokens:
            key = min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
            by_token[key].append(rule)
        else:
            always.append(rule)
    return dict(by_token), always


def judge(host: str, path: str, by_token: dict[str, list[Rule]], always: list[Rule]) -> Rule | None:
    """The rule of highest priority that fits; ties go to the smallest name."""
    address = f"{host}/{path}".translate(_FOLD)
    best = None
    candidates = [always, *(by_token.get(t, ()) for t in set(_TOKEN.findall(address)))]
    for rules in candidates:
        for rule in rules:
            better = best is None or (rule.priority, best.name) > (best.priority, rule.name)
            if better and rule.fits(host, path):
                best = rule
    return best


def filter_urls(pages: DataFrame, rules: list[Rule], patterns: list[Rule] = PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    `rule` is the listed rule that decides, NULL where a pattern rule or none does; `verdict` is that
    rule's, and `allow` where nothing fits. A NULL or empty URL has empty host and path; line breaks
    are characters of host and path like others. Only A-Z are folded. Repeated rows
    stay; other columns are not read. The rules, at most MAX_RULES, go to every task.
    """
    rules = [*rules, *patterns]
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    tokens = sorted({t for rule in rules for t in rule.tokens})
    by_token, always = index_rules(rules, token_counts(urls, tokens))

    def run(batches):
        for batch in batches:
            found = [
                judge(h, p, by_token, always)
                for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(),
                                strict=True)
            ]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("host"), batch.column("path"),
                pa.array([r.name if r and r.listed else None for r in found], pa.string()),
                pa.array([r.verdict if r else "allow" for r in found], pa.string()),
            ], ["page_id", "host", "path", "rule", "verdict"])

    return urls.mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string")
