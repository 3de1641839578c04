"""URL rules, found by their rarest token.

A rule is a regular expression over the whole URL plus the literal tokens (runs of ASCII
letters and digits, lower case) without which it cannot match. The rules are indexed by the
one of their tokens that fewest URLs hold. A URL's tokens fetch candidate rules from the
index, and only those run their regular expressions.

Host rules (host with its subdomains, and a start of the path) are such rules too: their
tokens are those of the host and the complete ones of the path. Of the host rules that fit,
the longest decides; without one, any fitting pattern blocks and everything else is allowed.

Scale. Rules are a parameter, of which every task holds a copy; what they need of the corpus
is one count per rule token, summed on the map side. URLs are judged where they are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import rows_to_batch, spark_schema

_TOKEN = re.compile("[a-z0-9]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.translate(_LOWER))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    ends = [i for c in "?#" if (i := rest.find(c)) >= 0]
    rest = rest[: min(ends)] if ends else rest
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


@dataclass(frozen=True)
class Rule:
    """``name`` tells rules apart; ``host`` and ``path`` are set for host rules only."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    host: str | None = None
    path: str = ""


def host_rule(verdict: str, name: str) -> Rule:
    """``com/`` or ``example.com/en/``: the host and its subdomains, and a start of the path."""
    host, _, path = name.partition("/")
    path = "/" + path
    # The scheme part ends at the first "://"; host letters may be of either case.
    letters = "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else re.escape(c) for c in host)
    pattern = rf"\A(?:(?!://).)*://(?:[^/?#]*\.)?{letters}{re.escape(path)}"
    whole = path[: path.rfind("/") + 1] if not path.endswith("/") else path
    return Rule(name, verdict, pattern, tuple(dict.fromkeys(tokens(host) + tokens(whole))), host, path)


def pattern_rule(verdict: str, name: str, pattern: str, literals: Sequence[str]) -> Rule:
    """A regular expression that matches only URLs which hold all of ``literals`` as tokens."""
    if not literals or any(tokens(x) != [x] for x in literals):
        raise ValueError(f"rule {name} needs literal tokens")
    return Rule(name, verdict, pattern, tuple(literals))


class RuleIndex:
    """Rules by their rarest token; ``frequency`` counts the URLs that hold a token."""

    def __init__(self, rules: Iterable[Rule], frequency: Mapping[str, int]):
        self._by_token: dict[str, list[tuple[Rule, re.Pattern[str]]]] = defaultdict(list)
        for rule in rules:
            rarest = min(rule.literals, key=lambda t: (frequency.get(t, 0), t))
            self._by_token[rarest].append((rule, re.compile(rule.pattern, re.DOTALL)))
        self.tried = 0

    def candidates(self, url: str) -> Iterator[tuple[Rule, re.Pattern[str]]]:
        for token in set(tokens(url)):
            yield from self._by_token.get(token, ())

    def fitting(self, url: str) -> list[Rule]:
        found = []
        for rule, pattern in self.candidates(url):
            self.tried += 1
            if pattern.search(url):
                found.append(rule)
        return found

    def judge(self, url: str | None) -> tuple[str | None, str, str | None]:
        """The deciding host rule, the verdict, and the pattern rule that blocked if one did."""
        found = self.fitting(url or "")
        hosts = [r for r in found if r.host is not None]
        if hosts:
            best = max(hosts, key=lambda r: (len(r.name), len(r.host or ""), r.name))
            return best.name, best.verdict, None
        patterns = sorted(r.name for r in found if r.verdict == "block")
        return (None, "block", patterns[0]) if patterns else (None, "allow", None)


#: The host rules of the registered query.
HOST_RULES = (
    host_rule("allow", "com/"),
    host_rule("block", "example.com/en/"),
    host_rule("allow", "www.example.com/en/"),
    host_rule("block", "net/es/"),
    host_rule("block", "net/fr/"),
)
#: The method's own rules: hosts that sell by spam, and executable downloads.
PATTERN_RULES = (
    pattern_rule("block", "cheap-pills", r"://[^/?#]*\b[Cc]heap-[Pp]ills\b", ("cheap", "pills")),
    pattern_rule("block", "free-bets", r"://[^/?#]*\b[Ff]ree-[Bb]ets\b", ("free", "bets")),
    pattern_rule("block", "casino-host", r"://[^/?#]*\b[Cc]asino\b", ("casino",)),
    pattern_rule("block", "download-exe", r"\.[Ee][Xx][Ee](?:[?#]|\Z)", ("exe",)),
)

_OUT = pa.schema(
    [
        ("page_id", pa.int64()),
        ("host", pa.string()),
        ("path", pa.string()),
        ("rule", pa.string()),
        ("verdict", pa.string()),
        ("pattern", pa.string()),
    ]
)


def token_counts(urls: DataFrame, url_col: str, wanted: Sequence[str]) -> dict[str, int]:
    """How many URLs hold each wanted token: a count per wanted token comes back, no more."""
    each = F.array_distinct(F.regexp_extract_all(F.lower(F.col(f"`{url_col}`")), F.lit("([a-z0-9]+)"), 1))
    hit = F.array_intersect(each, F.array(*[F.lit(t) for t in wanted]))
    counted = urls.select(F.explode(hit).alias("token")).groupBy("token").count()
    return {r["token"]: r["count"] for r in counted.collect()}


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = HOST_RULES + PATTERN_RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict and pattern for every row of ``pages``.

    A null URL, or one without ``://``, has empty host and path; no rule fits it and it is
    allowed. Repeated rows and ids are judged row by row. Other columns are not read.
    """
    wanted = sorted({t for r in rules for t in r.literals})
    frequency = token_counts(pages, url_col, wanted) if wanted else {}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(rules, frequency)
        for batch in batches:
            urls = batch.column(1).to_pylist()
            rows = []
            for page_id, url in zip(batch.column(0).to_pylist(), urls):
                rows.append((page_id, *split_url(url), *index.judge(url)))
            yield rows_to_batch(rows, _OUT)

    picked = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
    )
    return picked.mapInArrow(judge, spark_schema(_OUT))
