"""URL filter: host and path rules first, then a weighted vocabulary of terms.

The vocabulary is one Aho-Corasick automaton per Python worker. A term counts where the
characters next to it in the lower-cased URL are no ASCII letters or digits. One strict
term rejects a URL, and so do ``soft_limit`` different soft terms.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is judged
by its terms alone (null: none). Rows are independent; all input columns stay, and one that
has the name of an output column is replaced by the output.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def ascii_lower(text: str) -> str:
    return text.translate(UPPER_TO_LOWER)


UPPER_TO_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}

STRICT_TERMS = (
    "porn", "porno", "xxx", "hentai", "camgirls", "escorts", "warez", "keygen", "phishing", "malware",
    "spam-farm", "link-farm", "content-farm",
)
SOFT_TERMS = (
    "adult", "sex", "nude", "casino", "poker", "betting", "jackpot", "loans", "payday", "viagra", "pills",
    "torrent", "crack", "cracked", "spam", "farm", "clickbait", "freebies", "replica", "webcam",
)


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the URL's path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Policy:
    rules: tuple[Rule, ...] = ()
    strict: tuple[str, ...] = STRICT_TERMS
    soft: tuple[str, ...] = SOFT_TERMS
    soft_limit: int = 2
    by_host: dict[str, list[Rule]] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        if self.soft_limit < 1:
            raise ValueError("soft_limit must be 1 or more")
        grouped: dict[str, list[Rule]] = {}
        for rule in sorted(self.rules, key=lambda r: (-len(r.text), r.text)):
            grouped.setdefault(rule.host, []).append(rule)
        object.__setattr__(self, "by_host", grouped)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (ASCII letters lower-cased) and path; both empty without ``://``."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    host, tail = ascii_lower(rest[:end]), rest[end:]
    stop = min((at for at in map(tail.find, "?#") if at >= 0), default=len(tail))
    return host, tail[:stop]


def fitting_rule(policy: Policy, host: str, path: str) -> Rule | None:
    """The longest rule that fits; of equally long ones the first by text."""
    best: Rule | None = None
    at = 0
    while host and at >= 0:
        for rule in policy.by_host.get(host[at:], ()):
            if path.startswith(rule.path):
                if best is None or (-len(rule.text), rule.text) < (-len(best.text), best.text):
                    best = rule
                break
        at = host.find(".", at) + 1 or -1
    return best


def automaton(policy: Policy) -> ahocorasick.Automaton | None:
    """None without terms."""
    built = ahocorasick.Automaton()
    for kind, terms in (("soft", policy.soft), ("strict", policy.strict)):
        for term in terms:
            built.add_word(ascii_lower(term), (ascii_lower(term), kind))
    if not len(built):
        return None
    built.make_automaton()
    return built


def term_hits(built: ahocorasick.Automaton | None, url: str | None) -> tuple[int, int]:
    """Strict hits, and different soft terms."""
    if not url or built is None:
        return 0, 0
    low, strict, soft = ascii_lower(url), 0, set()
    for last, (term, kind) in built.iter(low):
        first = last - len(term)
        if (first >= 0 and low[first] in LETTERS) or (last + 1 < len(low) and low[last + 1] in LETTERS):
            continue
        if kind == "strict":
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


SCHEMA = "host string, path string, rule string, strict_hits int, soft_terms int, verdict string"


def judge(pages: DataFrame, policy: Policy, url: str = "url") -> DataFrame:
    """Add host, path, rule, the counts of terms, and the verdict (``allow`` or ``block``)."""

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        built = automaton(policy)
        for urls in batches:
            yield pd.DataFrame(list(verdicts(urls, built)), columns=[c.split()[0] for c in SCHEMA.split(", ")])

    def verdicts(urls: Iterable[str | None], built: ahocorasick.Automaton | None) -> Iterator[tuple]:
        for text in urls:
            host, path = split_url(text)
            rule = fitting_rule(policy, host, path)
            strict, soft = term_hits(built, text)
            by_terms = "block" if strict or soft >= policy.soft_limit else "allow"
            yield host, path, rule and rule.text, strict, soft, rule.verdict if rule else by_terms

    judged = pages.withColumn("__judged", run(F.col(url)))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return judged.withColumns({n: F.col(f"__judged.{n}") for n in names}).drop("__judged")
