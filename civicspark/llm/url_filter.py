"""URL filter: site rules, then a weighted vocabulary found by Aho-Corasick.

A url is rejected by the vocabulary when one strict term or enough *distinct*
soft terms occur in it as whole terms (no letter or digit on either side).
Site rules go first: a rule fits its host and every subdomain when the url's
path starts with the rule's path; the longest fitting rule decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import LOWER, UPPER

#: Terms that reject a url on their own, by category. Site owners take these words for what they offer.
STRICT_BY_CATEGORY = {
    "adult": (
        "adult", "adults", "bdsm", "camgirl", "camgirls", "camsex", "erotic", "erotica", "escort", "escorts", "fetish", "hentai", "hookup", "hookups",
        "milf", "nsfw", "nude", "nudes", "porn", "porno", "pornography", "sex", "sexcam", "sexcams", "sexy", "stripper", "strippers", "swingers", "xxx",
    ),
    "gambling": (
        "baccarat", "betting", "blackjack", "bookmaker", "bookmakers", "casino", "gamble", "gambling", "jackpot", "jackpots", "poker",
        "roulette", "sportsbook",
    ),
    "pharma": ("ambien", "cialis", "kamagra", "levitra", "modafinil", "phentermine", "tramadol", "viagra", "xanax"),
    "spam": ("clickbait", "linkfarm", "malware", "phishing", "scam", "scams", "spam", "spammer", "spammy"),
    "warez": ("crackz", "keygen", "keygens", "nulled", "serialz", "torrent", "torrents", "warez"),
    "ads": (
        "ads", "adserver", "adservice", "adtrack", "adtracker", "adtracking", "advert", "adverts", "clicktrack", "clicktracker",
        "doubleclick", "popunder", "popunders", "webbug",
    ),
}
#: Terms that reject a url when several different ones occur; each of them has harmless uses.
SOFT_BY_CATEGORY = {
    "adult": ("cam", "cams", "dating", "girls", "hot", "live", "mature", "singles", "strip", "teen", "teens", "webcam"),
    "gambling": ("bet", "bets", "bingo", "bonus", "casinos", "lottery", "lotto", "odds", "slots", "spins", "wager", "win", "winner"),
    "pharma": ("cheap", "diet", "drug", "drugs", "meds", "pharmacy", "pill", "pills", "prescription", "steroids", "weightloss"),
    "spam": ("cash", "credit", "deal", "deals", "discount", "earn", "farm", "free", "loan", "loans", "money", "offer", "payday", "prize", "replica"),
    "warez": ("crack", "cracked", "cracks", "hack", "hacks", "iso", "mod", "patch", "pirate", "rip", "serial", "serials"),
    "tracking": ("ad", "advertising", "affiliate", "banner", "banners", "beacon", "click", "clicks", "pixel", "popup", "popups", "sponsor", "track", "tracker", "tracking"),
}
STRICT_TERMS = tuple(sorted({t for terms in STRICT_BY_CATEGORY.values() for t in terms}))
SOFT_TERMS = tuple(sorted({t for terms in SOFT_BY_CATEGORY.values() for t in terms} - set(STRICT_TERMS)))

#: Largest vocabulary or rule list shipped to the tasks, in characters.
MAX_LIST_CHARS = 64 << 20

_TERM_CHARS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_TO_LOWER = str.maketrans(UPPER, LOWER)

_SCHEMA = "rule string, rule_verdict string, strict_hits int, soft_hits int"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class SiteRule:
    """``verdict`` (allow or block) for ``host`` and its subdomains under ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def find_rule(rules: dict[str, list[tuple[str, str]]], host: str, path: str) -> tuple[str | None, str | None]:
    """The longest rule that fits; of equally long ones that of the longest host."""
    best, suffix = None, host
    while suffix:
        for rule_path, verdict in rules.get(suffix, ()):
            if path.startswith(rule_path) and (best is None or len(suffix) + len(rule_path) > len(best[0])):
                best = (suffix + rule_path, verdict)
        suffix = suffix.partition(".")[2]
    return best or (None, None)


def whole_terms(automaton: ahocorasick.Automaton, url: str) -> set[str]:
    """Distinct vocabulary terms that occur in ``url`` with no letter or digit beside them."""
    low, found = url.translate(_TO_LOWER), set()
    for end, term in automaton.iter(low):
        start = end - len(term) + 1
        if (start == 0 or low[start - 1] not in _TERM_CHARS) and (end + 1 == len(low) or low[end + 1] not in _TERM_CHARS):
            found.add(term)
    return found


def filter_urls(
    pages: DataFrame,
    rules: Iterable[SiteRule] = (),
    strict: Iterable[str] = STRICT_TERMS,
    soft: Iterable[str] = SOFT_TERMS,
    min_soft: int = 2,
    url_col: str = "url",
) -> DataFrame:
    """All columns of ``pages`` plus ``host, path, rule, verdict, strict_hits, soft_hits``.

    A null url, or one without ``://``, has an empty host and path, so no rule
    fits; its text (if any) is still searched for terms. ``verdict`` is the
    rule's, else ``block`` on a strict term or ``min_soft`` distinct soft
    terms, else ``allow``. Columns of ``pages`` with one of the new names are
    replaced. One Arrow pass, no shuffle; the lists are checked against
    ``MAX_LIST_CHARS`` before they are shipped.
    """
    rules, strict, soft = list(rules), sorted(set(strict)), sorted(set(soft) - set(strict))
    size = sum(map(len, strict)) + sum(map(len, soft)) + sum(len(r.text) for r in rules)
    if size > MAX_LIST_CHARS:
        raise ValueError(f"rules and terms have {size} characters; at most {MAX_LIST_CHARS} are shipped to tasks")
    by_host: dict[str, list[tuple[str, str]]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append((r.path, r.verdict))
    strict_set = frozenset(strict)

    @F.pandas_udf(_SCHEMA)
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for term in [*strict, *soft]:
            automaton.add_word(term, term)
        automaton.make_automaton()
        for url, host, path in batches:
            rows = []
            for u, h, p in zip(url, host, path, strict=True):
                hits = whole_terms(automaton, u) if u and len(automaton) else set()
                n_strict = len(hits & strict_set)
                rows.append((*find_rule(by_host, h, p), n_strict, len(hits) - n_strict))
            yield pd.DataFrame(rows, columns=["rule", "rule_verdict", "strict_hits", "soft_hits"])

    new = ("host", "path", "rule", "verdict", "strict_hits", "soft_hits")
    kept = [c for c in pages.columns if c == url_col or c not in new]
    parts = pages.select(
        *(F.col(f"`{c}`") for c in kept), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")
    )
    judged = parts.withColumn("_judged", judge(F.col(url_col), F.col("host"), F.col("path")))
    rejected = (F.col("_judged.strict_hits") >= 1) | (F.col("_judged.soft_hits") >= min_soft)
    return judged.select(
        *(F.col(f"`{c}`") for c in kept),
        "host",
        "path",
        F.col("_judged.rule").alias("rule"),
        F.coalesce(F.col("_judged.rule_verdict"), F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        F.col("_judged.strict_hits").alias("strict_hits"),
        F.col("_judged.soft_hits").alias("soft_hits"),
    )
