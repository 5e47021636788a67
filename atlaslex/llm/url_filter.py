"""URL filter: host and path rules first, then a weighted vocabulary.

Rules name a host, which stands for its subdomains too, and the beginning of a path; the longest fitting rule decides.
Where no rule fits, an Aho-Corasick automaton finds the terms of a vocabulary in the lower-cased address. A term counts
where no ASCII letter or digit touches it. One strict term rejects, and so do ``SOFT_LIMIT`` different soft terms: single soft terms
stand in many harmless addresses.

Defined cases: a null url, or one without ``://``, has an empty host and path, so no rule fits; the vocabulary still
reads the text that is there (null: none) and allows what has no hits. Repeated rows are judged alike. Extra columns are
not read. Addresses may have any length. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from atlaslex.llm.batches import LOWER_CASE, text_bytes, text_function, unused

#: Host and path as one text -> verdict.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}

STRICT, SOFT, SOFT_LIMIT = 2, 1, 2

#: Terms that mean pornography or stolen software wherever they stand: one place rejects. Terms are lower case and may hold other characters than letters.
STRICT_TERMS = [
    "porn", "porno", "pornhub", "xxx", "xvideos", "hentai", "camgirl", "camgirls", "milf", "nsfw", "warez", "serialz", "keygens", "crackz", "carding",
]
#: Terms of betting, dating, drugs, loans, attacks and downloads that stand in harmless addresses too: several different ones reject.
SOFT_TERMS = [
    "adult", "sex", "sexy", "nude", "nudes", "erotic", "fetish", "hardcore", "escort", "escorts", "casino", "bet", "bets", "betting", "bingo", "poker",
    "slot", "slots", "roulette", "blackjack", "jackpot", "lottery", "gambling", "wager", "dating", "hookup", "singles", "torrent", "torrents", "crack",
    "cracked", "keygen", "serial", "nulled", "free-download", "malware", "ransomware", "phishing", "darknet", "pills", "viagra", "cialis", "pharmacy",
    "replica", "payday", "loans", "forex", "hacks", "cheats",
]
VOCABULARY = dict.fromkeys(STRICT_TERMS, STRICT) | dict.fromkeys(SOFT_TERMS, SOFT)

FIELDS = StructType(
    [StructField(n, StringType()) for n in ("host", "path", "rule", "verdict")]
    + [StructField(n, LongType()) for n in ("strict_hits", "soft_terms")]
)


@cache
def automaton():
    """The vocabulary as an Aho-Corasick automaton, built once per Python worker."""
    import ahocorasick

    built = ahocorasick.Automaton()
    for term, weight in VOCABULARY.items():
        built.add_word(term, (term, weight))
    built.make_automaton()
    return built


def split_url(url: str) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    ends = [len(rest)]
    ends += [i for i in (rest.find(c) for c in "?#") if i >= 0]
    rest = rest[: min(ends)]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.encode().translate(LOWER_CASE).decode(), path


def fitting_rule(host: str, path: str, rules: dict[str, str]) -> str | None:
    """The longest rule whose host is ``host`` or a parent of it and whose path starts ``path``."""
    best = None
    for rule in rules:
        rule_host, rule_path = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = (host == rule_host or host.endswith(f".{rule_host}")) and path.startswith(rule_path)
        if fits and (best is None or len(rule) > len(best)):
            best = rule
    return best


def _word(c: str) -> bool:
    return c.isascii() and c.isalnum()


def weigh(address: str) -> tuple[int, int]:
    """Places of strict terms, and different soft terms, of a lower-cased address."""
    strict, soft = 0, set()
    for end, (term, weight) in automaton().iter(address):
        start = end - len(term) + 1
        if (start and _word(address[start - 1])) or _word(address[end + 1 : end + 2]):
            continue
        if weight == STRICT:
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


def _judge(urls: list[bytes]) -> dict:
    out = {field: [] for field in FIELDS.names}
    for raw in urls:
        host, path = split_url(raw.decode())
        rule = fitting_rule(host, path, RULES) if host else None
        strict, soft = weigh(raw.translate(LOWER_CASE).decode())
        verdict = RULES[rule] if rule else "block" if strict or soft >= SOFT_LIMIT else "allow"
        for field, value in zip(FIELDS.names, (host, path, rule, verdict, strict, soft), strict=True):
            out[field].append(value)
    return out


judge = text_function(FIELDS, _judge)


def judge_urls(pages: DataFrame) -> DataFrame:
    """``page_id``, host, path, rule, verdict and the hits of every page; reads the two columns only."""
    return pages.select("page_id", judge(text_bytes("url")).alias("j")).select("page_id", "j.*")


def keep(pages: DataFrame) -> DataFrame:
    """The pages whose address is allowed, with the columns they had."""
    (name,) = unused(pages, "judged")
    found = pages.withColumn(name, judge(text_bytes("url")))
    return found.where(F.col(f"{name}.verdict") == "allow").drop(name)
