"""URL filters: path rules by longest match, then pattern rules indexed by a literal token.

Base verdict: a (host, path) rule fits a host and its subdomains when the url's path
starts with the rule's path; the longest fitting rule decides. Urls no path rule
fits are judged by the pattern rules: each names the literal tokens its regular
expression can't match without; the rarest of them over all given urls becomes its
index key. A url's tokens fetch the candidate rules and only those are run. One
matching rule blocks the url; without one it is allowed.

Plan: token frequencies are one pre-aggregated count restricted to the rules'
literals (so at most one row per literal reaches the driver). Judging is a map over
Arrow batches of (id, url) with no shuffle; the compiled rules, a fixed table, go
with the task. Which literal is the rarest changes the work only, never a verdict.

Defined results: null url or one without ``://``: empty host and path, no rule,
verdict by the pattern rules (null: allow). Repeated rows: returned as often as
given. Very long urls are read whole. Empty table: empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.tasks import map_batches

# Fixed values: (action, host, path) of the base rules.
PATH_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

# Pattern rules: (name, literal tokens each match must hold, regular expression on the
# lower-cased url). A token is a maximal run of a-z and 0-9, so every literal stands
# between characters outside that class (or the url's ends) in the expression.
_SEP = r"(?:^|[^a-z0-9])"
_END = r"(?:[^a-z0-9]|$)"


def _phrase(*tokens: str) -> tuple[list[str], str]:
    return list(tokens), _SEP + r"[^a-z0-9/]".join(tokens) + _END


PATTERN_RULES = [(name, *spec) for name, spec in [
    ("gambling-casino-win", _phrase("casino", "win")),
    ("gambling-free-bets", _phrase("free", "bets")),
    ("gambling-casino", _phrase("casino")),
    ("gambling-poker", _phrase("online", "poker")),
    ("gambling-slots", _phrase("slots")),
    ("gambling-bonus", _phrase("deposit", "bonus")),
    ("adult-host", (["adult"], r"^[a-z]+://(?:[^/?#]*[.-])?adult[.-]")),
    ("adult-x", _phrase("adult", "x")),
    ("adult-xxx", _phrase("xxx")),
    ("adult-porn", _phrase("porn")),
    ("adult-cams", _phrase("live", "cams")),
    ("pharma-pills", _phrase("cheap", "pills")),
    ("pharma-viagra", _phrase("viagra")),
    ("loans-payday", _phrase("payday", "loans")),
    ("warez-crack", _phrase("crack", "download")),
    ("warez-torrent", _phrase("torrent")),
    ("malware-phish", _phrase("phish")),
    ("malware-verify", (["verify", "login"], _SEP + r"verify[^a-z0-9].*" + _SEP + "login" + _END)),
    ("tracker-doubleclick", (["doubleclick", "net"], r"^[a-z]+://(?:[^/?#]*\.)?doubleclick\.net" + _END)),
    ("tracker-adserver", (["adserver"], r"^[a-z]+://(?:[^/?#]*\.)?adserver\.")),
    ("spam-replica", _phrase("replica", "watches")),
    ("spam-essay", _phrase("essay", "writing", "service")),
    ("session-login", (["wp", "login", "php"], r"/wp-login\.php" + _END)),
    ("session-cart", (["cart", "add"], "/cart/add" + _END)),
]]

_TOKEN = re.compile("[a-z0-9]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def ascii_lower(s: str) -> str:
    return s.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a url; both empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return ascii_lower(host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def path_rule(host: str, path: str, rules: list[tuple[str, str, str]]) -> tuple[str, str] | None:
    """(rule, action) of the longest fitting path rule."""
    fits = [(len(h + p), h + p, a) for a, h, p in rules
            if path.startswith(p) and (host == h or host.endswith("." + h))]
    return max(fits)[1:] if fits else None


def token_counts(urls: DataFrame, url: str, literals: list[str]) -> dict[str, int]:
    """Over all urls, how many hold each literal (at most one row per literal is collected)."""
    tokens = F.array_distinct(F.regexp_extract_all(F.translate(
        url, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("([a-z0-9]+)"), F.lit(1)))
    held = F.array_intersect(tokens, F.array(*map(F.lit, literals)))
    rows = urls.select(F.explode(held).alias("token")).groupBy("token").count().collect()
    return dict.fromkeys(literals, 0) | {r["token"]: r["count"] for r in rows}


def rarest_index(rules: list[tuple[str, list[str], str]], counts: dict[str, int]) -> dict[str, list[int]]:
    """Literal token -> numbers of the rules indexed by it (their rarest; ties: the first named)."""
    index: dict[str, list[int]] = {}
    for i, (_, literals, _) in enumerate(rules):
        index.setdefault(min(literals, key=lambda t: counts.get(t, 0)), []).append(i)
    return index


def filter_urls(df: DataFrame, key: str = "page_id", url: str = "url",
                path_rules: list[tuple[str, str, str]] = PATH_RULES,
                pattern_rules: list[tuple[str, list[str], str]] = PATTERN_RULES) -> DataFrame:
    """key, host, path, rule, verdict, pattern (the first matching pattern rule, else null)."""
    pairs = df.select(F.col(key).alias("key"), F.col(url).alias("url"))
    literals = sorted({t for _, tokens, _ in pattern_rules for t in tokens})
    index = rarest_index(pattern_rules, token_counts(pairs, "url", literals)) if literals else {}
    sources = [(name, regex) for name, _, regex in pattern_rules]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(name, re.compile(regex)) for name, regex in sources]
        for batch in batches:
            rows: list[tuple] = []
            for u in batch.column("url").to_pylist():
                host, path = split_url(u)
                fit = path_rule(host, path, path_rules)
                low = ascii_lower(u or "")
                fetched = sorted({i for t in set(_TOKEN.findall(low)) for i in index.get(t, ())})
                hit = next((compiled[i][0] for i in fetched if compiled[i][1].search(low)), None)
                verdict = fit[1] if fit else "block" if hit else "allow"
                rows.append((host, path, fit and fit[0], verdict, hit))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(c, pa.string()) for c in cols]],
                ["key", "host", "path", "rule", "verdict", "pattern"])

    kind = dict(pairs.dtypes)["key"]
    out = map_batches(pairs, judge, f"key {kind}, host string, path string, rule string, verdict string, pattern string")
    return out.withColumnRenamed("key", key)
