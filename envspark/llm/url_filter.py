"""URL filter: host rules first, then logistic regression on hashed character n-grams.

A rule is a host and a path prefix; it fits the host and its subdomains, and the longest
fitting rule decides. Other urls are judged by a logistic regression over the hashed
n-grams of host and path, fitted on the driver from a small labelled table.

Cases: a null url, or one without `://`, has an empty host and path, fits no rule and is
allowed, as it has no known n-grams; of rules of equal length the first in order wins (two rules that fit have
equal length only if they are equal); repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = 1 << 15
LENGTHS = (3, 4, 5)
# a url is blocked if the model is fairly sure; unseen words score near one half
THRESHOLD = 0.7

#: fixed values of the task: verdict and rule
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: hosts of the small labelled table, invented
UNWANTED = (
    "adult-videos", "xxx-adult", "adult-chat", "adultzone", "hot-adult", "adult-x-clips", "casino-royal", "casino777",
    "online-casino", "best-casino-games", "win-casino", "casino-slots", "free-bets-now", "sports-bets", "bets24",
    "poker-bets", "freebets", "live-bets", "cheap-pills-shop", "pills-online", "diet-pills", "cheap-meds", "cheappills",
    "buy-pills", "spam-mail", "spamhost", "link-farm", "seo-spam", "spam-links", "linkfarm-spam", "ads-server",
    "track-ads", "ads-click", "adserver-track", "popup-ads", "click-track", "warez-crack", "phish-login", "keygen-warez",
    "fake-lottery")
ORDINARY = (
    "library", "university", "gardening", "news", "weather", "museum", "recipes", "history", "travel", "science",
    "townhall", "school", "music", "health", "thesis", "theatre", "nation", "other", "station", "motion", "therapy",
    "thatch", "thin", "section", "action", "table", "heron", "forum", "maps", "docs", "sports", "farm-shop",
    "adult-education", "betsy-crafts", "hiking-tracks", "theses", "attention", "ethernet", "leather", "the-harbour")
#: each host stands under these, so that neither subdomain nor path tells the classes apart
FORMS = ("http://{}.test/en/12", "https://www.{}.test/fr/7.html", "http://blog.{}.test/de/3?page=2",
         "https://m.{}.test/es/5/", "http://{}.test/", "https://{}.test/en/88#top")
LABELLED = tuple((form.format(host), label) for label, hosts in ((1, UNWANTED), (0, ORDINARY))
                 for host in hosts for form in FORMS)


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?` or `#`, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    branches = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        branches.append((fits, rule, verdict))
    none = F.lit(None).cast("string")
    return tuple(reduce(lambda out, b: F.when(b[0], F.lit(b[i])).otherwise(out), reversed(branches), none)
                 for i in (1, 2))


def places(host: str, path: str) -> list[int]:
    """Where the distinct n-grams of host and path are hashed to."""
    out = set()
    for mark, part in (("h", host), ("p", path)):
        whole = f"^{part}$"
        for n in LENGTHS:
            out.update(zlib.crc32((mark + whole[i:i + n]).encode()) % PLACES for i in range(len(whole) - n + 1))
    return sorted(out)


def split(url: str) -> tuple[str, str]:
    """Host and path of a labelled url."""
    rest = url.partition("://")[2].partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.lower(), slash + path


def fit(labelled: Sequence[tuple[str, int]] = LABELLED, steps: int = 600, rate: float = 4.0,
        decay: float = 3e-4) -> np.ndarray:
    """Weights by place, without a constant: what is unknown scores one half.

    Gradient steps on the mean loss, with both classes weighing the same.
    """
    rows = [places(*split(url)) for url, _ in labelled]
    used = sorted(set().union(*rows))
    column = {place: i for i, place in enumerate(used)}
    marks = np.zeros((len(rows), len(used)))
    for mark, row in zip(marks, rows):
        mark[[column[p] for p in row]] = 1 / np.sqrt(len(row))
    wanted = np.array([y for _, y in labelled], dtype=float)
    share = np.where(wanted == 1, 0.5 / max(1, wanted.sum()), 0.5 / max(1, (1 - wanted).sum()))
    weights = np.zeros(len(used))
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-marks @ weights))
        weights -= rate * (marks.T @ ((chance - wanted) * share) + decay * weights)
    out = np.zeros(PLACES)
    out[used] = weights
    return out


def judged(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES,
           labelled: Sequence[tuple[str, int]] = LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """`key`, host, path, rule, verdict, score (chance that the model gives to block)."""
    sent = pages.sparkSession.sparkContext.broadcast(fit(labelled).astype(np.float32))

    @F.pandas_udf("double")
    def chance(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        weights = sent.value
        for hosts, paths in parts:
            out = np.empty(len(hosts))
            for i, (host, path) in enumerate(zip(hosts, paths)):
                found = places(host, path)
                out[i] = weights[found].sum() / np.sqrt(max(1, len(found)))
            yield pd.Series(1 / (1 + np.exp(-out)))

    parts = pages.select(F.col(f"`{key}`"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    scored = parts.withColumn("score", chance("host", "path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select(F.col(f"`{key}`"), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                         "score")
