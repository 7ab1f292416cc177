"""URL filter: allow and block rules, and for all other URLs a logistic regression on hashed character n-grams.

The features of a URL are the n-grams of its host, closed by marks at both ends, and those of its path, each hashed into a table of
its own half and weighed by one over the root of their number. The regression is fitted in numpy on a
small labelled URL table with a quadratic penalty. A quarter of the site names is set aside first, and the threshold is such that a model
of the others blocks few of their wanted URLs: it holds for names that no training row has. Scoring is a map over the URLs.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the
end. A rule ``host/path`` fits its host and all subdomains if the URL's path starts with its path (from its first ``/``);
the longest rule wins, of equally long ones the one with the longer host.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed, as a host without
letters has few features. Repeated rows are judged each. Empty tables give empty
results. Other columns are ignored. URLs are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.text import mix, prepare, span_hashes, text_bytes, tidied

SIZES, BUCKETS = (3, 4, 5), 1 << 16
ROUNDS, RATE, PENALTY = 1500, 4.0, 0.0002
#: Names of the labelled table that choose the threshold are those whose crc32 has this remainder modulo 4.
CALIBRATES = 0
#: The largest share of wanted URLs of unknown names that may be blocked.
MOST_WRONG = 0.02

#: Words in the names of unwanted sites, by kind, and in those of others. The table is made of them by rule.
UNWANTED = {
    "gambling": "gamble gambling gamblers casinos casinoroyal pokerroom poker holdem blackjack roulette jackpot jackpots slots "
    "slotmachine bingo lotto lottery sportsbook bookie betting bettors betslip bestbet winner winners winnings bigwin spins",
    "adult": "adults adultfun adultchat xxx xxxtube porn porno pornstars sexy sexchat sexcams nudes nudity escorts erotic hentai "
    "livecams camgirls hotgirls milfs swingers",
    "pharmacy": "viagra cialis tramadol xanax pill pillshop pillstore buypills dietpill meds cheapmeds rxdrugs steroids pharmacyrx "
    "slimming weightloss painkillers",
    "advertising": "adserver adservice adclick adclicks adnetwork adsrv myads popads popunder popups banners bannerads tracker trackers "
    "tracking trackpixel clicktrack pixeltag clicks clickbait affiliate affiliates",
    "spam": "spammer spammers spamming spamlist spamlinks massmail bulkmail linkfarms linkfarming contentfarm backlinks seolinks doorway "
    "doorways autoblog",
    "offers": "freebie freebies freegift freegifts freecash freespins freemoney giveaway prizes payday loans quickloan cheapest cheaper "
    "cheaply replica replicas fakewatch getrich easycash hotdeals moneymaker",
}
WANTED = {
    "culture": "library libraries museum theatre cinema music orchestra opera poetry painting sculpture gallery archive heritage history "
    "festival concert literature stories chapters publisher newspaper magazine broadcast photography",
    "learning": "school academy university college institute education teaching lessons mathematics physics chemistry biology geography "
    "grammar dictionary encyclopedia research journal science statistics alphabet adulthood childhood",
    "public": "council parliament ministry government citizens election justice police firebrigade hospital clinic health nursing "
    "charity foundation association federation embassy station railway transport airport harbour",
    "nature": "garden gardening forest mountain river ocean weather climate climbing hiking birds butterflies animals farmers farmland "
    "pillow windmill willows grassland meadow orchard thunder northern southern island",
    "home": "cooking recipes kitchen bakery coffee restaurant family parents mothers fathers brothers neighbours furniture carpentry "
    "knitting cycling running athletics football swimming chess puzzles freedom together",
    "work": "engineering software computing developers opensource network documentation manual workshop factory machines tools "
    "electronics robotics windows browser adventure address advice railtrack soundtracks between better spanish",
    "elsewhere": "bibliotheque musee theatre ecole mairie jardin sante voyage quotidien recherche nachrichten bibliothek schule gemeinde "
    "zeitung garten wetter forschung gesundheit noticias biblioteca escuela ayuntamiento jardines ciencia",
}

_BESIDE = {1: "best lucky online top vip big hot super max now royal club".split(), 0: "city local national open new old our young great royal online club".split()}
_ENDINGS = ("com", "net", "org", "info", "co.uk", "de", "fr", "io")
_PREFIXES = ("", "www.", "blog.", "m.", "", "en.")
_PLAIN_PATHS = ("/en/{n}", "/fr/{n}/", "/", "/de/{n}.html", "/es/{n}", "/index.html", "", "/{n}")
_OWN_PATHS = {
    1: ("/play/bonus-{n}", "/buy-now/{n}", "/claim/prize", "/go/out.php", "/click/{n}", "/signup/offer{n}", "/jackpots/big", "/live/show{n}", "/order/discount"),
    0: ("/about", "/articles/{n}", "/wiki/topic{n}", "/2019/03/report", "/docs/introduction", "/news/{n}", "/contact.html", "/courses/unit-{n}", "/events/may"),
}


def labelled_urls() -> list[tuple[str, str, int]]:
    """The labelled URL table: (name, url, 1 for unwanted).

    Sites of both classes are a word, two words with or without a hyphen, or a word and a number, under the same prefixes and
    endings; half of their URLs have a path that says something of the class, the other half one that may be of either.
    """
    out = []
    for label, kinds in ((1, UNWANTED), (0, WANTED)):
        for words in kinds.values():
            words = words.split()
            for i, word in enumerate(words):
                other, beside = words[(i * 7 + 3) % len(words)], _BESIDE[label][i % len(_BESIDE[label])]
                names = (word, f"{word}-{other}", f"{beside}-{word}", f"{beside}{word}", f"{word}{10 + i * 13 % 90}")
                for j, name in enumerate(names):
                    at = i + j
                    host = f"{_PREFIXES[at % len(_PREFIXES)]}{name}.{_ENDINGS[(i + 3 * j) % len(_ENDINGS)]}"
                    own = _OWN_PATHS[label]
                    for path in (_PLAIN_PATHS[at % len(_PLAIN_PATHS)], own[at % len(own)]):
                        out.append((word, f"https://{host}{path.format(n=(at * 37) % 1000)}", label))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """A struct with ``rule`` and ``verdict`` of the longest fitting one of (verdict, host/path), or NULL."""
    fits = []
    for verdict, rule in rules:
        own, _, rest = rule.partition("/")
        fit = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        value = F.struct(
            F.lit(len(rule)).alias("length"), F.lit(len(own)).alias("host"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")
        )
        fits.append(F.when(fit, value))
    return F.array_max(F.array(*fits))


def _features(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and weight of every n-gram."""
    found = []
    for part, texts in enumerate((hosts, paths)):
        data, offsets = text_bytes(texts)
        if part == 0:  # marks at both ends of a host
            at = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            marked = np.full(len(data) + 2 * (len(offsets) - 1), ord("^"), np.uint8)
            marked[np.arange(len(data)) + 2 * at + 1] = data
            data, offsets = marked, offsets + 2 * np.arange(len(offsets))
        lengths = np.diff(offsets)
        own = []
        for size in SIZES:
            counts = np.maximum(0, lengths - size + 1)
            text = np.repeat(np.arange(len(lengths)), counts)
            starts = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[:-1][text]
            hashes = mix(span_hashes(data, starts, starts + size) + np.uint64(size)) if len(starts) else np.zeros(0, np.uint64)
            own.append((text, (hashes % np.uint64(BUCKETS // 2)).astype(np.int64) + part * (BUCKETS // 2)))
        text = np.concatenate([t for t, _ in own])
        total = np.maximum(1, np.bincount(text, minlength=len(lengths)))
        found.append((text, np.concatenate([b for _, b in own]), 1 / np.sqrt(total[text])))
    return tuple(np.concatenate(x) for x in zip(*found))


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float
    block_from: float = 0.5

    def scores(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        text, bucket, weight = _features(hosts, paths)
        z = np.bincount(text, self.weights[bucket] * weight, minlength=len(hosts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fitted(hosts: pa.Array, paths: pa.Array, labels: np.ndarray) -> UrlModel:
    text, bucket, weight = _features(hosts, paths)
    # Both classes weigh the same, however many URLs they have.
    each = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    weights, bias = np.zeros(BUCKETS), 0.0
    for _ in range(ROUNDS):
        z = np.bincount(text, weights[bucket] * weight, minlength=len(labels)) + bias
        miss = (1 / (1 + np.exp(-z)) - labels) * each
        weights -= RATE * (np.bincount(bucket, miss[text] * weight, minlength=BUCKETS) + PENALTY * weights)
        bias -= miss.sum()
    return UrlModel(weights, float(bias))


def train(names: list[str], hosts: list[str], paths: list[str], labels: list[int]) -> UrlModel:
    """The model of all URLs, with a threshold that blocks few wanted URLs of names that a first model has not seen."""
    y = np.array(labels, float)
    aside = np.array([zlib.crc32(name.encode()) % 4 == CALIBRATES for name in names], bool)
    hosts, paths = pa.array(hosts, pa.string()), pa.array(paths, pa.string())
    model = fitted(hosts, paths, y)
    if len(set(y[~aside])) == 2 and (y[aside] == 0).any():
        first = fitted(hosts.filter(pa.array(~aside)), paths.filter(pa.array(~aside)), y[~aside])
        unseen = first.scores(hosts.filter(pa.array(aside)), paths.filter(pa.array(aside)))
        model.block_from = max(0.5, float(np.quantile(unseen[y[aside] == 0], 1 - MOST_WRONG)))
    return model


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    labelled: list[tuple[str, str, int]],
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score`` of every row.

    ``rules`` and ``labelled`` (name of the site, url, 1 for unwanted) are small tables of the caller's policy.
    """
    spark = pages.sparkSession
    prepare(spark, rows=10_000)
    host, path = host_and_path(F.col("url"))
    taught = spark.createDataFrame(labelled, "name string, url string, label int").select("name", host.alias("host"), path.alias("path"), "label")
    taught = sorted(taught.collect())  # the table is the caller's
    model = train(*[[row[k] for row in taught] for k in range(4)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(batch.column("host"), batch.column("path"))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("page_id", "host", "path")] + [pa.array(found)], schema.names)

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    schema = T.StructType([rows.schema["page_id"], *[T.StructField(c, T.StringType()) for c in ("host", "path")], T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(tidied(score), schema).withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("score") >= model.block_from, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", own).alias("verdict"), "score"
    )
