"""URL filter: ordered rules, and for the rest naive Bayes over the words of host and path.

Names such as ``freecasinobets`` are split into words by a unigram model (Viterbi over all splits): the words' counts
come from the texts of all pages, and only those that are part of some host are looked up, by a join. Multinomial naive
Bayes then scores host words and path words. It learns from pages whose words are on a short list of seeds, and finds
out which other words go with them. Its words are hashed to a fixed number of features, so the model's size is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import pack, staged
from arrears.llm.registry import query, table

LONGEST = 24  # letters of a word in the unigram model
FEATURES = 1 << 16
SMOOTH = 0.05
PRIOR_SHARE = 1e-5  # share that each word of the lexicon has in the unigram model beside its count

#: Words that mark an unwanted page.
SEEDS = """
casino casinos poker roulette blackjack jackpot slot slots bet bets betting bingo lottery gambling pill pills viagra
cialis pharmacy pharma steroid steroids porn porno xxx sex sexy nude escort escorts adult hentai webcam payday loan
loans warez keygen crack cracked torrent torrents hack hacks replica replicas fake counterfeit binary forex
""".split()

#: Words that are common in names of hosts.
COMMON = """
the and for free cheap best win winner buy sale shop store online web site world news blog daily live game games play
club house home land city book books music video movie movies photo photos mail chat forum help info guide review
reviews tech data cloud soft art design travel hotel food health sport sports school learn job jobs money bank card
""".split()

#: Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """The host (A-Z in lower case) up to ``/``, ``?``, ``#``; the path up to ``?``, ``#``; empty without ``://``."""
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(address, "://")
    rest = F.when(at > 0, F.substring(address, at + 3, F.length(address))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def rule_of(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits ``host`` and ``path``; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones override
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(
            F.col("path"), F.lit(path)
        )
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def letters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("([a-z]+)"), F.lit(1))


def word_counts(pages: DataFrame, text: str) -> DataFrame:
    """``word`` and ``n``: words of up to ``LONGEST`` small letters in the texts, markup left out."""
    plain = F.translate(F.regexp_replace(F.col(text).cast("string"), "<[^<>]*>", " "), UPPER, LOWER)
    words = pages.select(F.explode(letters(plain)).alias("word"))
    return words.where(F.length("word") <= LONGEST).groupBy("word").agg(F.count("*").alias("n"))


def split_word(name: str, counts: dict[str, float], total: float) -> list[str]:
    """The likeliest split. A word without count has a share that falls tenfold with each letter."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        top = (-math.inf, 0)
        for begin in range(max(0, end - LONGEST), end):
            n = counts.get(name[begin:end])
            share = math.log10(n / total) if n else 1 - math.log10(total) - (end - begin)
            top = max(top, (best[begin][0] + share, begin))
        best.append(top)
    out, end = [], len(name)
    while end:
        begin = best[end][1]
        out.append(name[begin:end])
        end = begin
    return out[::-1]


def split_names(names: DataFrame, counts: DataFrame, lexicon: Sequence[str]) -> DataFrame:
    """``name`` and ``words`` for each distinct name."""
    total = float((counts.agg(F.sum("n")).first()[0] or 0) + 10)
    prior = total * PRIOR_SHARE
    length = F.length("name")
    parts = names.select(
        "name",
        F.explode(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(1), length),
                        lambda at: F.transform(
                            F.sequence(F.lit(1), F.least(F.lit(LONGEST), length - at + 1)),
                            lambda size: F.substring("name", at, size),
                        ),
                    )
                )
            )
        ).alias("word"),
    )
    found = (
        parts.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("found"))
    )
    rows = names.join(found, "name", "left").select("name", "found")

    def work(batches):
        for batch in batches:
            known, words = batch.column(1).to_pylist(), []
            for name, held in zip(batch.column(0).to_pylist(), known):
                n = {x["word"]: float(x["n"]) for x in held or ()}
                for w in lexicon:
                    if w in name:
                        n[w] = n.get(w, 0.0) + prior
                words.append(split_word(name, n, total))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["name", "words"]
            )

    return rows.mapInArrow(work, "name string, words array<string>")


def judge(
    pages: DataFrame,
    keep: list[str],
    url: str = "url",
    text: str = "html",
    rules: Sequence[tuple[str, str, str]] = RULES,
    seeds: Sequence[str] = SEEDS,
    common: Sequence[str] = COMMON,
) -> DataFrame:
    """``row`` (struct of ``keep``), host, path, rule, verdict, words and score for each page.

    The verdict is that of the longest rule that fits, else block if the score (log-odds of naive Bayes) is above
    zero. A null url, or one without ``://``, has an empty host and path and no words. Null texts hold no words.
    Repeated rows are judged each. Without seeded pages, or with seeded pages only, the score is that of the smoothed
    shares of the two classes. An empty table gives an empty result.
    """
    host, path = host_and_path(url)
    read = pages.select(pack(keep), host.alias("host"), path.alias("path"))
    read = staged(read.withColumn("owner", F.monotonically_increasing_id()), "urls")
    hosts = read.select("host").distinct()
    names = hosts.select("host", F.posexplode(letters(F.col("host"))).alias("at", "name"))
    distinct = staged(names.select("name").distinct(), "host-names")
    split = split_names(distinct, word_counts(pages, text), sorted({*seeds, *common}))
    host_words = staged(
        names.join(split, "name")
        .groupBy("host")
        .agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
        .select("host", F.flatten(F.col("parts.words")).alias("host_words")),
        "host-words",
    )
    path_words = letters(F.translate("path", UPPER, LOWER))
    worded = read.join(host_words, "host", "left").select(
        "owner", F.concat(F.coalesce("host_words", F.array().cast("array<string>")), path_words).alias("words")
    )
    worded = staged(
        worded.withColumn("seeded", F.arrays_overlap("words", F.array(*map(F.lit, seeds)))), "url-words"
    )
    tokens = worded.select(
        "owner", "seeded", F.explode("words").alias("word")
    ).withColumn("feature", F.pmod(F.xxhash64("word"), F.lit(FEATURES)))
    counts = staged(
        tokens.groupBy("feature").agg(
            F.count_if("seeded").alias("bad"), F.count_if(~F.col("seeded")).alias("good")
        ),
        "url-features",
    )
    bad, good, kinds = counts.agg(F.sum("bad"), F.sum("good"), F.count("*")).first()
    sizes = worded.agg(F.count_if("seeded"), F.count_if(~F.col("seeded"))).first()
    odds = lambda bad, good: math.log((bad + SMOOTH) / (good + SMOOTH))
    others = SMOOTH * max(kinds - 1, 0)
    whole = odds((bad or 0) + others, (good or 0) + others)
    weights = counts.select("feature", (F.log((F.col("bad") + SMOOTH) / (F.col("good") + SMOOTH)) - whole).alias("w"))
    scores = (
        tokens.join(F.broadcast(weights), "feature")  # at most FEATURES rows
        .groupBy("owner")
        .agg(F.sum("w").alias("w"))
    )
    scored = worded.join(scores, "owner", "left").select(
        "owner", "words", (F.coalesce("w", F.lit(0.0)) + odds(*sizes)).alias("score")
    )
    name, verdict = rule_of(rules)
    return read.join(scored, "owner").select(
        "row",
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        "words",
        "score",
    )


@query("op4_url_filters")
def op4_url_filters(spark, folder):
    judged = judge(table(spark, folder, "pages"), ["page_id"])
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "score")
