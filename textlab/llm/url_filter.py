"""Operator 1: URL rules, then naive Bayes over segmented host and path words.

A rule ``host/path`` fits its host and all subdomains where the url's path starts
with the rule's; the longest fitting rule decides (equal lengths: the smaller
text). Every other url gets the method's verdict. Host labels without a separator
are split into words by a unigram Viterbi fold over a relational lattice (see
``lattice``); word counts come from the text of all pages, hyphenated host labels
and paths. Host names that a text mentions are taken out of it first, and a label counts
as a word once for every other host that has it: a label must not vouch for itself.
A multinomial naive Bayes then scores host and path words. It learns
from the urls that a rule decides, by the rule's verdict, and judges the others.

Hosts and paths are reduced to their distinct values before they are split or
scored, and counts are pre-aggregated, so a host with a third of all pages is one
row. Joins back to the pages are left to AQE's skew splitting.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, fits
no rule and has no words; the class prior decides (allow, where the classes are even or no
rule decides any url). Labels of more than 63
characters (no valid DNS label) stay one word, and so do letters of a label that no known words
spell. Repeated rows are judged one by one. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import ascii_lower, let, materialise
from textlab.llm.lattice import edges, viterbi

MAX_LABEL = 63
#: Longer words are counted and scored, but are no pieces of labels.
MAX_WORD = 24
#: Natural logarithm; a letter outside all words costs more than any word.
STRAY_LETTER = -50.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.split("/", 1)[1] if "/" in self.pattern else ""


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; '' both where there is no ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(u, shape, 1)), F.regexp_extract(u, shape, 2)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The deciding rule's pattern and verdict, NULL where none fits."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        pattern = F.when(fits, F.lit(r.pattern)).otherwise(pattern)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return pattern, verdict


def _letters(text: Column, least: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit("[a-z]{%d,}" % least), F.lit(0))


#: Names with a dot between letters or digits, as hosts have.
HOST_LIKE = r"[a-z0-9-]+(?:\.[a-z0-9-]+)+"


def word_counts(pages: DataFrame) -> DataFrame:
    """``piece, n``: words of two letters or more of all pages' text, split labels and paths,
    and labels by the number of other hosts that have them."""
    host, path = url_parts(F.col("url"))
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<[^>]*>|&#?\w+;", " "))
    text = F.regexp_replace(text, HOST_LIKE, " ")
    hyphened = F.array_join(F.filter(F.split(host, r"\."), lambda x: x.contains("-")), " ")
    seen = pages.select(F.explode(_letters(F.concat_ws(" ", text, hyphened, ascii_lower(path)), 2)).alias("piece"))
    labels = (
        pages.select(host.alias("host")).distinct()
        .select("host", F.explode(F.array_distinct(_letters(F.col("host"), 2))).alias("piece"))
        .groupBy("piece").agg((F.count(F.lit(1)) - 1).alias("n")).filter("n > 0")
    )
    counted = seen.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(labels).groupBy("piece").agg(F.sum("n").alias("n"))


def segment_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host, words``: the words of each distinct host, in order."""
    parts = hosts.select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("_pos", "word")).filter("word <> ''")
    labels = parts.select("word").distinct()
    total = counts.agg(F.sum("n").cast("double").alias("_total"))
    known = (
        counts.filter(F.length("piece") <= MAX_WORD)
        .withColumn("id", F.lit(1))
        .withColumn("score", F.log(F.col("n") / F.greatest(F.lit(1.0), F.coalesce(total.scalar(), F.lit(1.0)))))
    )
    lattice = edges(labels.filter(F.length("word") <= MAX_LABEL), known, MAX_WORD)
    path = viterbi(F.col("_edges"), F.length("word"), F.lit(STRAY_LETTER))
    split = lattice.select(
        F.col("word").alias("_word"),
        # known words, and the letters between them together
        F.filter(
            F.split(
                F.array_join(
                    F.transform(
                        path,
                        lambda e: let(
                            F.substring(F.col("word"), e["start"], e["len"]),
                            lambda w: F.when(e["id"].isNotNull(), F.concat(F.lit(" "), w, F.lit(" "))).otherwise(w),
                        ),
                    ),
                    "",
                ),
                " +",
            ),
            lambda w: w != "",
        ).alias("_split"),
    )
    return (
        parts.join(split, F.col("word") == F.col("_word"), "left")
        .groupBy("host")
        .agg(F.collect_list(F.struct("_pos", F.coalesce("_split", F.array("word")).alias("w"))).alias("_all"))
        .select("host", F.flatten(F.transform(F.sort_array("_all"), lambda x: x["w"])).alias("words"))
    )


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` (log odds to block) of every page."""
    host, path = url_parts(F.col("url"))
    pattern, decided = matching_rule(F.col("host"), F.col("path"), rules)
    urls = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("_words", F.array_join(_letters(ascii_lower(F.col("path"))), " "))
        .select("*", pattern.alias("rule"), decided.alias("_decided"))
    )
    # examples of the two classes: what the rules decide
    seen = materialise(
        urls.groupBy("host", "_words").agg(
            F.count_if(F.col("_decided") == "block").alias("b"), F.count_if(F.col("_decided") == "allow").alias("a")
        ),
        "url-shapes",
    )
    # written once: the total and the scores both read the counts
    counts = materialise(word_counts(pages), "word-counts")
    split = segment_hosts(seen.select("host").distinct(), counts).withColumnRenamed("host", "_host")
    shapes = materialise(
        seen.join(split, F.col("host") == F.col("_host"), "left")
        .withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
        .select(
            "host", "_words", "b", "a", F.concat("words", F.array_remove(F.split("_words", " "), "")).alias("tokens")
        ),
        "url-tokens",
    )
    classes = shapes.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("b", "a")],
        *[F.coalesce(F.sum(F.col(c) * F.size("tokens")), F.lit(0)).alias(f"t{c}") for c in ("b", "a")],
    ).first()
    tokens = (
        shapes.select(F.explode("tokens").alias("token"), "b", "a")
        .groupBy("token").agg(F.sum("b").alias("_b"), F.sum("a").alias("_a"))
        .filter("_b + _a > 0")
    )
    vocabulary = tokens.agg(F.count(F.lit(1))).first()[0]
    odds = tokens.select(
        F.col("token").alias("_token"),
        (
            F.log((F.col("_b") + 1.0) / F.lit(float(classes["tb"] + vocabulary)))
            - F.log((F.col("_a") + 1.0) / F.lit(float(classes["ta"] + vocabulary)))
        ).alias("_odds"),
    )
    prior = F.log(F.lit((classes["b"] + 1.0) / (classes["a"] + 1.0)))
    scored = (
        shapes.select("host", "_words", F.explode_outer("tokens").alias("token"))
        .join(odds, F.col("token") == F.col("_token"), "left")
        .groupBy(F.col("host").alias("_h"), F.col("_words").alias("_w"))
        .agg((F.coalesce(F.sum("_odds"), F.lit(0.0)) + prior).alias("score"))
    )
    judged = urls.join(scored, (F.col("host") == F.col("_h")) & (F.col("_words") == F.col("_w")), "left")
    own = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("_decided", own).alias("verdict"), "score"
    )
