"""URL filters: rules by host and path, then naive Bayes on words split out of host names.

Host names run words together.  The unigram counts of the pages' visible texts
price every split, and Viterbi finds the cheapest.  The words of host and path
are scored by multinomial naive Bayes; it learns from the pages a rule decides.
Counts, substrings and scores are joined and summed in Spark; nothing that grows
with the pages is gathered or broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foliospark.llm.common import row_key, stored

#: (verdict, host/path); the longest that fits wins.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
#: What is not seen of a page: comments, scripts and styles, other tags, entities.
HIDDEN = (r"(?s)<!--.*?(?:-->|\z)", r"(?is)<(script|style)\b.*?(?:</\1[^>]*>|\z)", r"<[/!?A-Za-z][^>]*(?:>|\z)", r"&#?[A-Za-z0-9]+;")


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parted(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return _lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def visible(html: Column) -> Column:
    """The text of a page, its title included; what is left out parts words."""
    text = F.coalesce(html, F.lit(""))
    for pattern in HIDDEN:
        text = F.regexp_replace(text, pattern, " ")
    return text


def unigrams(pages: DataFrame) -> DataFrame:
    """``word, n``: how often words of ASCII letters stand in the visible texts of ``pages (html)``."""
    words = F.regexp_extract_all(_lower(visible(F.col("html"))), F.lit(r"[a-z]+"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(label: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most likely split; ``known`` counts words by start and end, an unknown word is the rarer the longer it is."""
    best, back = [0.0] + [-math.inf] * len(label), [0] * (len(label) + 1)
    unknown, letter = math.log(10 / max(total, 1)), math.log(10)
    ending: dict[int, list[int]] = {}
    for start, end in sorted(known):
        ending.setdefault(end, []).append(start)
    far = 0  # where the best unknown word begins; letters cost the same anywhere
    for end in range(1, len(label) + 1):
        if best[end - 1] + (end - 1) * letter > best[far] + far * letter:
            far = end - 1
        best[end], back[end] = best[far] + unknown - (end - far) * letter, far
        for start in ending.get(end, ()):
            price = best[start] + math.log(known[start, end] / total)
            if price > best[end]:
                best[end], back[end] = price, start
    words, end = [], len(label)
    while end:
        words.append(label[back[end]:end])
        end = back[end]
    return words[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """``label, words`` for distinct ``labels (label)`` of ASCII letters."""
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    longest = labels.agg(F.max(F.length("label")).alias("n")).first().n or 0
    # Only substrings as long as some word are looked up.
    sizes = sorted(r.n for r in counts.select(F.length("word").alias("n")).where(F.col("n") <= longest).distinct().collect())
    starts = labels.where(F.length("label") > 0).select("label", F.explode(F.sequence(F.lit(0), F.length("label") - 1)).alias("start"))
    cut = starts.select("label", "start", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("size")).where(
        F.col("start") + F.col("size") <= F.length("label")).select(
        "label", "start", (F.col("start") + F.col("size")).alias("end"), F.expr("substring(label, start + 1, size)").alias("word"))
    found = cut.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("start", "end", "n")).alias("found"))
    schema = pa.schema([("label", pa.string()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("label").to_pylist()
            words = [viterbi(name, {(f["start"], f["end"]): f["n"] for f in found or ()}, total)
                     for name, found in zip(names, batch.column("found").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, schema.field(1).type)], schema=schema)

    return labels.where(F.length("label") > 0).join(found, "label", "left").mapInArrow(run, "label string, words array<string>")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` per row of ``pages (page_id, url, html)``.

    ``score`` is the log odds of allow, and decides where no rule fits (0 allows);
    without learnt pages it is 0.  Of a host only runs of ASCII letters are split
    into words and scored, not its digits, hyphens and other letters; of a path
    runs of letters, and of digits as one token.  A null URL or HTML is empty; null ids stay
    null; equal rows give equal results; texts of any length are read whole;
    other columns are not read; an empty table gives an empty result.
    """
    host, path = parted(F.col("url"))
    split = pages.select("page_id", row_key("page_id", "url").alias("row"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    split = stored(split.select("*", rule.alias("rule"), verdict.alias("said")), "urls")
    letters = F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0))
    hosts = split.select("row", "said", F.explode(letters).alias("label"))
    words = stored(segmented(hosts.select("label").distinct(), stored(unigrams(pages), "unigrams")), "segments")
    in_host = hosts.join(words, "label").select("row", "said", F.explode("words").alias("word")).select(
        "row", "said", F.concat(F.lit("host:"), "word").alias("token"))
    in_path = split.select("row", "said", F.explode(F.regexp_extract_all(_lower(F.col("path")), F.lit("[a-z]+|[0-9]+"), F.lit(0))).alias("word")).select(
        "row", "said", F.concat(F.lit("path:"), F.when(F.col("word").rlike("^[0-9]"), F.lit("#")).otherwise(F.col("word"))).alias("token"))
    tokens = stored(in_host.union(in_path), "tokens")
    allow, block = F.col("said") == "allow", F.col("said") == "block"
    seen = stored(tokens.groupBy("token").agg(F.count_if(allow).alias("allowed"), F.count_if(block).alias("blocked")), "counts")
    sums = seen.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"), F.count(F.lit(1)).alias("v")).first()
    pages_said = split.agg(F.count_if(allow).alias("a"), F.count_if(block).alias("b")).first()
    learnt = bool(pages_said.a and pages_said.b)
    prior = math.log(pages_said.a / pages_said.b) if learnt else 0.0
    n_allow, n_block = (sums.a or 0) + sums.v, (sums.b or 0) + sums.v
    odds = F.log((F.col("allowed") + 1.0) / n_allow) - F.log((F.col("blocked") + 1.0) / n_block) if learnt else F.lit(0.0)
    # Repeats of a token in a page are summed before they meet the counts.
    held = tokens.groupBy("row", "token").agg(F.count(F.lit(1)).alias("times"))
    scores = held.join(seen.select("token", odds.alias("odds")), "token").groupBy("row").agg(
        F.sum(F.round(F.col("times") * F.col("odds"), 9).cast("decimal(28,9)")).cast("double").alias("sum"))
    # Equal rows share a key and so their tokens; each has them as often as there are such rows.
    copies = split.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    score = F.lit(prior) + F.coalesce(F.col("sum") / F.col("copies"), F.lit(0.0))
    return split.join(copies, "row").join(scores, "row", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(score >= 0, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"), score.alias("score"))
