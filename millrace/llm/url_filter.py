"""URL filter: rules first, then naive Bayes over the words that host names are made of.

Host names are split into words by a unigram Viterbi search; words and their counts come from the texts of all pages, and those
that are part of a name of some url make the lexicon. A multinomial naive Bayes learns allow and block from all urls that a rule
judges, and judges the rest by host words and path tokens.
"""

from __future__ import annotations

import functools
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Least count in all pages of a word of the lexicon; letters of its longest word.
LEAST, LONGEST = 2, 24
ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a url; empty without `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its action, both null if none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(action)
    return rule, action


def page_words(html: DataFrame, column: str) -> DataFrame:
    """(w, count): the words of all texts without their markup, in one pass."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(f"`{column}`"), F.lit("")), r"(?s)<(script|style)\b.*?</\1>", " "), r"<[^>]*>|&\w+;", " ")
    words = html.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("w")).where(F.length("w").between(2, LONGEST))
    return table(words.groupBy("w").count())


def lexicon_of(words: DataFrame, names: DataFrame, least: int = LEAST) -> dict[str, float]:
    """log10 probabilities of the words of pages that are part of a name (a column), which no other word can be.

    What is collected is bounded by the parts of the distinct names, not by the pages: words in no name leave the lexicon unread.
    """
    total = words.agg(F.sum("count")).first()[0] or 0
    size = F.length("name")
    parts = names.select("name", F.explode(F.sequence(F.lit(1), size - 1)).alias("at"))
    parts = parts.select(F.explode(F.transform(F.sequence(F.lit(2), F.least(F.lit(LONGEST), F.length("name") - F.col("at") + 1)), lambda n: F.substr("name", F.col("at"), n))).alias("w"))
    rows = words.where(F.col("count") >= least).join(parts.distinct(), "w", "left_semi").collect()
    return {r.w: math.log10(r["count"] / total) for r in rows}


class Splitter:
    """The likeliest words of a name. A part that no word covers costs as one unknown word, ten times rarer with each letter."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.unknown = min(lexicon.values(), default=0.0) - 1
        self.split = functools.lru_cache(1 << 16)(self._split)

    def _split(self, name: str) -> tuple[str, ...]:
        best, came = [0.0], [0]
        for j in range(1, len(name) + 1):
            value, at = max((best[i] + self.lexicon.get(name[i:j], self.unknown - (j - i)), -i) for i in range(max(0, j - LONGEST), j))
            best.append(value)
            came.append(-at)
        out, j = [], len(name)
        while j:
            out.append(name[came[j] : j])
            j = came[j]
        return tuple(out[::-1])

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of the host's names, without the last, and of the path; words outside the lexicon are one token, numbers another."""
        out = []
        for kind, names in (("h", re.split(r"[^\w]+|_", host)[:-1]), ("p", re.split(r"[^\w]+|_", path.lower()))):
            for name in names:
                for part in re.findall(r"\d+|[^\W\d]+", name):
                    out += [f"{kind}:#"] if part[0].isdigit() else [f"{kind}:{w if w in self.lexicon else '?'}" for w in self.split(part)]
        return out


def _tokens(lexicon):
    def f(batches):
        own = Splitter(lexicon.value)
        for batch in batches:
            host, path = (batch.column(i).to_pylist() for i in (0, 1))
            yield pa.record_batch([batch.column(2), pa.array([own.tokens(h, p) for h, p in zip(host, path)], pa.list_(pa.string()))], ["action", "tokens"])

    return f


def naive_bayes(counts: dict[tuple[str, str], int], classes: dict[str, int]) -> tuple[float, dict[str, float]]:
    """Log odds of block against allow: of the classes, and of each token, with one added to each count."""
    words = {w for _, w in counts}
    total = {c: sum(n for (k, _), n in counts.items() if k == c) + len(words) + 1 for c in (ALLOW, BLOCK)}
    odds = {w: math.log((counts.get((BLOCK, w), 0) + 1) / total[BLOCK]) - math.log((counts.get((ALLOW, w), 0) + 1) / total[ALLOW]) for w in words}
    return math.log((classes.get(BLOCK, 0) + 1) / (classes.get(ALLOW, 0) + 1)), odds


def _judged(lexicon, model):
    def f(batches):
        own, (prior, odds) = Splitter(lexicon.value), model.value
        for batch in batches:
            tokens = [own.tokens(h, p) for h, p in zip(*(batch.column(i).to_pylist() for i in (1, 2)))]
            score = [prior + sum(odds.get(w, 0.0) for w in t) for t in tokens]
            verdict = [a or (BLOCK if s > 0 else ALLOW) for a, s in zip(batch.column(4).to_pylist(), score)]
            words = [[w[2:] for w in t if w[0] == "h"] for t in tokens]
            yield pa.record_batch([*batch.columns[:4], pa.array(verdict, pa.string()), pa.array(score, pa.float64()), pa.array(words, pa.list_(pa.string()))], ["row", "host", "path", "rule", "verdict", "score", "host_words"])

    return f


def judge_urls(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", rules=RULES, least: int = LEAST) -> DataFrame:
    """row (a struct of the page's id), host, path, rule, verdict, score (log odds of block) and host_words for each row of pages.

    Null urls and urls without `://` have an empty host and path, so only the classes' share judges them. Repeated rows each count
    and each get a row; a very long url is split whole. If no rule judges any url, or the table is empty, every url that is left is allowed. Other columns are not read.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(f"`{url}`"))
    parsed = pages.select(F.struct(F.col(f"`{page_id}`").alias("page_id")).alias("row"), host.alias("host"), path.alias("path"))
    rule, action = matched_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("row", "host", "path", rule.alias("rule"), action.alias("action"))
    names = parsed.select(F.explode(F.concat(*[F.regexp_extract_all(x, F.lit(r"\p{L}{2,}"), F.lit(0)) for x in (F.col("host"), F.lower("path"))])).alias("name")).distinct()
    lexicon = spark.sparkContext.broadcast(lexicon_of(page_words(pages, html), names, least))
    # a host with a third of all rows comes here as a few rows with counts
    labelled = parsed.where("action is not null").groupBy("host", "path", "action").count()
    classes = {r.action: r.n for r in labelled.groupBy("action").agg(F.sum("count").alias("n")).collect()}
    tokens = labelled.select("host", "path", F.struct("action", "count").alias("action")).mapInArrow(_tokens(lexicon), "action struct<action: string, count: long>, tokens array<string>")
    counts = tokens.select("action.*", F.explode("tokens").alias("token")).groupBy("action", "token").agg(F.sum("count").alias("n")).collect()
    model = spark.sparkContext.broadcast(naive_bayes({(r.action, r.token): r.n for r in counts}, classes))
    schema = T.StructType([*parsed.select("row", "host", "path", "rule").schema, *T.StructType.fromDDL("verdict string, score double, host_words array<string>")])
    return parsed.mapInArrow(_judged(lexicon, model), schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every page."""
    found = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("row.page_id", "host", "path", "rule", "verdict", "score", "host_words")
